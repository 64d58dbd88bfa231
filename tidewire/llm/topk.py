"""Exact BM25 top-k search over sharded inverted indexes with block-max pruning.

Documents are dealt to shards of about `SHARD_DOCS` by a hash of their row. A shard orders its documents by length and
is written with each term's documents (inverted). Document counts and the mean length are global, so scores do
not depend on the shard.

Queries run through a shard `TOGETHER` at a time. A shard is closed for a query if the largest gains of its terms don't
reach the query's floor. Terms in more than 1 / `RARE_SHARE` of the shard are a table of documents, with the largest gain in
every block of `BLOCK_DOCS` documents. The rarer terms are summed up over their postings; the product of queries and
block maxima, with the highest of these sums, bounds what any document of a block can get. The blocks of the highest bounds
come first (`VISIT` documents a query); the k-th best there and the floor close all blocks that are bounded below. In a block that is
open, the product of the queries that it is open to and its part of the table completes the sums. Products have 24 bits;
how far that can be off is added to every bound, and the documents that can be among the k best are scored exactly from
their forward lists. The shards' k best are merged exactly: score rounded to six decimals, then the smaller key.

Shards are searched in rounds, `FIRST_SHARDS` of them, then twice as many, and so on. After a round each query's k-th best
so far is its floor; a shard of the next round returns only what reaches it. So the rows that leave the shards are some k a round
for each query, whatever the number of shards. A round with fewer shards than there are cores deals its queries over several tasks.

Queries are rows themselves; each of a query's distinct terms counts once. They go to the shards in blocks of at
most `QUERY_TERMS` terms (one query at least), collected and broadcast one after the other, as the written index stays where it is.

Terms are words with A-Z in lower case, told apart by 54-bit hashes, so that a hash and its row's place in a batch sort as one number. A null or blank text is found by no query and finds
nothing. Rows with the same key are documents of their own; equal query rows are asked once. An empty table gives an
empty one. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import in_batches, texts
from tidewire.llm.simhash import LOWER
from tidewire.llm.substring import word_hashes
from tidewire.session import cut_lineage, scratch_path

K1, B = 1.2, 0.75
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHARD_DOCS = 1_500
TERM_BITS = 54
BLOCK_DOCS = 64
QUERY_TERMS = 4_000_000
RARE_SHARE = 16
TOGETHER = 256
VISIT = 64
FIRST_SHARDS = 8
DIGITS = 6

FOUND = "query_row bigint, key bigint, score double"


def term_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per document: `key`, `row`, its number of words, distinct `terms` in order and how often each occurs."""
    rows = docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(key, text).alias("row")
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        words, owner = word_hashes([t.translate(LOWER) for t in texts(batch, "text")])
        lengths = np.bincount(owner, minlength=n)
        words = np.sort(owner.astype(np.uint64) << np.uint64(TERM_BITS) | words >> np.uint64(64 - TERM_BITS))
        first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.empty(0, np.int64)
        often = np.diff(np.r_[first, len(words)])
        owner = (words[first] >> np.uint64(TERM_BITS)).astype(np.int64)
        terms = (words[first] & np.uint64((1 << TERM_BITS) - 1)).astype(np.int64)
        offsets = pa.array(np.r_[0, np.cumsum(np.bincount(owner, minlength=n))], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                batch.column("row"),
                pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms)),
                pa.ListArray.from_arrays(offsets, pa.array(often.astype(np.int32))),
            ],
            ["key", "row", "length", "terms", "often"],
        )

    return in_batches(rows, work, "key bigint, row bigint, length bigint, terms array<bigint>, often array<int>")


def document_counts(index: DataFrame) -> DataFrame:
    """(`term`, `n`): in how many documents of all shards each term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, counts in zip(batch.column("names"), batch.column("counts"), strict=True):
                term, n = np.frombuffer(names.as_buffer(), dtype=np.int64), np.frombuffer(counts.as_buffer(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64())], ["term", "n"])

    return index.select("names", "counts").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def build_shards(terms: DataFrame, shards: int) -> DataFrame:
    """One row per shard: its documents by length, and the documents of each of its terms, as bytes."""

    def build(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("length", "ascending"), ("key", "ascending"), ("row", "ascending")]).combine_chunks()
        lists = shard.column("terms")
        owner = np.repeat(np.arange(shard.num_rows, dtype=np.int32), pa.compute.list_value_length(lists).to_numpy())
        flat = pa.compute.list_flatten(lists).to_numpy().astype(np.int64)
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        data = {
            "keys": shard.column("key").fill_null(0).to_numpy().astype(np.int64),
            "no_key": shard.column("key").is_null().to_numpy().astype(np.int8),
            "lengths": shard.column("length").to_numpy().astype(np.int64),
            "names": flat[order][first],
            "counts": np.diff(first, append=len(flat)).astype(np.int64),
            "docs": owner[order],
            "often": pa.compute.list_flatten(shard.column("often")).to_numpy().astype(np.int32)[order],
        }
        number = shard.column("shard")[0].as_py()
        sums = {"shard": pa.array([number], pa.int64()), "n_docs": pa.array([shard.num_rows], pa.int64()), "words": pa.array([int(data["lengths"].sum())], pa.int64())}
        return pa.table(sums | {name: pa.array([values.tobytes()], pa.binary()) for name, values in data.items()})

    schema = "shard bigint, n_docs bigint, words bigint, keys binary, no_key binary, lengths binary, names binary, counts binary, docs binary, often binary"
    dealt = terms.filter("length > 0").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(build, schema)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class Queries:
    """A block of queries: the terms of all, in order and with their weights, and each query's places among them."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, idf: np.ndarray, places: np.ndarray, begin: np.ndarray):
        self.rows, self.terms, self.idf, self.places, self.begin = rows, terms, idf, places, begin

    @classmethod
    def of(cls, block: pa.Table, n_docs: int) -> Queries:
        block = block.combine_chunks()
        counts = pa.compute.list_flatten(block.column("counts")).to_numpy()
        terms, first, places = np.unique(pa.compute.list_flatten(block.column("terms")).to_numpy(), return_index=True, return_inverse=True)
        idf = np.log(1 + (n_docs - counts[first] + 0.5) / (counts[first] + 0.5))
        sizes = pa.compute.list_value_length(block.column("terms")).to_numpy()
        return cls(block.column("row").to_numpy(), terms, idf, places.astype(np.int32), np.r_[0, np.cumsum(sizes)])

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.rows, self.terms, self.idf, self.places, self.begin


class Shard:
    """What a shard has of the terms of a block of queries."""

    def __init__(self, row: dict, mean_length: float, queries: Queries):
        def read(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(row[name], dtype=kind)

        self.keys, self.no_key = read("keys", np.int64), read("no_key", np.int8).astype(bool)
        self.n = len(self.keys)
        self.blocks = -(-self.n // BLOCK_DOCS)
        names, counts = read("names", np.int64), read("counts", np.int64)
        at = np.minimum(np.searchsorted(queries.terms, names), len(queries.terms) - 1)
        asked = np.flatnonzero(queries.terms[at] == names)
        #: From the place of a term among those of the queries to its number here.
        self.number = np.full(len(queries.terms), -1, dtype=np.int32)
        self.number[at[asked]] = np.arange(len(asked))
        self.sizes = counts[asked]
        places = ranges((np.cumsum(counts) - counts)[asked], self.sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.docs, often = read("docs", np.int32)[places], read("often", np.int32)[places].astype(np.float64)
        norm = K1 * (1 - B + B * read("lengths", np.int64) / mean_length)
        term = np.repeat(np.arange(len(asked), dtype=np.int32), self.sizes)
        self.gains = queries.idf[at[asked]][term] * (often * (K1 + 1) / (often + norm[self.docs]))
        self.most = np.maximum.reduceat(self.gains, self.starts) if len(asked) else np.empty(0)
        # Forward lists, terms in order.
        order = np.argsort(self.docs.astype(np.uint16) if self.n < 1 << 16 else self.docs, kind="stable")
        self.forward_term, self.forward_gain = term[order], self.gains[order]
        self.begin = np.r_[0, np.cumsum(np.bincount(self.docs, minlength=self.n))]
        self.in_query = np.zeros(len(asked))
        # Frequent terms as a table of documents, and its block maxima.
        frequent = np.flatnonzero(self.sizes > self.n // RARE_SHARE)
        self.column = np.full(len(asked), -1, dtype=np.int32)
        self.column[frequent] = np.arange(len(frequent))
        places = ranges(self.starts[frequent], self.sizes[frequent])
        self.table = np.zeros((len(frequent), self.blocks * BLOCK_DOCS), dtype=np.float32)
        self.table[self.column[term[places]], self.docs[places]] = self.gains[places]
        self.block_most = self.table.reshape(len(frequent), self.blocks, BLOCK_DOCS).max(axis=2)
        # More than sums of so many numbers of 24 bits can be off, as a share of them.
        self.off = (len(frequent) + 8) * 2.0**-23

    def exact(self, docs: np.ndarray) -> np.ndarray:
        """Scores from the forward lists, for the query that is set in `in_query`."""
        sizes = self.begin[docs + 1] - self.begin[docs]
        at = ranges(self.begin[docs], sizes)
        values = self.in_query[self.forward_term[at]] * self.forward_gain[at]
        return np.round(np.add.reduceat(values, np.cumsum(sizes) - sizes), DIGITS)

    def search_some(self, queries: Queries, which: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """`search` for the queries of a block that the largest gains of their terms don't close the shard for."""
        sizes = queries.begin[which + 1] - queries.begin[which]
        terms = self.number[queries.places[ranges(queries.begin[which], sizes)]]
        owner = np.repeat(np.arange(len(which)), sizes)[terms >= 0]
        terms = terms[terms >= 0]
        most = np.bincount(owner, self.most[terms], minlength=len(which))
        open_ = (most > 0) & (most >= floors[which] - 10**-DIGITS)
        stays = open_[owner]
        owner, which = (np.cumsum(open_) - 1)[owner[stays]], which[open_]
        if not len(which):
            return
        for query, docs, scores in self.search(terms[stays], owner, floors[which], k):
            yield which[query], docs, scores

    def _add(self, sums: np.ndarray, wanted: np.ndarray, open_: np.ndarray) -> None:
        """Adds the gains of frequent terms in the blocks that are open to each query."""
        for block in np.flatnonzero(open_.any(axis=0)):
            asks = np.flatnonzero(open_[:, block])
            table = self.table[:, block * BLOCK_DOCS : (block + 1) * BLOCK_DOCS]
            sums[asks, block] += (wanted if len(asks) == len(wanted) else wanted[asks]) @ table

    def search(self, terms: np.ndarray, owner: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For queries with documents that score their floor or more: the query's number, its k best of these, and their scores.

        `terms` are numbers of terms, `owner` the query that has each, in order.
        """
        # Ties with the k-th are looked at, too: the smaller key wins.
        slack, m, width = 10**-DIGITS, len(floors), self.blocks * BLOCK_DOCS
        least = floors - slack
        column = self.column[terms]
        rare = column < 0
        wanted = np.zeros((m, len(self.table)), dtype=np.float32)
        wanted[owner[~rare], column[~rare]] = 1
        sizes = self.sizes[terms[rare]]
        places = ranges(self.starts[terms[rare]], sizes)
        cells = np.repeat(owner[rare] * width, sizes) + self.docs[places]
        # Without any, counts would be whole numbers.
        sums = np.bincount(cells, self.gains[places], minlength=m * width).astype(np.float64, copy=False).reshape(m, width)
        bounds = (wanted @ self.block_most) * (1 + self.off) + sums.reshape(m, self.blocks, BLOCK_DOCS).max(axis=2)
        open_ = (bounds > 0) & (bounds >= least[:, None])
        # Blocks of the largest bounds come first; the k-th best of their documents may close others.
        first = min(-(-VISIT // BLOCK_DOCS), self.blocks)
        seen = np.zeros_like(open_)
        np.put_along_axis(seen, np.argpartition(-bounds, first - 1, axis=1)[:, :first], True, axis=1)
        by_block = sums.reshape(m, self.blocks, BLOCK_DOCS)
        seen &= open_
        self._add(by_block, wanted, seen)
        if first * BLOCK_DOCS >= k:
            full = np.flatnonzero(seen.sum(axis=1) == first)
            visited = by_block[full][seen[full]].reshape(len(full), first * BLOCK_DOCS)
            kth = np.partition(visited, -k, axis=1)[:, -k]
            least[full] = np.maximum(least[full], kth * (1 - self.off) - slack)
            open_ &= bounds >= least[:, None]
        self._add(by_block, wanted, open_ & ~seen)
        by_block[~(open_ | seen)] = 0
        sums *= 1 + self.off
        reach = (sums > 0) & (sums >= least[:, None])
        many = np.flatnonzero(reach.sum(axis=1) > k)
        if len(many):
            kth = np.partition(sums[many], width - k, axis=1)[:, width - k]
            reach[many] &= sums[many] >= (kth * (1 - 2 * self.off) - slack)[:, None]
        ends = np.searchsorted(owner, np.arange(m + 1))
        query, doc = np.nonzero(reach)
        cuts = np.searchsorted(query, np.arange(m + 1))
        for i in np.flatnonzero(np.diff(cuts)):
            docs, own = doc[cuts[i] : cuts[i + 1]], terms[ends[i] : ends[i + 1]]
            self.in_query[own] = 1
            scores = self.exact(docs)
            self.in_query[own] = 0
            order = np.lexsort((self.keys[docs], self.no_key[docs], -scores))[:k]
            order = order[scores[order] >= floors[i]]
            if len(order):
                yield i, docs[order], scores[order]


def search_round(shards: DataFrame, queries: Queries, floors: np.ndarray, mean_length: float, k: int) -> DataFrame:
    """(`query_row`, `key`, `score`) of each shard's k best that reach the floor, for a block of queries.

    `slice` and `slices` of a shard's row say which of the queries are its.
    """
    # Arrays only: a broadcast can't hold what needs this package to be read, as executors may not have it.
    sent = shards.sparkSession.sparkContext.broadcast((queries.arrays(), floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                arrays, floors = sent.value
                asked = Queries(*arrays)
                shard = Shard(row, mean_length, asked)
                rows, docs, scores = [], [], []
                own = np.arange(row["slice"], len(floors), row["slices"])
                for at in range(0, len(own), TOGETHER):
                    for query, found, score in shard.search_some(asked, own[at : at + TOGETHER], floors, k):
                        rows.append(np.full(len(found), asked.rows[query]))
                        docs.append(found)
                        scores.append(score)
                if rows:
                    found = np.concatenate(docs)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(rows), pa.int64()),
                            pa.array(shard.keys[found], pa.int64(), mask=shard.no_key[found]),
                            pa.array(np.concatenate(scores), pa.float64()),
                        ],
                        ["query_row", "key", "score"],
                    )

    return shards.mapInArrow(run, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, with `rank`."""
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search_rounds(index: DataFrame, rounds: int, queries: Queries, mean_length: float, k: int) -> DataFrame:
    """The k best of all shards for a block of queries."""
    spark, kept = index.sparkSession, None
    asked = queries.rows
    floors, cores = np.zeros(len(asked)), spark.sparkContext.defaultParallelism
    order = np.argsort(asked)
    for n in range(rounds):
        slices = max(1, -(-cores // (FIRST_SHARDS << n)))
        shards = index.filter(F.col("round") == n).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        shards = shards.withColumn("slices", F.lit(slices))
        if slices > 1:
            shards = shards.repartition(slices * FIRST_SHARDS << n, "shard", "slice")
        found = search_round(shards, queries, floors, mean_length, k)
        if kept is not None:
            found = found.unionByName(kept.drop("rank"))
        kept = cut_lineage(best_of(found, k), "found")
        # One number per query of the block.
        last = kept.filter(F.col("rank") == k).select("query_row", "score").toArrow()
        at = order[np.searchsorted(asked, last.column("query_row").to_numpy(), sorter=order)]
        floors[at] = last.column("score").to_numpy()
    return kept


def top_k(docs: DataFrame, is_query: Column, k: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(`query_id`, `rank`, key, `score`) of the k best documents for each query row."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], f"query_id bigint, rank int, {key} bigint, score double")
    n_rows = docs.count()
    if not n_rows:
        return empty
    n_shards = -(-n_rows // SHARD_DOCS)
    built = build_shards(term_rows(docs, key, text), n_shards)
    # Round n has the shards from FIRST_SHARDS * (2 ^ n - 1) on.
    path = scratch_path(spark, "index")
    by_round = built.withColumn("round", F.floor(F.log2(F.floor(F.col("shard") / FIRST_SHARDS) + 1)).cast("int"))
    by_round.write.partitionBy("round").parquet(path)
    index = spark.read.schema(by_round.schema).parquet(path)
    rounds = ((n_shards - 1) // FIRST_SHARDS + 1).bit_length()
    n_docs, words = index.agg(F.sum("n_docs"), F.sum("words")).first()
    asked = cut_lineage(term_rows(docs.filter(is_query), key, text).filter("length > 0").dropDuplicates(["row"]), "queries")
    per_term = asked.select("row", F.explode("terms").alias("term")).join(document_counts(index), "term")
    counted = cut_lineage(
        per_term.groupBy("row").agg(F.collect_list("term").alias("terms"), F.collect_list("n").alias("counts")), "query-terms"
    )
    parts = []
    # A shard is one long row; rows are handed over one by one while the blocks run.
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, "1")
    try:
        for low, high in _blocks(counted):
            block = counted.filter(F.col("row").between(low, high)).toArrow()
            if block.num_rows:
                parts.append(search_rounds(index, rounds, Queries.of(block, n_docs), words / n_docs, k))
    finally:
        spark.conf.set(ARROW_ROWS, before)
    if not parts:
        return empty
    merged = reduce(DataFrame.unionAll, parts)
    names = asked.select(F.col("row").alias("query_row"), F.col("key").alias("query_id"))
    return merged.join(names, "query_row").select("query_id", "rank", F.col("key").alias(key), "score")


def _blocks(counted: DataFrame) -> list[tuple[int, int]]:
    """Ranges of query rows of about `QUERY_TERMS` terms each; rows are hashes, so equal ranges hold equal shares."""
    total = counted.agg(F.sum(F.size("terms"))).first()[0]
    if not total:
        return []
    n = -(-total // QUERY_TERMS)
    edges = [-(1 << 63) + (i << 64) // n for i in range(n + 1)]
    return [(a, b - 1) for a, b in zip(edges, edges[1:], strict=False)]
