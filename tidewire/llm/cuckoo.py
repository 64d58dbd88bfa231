"""Exact duplicates by an index of cuckoo filters.

A text's digest is its SHA-256. The index holds the live digests in shards by their leading bits. A shard is a cuckoo
filter, buckets of four 16-bit marks, and beside each mark the bucketed content: the whole digest, the number of rows
that have it and the row that stays. A look-up reads the marks of a digest's two buckets; only a mark that matches is
verified against the content, so a false hit costs a comparison and never a result. A full bucket moves a mark to its
other bucket; when moves run out, the shard doubles and is filled again from the stored digests. Removing a row lowers
its digest's count, and a digest without rows leaves the filter.

Each task first dedups its own rows in a filter of its own, so a group of copies reaches its shard as one entry a
task, whatever its size. Shards are merged side by side, with about `SHARD_KEYS` digests each. What the index knows is
joined back to the rows by digest: a group with more than one in `HEAVY_SHARE` of all rows is one of fewer than
`HEAVY_SHARE` such groups, which are broadcast; no other group can crowd a task.

Of equal texts the row with the largest key stays; a null key is smaller than any, and of rows with the same key the
one first in the written order stays. A null text is an empty one. An empty table gives an empty one. Only the named
columns are read; the key is an integer column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.session import cut_lineage

SLOTS = 4
FIRST_BUCKETS = 64
MOVES = 200
LOAD = 0.9
# Digests of a task's own filter, beyond which it is handed on, and of a shard.
TASK_KEYS = 1 << 16
SHARD_KEYS = 1 << 12
HEAVY_SHARE = 1 << 12

ENTRY = "digest binary, n bigint, top bigint, known boolean, row bigint"
FIELDS = ("digest", "n", "top", "known", "row")


class Filter:
    """Marks in buckets, and the content that they stand for."""

    def __init__(self, buckets: int = FIRST_BUCKETS) -> None:
        self.size, self.resizes = 0, 0
        self._make(buckets)

    def _make(self, buckets: int) -> None:
        self.buckets = buckets
        self.marks = np.zeros((buckets, SLOTS), np.uint16)
        self.content = np.zeros((buckets, SLOTS, 4), "<u8")
        self.n, self.top, self.row = (np.zeros((buckets, SLOTS), np.int64) for _ in range(3))
        self.known = np.zeros((buckets, SLOTS), bool)

    # --- places ---------------------------------------------------------------------------------

    def _mark(self, keys: np.ndarray) -> np.ndarray:
        """16 bits of the digest, never 0, which is an empty slot."""
        return np.maximum(keys[:, 1] & np.uint64(0xFFFF), 1).astype(np.uint16)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys[:, 2] & np.uint64(self.buckets - 1)).astype(np.int64)

    def _other(self, bucket: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The second place; from there the same rule leads back."""
        spread = (marks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return bucket ^ (spread & np.uint64(self.buckets - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place (bucket * SLOTS + slot) of each digest, -1 if it isn't live."""
        found = np.full(len(keys), -1, np.int64)
        marks = self._mark(keys)
        first = self._first(keys)
        for bucket in (first, self._other(first, marks)):
            asked, slot = np.nonzero((self.marks[bucket] == marks[:, None]) & (found < 0)[:, None])
            same = (self.content[bucket[asked], slot] == keys[asked]).all(axis=1)
            found[asked[same]] = bucket[asked[same]] * SLOTS + slot[same]
        return found

    # --- changes --------------------------------------------------------------------------------

    def insert(self, entries: tuple[np.ndarray, ...]) -> None:
        """Entries (digests, counts, keys, keys known, rows); live digests grow, the others become live."""
        entries = grouped(entries)
        keys, n, top, known, row = entries
        place = self.find(keys)
        old = place >= 0
        at = np.unravel_index(place[old], self.marks.shape)
        self.n[at] += n[old]
        wins = later((known[old], top[old], row[old]), (self.known[at], self.top[at], self.row[at]))
        at = tuple(a[wins] for a in at)
        self.top[at], self.known[at], self.row[at] = top[old][wins], known[old][wins], row[old][wins]
        self._add(tuple(e[~old] for e in entries))

    def remove(self, keys: np.ndarray, n: np.ndarray) -> None:
        """Takes so many rows from each digest (all different); one without rows left leaves its bucket."""
        place = self.find(keys)
        at = np.unravel_index(place[place >= 0], self.marks.shape)
        self.n[at] -= n[place >= 0]
        gone = self.n[at] <= 0
        self.marks[tuple(a[gone] for a in at)] = 0
        self.size -= int(gone.sum())

    def entries(self) -> tuple[np.ndarray, ...]:
        at = np.nonzero(self.marks)
        return self.content[at], self.n[at], self.top[at], self.known[at], self.row[at]

    def _put(self, at: tuple, marks: np.ndarray, entries: tuple) -> None:
        self.marks[at] = marks
        self.content[at], self.n[at], self.top[at], self.known[at], self.row[at] = entries

    def _add(self, entries: tuple[np.ndarray, ...]) -> None:
        if self.size + len(entries[0]) > LOAD * self.buckets * SLOTS:
            return self._resize(entries)
        marks = self._mark(entries[0])
        bucket = self._first(entries[0])
        placed, move = len(marks), 0
        while len(marks):
            # The first free slots of each bucket go to its first askers.
            order = np.argsort(bucket, kind="stable")
            entries, marks, bucket = tuple(e[order] for e in entries), marks[order], bucket[order]
            rank = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            free = self.marks[bucket] == 0
            fits = rank < free.sum(axis=1)
            slot = np.argmax(np.cumsum(free, axis=1) == rank[:, None] + 1, axis=1)
            self._put((bucket[fits], slot[fits]), marks[fits], tuple(e[fits] for e in entries))
            entries, marks, bucket, rank = tuple(e[~fits] for e in entries), marks[~fits], bucket[~fits], rank[~fits]
            move += 1
            if move > MOVES:
                self.size += placed - len(marks)
                return self._resize(entries)
            if move > 1:
                # Of a full bucket's askers one takes the place of a mark, which goes on to its other bucket.
                full = np.unique(bucket, return_index=True)[1]
                full = full[(self.marks[bucket[full]] != 0).all(axis=1)]
                at = (bucket[full], np.full(len(full), move % SLOTS))
                out_marks = self.marks[at]
                out = (self.content[at], self.n[at], self.top[at], self.known[at], self.row[at])
                self._put(at, marks[full], tuple(e[full] for e in entries))
                for e, o in zip(entries, out, strict=True):
                    e[full] = o
                marks[full] = out_marks
            bucket = self._other(bucket, marks)
        self.size += placed
        return None

    def _resize(self, waiting: tuple[np.ndarray, ...]) -> None:
        """Twice the buckets, or as many as all digests need, filled from the stored ones."""
        held = self.entries()
        every = tuple(np.concatenate(both) for both in zip(held, waiting, strict=True))
        buckets = self.buckets * 2
        while len(every[0]) > LOAD * buckets * SLOTS:
            buckets *= 2
        self.resizes += 1
        self._make(buckets)
        self.size = 0
        self._add(every)


def later(mine: tuple, theirs: tuple) -> np.ndarray:
    """Where my row (key known, key, row) stays and theirs goes."""
    known, top, row = (a == b for a, b in zip(mine, theirs, strict=True))
    return (mine[0] & ~theirs[0]) | (known & ((mine[1] > theirs[1]) | (top & ~row & (mine[2] < theirs[2]))))


def grouped(entries: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """One entry per digest: counts summed up, the row that stays."""
    keys, n, top, known, row = entries
    if not len(keys):
        return entries
    order = np.lexsort((-row, top, known, keys[:, 3], keys[:, 2], keys[:, 1], keys[:, 0]))
    keys = keys[order]
    ends = np.r_[(keys[1:] != keys[:-1]).any(axis=1), True]
    begins = np.r_[0, np.flatnonzero(ends)[:-1] + 1]
    last = order[ends]
    return keys[ends], np.add.reduceat(n[order], begins), top[last], known[last], row[last]


# --- batches ------------------------------------------------------------------------------------


def digests(column: pa.Array) -> np.ndarray:
    """Digests of 32 bytes as four numbers each."""
    return np.frombuffer(bytearray(b"".join(column.to_pylist())), "<u8").reshape(-1, 4) if len(column) else np.zeros((0, 4), "<u8")


def read_entries(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, ...]:
    top = batch.column("top")
    return (
        digests(batch.column("digest")),
        batch.column("n").to_numpy().astype(np.int64),
        top.fill_null(0).to_numpy().astype(np.int64),
        top.is_valid().to_numpy(zero_copy_only=False) if isinstance(top, pa.Array) else top.is_valid().to_numpy(),
        batch.column("row").to_numpy().astype(np.int64),
    )


def write_entries(entries: tuple[np.ndarray, ...], **more) -> pa.RecordBatch:
    keys, n, top, known, row = entries
    data = keys.astype("<u8").tobytes()
    columns = {
        "digest": pa.array([data[i : i + 32] for i in range(0, len(data), 32)], pa.binary()),
        "n": pa.array(n),
        "top": pa.array(top, mask=~known),
        "known": pa.array(known),
        "row": pa.array(row),
    }
    return pa.RecordBatch.from_pydict(more | columns)


# --- on Spark -----------------------------------------------------------------------------------


def digested(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(`top` the key, `digest`, `row`), written: `row` numbers the rows and stays the same from here on."""
    rows = docs.select(
        F.col(key).cast("bigint").alias("top"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    return cut_lineage(rows, "digests")


def _per_task(rows: DataFrame) -> DataFrame:
    """Entries of each task's rows, one per digest as long as the task's filter has room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Filter()
        for batch in batches:
            if batch.num_rows:
                held.insert(read_entries(batch))
            if held.size > TASK_KEYS:
                yield write_entries(held.entries())
                held = Filter()
        if held.size:
            yield write_entries(held.entries())

    return rows.select("digest", F.lit(1).cast("bigint").alias("n"), "top", "row").mapInArrow(run, ENTRY)


def _shards(n: int) -> int:
    """A power of two, so that a shard is a number of leading bits."""
    return 1 << max(0, (n // SHARD_KEYS).bit_length())


def _sharded(entries: DataFrame, shards: int) -> DataFrame:
    bits = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
    return entries.withColumn("shard", F.pmod(bits, F.lit(shards)))


def build(rows: DataFrame) -> DataFrame:
    """The index of the rows from `digested`: an entry per live digest, written."""
    return merge(cut_lineage(_per_task(rows), "entries"))


def merge(entries: DataFrame) -> DataFrame:
    """One entry per digest: each shard's entries go into its filter."""

    def work(table: pa.Table) -> pa.Table:
        held = Filter()
        for batch in table.to_batches(max_chunksize=TASK_KEYS):
            held.insert(read_entries(batch))
        return pa.Table.from_batches([write_entries(held.entries())])

    merged = _sharded(entries, _shards(entries.count())).groupBy("shard").applyInArrow(work, ENTRY)
    return cut_lineage(merged, "index")


def insert(index: DataFrame, rows: DataFrame) -> DataFrame:
    """The index with more rows, numbered apart from those that it has."""
    return merge(cut_lineage(index.select(*FIELDS).unionByName(_per_task(rows).select(*FIELDS)), "entries"))


def remove(index: DataFrame, gone: DataFrame, live: DataFrame) -> DataFrame:
    """The index without the rows `gone`; `live` are all rows that are left.

    A digest whose staying row went gets the largest of those left.
    """
    taken = cut_lineage(build(gone).withColumn("live", F.lit(False)).unionByName(index.select(*FIELDS).withColumn("live", F.lit(True))), "entries")

    def work(table: pa.Table) -> pa.Table:
        live = table.column("live").combine_chunks()
        held = Filter()
        held.insert(read_entries(table.filter(live).combine_chunks()))
        keys, n, *_ = read_entries(table.filter(pc.invert(live)).combine_chunks())
        held.remove(keys, n)
        return pa.Table.from_batches([write_entries(held.entries())])

    left = cut_lineage(_sharded(taken, _shards(taken.count())).groupBy("shard").applyInArrow(work, ENTRY), "index")
    # Only digests whose staying row went need the rows that are left.
    lost = left.join(gone.select("digest", "row"), ["digest", "row"], "left_semi").select("digest")
    heirs = build(cut_lineage(live.join(lost, "digest", "left_semi"), "heirs"))
    fresh = left.join(lost, "digest", "left_anti").select(*FIELDS).unionByName(heirs.select(*FIELDS))
    return cut_lineage(fresh, "index")


def look_up(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Adds to rows (`digest`, ...) what the index has: `group_size`, `keep` the staying row's key and `keep_row`."""
    answers = index.select("digest", F.col("n").alias("group_size"), F.col("top").alias("keep"), F.col("row").alias("keep_row"))
    bound = -(-(index.agg(F.sum("n")).first()[0] or 0) // HEAVY_SHARE)
    heavy = answers.filter(F.col("group_size") > bound)
    first = rows.join(F.broadcast(heavy), "digest", "left")
    met = cut_lineage(first, "looked-up")
    rest = met.filter("keep_row IS NULL").select(*rows.columns)
    others = answers.filter(F.col("group_size") <= bound)
    return met.filter("keep_row IS NOT NULL").unionByName(rest.join(others, "digest"))


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, `keep_id`, `group_size`, `kept` and `text_sha256`."""
    rows = digested(docs, key, text)
    found = look_up(rows, build(rows))
    return found.select(
        F.col("top").alias(key),
        F.col("keep").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
