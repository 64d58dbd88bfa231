"""Phrase collocations per language, mined by direct-address tiling.

Texts are cut into chunks of one language and about `CHUNK` words, held as arrays of numbers with -1 between pieces. A
round counts the pairs of neighbours in all chunks, keeps the pairs that occur `LEAST` times or more, numbers them by
frequency, and replaces each place of a chunk by the number of the pair that begins there. Round one numbers words; as
a phrase occurs no more often than its parts, the neighbours of round two's numbers are the candidates of three words,
those of round three's the candidates of four: each phrase of m words is a pair of phrases of m - 1 words that overlap.

Counting goes by tiles. Number n is rank n // R of residue n % R, and the tile of a pair (a, b) is (a % R, b % R) with
the cell (a // R, b // R). So every tile has the same mix of frequent and rare pairs, none is hot, and in each the
frequent ones lie in the corner, ranks under `DENSE`: these are counted directly, in a dense array with `bincount`; the
sparse rest is counted as sorted coordinates. A chunk is counted by itself first, so a pair of any frequency reaches
its tile as one entry a chunk. R grows with the input so that a tile's entries stay near `TILE_ENTRIES`. A tile numbers
its frequent pairs by rank, number = rank * tiles + tile, which needs no order of all pairs, and tells the chunks that
they came from. What chunks know of words travels as arrays of bytes; the words themselves stay with the candidates.

Counts are exact: dense corners and sorted entries are summed up as 64-bit integers, scores are computed as decimals.
A null language is `und`, a null text is empty; repeated rows count twice; an empty table gives an empty one. Only the
named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import texts
from tidewire.session import cut_lineage

LEAST = 30
LONGEST = 4
# A longer phrase takes a part's place from so many hundredths of its count on.
SHARE = 80
SCALE = 2_000_000
TOP = 2_000

CHUNK = 1 << 18
# Bytes of a text that are split into words at a time.
SLICE = 1 << 20
# Words waiting in a task for their chunk to fill, over all languages.
WAITING = 1 << 21
TILE_ENTRIES = 1 << 21
DENSE = 512
UNDETERMINED = "und"

# UTF-8 bytes: A-Z to lower case, tab to space, the ends of pieces to a byte that UTF-8 never has.
END = b"\xff"
BYTES = bytes(255 if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

# `numbers` of a chunk; `keys` and `counts` of one chunk for one tile.
ROW = "chunk string, lang string, numbers binary, tile bigint, keys binary, counts binary"
# `found` of a tile: `left` and `right` of a pair, or a word, with its number and count; `keys` and `numbers` for a chunk.
FOUND = "lang string, chunk string, numbers binary, keys binary, word binary, left bigint, right bigint, number bigint, n bigint"


def words_of(text: str) -> Iterator[list[bytes]]:
    """The text's words in slices, with `END` after each piece."""
    data = text.encode().translate(BYTES).replace(END, b" \xff ") + b" \xff"
    begin = 0
    while begin < len(data):
        end = data.find(b" ", begin + SLICE)
        end = len(data) if end < 0 else end
        yield data[begin:end].split()
        begin = end


def pack(numbers: np.ndarray) -> bytes:
    """Bytes of the numbers, the low ones of all first: most of the high ones are equal and take no space on the way."""
    wide = np.ascontiguousarray(numbers, "<i8")
    size = max(1, (int(wide.max(initial=0)).bit_length() + 8) // 8) if wide.min(initial=0) >= -1 else 8
    planes = wide.view(np.uint8).reshape(-1, 8)[:, :size].T
    return bytes([size]) + planes.tobytes()


def unpack(data: bytes) -> np.ndarray:
    size = data[0]
    planes = np.frombuffer(data, np.uint8)[1:].reshape(size, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :size] = planes.T
    if size < 8:
        wide[:, size:] = np.where(planes[-1] >= 128, 255, 0)[:, None]
    return wide.reshape(-1).view("<i8")


def batch_of(schema: str, rows: list[dict]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_pydict({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in fields})


def table_of(schema: str, rows: list[dict]) -> pa.Table:
    return pa.Table.from_batches([batch_of(schema, rows)])


def sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts added up by key, keys ascending."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts[order], first)


# --- chunks -------------------------------------------------------------------------------------


class Numbering(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Chunk:
    """A chunk in the making: its words numbered, END as -1."""

    def __init__(self) -> None:
        self.own, self.parts, self.size = Numbering(), [], 0

    def add(self, text: str) -> int:
        before = self.size
        for words in words_of(text):
            numbers = np.fromiter(map(self.own.__getitem__, words), np.int32, len(words))
            self.parts.append(numbers)
            self.size += len(numbers)
        return self.size - before

    def rows(self, chunk: str, lang: str, tiles: int) -> Iterator[dict]:
        numbers = np.concatenate(self.parts).astype(np.int64)
        end = self.own[END]
        counts = np.bincount(numbers, minlength=len(self.own))
        numbers[numbers == end] = -1
        yield {"chunk": chunk, "lang": lang, "numbers": pack(numbers)}
        by_tile: dict[int, list] = {}
        for word, number in self.own.items():
            if number != end:
                by_tile.setdefault(zlib.crc32(word) % tiles, []).append((word, number))
        for tile, found in by_tile.items():
            at = np.array([number for _, number in found])
            yield {
                "chunk": chunk, "lang": lang, "tile": tile, "keys": b" ".join(word for word, _ in found),
                "numbers": pack(at), "counts": pack(counts[at]),
            }


def chunks(docs: DataFrame, tiles: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """Chunks numbered by their own words, and their words for each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, Chunk] = {}
        made, held = 0, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for found, value in zip(batch.column(lang).to_pylist(), texts(batch, text), strict=True):
                key = UNDETERMINED if found is None else found
                held += waiting.setdefault(key, Chunk()).add(value)
                while waiting and (held > WAITING or waiting.get(key, Chunk()).size >= CHUNK):
                    full = key if waiting.get(key, Chunk()).size >= CHUNK else max(waiting, key=lambda k: waiting[k].size)
                    held -= waiting[full].size
                    yield batch_of(ROW, list(waiting.pop(full).rows(f"{part}-{made}", full, tiles)))
                    made += 1
        for key, rest in waiting.items():
            yield batch_of(ROW, list(rest.rows(f"{part}-{made}", key, tiles)))
            made += 1

    return docs.select(text, lang).mapInArrow(run, ROW)


# --- tiles --------------------------------------------------------------------------------------


def ranked(tile: int, tiles: int, counts: np.ndarray) -> np.ndarray:
    """Numbers of a tile's frequent keys: the more frequent, the smaller."""
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    return rank * tiles + tile


def word_tile(table: pa.Table, tiles: int, least: int) -> pa.Table:
    """A tile's frequent words, and for each chunk the numbers of those that it has."""
    rows = table.to_pylist()
    lang, tile = rows[0]["lang"], rows[0]["tile"]
    words = [r["keys"].split(b" ") for r in rows]
    own = Numbering()
    keys = [np.fromiter(map(own.__getitem__, w), np.int64, len(w)) for w in words]
    n = sums(np.concatenate(keys), np.concatenate([unpack(r["counts"]) for r in rows]))[1]
    frequent = np.flatnonzero(n >= least)
    number = np.full(len(n), -1, np.int64)
    number[frequent] = ranked(tile, tiles, n[frequent])
    by_number = list(own)
    out = [{"lang": lang, "word": by_number[i], "number": int(number[i]), "n": int(n[i])} for i in frequent.tolist()]
    for row, mine in zip(rows, keys, strict=True):
        kept = number[mine] >= 0
        if kept.any():
            out.append({"chunk": row["chunk"], "keys": pack(unpack(row["numbers"])[kept]), "numbers": pack(number[mine][kept])})
    return table_of(FOUND, out)


def cells(keys: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """The ranks of a pair's two sides, and so its cell in its tile."""
    return (keys >> 32) // side, (keys & 0xFFFFFFFF) // side


def pair_tile(table: pa.Table, side: int, least: int) -> pa.Table:
    """A tile's frequent pairs, and for each chunk the numbers of those that it has."""
    lang, tile = table.column("lang")[0].as_py(), table.column("tile")[0].as_py()
    keys = [unpack(k) for k in table.column("keys").to_pylist()]
    counts = [unpack(c) for c in table.column("counts").to_pylist()]
    corner = np.zeros(DENSE * DENSE, np.int64)
    sparse_keys, sparse_counts = [], []
    for key, n in zip(keys, counts, strict=True):
        a, b = cells(key, side)
        dense = (a < DENSE) & (b < DENSE)
        # A chunk's counts are far below 2^53, and its keys differ.
        corner += np.bincount(a[dense] * DENSE + b[dense], n[dense], DENSE * DENSE).astype(np.int64)
        sparse_keys.append(key[~dense])
        sparse_counts.append(n[~dense])
    sparse, n_sparse = sums(np.concatenate(sparse_keys), np.concatenate(sparse_counts))
    often = np.flatnonzero(corner >= least)
    left, right = tile // side, tile % side
    found = ((often // DENSE * side + left) << 32) | (often % DENSE * side + right)
    found = np.r_[found, sparse[n_sparse >= least]]
    n = np.r_[corner[often], n_sparse[n_sparse >= least]]
    number = ranked(tile, side * side, n)
    order = np.argsort(found)
    found, n, number = found[order], n[order], number[order]
    if not len(found):
        return table_of(FOUND, [])
    size = len(found)
    kept = pa.table(
        {
            "lang": pa.array([lang] * size), "chunk": pa.nulls(size, pa.string()), "numbers": pa.nulls(size, pa.binary()),
            "keys": pa.nulls(size, pa.binary()), "word": pa.nulls(size, pa.binary()), "left": pa.array(found >> 32),
            "right": pa.array(found & 0xFFFFFFFF), "number": pa.array(number), "n": pa.array(n),
        }
    )
    out = []
    for chunk, key in zip(table.column("chunk").to_pylist(), keys, strict=True):
        place = np.minimum(np.searchsorted(found, key), size - 1)
        mine = found[place] == key
        if mine.any():
            out.append({"chunk": chunk, "keys": pack(key[mine]), "numbers": pack(number[place[mine]])})
    return pa.concat_tables([kept, table_of(FOUND, out)])


def pairs_of(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of two neighbours with numbers, and their key."""
    at = np.flatnonzero((numbers[:-1] >= 0) & (numbers[1:] >= 0))
    return at, (numbers[at] << 32) | numbers[at + 1]


def renumbered(numbers: np.ndarray, keys: np.ndarray, new: np.ndarray, pairs: bool) -> np.ndarray:
    """Each word's, or each pair's, new number at its place; runs of places without one shrink to one."""
    order = np.argsort(keys)
    keys, new = keys[order], new[order]
    at, asked = pairs_of(numbers) if pairs else (np.flatnonzero(numbers >= 0), numbers[numbers >= 0])
    out = np.full(len(numbers), -1, np.int64)
    if len(keys):
        place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        out[at] = np.where(keys[place] == asked, new[place], -1)
    if len(out) and out.max() >= 1 << 31:
        raise OverflowError("more frequent phrases of a language than numbers of 31 bits")
    gap = out < 0
    return out[~(gap & np.r_[False, gap[:-1]])]


def next_round(table: pa.Table, found: pa.Table, side: int, pairs: bool) -> pa.Table:
    """A chunk with new numbers, and its neighbours for each tile."""
    if not table.num_rows or not found.num_rows:
        return table_of(ROW, [])
    row = {"chunk": table.column("chunk")[0].as_py(), "lang": table.column("lang")[0].as_py()}
    keys, new = (np.concatenate([unpack(v) for v in found.column(c).to_pylist()]) for c in ("keys", "numbers"))
    numbers = renumbered(unpack(table.column("numbers")[0].as_py()), keys, new, pairs)
    _, key = pairs_of(numbers)
    if not len(key):
        return table_of(ROW, [])
    a, b = cells(key, 1)
    dense = (a < DENSE) & (b < DENSE)
    corner = np.bincount(a[dense] * DENSE + b[dense], minlength=DENSE * DENSE)
    often = np.flatnonzero(corner)
    rest, n = np.unique(key[~dense], return_counts=True)
    key = np.r_[((often // DENSE) << 32) | (often % DENSE), rest]
    n = np.r_[corner[often], n]
    a, b = cells(key, 1)
    tile = a % side * side + b % side
    order = np.argsort(tile, kind="stable")
    key, n, tile = key[order], n[order], tile[order]
    first = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    out = [row | {"numbers": pack(numbers)}]
    for begin, end in zip(first.tolist(), [*first[1:].tolist(), len(key)], strict=True):
        out.append(row | {"tile": int(tile[begin]), "keys": pack(key[begin:end]), "counts": pack(n[begin:end])})
    return table_of(ROW, out)


def rounds(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[list[DataFrame], DataFrame]:
    """Per round the frequent words or pairs (`lang`, `word` or `left` and `right`, `number`, `n`), and `n` words per language."""
    docs = docs.select(text, lang)
    # About five letters a word, and at most one entry a word in a tile.
    words = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    side = max(1, int((words / 6 / TILE_ENTRIES) ** 0.5))
    rows = cut_lineage(chunks(docs, side * side, text, lang), "chunks")
    totals = rows.filter("tile IS NOT NULL").select("lang", "counts")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [int(unpack(c).sum()) for c in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(n, pa.int64())], ["lang", "n"])

    totals = totals.mapInArrow(total, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n"))
    by_word = (lambda table: word_tile(table, side * side, least)), (lambda table, new: next_round(table, new, side, False))
    by_pair = (lambda table: pair_tile(table, side, least)), (lambda table, new: next_round(table, new, side, True))
    out = []
    for length in range(1, LONGEST + 1):
        count, step = by_word if length == 1 else by_pair
        entries = rows.filter("tile IS NOT NULL")
        found = cut_lineage(entries.groupBy("lang", "tile").applyInArrow(count, FOUND), "tiles")
        out.append(found.filter("n IS NOT NULL").select("lang", "word", "left", "right", "number", "n"))
        if length < LONGEST:
            held = rows.filter("tile IS NULL").select("chunk", "lang", "numbers").groupBy("chunk")
            told = found.filter("chunk IS NOT NULL").select("chunk", "keys", "numbers").groupBy("chunk")
            rows = cut_lineage(held.cogroup(told).applyInArrow(step, ROW), "chunks")
    return out, totals


# --- scores -------------------------------------------------------------------------------------


def phrases(found: list[DataFrame]) -> list[DataFrame]:
    """Per length the frequent phrases: (lang, number, words, begins, ends).

    `begins` has the counts of the first 1, 2 ... words, `ends` those of the last 1, 2 ... words; the last of each is the
    phrase's own.
    """
    own = F.array("n")
    out = [found[0].select("lang", "number", F.array(F.decode("word", "UTF-8")).alias("words"), own.alias("begins"), own.alias("ends"))]
    for pairs in found[1:]:
        shorter = out[-1]
        left = shorter.select("lang", F.col("number").alias("left"), "words", "begins")
        right = shorter.select("lang", F.col("number").alias("right"), F.element_at("words", -1).alias("last"), "ends")
        longer = pairs.select("lang", "left", "right", "number", "n").join(left, ["lang", "left"]).join(right, ["lang", "right"])
        longer = longer.select(
            "lang", "number", "left", "right", F.concat("words", F.array("last")).alias("words"),
            F.concat("begins", own).alias("begins"), F.concat("ends", own).alias("ends"),
        )
        out.append(cut_lineage(longer, "phrases"))
    return out


def not_in_longer(rows: DataFrame, longer: DataFrame | None, share: int) -> DataFrame:
    """Rows without those that a phrase one word longer nearly always goes around.

    A phrase longer still is no more frequent than the one between, which is then a candidate as well.
    """
    if longer is None:
        return rows
    n = F.element_at("begins", -1).alias("n")
    around = longer.select("lang", F.col("left").alias("number"), n).unionByName(longer.select("lang", F.col("right").alias("number"), n))
    most = around.groupBy("lang", "number").agg(F.max("n").alias("most"))
    a = F.element_at("begins", -1).cast("decimal(20,0)")
    inside = F.coalesce(F.col("most").cast("decimal(20,0)") * 100 >= a * share, F.lit(False))
    return rows.join(most, ["lang", "number"], "left").filter(~inside).drop("most")


def scored(rows: DataFrame, length: int) -> DataFrame:
    """Adds `a`, and `l`, `r` and `score` of the cut with the lowest score."""
    a = F.element_at("begins", -1)
    cuts = []
    for k in range(1, length):
        before, after = F.element_at("begins", k), F.element_at("ends", length - k)
        both = before.cast("decimal(20,0)") + after.cast("decimal(20,0)")
        score = F.call_function("div", a.cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(8,0)"), both)
        cuts.append(F.struct(score.cast("bigint").alias("score"), F.lit(k).alias("k"), before.alias("l"), after.alias("r")))
    least = F.array_min(F.array(*cuts))
    return rows.select("lang", F.concat_ws(" ", "words").alias("phrase"), a.alias("a"), least.alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def first_of_each(rows: DataFrame, order: list, top: int) -> DataFrame:
    """Each language's first rows with their `rank`; ranges of the order stand in tasks, not languages."""
    ranged = rows.repartitionByRange("lang", *order).withColumn("part", F.spark_partition_id())
    ranged = cut_lineage(ranged, "ranged")
    # One row per language and range.
    sizes = ranged.groupBy("lang", "part").count()
    earlier = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0))).filter(F.col("before") < top)
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    ranked = ranged.join(starts.drop("count"), ["lang", "part"]).withColumn("rank", F.col("before") + place)
    return ranked.filter(F.col("rank") <= top).drop("part", "before")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first `top` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    found, totals = rounds(docs, text, lang, least)
    by_length = phrases(found)
    every = None
    for at in range(1, LONGEST):
        longer = by_length[at + 1] if at + 1 < LONGEST else None
        rows = scored(not_in_longer(by_length[at], longer, SHARE), at + 1)
        every = rows if every is None else every.unionByName(rows)
    best = first_of_each(every, [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
