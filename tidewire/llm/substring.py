"""Removal of passages that repeat, by backward search in FM-indexes per shard.

A window is `WINDOW` consecutive words of one document; it is repeated if its words also start at another
place. Windows are routed by anchor: the smallest hash among the runs of `ANCHOR` words in a window, leftmost
on a tie. Equal windows have equal anchors, so windows of different anchors never need to meet, and an anchor
that occurs once in the corpus needs no look at all. The consecutive windows of a document around the
same anchor are a segment.

Equal segments are counted before they move. Each different one is sent once, with its count, to its anchor's
shard. The shard builds a compressed FM-index of its segments: a wavelet matrix of bit vectors with block counts over the
Burrows-Wheeler transform of the segments' words. All segments are then streamed through it from
their last word to the first. Each step extends the match to the left by one rank query per interval end and
cuts the match back to `WINDOW` words at the right, which gives the suffix interval of every window; the
window repeats if the counts in the interval add up to two or more.

An anchor with more than `CROWDED` different segments (a common phrase in ever new surroundings) would fill one shard; its
windows are counted by their own hashes instead. Words, anchors and segments are told apart by 64-bit hashes.

Words are judged on the input: overlapping and adjoining repeats of the same document count. A null text has
no words. Documents with the same key and text get equal results, and their windows repeat each other. An empty
table gives an empty one. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import WORD_RE, in_batches, sha256, texts
from tidewire.session import cut_lineage

WINDOW = 35
ANCHOR = 8
CROWDED = 1_000
HOT_SHARE = 1 << 12
SHARD_WORDS = 1_000_000

_rng = np.random.default_rng(20240607)
BYTE_VALUES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(32))) * MIX
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of a number modulo 2**64, as many as were asked for so far."""

    def __init__(self, base: np.uint64):
        self.base, self.known = base, np.ones(1, dtype=np.uint64)

    def first(self, n: int) -> np.ndarray:
        if n > len(self.known):
            steps = np.full(2 * n, self.base)
            steps[0] = 1
            self.known = np.cumprod(steps)
        return self.known[:n]


UP, DOWN = Powers(BASE), Powers(INVERSE)


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end] that depend on their contents and length only."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * UP.first(len(values)), out=sums[1:])
    moved = (sums[ends] - sums[starts]) * DOWN.first(len(values) + 1)[starts]
    return mixed(moved + (ends - starts).astype(np.uint64) * MIX)


def word_hashes(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and each word's text number."""
    parts = [t.encode() + b"\n" for t in batch]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)))
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    limits = np.cumsum([len(p) for p in parts])
    return range_hashes(BYTE_VALUES[data], starts, ends), np.searchsorted(limits, starts, side="right")


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in each run of `width`, by doubling."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        shift = min(have, width - have)
        left, right = best[:-shift], best[shift:]
        better = right < left
        best, at = np.where(better, right, left), np.where(better, at[shift:], at[:-shift])
        have += shift
    return at


class Segments:
    """Segments of a batch: text number, first word within the text, windows, hashes."""

    def __init__(self, batch: list[str]):
        self.words, self.owner = word_hashes(batch)
        self.first_word = np.searchsorted(self.owner, np.arange(len(batch) + 1))
        n = len(self.words)
        empty = np.empty(0, dtype=np.int64)
        self.start = self.windows = empty
        self.anchor = self.hash = empty.astype(np.uint64)
        if n < WINDOW:
            return
        runs = n - ANCHOR + 1
        at = np.arange(runs)
        order = range_hashes(self.words, at, at + ANCHOR)
        low = smallest(order, WINDOW - ANCHOR + 1)
        valid = self.owner[: n - WINDOW + 1] == self.owner[WINDOW - 1 :]
        place = np.where(valid, low, -1)
        new = np.r_[True, place[1:] != place[:-1]] | np.r_[True, self.owner[1 : len(place)] != self.owner[: len(place) - 1]]
        start = np.flatnonzero(new)
        windows = np.diff(np.r_[start, len(place)])
        whole = place[start] >= 0
        self.start, self.windows = start[whole], windows[whole]
        self.anchor = order[place[self.start]]
        self.hash = range_hashes(self.words, self.start, self.start + self.windows + WINDOW - 1)

    def local(self) -> np.ndarray:
        return self.start - self.first_word[self.owner[self.start]]


def row_hash(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("row", row_hash("key", "text"))


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def segment_rows(rows: DataFrame) -> DataFrame:
    """(`anchor`, `segment`, `row`, `place`): a place holds the first word and the number of windows."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = Segments(texts(batch, "text"))
        row = batch.column("row").to_numpy()
        return pa.RecordBatch.from_arrays(
            [
                signed(found.anchor),
                signed(found.hash),
                pa.array(row[found.owner[found.start]]),
                pa.array(found.local() << 8 | found.windows),
            ],
            ["anchor", "segment", "row", "place"],
        )

    return in_batches(rows.select("row", "text"), work, "anchor bigint, segment bigint, row bigint, place bigint")


def anchor_rows(rows: DataFrame) -> DataFrame:
    """(`anchor`, `n`), counted within each batch."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        anchor, n = np.unique(Segments(texts(batch, "text")).anchor, return_counts=True)
        return pa.RecordBatch.from_arrays([signed(anchor), pa.array(n, pa.int64())], ["anchor", "n"])

    return in_batches(rows.select("text"), work, "anchor bigint, n bigint")


def fetch_words(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per wanted place of a row, its words as bytes; of a crowded anchor, one line per window with its hash.

    `wanted` has, per row, `places`: structs of place, anchor, segment, n, crowded. Equal rows give equal lines.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        words, owner = word_hashes(texts(batch, "text"))
        first = np.searchsorted(owner, np.arange(batch.num_rows))
        places = batch.column("places")
        flat = places.flatten()
        text_of = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(places).to_numpy())
        place = flat.field("place").to_numpy()
        start, windows = first[text_of] + (place >> 8), place & 255
        crowded = flat.field("crowded").to_numpy(zero_copy_only=False)
        normal = np.flatnonzero(~crowded)
        whole = [words[s : s + w + WINDOW - 1].tobytes() for s, w in zip(start[normal], windows[normal], strict=True)]
        many = np.flatnonzero(crowded)
        each = np.repeat(start[many], windows[many]) + np.concatenate([np.arange(w) for w in windows[many]] or [np.empty(0, np.int64)])
        each_text = np.repeat(text_of[many], windows[many])
        hashes = range_hashes(words, each, each + WINDOW) if len(each) else np.empty(0, np.uint64)
        row = batch.column("row").to_numpy()
        none = np.zeros(len(each), dtype=np.int64)
        out = [
            np.r_[flat.field("anchor").to_numpy()[normal], none],
            np.r_[flat.field("segment").to_numpy()[normal], hashes.view(np.int64)],
            np.r_[flat.field("n").to_numpy()[normal], none + 1],
            np.r_[row[text_of[normal]], row[each_text]],
            np.r_[place[normal], (each - first[each_text]) << 8 | 1],
        ]
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, out), pa.array([*whole, *[None] * len(each)], pa.binary())],
            ["anchor", "segment", "n", "row", "place", "words"],
        )

    joined = rows.select("row", "text").join(wanted, "row")
    return in_batches(joined, work, "anchor bigint, segment bigint, n bigint, row bigint, place bigint, words binary")


# --- the index --------------------------------------------------------------------------------


class BitVector:
    """Bits in 64-bit words with counts before each, for rank queries."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype="<u8")
        self.words.view(np.uint8)[: len(packed)] = packed
        counts = np.bitwise_count(self.words)
        self.before = (np.cumsum(counts) - counts).astype(np.uint32)

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        block = place >> 6
        below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & below).astype(np.int64)


class WaveletMatrix:
    """Rank of any symbol in a sequence: one bit vector per bit of the symbols, highest first."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.depth = max(1, int(size - 1).bit_length())
        self.levels: list[tuple[BitVector, int]] = []
        for level in reversed(range(self.depth)):
            bits = (symbols >> level & 1).astype(bool)
            self.levels.append((BitVector(bits), int(len(bits) - bits.sum())))
            symbols = np.r_[symbols[~bits], symbols[bits]]
        # Symbols end up ordered by their reversed bits: the place where each begins there.
        self.begins = np.zeros(size, dtype=np.int64)
        last, first = np.unique(symbols, return_index=True)
        self.begins[last] = first

    def rank(self, symbols: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        for level, (bits, zeros) in zip(reversed(range(self.depth)), self.levels, strict=True):
            ones = bits.ones(place)
            place = np.where(symbols >> level & 1, zeros + ones, place - ones)
        return place - self.begins[symbols]


class FmIndex:
    """Of weighted sequences of words, each followed by a separator."""

    def __init__(self, sequences: list[np.ndarray], weights: np.ndarray):
        sizes = np.array([len(s) for s in sequences])
        flat = np.concatenate(sequences)
        _, ids = np.unique(flat, return_inverse=True)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(len(flat) + len(sizes), dtype=np.int64)
        inside = np.ones(len(text), dtype=bool)
        inside[self.starts + sizes] = False
        text[inside] = ids + 1
        self.text, self.sizes = text, sizes
        order, same = self._sorted(text)
        self.size = int(text.max()) + 1
        counts = np.bincount(text, minlength=self.size)
        self.tree = WaveletMatrix(text[order - 1], self.size)
        self.before = np.cumsum(counts) - counts
        weight = np.repeat(weights, sizes + 1)[order]
        self.weight_before = np.r_[0, np.cumsum(weight)]
        # For each suffix, the interval of those that share its first WINDOW words.
        new = np.r_[True, ~same]
        begin = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        self.block_start, self.block_end = begin[number], np.r_[begin[1:], len(text)][number]

    @staticmethod
    def _sorted(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes by their first 64 symbols, and which of them share WINDOW with the one before.

        Backward search uses prefixes of WINDOW + 1 words at most, so a deeper order isn't needed.
        """
        n = len(text)
        rank, width, at_32 = text, 1, None
        while width < 64:
            ahead = np.zeros(n, dtype=np.int64)
            ahead[:-width] = rank[width:] + 1
            _, rank = np.unique(rank * (n + 2) + ahead, return_inverse=True)
            width *= 2
            if width == 32:
                at_32 = rank
        order = np.argsort(rank, kind="stable")
        tail = np.full(n, -1, dtype=np.int64)
        tail[: n - (WINDOW - 32)] = at_32[WINDOW - 32 :]
        a, b = order[:-1], order[1:]
        return order, (at_32[a] == at_32[b]) & (tail[a] == tail[b])

    def repeated(self) -> list[int]:
        """For each sequence, bits of its windows that occur twice or more, counted by weight."""
        masks = np.zeros(len(self.sizes), dtype=np.int64)
        low, high = np.zeros(len(self.sizes), dtype=np.int64), np.full(len(self.sizes), len(self.text))
        for step in range(1, int(self.sizes.max()) + 1):
            live = np.flatnonzero(self.sizes >= step)
            place = self.sizes[live] - step
            symbol = self.text[self.starts[live] + place]
            base = self.before[symbol]
            low[live] = base + self.tree.rank(symbol, low[live])
            high[live] = base + self.tree.rank(symbol, high[live])
            if step < WINDOW:
                continue
            if step > WINDOW:
                high[live] = self.block_end[low[live]]
                low[live] = self.block_start[low[live]]
            often = self.weight_before[high[live]] - self.weight_before[low[live]] >= 2
            masks[live[often]] |= 1 << place[often]
        return masks.tolist()


def search_shards(units: DataFrame, shards: int) -> DataFrame:
    """(`anchor`, `segment`, `mask`): the repeated windows of each different segment."""

    def search(shard: pa.Table) -> pa.Table:
        # Rows with the same key and text have sent the same segments.
        ids = np.stack([shard.column("anchor").to_numpy(), shard.column("segment").to_numpy()], axis=1)
        shard = shard.take(np.sort(np.unique(ids, axis=0, return_index=True)[1]))
        sequences = [np.frombuffer(w, dtype=np.uint64) for w in shard.column("words").to_pylist()]
        masks = FmIndex(sequences, shard.column("n").to_numpy()).repeated()
        found = pa.table({"anchor": shard.column("anchor"), "segment": shard.column("segment"), "mask": pa.array(masks, pa.int64())})
        return found.filter(pa.compute.not_equal(found.column("mask"), 0))

    sharded = units.select(F.pmod("anchor", F.lit(shards)).alias("shard"), "anchor", "segment", "n", "words")
    return sharded.groupBy("shard").applyInArrow(search, "anchor bigint, segment bigint, mask bigint")


# --- all of it --------------------------------------------------------------------------------


def repeats(rows: DataFrame, crowded_from: int = CROWDED) -> DataFrame:
    """Per row with repeated windows, `marks`: structs of the first word and the bits of the windows after it."""
    spark = rows.sparkSession
    twice = cut_lineage(
        anchor_rows(rows).groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "anchors"
    )
    met = cut_lineage(segment_rows(rows).join(twice, "anchor", "left_semi"), "segments")
    kinds = cut_lineage(
        met.groupBy("anchor", "segment").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "place")).alias("one")), "kinds"
    )
    crowded = cut_lineage(kinds.groupBy("anchor").count().filter(F.col("count") > crowded_from).select("anchor"), "crowded")
    normal = kinds.join(crowded, "anchor", "left_anti").select(
        F.col("one.row").alias("row"), F.col("one.place").alias("place"), "anchor", "segment", "n", F.lit(False).alias("crowded")
    )
    many = met.join(crowded, "anchor", "left_semi").select(
        "row", "place", "anchor", F.lit(0).cast("long").alias("segment"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("crowded")
    )
    wanted = (
        normal.unionByName(many.distinct())
        .groupBy("row")
        .agg(F.collect_list(F.struct("place", "anchor", "segment", "n", "crowded")).alias("places"))
    )
    units = cut_lineage(fetch_words(rows, wanted), "units")
    whole, single = units.filter("words IS NOT NULL"), units.filter("words IS NULL")
    words = whole.agg(F.sum(F.length("words") / 8)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(words) // SHARD_WORDS))
    masks = met.join(search_shards(whole, shards), ["anchor", "segment"]).select("row", F.shiftright("place", 8).alias("start"), "mask")
    counted = single.groupBy("segment").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).filter("n > 1")
    often = cut_lineage(counted.select("segment", (F.col("rows") > single.count() // HOT_SHARE + 1).alias("hot")), "often")
    # Fewer than HOT_SHARE windows have that many rows; their rows stay where they are.
    hot = F.broadcast(often.filter("hot"))
    others = single.join(hot, "segment", "left_anti").join(often.filter("NOT hot"), "segment", "left_semi")
    found = single.join(hot, "segment", "left_semi").unionByName(others)
    singles = found.select("row", F.shiftright("place", 8).alias("start"), F.lit(1).cast("long").alias("mask"))
    return masks.unionByName(singles).distinct().groupBy("row").agg(F.collect_list(F.struct("start", "mask")).alias("marks"))


def covered(n_words: int, marks: list[dict]) -> np.ndarray:
    """Which words a repeated window covers."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    for mark in marks:
        mask, start = mark["mask"], mark["start"]
        while mask:
            low = mask & -mask
            at = start + low.bit_length() - 1
            edge[at] += 1
            edge[at + WINDOW] -= 1
            mask ^= low
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, `kept` (its words outside repeats, joined by one space), `n_words`, `n_removed`."""
    return _marked(docs, key, text, "kept")


def digest_kept(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As `remove_repeats`, with the digest of the kept words in place of them."""
    return _marked(docs, key, text, "kept_sha256")


def _marked(docs: DataFrame, key: str, text: str, kept: str) -> DataFrame:
    rows = _rows(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out, n_words, n_removed = [], [], []
        for t, marks in zip(texts(batch, "text"), batch.column("marks").to_pylist(), strict=True):
            words = WORD_RE.findall(t)
            n_words.append(len(words))
            gone = covered(len(words), marks) if marks else None
            n_removed.append(int(gone.sum()) if marks else 0)
            rest = " ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if marks else " ".join(words)
            out.append(rest if kept == "kept" else sha256(rest.encode()))
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, pa.string())],
            ["key", "n_words", "n_removed", kept],
        )

    joined = rows.join(repeats(rows), "row", "left").select("key", "text", "marks")
    return in_batches(joined, work, f"key {kind}, n_words bigint, n_removed bigint, {kept} string").withColumnRenamed("key", key)
