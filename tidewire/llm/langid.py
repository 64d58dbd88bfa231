"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to `ORDER` bytes. A byte costs
-log2(n / (total + distinct)) bits in the longest context that it was seen in, and every longer known
context before it adds an escape of -log2(distinct / (total + distinct)); a byte unknown everywhere
costs 8 bits more. Statistics are counted on Spark from the learning rows and then frozen, so the code
length of a text doesn't depend on other texts. The language of the shortest code wins, the smaller
name on a tie; the score is the winner's posterior under equal priors.

Every learning row counts, from its first to its last byte; a language without a byte of text is left out. Trees of
more than `MODEL_CELLS` numbers are dealt to parts by the two bytes before the predicted one. Parts are built and sent
one after the other, and each adds the bits of its own places to a text's sums, so neither the driver nor a task holds
more than one part; texts are written once more for each part after the first. Prediction covers every byte, too.
A caller may bound what is learned (`learn_chars`); then `drawn_slices` draws slices of texts by a hash.

A posterior doesn't tell whether a text is in any learned language: noise is a little less unlike one of them.
Bits per byte do. `limits` learns from all held-out texts how many a language's own texts take; they are counted in
steps of 1 / `BIT_STEPS`.

A null text, or one without a letter (a character of Unicode category L), is `und` with score 0; so is every text when no row can be
learned from. A null key counts as an empty one; repeated rows learn twice and are predicted alike.
Columns other than the named ones are never touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import ROWS_PER_BATCH, fresh, in_batches
from tidewire.session import cut_lineage

ORDER = 4
PAIRS = 1 << 16
# Of a part of the trees: grams by language, times the languages and the room that a gram itself takes.
MODEL_CELLS = 1 << 25
GRAM_CELLS = 16
SLICE_CHARS = 1_000
SPARE = 1.3
DRAWS = 1 << 40
BUCKETS = 1 << 12
# A text is unlike its language with more bits a byte than the median of the language's own held-out texts and twice
# the way from there to their 99th percentile, or `LEAST_MARGIN` if that is more; `SHORT_BITS` are free in any text.
BIT_STEPS = 1 << 12
FEW_TEXTS = 20
LEAST_MARGIN = 2.5
SHORT_BITS = 100
SHORT_BYTES = 12
SLICE = 1 << 19
COUNTED = 1 << 21
UNDETERMINED = "und"


def held_out(key: str) -> Column:
    """Rows that are never learned from: one key in four, by its checksum."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 4 == 2


def padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes, `ORDER` zero bytes before each, and the place where each text begins."""
    parts = [t.encode() for t in texts]
    data = b"".join(b"\0" * ORDER + p for p in parts)
    sizes = np.array([len(p) + ORDER for p in parts], dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8), np.cumsum(sizes) - sizes


def grams(data: np.ndarray, low: int, high: int) -> np.ndarray:
    """For the places low..high, the byte there and the `ORDER` bytes before it as one number."""
    out = np.zeros(high - low, dtype=np.int64)
    for back in range(ORDER, -1, -1):
        out = (out << 8) | data[low - back : high - back]
    return out


class Slots:
    """Number of a known key, or -1: open addressing over numpy arrays, made where it is first asked; only the keys are sent."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.table: tuple[int, np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> np.ndarray:
        return self.known

    def __setstate__(self, known: np.ndarray) -> None:
        self.__init__(known)

    @staticmethod
    def _home(keys: np.ndarray, bits: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - bits)).astype(np.int64)

    def _built(self) -> tuple[int, np.ndarray, np.ndarray]:
        if self.table is None:
            known = self.known
            bits = max(4, int(np.ceil(np.log2(max(1, len(known)) * 4))))
            keys, values = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int32)
            left, at = np.arange(len(known), dtype=np.int32), self._home(known, bits)
            while len(left):
                free = np.flatnonzero(keys[at] == -1)
                # Of the keys that want a slot, the last one written has it.
                values[at[free]] = left[free]
                won = free[values[at[free]] == left[free]]
                keys[at[won]] = known[left[won]]
                rest = np.ones(len(left), dtype=bool)
                rest[won] = False
                left, at = left[rest], (at[rest] + 1) & ((1 << bits) - 1)
            self.table = bits, keys, values
        return self.table

    def find(self, asked: np.ndarray) -> np.ndarray:
        bits, keys, values = self._built()
        at = self._home(asked, bits)
        found = keys[at]
        out = np.where(found == asked, values[at], np.int32(-1))
        open_ = np.flatnonzero((found != asked) & (found != -1))
        at = at[open_]
        while len(open_):
            at = (at + 1) & ((1 << bits) - 1)
            found = keys[at]
            hit = found == asked[open_]
            out[open_[hit]] = values[at[hit]]
            go = ~hit & (found != -1)
            open_, at = open_[go], at[go]
        return out


@dataclass
class Trees:
    """Frozen statistics: per order, the bits of known (context, byte) pairs and of escapes, by language.

    They are of places whose two bytes before are in `low`..`high`; other places have no bits.
    """

    languages: list[str]
    nodes: list[Slots]
    bits: list[np.ndarray]
    contexts: list[Slots]
    escapes: list[np.ndarray]
    low: int = 0
    high: int = PAIRS

    @classmethod
    def of(
        cls, languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray,
        low: int = 0, high: int = PAIRS, short_grams: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
    ) -> Trees:
        """From counts of full-order grams; shorter contexts are their suffixes.

        A part has all grams of its contexts of two bytes and more; what is shorter comes from `short_grams`
        (language, two bytes, count) of all parts.
        """
        full = language, gram, count
        nodes, bits, contexts, escapes = [], [], [], []
        n_languages = len(languages)
        suffix_keys, suffix_bits = np.empty(0, dtype=np.int64), np.empty((0, n_languages))
        for order in range(ORDER + 1):
            language, gram, count = short_grams if short_grams and order < 2 else full
            short = gram & ((1 << 8 * (order + 1)) - 1)
            keys, at = np.unique(short, return_inverse=True)
            n = np.zeros((len(keys), n_languages))
            np.add.at(n, (at, language), count)
            context_keys, context_at = np.unique(keys >> 8, return_inverse=True)
            total = np.zeros((len(context_keys), n_languages))
            distinct = np.zeros_like(total)
            np.add.at(total, context_at, n)
            np.add.at(distinct, context_at, (n > 0).astype(float))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
            # The longest contexts are the most, and no other order needs their bits in full.
            cost = np.empty((len(keys), n_languages), dtype=np.float32 if order == ORDER else np.float64)
            for some in (slice(i, i + SLICE // 8) for i in range(0, len(keys), SLICE // 8)):
                context = context_at[some]
                if order:
                    lower = suffix_bits[np.searchsorted(suffix_keys, keys[some] & ((1 << 8 * order) - 1))]
                else:
                    lower = 8.0
                with np.errstate(divide="ignore", invalid="ignore"):
                    seen = -np.log2(n[some] / (total[context] + distinct[context]))
                cost[some] = np.where(n[some] > 0, seen, escape[context] + lower)
            nodes.append(Slots(keys))
            bits.append(cost.astype(np.float32, copy=False))
            contexts.append(Slots(context_keys))
            escapes.append(escape.astype(np.float32))
            suffix_keys, suffix_bits = keys, cost
        return cls(languages, nodes, bits, contexts, escapes, low, high)

    def parts(self) -> Iterator[Trees]:
        yield self

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of every text in every language."""
        data, begins = padded(texts)
        total = np.zeros((len(texts), len(self.languages)))
        owners = np.repeat(np.arange(len(texts)), np.diff(np.r_[begins, len(data)]))
        for low in range(ORDER, len(data), SLICE):
            high = min(low + SLICE, len(data))
            gram = grams(data, low, high)
            owner = owners[low:high]
            # The zero bytes in front of a text are context, not text.
            skipped = np.arange(low, high) - begins[owner] < ORDER
            if (self.low, self.high) == (0, PAIRS):
                cost = self._cost(gram)
                cost[skipped] = 0
            else:
                pair = gram >> 8 & PAIRS - 1
                own = np.flatnonzero(~skipped & (pair >= self.low) & (pair < self.high))
                cost = np.zeros((high - low, len(self.languages)), dtype=np.float32)
                cost[own] = self._cost(gram[own])
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            total[owner[first]] += np.add.reduceat(cost, first, axis=0, dtype=np.float64)
        return total

    def _cost(self, gram: np.ndarray) -> np.ndarray:
        at = self.nodes[ORDER].find(gram)
        cost = self.bits[ORDER][at]
        missed = np.flatnonzero(at < 0)
        if len(missed):
            cost[missed] = self._escaped(gram[missed])
        return cost

    def _escaped(self, gram: np.ndarray) -> np.ndarray:
        """Bits of grams unknown to every language at full order."""
        cost = np.zeros((len(gram), len(self.languages)), dtype=np.float32)
        left = np.arange(len(gram))
        for order in range(ORDER, -1, -1):
            short = gram[left] & ((1 << 8 * (order + 1)) - 1)
            at = self.nodes[order].find(short)
            known = at >= 0
            cost[left[known]] += self.bits[order][at[known]]
            left, short = left[~known], short[~known]
            context = self.contexts[order].find(short >> 8)
            met = context >= 0
            cost[left[met]] += self.escapes[order][context[met]]
        cost[left] += 8
        return cost

    def predict(self, texts: list[str | None], before: np.ndarray | float = 0.0) -> tuple[list[str], list[float], list[float]]:
        """Languages, their posteriors, and the bits per byte in them; `before` has the bits of other parts."""
        lengths = self.code_lengths([t or "" for t in texts]) + before
        best = np.argmin(lengths, axis=1)
        odds = np.exp2(np.maximum(lengths.min(axis=1, keepdims=True) - lengths, -1000))
        score = 1 / odds.sum(axis=1)
        told = [any(map(str.isalpha, t or "")) for t in texts]
        per_byte = lengths.min(axis=1) / [max(1, len((t or "").encode())) for t in texts]
        return (
            [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, told, strict=True)],
            [float(s) if ok else 0.0 for s, ok in zip(score, told, strict=True)],
            per_byte.tolist(),
        )


@dataclass
class Parts:
    """Trees that are too large for one place; `counted` has their grams on Spark, `edges` the parts' bounds."""

    languages: list[str]
    counted: DataFrame
    edges: list[int]
    short_grams: tuple[np.ndarray, np.ndarray, np.ndarray]

    def parts(self) -> Iterator[Trees]:
        pair = pair_of(F.col("gram"))
        for low, high in zip(self.edges, self.edges[1:], strict=False):
            own = self.counted.filter((pair >= low) & (pair < high))
            yield Trees.of(self.languages, *told_apart(own), low, high, self.short_grams)


def pair_of(gram: Column) -> Column:
    """The two bytes before the predicted one."""
    return F.shiftright(gram, 8).bitwiseAND(F.lit(PAIRS - 1))


def told_apart(counted: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, gram and count of counted grams, in order."""
    found = counted.toArrow()
    gram, n = found.column("gram").to_numpy(), found.column("n").to_numpy()
    order = np.argsort(gram)
    gram, n = gram[order], n[order]
    width = 8 * (ORDER + 1)
    return gram >> width, gram & ((1 << width) - 1), n


def by_language(values: dict, lang: Column) -> Column:
    return F.create_map(*[x for name, v in values.items() for x in (F.lit(name), F.lit(v))])[lang]


def drawn_slices(rows: DataFrame, key: str, text: str, lang: str, learn_chars: int) -> DataFrame | None:
    """`_lang`, `_lead` (the characters before the slice) and `_text` of the slices to learn from; None if there are none.

    Slices are drawn at a rate that gives somewhat more than enough, and then by buckets of their hash until the bound.
    """
    rows = rows.select(key, text, lang).filter(F.col(lang).isNotNull() & (F.length(text) > 0))
    sizes = rows.groupBy(lang).agg(F.sum(F.length(text).cast("long")).alias("_chars"))
    chars = {r[0]: r[1] for r in sizes.collect()}
    if not chars:
        return None
    ends = {name: max(1, round(min(1.0, SPARE * learn_chars / n) * DRAWS)) for name, n in chars.items()}

    def draw(n: Column) -> Column:
        return F.struct(n.alias("n"), F.pmod(F.xxhash64(F.col("_mark"), n), F.lit(DRAWS)).alias("draw"))

    # Both arrays are a generator's output, so that the text is hashed once and not once a slice.
    drawn = rows.select(
        F.col(text).alias("_text"), F.col(lang).alias("_lang"), by_language(ends, F.col(lang)).alias("_end"),
        F.explode(F.array(F.xxhash64(F.lit("learn"), F.col(key), F.col(text)))).alias("_mark"),
    )
    drawn = drawn.select(
        "_text", "_lang", "_end",
        F.explode(F.array(F.filter(F.transform(slices_of("_text"), draw), lambda s: s["draw"] < F.col("_end")))).alias("_drawn"),
    ).filter(F.size("_drawn") > 0)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [
            (name, s["draw"] * BUCKETS // end, t[max(0, at - ORDER) : at], t[at : at + SLICE_CHARS])
            for t, name, end, found in zip(*[batch.column(c).to_pylist() for c in ("_text", "_lang", "_end", "_drawn")], strict=True)
            for s in found
            for at in [s["n"] * SLICE_CHARS]
        ]
        kinds = (pa.string(), pa.int32(), pa.string(), pa.string())
        names = ["_lang", "_bucket", "_lead", "_text"]
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], names)

    cut_out = cut_lineage(in_batches(drawn, cut, "_lang string, _bucket int, _lead string, _text string"), "slices")
    filled = cut_out.groupBy("_lang", "_bucket").agg(F.sum(F.length("_text").cast("long")).alias("n")).collect()
    last = {}
    for name in chars:
        buckets = sorted((r["_bucket"], r["n"]) for r in filled if r["_lang"] == name)
        whole = np.cumsum([n for _, n in buckets])
        # A first bucket beyond the bound stays: equal rows are drawn together.
        last[name] = buckets[max(0, int(np.searchsorted(whole, learn_chars, side="right")) - 1)][0] if buckets else -1
    return cut_out.filter(F.col("_bucket") <= by_language(last, F.col("_lang")))


def slices_of(text: str) -> Column:
    """Numbers of a text's slices."""
    return F.sequence(F.lit(0), F.floor((F.length(text) - 1) / SLICE_CHARS).cast("int"))


def learn(rows: DataFrame, key: str, text: str, lang: str, learn_chars: int | None = None) -> Trees | Parts | None:
    """Trees from all rows with a language, or from `learn_chars` characters of each; None when there are no such rows."""
    if learn_chars is None:
        drawn = rows.select(F.col(lang).alias("_lang"), F.lit("").alias("_lead"), F.col(text).alias("_text"))
        drawn = drawn.filter(F.col("_lang").isNotNull() & (F.length("_text") > 0))
    else:
        drawn = drawn_slices(rows, key, text, lang, learn_chars)
    if drawn is None:
        return None
    languages = sorted(r[0] for r in drawn.select("_lang").distinct().collect())
    if not languages:
        return None
    drawn = drawn.select(by_language({name: i for i, name in enumerate(languages)}, F.col("_lang")).alias("_lang"), "_lead", "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                batch = whole.slice(at, ROWS_PER_BATCH)
                leads = batch.column("_lead").to_pylist()
                data, begins = padded([a + b for a, b in zip(leads, batch.column("_text").to_pylist(), strict=True)])
                # Where a text's own bytes begin.
                known = begins + ORDER + np.array([len(a.encode()) for a in leads], dtype=np.int64)
                languages = batch.column("_lang").to_numpy().astype(np.int64)
                for low in range(ORDER, len(data), COUNTED):
                    high = min(low + COUNTED, len(data))
                    place = np.arange(low, high)
                    owner = np.searchsorted(begins, place, side="right") - 1
                    full = (grams(data, low, high) | languages[owner] << 8 * (ORDER + 1))[place >= known[owner]]
                    keys, counts = np.unique(full, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["gram", "n"])

    counted = drawn.mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    counted = cut_lineage(counted, "grams")
    # One number per two bytes.
    sizes = dict(counted.groupBy(pair_of(F.col("gram"))).count().collect())
    if not sizes:
        return None
    most = max(1, MODEL_CELLS // (len(languages) + GRAM_CELLS))
    edges, inside = [0], 0
    for pair, n in sorted(sizes.items()):
        if inside and inside + n > most:
            edges.append(pair)
            inside = 0
        inside += n
    if len(edges) == 1:
        return Trees.of(languages, *told_apart(counted))
    width = 8 * (ORDER + 1)
    short = F.shiftleft(F.shiftright("gram", width), width).bitwiseOR(F.col("gram").bitwiseAND(F.lit(PAIRS - 1)))
    return Parts(languages, counted, [*edges, PAIRS], told_apart(counted.groupBy(short.alias("gram")).agg(F.sum("n").alias("n"))))


def summed(docs: DataFrame, trees: Trees | Parts, text: str) -> tuple[DataFrame, Trees, str | None]:
    """The last part of the trees, the documents with the bits of the parts before it, and those bits' column if there are any."""
    last, bits = None, None
    for part in trees.parts():
        if last is not None:
            docs, bits = _added(docs, last, text, bits)
        last = part
    return docs, last, bits


def _added(docs: DataFrame, part: Trees, text: str, bits: str | None) -> tuple[DataFrame, str]:
    name = bits or fresh(docs, "_bits")
    columns = [c for c in docs.columns if c != name]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = part.code_lengths([t or "" for t in batch.column(text).to_pylist()]) + _before(batch, bits)
        offsets = pa.array(np.arange(batch.num_rows + 1) * lengths.shape[1], pa.int32())
        sums = pa.ListArray.from_arrays(offsets, pa.array(lengths.ravel()))
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], sums], [*columns, name])

    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns] + [f"`{name}` array<double>"])
    return cut_lineage(in_batches(docs, work, schema), "bits"), name


def _before(batch: pa.RecordBatch, bits: str | None) -> np.ndarray | float:
    if bits is None:
        return 0.0
    return pa.compute.list_flatten(batch.column(bits)).to_numpy().reshape(batch.num_rows, -1)


def identify(docs: DataFrame, trees: Trees | Parts | None, key: str = "doc_id", text: str = "text", keep: tuple = ()) -> DataFrame:
    """One row per document: its key, the columns to keep, `lang_pred`, `score` and `bits`, the bits per byte."""
    columns = [key, *[c for c in keep if c != key]]
    if trees is None:
        return docs.select(*columns, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits"))
    source, last, before = summed(docs.select(*dict.fromkeys([*columns, text])), trees, text)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores, bits = last.predict(batch.column(text).to_pylist(), _before(batch, before))
        kept = [batch.column(c) for c in columns]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64())],
            [*columns, "lang_pred", "score", "bits"],
        )

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return in_batches(source, work, f"{schema}, lang_pred string, score double, bits double")


def quantiles(values: np.ndarray, counts: np.ndarray, shares: list[float]) -> list[float]:
    """As `np.quantile` of the values, each repeated as often as it was counted."""
    order = np.argsort(values)
    values, ends = values[order], np.cumsum(counts[order])
    places = np.array(shares) * (ends[-1] - 1)
    low = values[np.searchsorted(ends, np.floor(places), side="right")]
    high = values[np.searchsorted(ends, np.ceil(places), side="right")]
    return (low + (high - low) * (places - np.floor(places))).tolist()


def limits(rows: DataFrame, trees: Trees | Parts | None, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, float]:
    """Bits per byte that a language's own texts stay below, from all of the rows, which weren't learned from.

    A language with fewer than `FEW_TEXTS` texts has the limit of all texts together; without as many there is none.
    """
    if trees is None:
        return {}
    told = rows.filter(F.col(lang).isin(trees.languages) & (F.octet_length(text) >= SHORT_BYTES))
    number = by_language({name: i for i, name in enumerate(trees.languages)}, F.col(lang))
    source, last, before = summed(told.select(F.col(text).alias("_text"), number.alias("_lang")), trees, "_text")

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, language = batch.column("_text").to_pylist(), batch.column("_lang").to_numpy()
        lengths = last.code_lengths(own) + _before(batch, before)
        bits = lengths[np.arange(len(own)), language] / [len(t.encode()) for t in own]
        return pa.RecordBatch.from_arrays([batch.column("_lang"), pa.array(np.rint(bits * BIT_STEPS).astype(np.int64))], ["lang", "steps"])

    # A language has as many steps as there are between 0 and its highest bits per byte.
    found = in_batches(source, measure, "lang int, steps bigint").groupBy("lang", "steps").agg(F.count(F.lit(1)).alias("n")).toArrow()
    language, bits, n = found.column("lang").to_numpy(), found.column("steps").to_numpy() / BIT_STEPS, found.column("n").to_numpy()
    out = {}
    for i, name in enumerate(trees.languages):
        own = language == i
        own = own if n[own].sum() >= FEW_TEXTS else np.ones_like(own)
        if n[own].sum() >= FEW_TEXTS:
            middle, high = quantiles(bits[own], n[own], [0.5, 0.99])
            out[name] = float(middle + max(2 * (high - middle), LEAST_MARGIN))
    return out


def in_a_language(known: dict[str, float], text: str = "text") -> Column:
    """Whether a row of `identify` is in the language found. Below `SHORT_BYTES` a letter is enough."""
    size = F.octet_length(text)
    told = F.col("lang_pred") != UNDETERMINED
    if not known:
        return told
    limit = by_language(known, F.col("lang_pred"))
    return told & (limit.isNull() | (size < SHORT_BYTES) | (F.col("bits") <= limit + SHORT_BITS / size))
