"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's fingerprint has a bit set where over half of its word shingles' XXH64 values have it.
Equal fingerprints are one node. Two nodes are linked if `radius` bits or fewer differ.

Links are found by parts. Correlated bits are grouped into the same part, so that a part's values are
as uneven as the data allow. Every node spreads thresholds over the parts: -1 (part not used), 0, 1 ...,
with sum(threshold + 1) = radius + 1. A node within the radius must then agree with it on some part up to
that part's threshold, so any spread is complete, and a dynamic program picks the one with the fewest
estimated candidates: a part value that a third of all nodes share is left out by the nodes that
have it. The node probes its parts' values within the thresholds and verifies what it meets. Each pair is
looked for from its larger side only.

Components are found by passing on the smallest label along links and jumping to the label's label;
each round is written to the shared folder. A node has at most 2 080 others within two bits, so no node's
links are a hot group.

A null or blank text has fingerprint zero and is linked like any other. Repeated rows get the same
result; a component's id is its smallest key, nulls aside (null if it has no other). An empty table
gives an empty one. Only the named columns are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import WORD_RE, fresh, in_batches, texts
from tidewire.session import cut_lineage

SHINGLE = 3
RADIUS = 2
SEED = 42
BITS = 64
SKETCH = 1 << 16
FEW_NODES = 1 << 24
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64 bits of one text."""
    words = [w.encode() for w in WORD_RE.findall(text.translate(LOWER))]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) < shingle:
        spans = [(0, len(joined))]
    else:
        begins = np.r_[0, ends[:-1] + 1]
        spans = zip(begins[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple = ()) -> DataFrame:
    """One row per document: its key, the columns to keep and `fingerprint` as a long."""
    columns = [key, *[c for c in keep if c != key]]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t) for t in texts(batch, text)], dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(prints)], [*columns, "fingerprint"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return in_batches(docs.select(*dict.fromkeys([*columns, text])), work, f"{schema}, fingerprint bigint")


# --- parts ------------------------------------------------------------------------------------


def bit_correlation(nodes: DataFrame) -> np.ndarray:
    """64 x 64 absolute correlations, from sums over all nodes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = batch.column("fingerprint").to_numpy().astype("<i8")
        bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        both = bits.T @ bits
        return pa.RecordBatch.from_arrays(
            [pa.array(range(BITS)), pa.array(list(both.astype(np.float64))), pa.array([len(bits)] * BITS)], ["bit", "both", "n"]
        )

    sums = in_batches(nodes.select("fingerprint"), work, "bit bigint, both array<double>, n bigint")
    rows = (
        sums.select("bit", "n", F.posexplode("both").alias("other", "both"))
        .groupBy("bit", "other")
        .agg(F.sum("both").alias("both"), F.sum("n").alias("n"))
        .collect()
    )
    both, n = np.zeros((BITS, BITS)), max([r.n for r in rows], default=1)
    for r in rows:
        both[r.bit, r.other] = r.both
    mean = np.diag(both) / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return np.abs(both / n - np.outer(mean, mean)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of nearly equal width, each grown from a free bit by the bit most correlated with it."""
    free, out = set(range(BITS)), []
    for part in range(parts):
        width = -(-len(free) // (parts - part))
        ties = sorted(free)
        seed = max(ties, key=lambda b: sum(correlation[b, o] for o in ties))
        group = [seed]
        free.remove(seed)
        while len(group) < width:
            best = max(sorted(free), key=lambda b: sum(correlation[b, o] for o in group))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def part_value(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, gathered to the low end."""
    out = np.zeros(len(prints), dtype=np.int64)
    for place, bit in enumerate(bits):
        out |= ((prints >> bit) & 1) << place
    return out


def sketch_slot(values: np.ndarray) -> np.ndarray:
    return ((values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def flips(width: int, distance: int) -> np.ndarray:
    """All masks of exactly so many set bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), distance)], dtype=np.int64)


def spread_thresholds(candidates: np.ndarray, radius: int) -> np.ndarray:
    """For each node the cheapest thresholds, from `candidates[part, threshold + 1, node]`.

    best[s] is the least cost of the parts so far with sum(threshold + 1) = s.
    """
    parts, _, nodes = candidates.shape
    best = np.full((radius + 2, nodes), np.inf)
    best[0] = 0
    picks = []
    for part in range(parts):
        new, pick = np.full_like(best, np.inf), np.zeros(best.shape, dtype=np.int64)
        for total in range(radius + 2):
            for used in range(total + 1):
                cost = best[total - used] + candidates[part, used]
                better = cost < new[total]
                new[total][better], pick[total][better] = cost[better], used
        best = new
        picks.append(pick)
    left = np.full(nodes, radius + 1)
    out = np.zeros((parts, nodes), dtype=np.int64)
    for part in reversed(range(parts)):
        used = picks[part][left, np.arange(nodes)]
        out[part] = used - 1
        left -= used
    return out


def _posted(nodes: DataFrame, parts: list[list[int]]) -> DataFrame:
    """Every node under each of its parts' values."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = batch.column("fingerprint").to_numpy()
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(parts)), len(prints)), pa.int32()),
                pa.array(np.concatenate([part_value(prints, bits) for bits in parts])),
                pa.array(np.tile(prints, len(parts))),
            ],
            ["part", "value", "found"],
        )

    return in_batches(nodes.select("fingerprint"), work, "part int, value bigint, found bigint")


def _slot_counts(nodes: DataFrame, parts: list[list[int]]) -> np.ndarray:
    """Nodes per part and hashed value: at most `SKETCH` numbers a part."""
    posted = _posted(nodes, parts)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        slot = batch.column("part").to_numpy().astype(np.int64) * SKETCH + sketch_slot(batch.column("value").to_numpy())
        slots, n = np.unique(slot, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(slots), pa.array(n)], ["slot", "n"])

    counted = in_batches(posted, work, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(parts) * SKETCH)
    out[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    return out.reshape(len(parts), SKETCH)


def _probes(nodes: DataFrame, parts: list[list[int]], counts: np.ndarray, radius: int) -> DataFrame:
    """Every node under each part value within the thresholds it has chosen."""
    masks = [[flips(len(bits), d) for d in range(radius + 1)] for bits in parts]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = batch.column("fingerprint").to_numpy()
        values = [part_value(prints, bits) for bits in parts]
        cost = np.zeros((len(parts), radius + 2, len(prints)))
        for p, value in enumerate(values):
            for d in range(radius + 1):
                cost[p, d + 1] = cost[p, d]
                for mask in masks[p][d]:
                    # A probe costs about as much as a candidate.
                    cost[p, d + 1] += counts[p, sketch_slot(value ^ mask)] + 1
        chosen = spread_thresholds(cost, radius)
        part, value_out, asker = [], [], []
        for p, value in enumerate(values):
            for d in range(radius + 1):
                uses = np.flatnonzero(chosen[p] >= d)
                reached = (value[uses][:, None] ^ masks[p][d][None, :]).ravel()
                part.append(np.full(len(reached), p))
                value_out.append(reached)
                asker.append(np.repeat(prints[uses], len(masks[p][d])))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(part), pa.int32()), pa.array(np.concatenate(value_out)), pa.array(np.concatenate(asker))],
            ["part", "value", "asker"],
        )

    return in_batches(nodes.select("fingerprint"), work, "part int, value bigint, asker bigint")


def links(nodes: DataFrame, radius: int = RADIUS, parts: int | None = None) -> DataFrame:
    """Pairs (`found` < `asker`) of distinct fingerprints that differ in `radius` bits or fewer.

    Three parts of about 21 bits keep probes few; above `FEW_NODES` nodes two parts of 32 bits keep
    the candidates of a probe few. The pairs are the same.
    """
    parts = parts or (3 if nodes.count() <= FEW_NODES else 2)
    groups = group_bits(bit_correlation(nodes), parts)
    probes = _probes(nodes, groups, _slot_counts(nodes, groups), radius)
    near = F.bit_count(F.col("asker").bitwiseXOR(F.col("found"))) <= radius
    met = (F.col("p.part") == F.col("i.part")) & (F.col("p.value") == F.col("i.value")) & (F.col("found") < F.col("asker"))
    return probes.alias("p").join(_posted(nodes, groups).alias("i"), met & near).select("found", "asker")


# --- components -------------------------------------------------------------------------------


def components(pairs: DataFrame) -> DataFrame:
    """For every node of the pairs (`found`, `asker`), `label`: the smallest node that it is connected with."""
    edges = cut_lineage(
        pairs.select(F.col("found").alias("node"), F.col("asker").alias("other"))
        .unionByName(pairs.select(F.col("asker").alias("node"), F.col("found").alias("other")))
        .distinct(),
        "links",
    )
    labels = cut_lineage(
        edges.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label")), "labels"
    )
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("their"))
        passed = (
            edges.join(theirs, "other")
            .groupBy("node")
            .agg(F.min("their").alias("their"))
            .join(labels, "node")
            .select("node", F.col("label").alias("before"), F.least("label", "their").alias("label"))
        )
        passed = cut_lineage(passed, "labels")
        ahead = passed.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
        labels = cut_lineage(passed.join(ahead, "label").select("node", "before", F.col("ahead").alias("label")), "labels")
        if labels.filter("before <> label").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def near_duplicates(prints: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """Adds `component_id`, the smallest key reachable, to rows of (key, `fingerprint`, ...).

    `component` is the smallest fingerprint reachable; it tells components apart whose keys clash.
    """
    prints = cut_lineage(prints, "fingerprints")
    nodes = cut_lineage(prints.groupBy("fingerprint").agg(F.min(key).alias("low")), "nodes")
    reached = components(links(nodes, radius))
    labelled = nodes.join(reached.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "label", F.coalesce("label", "fingerprint")
    )
    ids = labelled.groupBy("label").agg(F.min("low").alias("component_id"))
    named = cut_lineage(labelled.join(ids, "label").select("fingerprint", "component_id", F.col("label").alias("component")), "components")
    return prints.join(named, "fingerprint")


def hex_digits(prints: Column) -> Column:
    return F.lpad(F.lower(F.hex(prints)), 16, "0")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """One document of each component, columns as they were: the one with the smallest key.

    A key counts before none; of a component's rows with the same key, one with the smallest hash of its text stays.
    """
    row, mark = fresh(docs, "_row"), fresh(docs, "_mark")
    marked = docs.withColumn(row, F.xxhash64(F.col(key), F.col(text)))
    found = near_duplicates(fingerprints(marked, key, text, (row,)), key, radius)
    stays = (
        found.groupBy("component")
        .agg(F.min(F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col(row).alias("r"))).alias("s"))
        .select(F.col("s.r").alias(row), F.coalesce(F.col("s.k").cast("string"), F.lit("")).alias(mark))
        .distinct()
    )
    keyed = marked.withColumn(mark, F.coalesce(F.col(key).cast("string"), F.lit("")))
    return keyed.join(stays, [row, mark], "left_semi").dropDuplicates([row, mark]).select(*docs.columns)
