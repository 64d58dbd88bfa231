"""Document fingerprints from closed syncmers; DataFrame functions only.

A text's tokens are its words, cut into pieces of up to `PIECE` characters, so that texts without spaces
have many tokens, too. A run of `K` tokens is an anchor if, of the hashes of the pairs of neighbours in
it, the smallest stands first or last. Whether it is one depends on nothing outside the run: an edit
elsewhere moves no anchor, and equal passages have equal anchors at equal distances. About half of
the runs are anchors.

The fingerprint holds every anchor in the order of the text: eight hex digits of its hash, a full stop, and its distance
in tokens, in hex, from the anchor before, from the first token for the first. Two anchors in a row with their distance
are a link; equal passages have equal links wherever they stand. The likeness of two fingerprints is the share of common
ones among all their distinct links. A text with one anchor has that for its only link, one without has the hash of
its tokens; a text without a token has an empty fingerprint, which is like another empty one (1) and unlike all
others (0).

Documents are neighbours in the order of their keys, nulls first, equal keys by their text's hash. The
order is made in ranges of keys between quantiles; one row, the first of the next range, is added to the
end of each, so no range needs another one and texts are shuffled once.

A null text is empty. Equal rows are neighbours of each other. A single row is its own neighbour. An empty
table gives an empty one. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.session import cut_lineage

PIECE = 6
K = 5
TOKEN = rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"
RANGES_PER_TASK = 4


def token_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))


def pair_hashes(tokens: Column) -> Column:
    """The hash of each token and the next; the last pairs with a null."""
    return F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))), lambda a, b: F.xxhash64(a, b))


def anchors(tokens: Column, pairs: Column) -> Column:
    """(`place`, `hash`) of every closed syncmer; places count tokens from 0."""

    def anchor(i: Column) -> Column:
        pair = [F.get(pairs, i + j) for j in range(K - 1)]
        least = F.least(*pair)
        closed = (pair[0] == least) | (pair[-1] == least)
        whole = F.xxhash64(pair[0], pair[2], F.get(tokens, i + K - 1))
        return F.when(closed, F.struct(i.alias("place"), F.shiftrightunsigned(whole, 33).cast("int").alias("hash")))

    runs = F.when(F.size(tokens) >= K, F.sequence(F.lit(0), F.size(tokens) - K)).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(runs, anchor), lambda a: a.isNotNull())


def fingerprint(tokens: Column, found: Column) -> Column:
    """The anchors, or in their place the hash of all tokens."""
    whole = F.struct(F.lit(0).alias("place"), F.shiftrightunsigned(F.xxhash64(tokens), 33).cast("int").alias("hash"))
    return F.when((F.size(found) == 0) & (F.size(tokens) > 0), F.array(whole)).otherwise(found)


def links(found: Column) -> Column:
    """Distinct hashes of neighbouring anchors and their distance, of a single anchor's hash if there is no other."""

    def link(i: Column) -> Column:
        a, b = F.get(found, i), F.get(found, i + 1)
        return F.xxhash64(a["hash"], b["hash"], b["place"] - a["place"])

    pairs = F.transform(F.sequence(F.lit(0), F.size(found) - 2), link)
    single = F.transform(found, lambda a: a["hash"].cast("bigint"))
    return F.array_distinct(F.when(F.size(found) > 1, pairs).otherwise(single))


def with_fingerprint(frame: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the fingerprint of a text column, and its links as `name`_links.

    Each step is a column of its own: an array used twice in one expression would be made twice.
    """
    steps = [f"{name}_{s}" for s in ("tokens", "pairs", "anchors")]
    return (
        frame.withColumn(steps[0], once(token_hashes(F.col(text))))
        .withColumn(steps[1], once(pair_hashes(F.col(steps[0]))))
        .withColumn(steps[2], once(anchors(F.col(steps[0]), F.col(steps[1]))))
        .withColumn(name, once(fingerprint(F.col(steps[0]), F.col(steps[2]))))
        .withColumn(f"{name}_links", once(links(F.col(name))))
        .withColumn(name, as_text(F.col(name)))
        .drop(*steps)
    )


def once(value: Column) -> Column:
    """A value that later expressions refer to instead of repeating it: a generator's output."""
    return F.explode(F.array(value))


def positions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and anchor: key, `place`, `hash`. Equal hashes at a constant distance are a shared passage."""
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_tokens", once(token_hashes(F.col("_text")))).withColumn("_pairs", once(pair_hashes(F.col("_tokens"))))
    return rows.select(key, F.explode(anchors(F.col("_tokens"), F.col("_pairs"))).alias("a")).select(key, "a.place", "a.hash")


def as_text(found: Column) -> Column:
    def written(a: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(0)).otherwise(F.get(found, i - 1)["place"])
        return F.concat(F.lpad(F.lower(F.hex(a["hash"])), 8, "0"), F.lit("."), F.lower(F.hex(a["place"] - before)))

    return F.array_join(F.transform(found, written), "-")


def likeness(a: Column, b: Column) -> Column:
    """The share of common links; both are distinct."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def range_number(key: Column, bounds: list[int]) -> Column:
    """How many bounds the key reaches: first among every n-th bound, then among the n after it."""
    if not bounds:
        return F.lit(0)
    n = max(1, int(len(bounds) ** 0.5))
    chunks = [bounds[i : i + n] for i in range(0, len(bounds), n)]
    reached = F.size(F.filter(F.array(*[F.lit(c[0]) for c in chunks]), lambda b: b <= key))
    fine = F.array(*[F.array(*[F.lit(b) for b in c]) for c in chunks])
    inside = F.size(F.filter(F.element_at(fine, F.greatest(reached, F.lit(1))), lambda b: b <= key))
    return F.when(key.isNull() | (reached == 0), F.lit(0)).otherwise((reached - 1) * n + inside)


def key_bounds(docs: DataFrame, key: str) -> list[int]:
    """Distinct quantiles of the keys, a few for each shuffle partition."""
    n = RANGES_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx(key, shares, max(10_000, 20 * n)).alias("b")).first()["b"]
    return sorted(set(found or []))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, `text`, `print`, `print_links`, and the next document's `next_text` and `next_links`.

    The last document is followed by the first.
    """
    number = range_number(F.col("key"), key_bounds(docs, key))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns(
        {"range": number, "tie": F.xxhash64("text")}
    )
    order = [F.col("key").asc_nulls_first(), F.col("tie")]
    first = rows.groupBy("range").agg(F.min(F.struct(F.col("key").isNotNull().alias("k"), "key", "tie")).alias("first"))
    by_range = Window.orderBy("range")
    # One row per range.
    heads = first.select("range", "first.key", "first.tie").withColumn("before", F.lag("range").over(by_range))
    heads = heads.withColumn("before", F.coalesce("before", F.max("range").over(Window.partitionBy())))
    heads = cut_lineage(heads.select("range", F.col("key").alias("first_key"), F.col("tie").alias("first_tie"), "before"), "heads")
    is_first = rows["key"].eqNullSafe(heads["first_key"]) & (rows["tie"] == heads["first_tie"]) & (rows["range"] == heads["range"])
    followers = (
        rows.join(F.broadcast(heads), is_first)
        .select(F.col("before").alias("range"), F.lit(1).alias("added"), "key", "tie", "text")
        .dropDuplicates(["range"])
    )
    all_rows = rows.select("range", F.lit(0).alias("added"), "key", "tie", "text").unionByName(followers)
    # Only texts are dealt out; links are made where the texts lie, and handed to the row before in the same order.
    ahead = Window.partitionBy("range").orderBy("added", *order)
    placed = all_rows.withColumn("next_text", F.lead("text").over(ahead))
    return (
        with_fingerprint(placed, "text", "print")
        .withColumn("next_links", F.lead("print_links").over(ahead))
        .filter("added = 0")
        .select(F.col("key").alias(key), "text", "print", "print_links", "next_text", "next_links")
    )


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by as much of the following one's beginning."""
    n = F.char_length(text)
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness to it and to the next."""
    rows = with_next(docs, key, text)
    rows = rows.select(
        key, "print", "print_links", "next_links", F.char_length("text").cast("long").alias("n_chars"),
        once(edited(F.col("text"), F.col("next_text"))).alias("edited"),
    )
    rows = with_fingerprint(rows, "edited", "edited_print")
    return rows.select(
        key,
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("print").alias("fingerprint"),
        F.col("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print_links"), F.col("edited_print_links")).alias("near_edited"),
        likeness(F.col("print_links"), F.col("next_links")).alias("near_next"),
    )
