"""Mixing sources to target weights by systematic sampling; DataFrame functions only.

A source's target is its share of the mixed words, at most `max_repeat` times its own words; what is
above that is shared again among the others by weight. Each of its documents then has the same
expected number of copies, target / size. Documents of a source are laid out by length, their expected
copies are summed up along it, one random offset (a digest of seed and source) is added, and a document
is taken once for each whole number that its stretch of the sum crosses. Ordered by length, the taken
words differ from the target by about one document. Sums are whole numbers of 2**-24 copies, so that
they neither drift nor depend on the order of additions.

The prefix sum has three levels, so that no source is summed up in one task: length classes of a source,
`BUCKETS` buckets (by a digest of the key) of a class, documents of a bucket.

A null text has no words. A null source is a source of its own, after all others. Equal rows may be
taken a different number of times, but the multiset of result rows is the same in each run. A source
without words takes nothing. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import WORD, fresh
from tidewire.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_REPEAT = 2.0
BUCKETS = 256
UNIT = 1 << 24
# What WORD leaves out.
SPACES = " \t\n\v\f\r"
SPACE = r"[\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    """Each word and the space after it become one character. `regexp_count` makes an array of all words to count them."""
    marks = F.ltrim(F.regexp_replace(text, f"{WORD}{SPACE}*", "x"), F.lit(SPACES))
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Number of digits and the first two of them: lengths of a class differ by a tenth at most."""
    digits = size.cast("string")
    return F.length(digits) * 100 + F.rpad(digits, 2, "0").substr(1, 2).cast("int")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], total_share: float, max_repeat: float) -> DataFrame:
    """From one row per source (`_source`, `_size`), adds `_target`.

    Sources are ordered by cap / weight. If the first k of them stop at their caps, the rest share what
    is left at `(words - caps) / weights` each; k is where that level no longer reaches the next cap, and
    there it is highest. Ranks by name and by cap need all sources in one task: one narrow row each, no text.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), rank + 1)
    by_cap = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.col("_all") * total_share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.col("_weights") - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    )
    return (
        sizes.withColumn("_weight", weight)
        .withColumn("_cap", F.col("_size") * F.lit(float(max_repeat)))
        .withColumn("_all", F.sum("_size").over(everything))
        .withColumn("_weights", F.sum("_weight").over(everything))
        .withColumn("_level", level)
        .withColumn("_level", F.max(F.when(F.col("_cap") >= F.col("_weight") * F.col("_level"), F.col("_level"))).over(everything))
        .withColumn("_target", F.least("_cap", F.coalesce(F.col("_weight") * F.col("_level"), F.col("_cap"))))
        .select("_source", "_size", "_target")
    )


def plan_copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_repeat: float = MAX_REPEAT,
    seed: int = 0,
) -> tuple[DataFrame, dict[str, str]]:
    """The documents with their words, their source's words and target, and their number of copies.

    Also returns the names of the four new columns under `size`, `source_size`, `target`, `copies`;
    a name that the documents have already gets underscores in front.
    """
    names = {n: fresh(docs, n) for n in ("size", "source_size", "target", "copies")}
    own = {n: fresh(docs, n) for n in ("_mix_class", "_mix_bucket", "_mix_source", "_mix_start", "_mix_step", "_mix_rank", "_mix_tie")}
    c_class, c_bucket, c_source = own["_mix_class"], own["_mix_bucket"], own["_mix_source"]
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    placed = (
        docs.withColumn(names["size"], word_count(F.col(text)))
        .withColumn(c_class, size_class(F.col(names["size"])))
        .withColumn(own["_mix_tie"], F.xxhash64(text))
        .withColumn(c_bucket, F.conv(F.substring(digest, 1, 2), 16, 10).cast("int"))
        # A null can't be joined on: sources are told apart by a prefixed name.
        .withColumn(c_source, F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")))
    )
    cells = cut_lineage(
        placed.groupBy(F.col(source).alias("_source"), F.col(c_class).alias("_class"), F.col(c_bucket).alias("_bucket")).agg(
            F.count(F.lit(1)).alias("_n"), F.sum(names["size"]).alias("_words")
        ),
        "mixing-cells",
    )
    classes = cells.groupBy("_source", "_class").agg(F.sum("_n").alias("_n"), F.sum("_words").alias("_words"))
    sources = classes.groupBy("_source").agg(F.sum("_words").alias("_size"))
    targets = source_targets(sources, weights, total_share, max_repeat)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("_source", F.lit("")))), 1, 6), 16, 10).cast("long")
    step = F.when(F.col("_size") > 0, F.floor(F.col("_target") / F.col("_size") * UNIT)).otherwise(F.lit(0)).cast("long")

    def so_far(*keys: str, order: str) -> Column:
        window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    class_starts = classes.select("_source", "_class", so_far("_source", order="_class").alias("_class_start"))
    join_name = F.coalesce(F.concat(F.lit("="), F.col("_source")), F.lit(""))
    steps = targets.select(join_name.alias("_name"), "_size", "_target", step.alias("_step"), offset.alias("_offset"))
    starts = (
        cells.withColumn("_bucket_start", so_far("_source", "_class", order="_bucket"))
        .withColumn("_name", join_name)
        .join(class_starts.withColumn("_name", join_name).drop("_source"), ["_name", "_class"])
        .join(steps, "_name")
        .select(
            F.col("_name").alias(c_source),
            F.col("_class").alias(c_class),
            F.col("_bucket").alias(c_bucket),
            F.col("_size").alias(names["source_size"]),
            F.col("_target").alias(names["target"]),
            F.col("_step").alias(own["_mix_step"]),
            (F.col("_offset") + (F.col("_class_start") + F.col("_bucket_start")) * F.col("_step")).alias(own["_mix_start"]),
        )
    )
    ties = [F.col(names["size"]), F.col(key), F.col(own["_mix_tie"])]
    rank = F.row_number().over(Window.partitionBy(c_source, c_class, c_bucket).orderBy(*ties))

    def crossed(rank: Column) -> Column:
        return F.shiftright(F.col(own["_mix_start"]) + rank * F.col(own["_mix_step"]), 24)

    planned = (
        placed.join(starts, [c_source, c_class, c_bucket])
        .withColumn(own["_mix_rank"], rank)
        .withColumn(names["copies"], crossed(F.col(own["_mix_rank"])) - crossed(F.col(own["_mix_rank"]) - 1))
        .select(*docs.columns, *names.values())
    )
    return planned, names


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, columns as they were."""
    planned, names = plan_copies(docs, **options)
    copy = fresh(planned, "_copy")
    repeated = planned.filter(F.col(names["copies"]) > 0).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.col(names["copies"]).cast("int")))
    )
    return repeated.select(*docs.columns)
