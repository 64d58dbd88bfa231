"""Keep a row when at least `seconds` have passed since the last kept row of its key.

This is both the idempotency rule (an event id is accepted again once its 24 h mark has expired)
and the alert cooldown. Which rows are kept depends on the chain of earlier ones, so:

* the first row of each key is kept; one row per key and task survives to the shuffle;
* only keys whose rows span at least the gap can keep more, and only their distinct times matter;
* keys with few such times fold a sorted array;
* keys with many build "next kept after" links in small time cells and follow them by doubling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.times import micros
from tidewire.operators.joins import BROADCAST_ROWS, fits
from tidewire.session import cut_lineage

# The fold copies its array per kept time, so longer chains follow links.
FOLD_LIMIT = 2_000
CELL_MICROS = 60_000_000


def keep_spaced(
    rows: DataFrame,
    keys: list[str],
    time: str,
    seconds: float,
    ties: list[str],
    fold_limit: int = FOLD_LIMIT,
) -> DataFrame:
    """`keys` must not be NULL. `ties` orders rows of equal time."""
    gap = int(seconds * 1_000_000)
    timed = rows.withColumn("_t", micros(F.col(time)))
    order = [F.col("_t"), *[F.col(c) for c in ties]]

    def first_of(frame: DataFrame, group: list[str]) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        return frame.withColumn("_rn", rank).filter("_rn = 1").drop("_rn")

    first = first_of(timed, keys)
    extra = _later_kept(timed.select(*keys, "_t"), keys, gap, fold_limit)
    if extra is None:
        return first.drop("_t")
    later = first_of(timed.join(extra, [*keys, "_t"], "left_semi"), [*keys, "_t"])
    return first.unionByName(later).drop("_t")


def _later_kept(times: DataFrame, keys: list[str], gap: int, fold_limit: int) -> DataFrame | None:
    """Kept (key, _t) pairs after each key's first, or None when no key spans the gap.

    The input is read once, down to the distinct times, which spread a key over all tasks. The join
    with the keys ends in a write, so a skewed key can be split while it runs.
    """
    distinct = cut_lineage(times.distinct(), "times")
    spans = distinct.groupBy(*keys).agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    long_lived = cut_lineage(
        spans.filter(F.col("_last") - F.col("_first") >= gap).select(*keys, "_first"), "long-lived"
    )
    if long_lived.isEmpty():
        return None
    few = F.broadcast(long_lived) if fits(long_lived) else long_lived
    candidates = cut_lineage(distinct.join(few, keys).filter(F.col("_t") >= F.col("_first") + gap), "candidates")
    sizes = candidates.groupBy(*keys).agg(F.count("*").alias("_n"))
    largest, total = sizes.agg(F.max("_n"), F.sum("_n")).first()
    if largest <= fold_limit:
        kept = _fold(candidates, keys, gap)
        # Few kept times are sent to the rows, so that the rows need not move for them.
        return F.broadcast(kept) if total <= BROADCAST_ROWS else kept
    crowded = cut_lineage(sizes.filter(F.col("_n") > fold_limit).select(*keys))
    few = candidates.join(crowded, keys, "left_anti")
    many = candidates.join(crowded, keys, "left_semi")
    return _fold(few, keys, gap).unionByName(_follow_links(many, keys, gap))


def _fold(candidates: DataFrame, keys: list[str], gap: int) -> DataFrame:
    def step(kept: Column, t: Column) -> Column:
        due = t >= F.element_at(kept, -1) + F.lit(gap)
        return F.when(due, F.concat(kept, F.array(t))).otherwise(kept)

    grouped = candidates.groupBy(*keys).agg(
        F.min("_first").alias("_first"), F.sort_array(F.collect_list("_t")).alias("_times")
    )
    chain = F.aggregate("_times", F.array("_first"), step)
    return grouped.select(*keys, F.explode(F.slice(chain, F.lit(2), F.size(chain))).alias("_t"))


def _follow_links(candidates: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """Kept times of crowded keys, reached from each key's first time along links t -> first time >= t + gap."""
    starts = candidates.groupBy(*keys).agg(F.min("_first").alias("_t"))
    nodes = candidates.select(*keys, "_t").unionByName(starts)
    links = cut_lineage(_links(nodes, keys, gap))
    reached = starts
    while True:
        step = reached.join(links, [*keys, "_t"]).select(*keys, F.col("_next").alias("_t"))
        grown = cut_lineage(reached.unionByName(step).distinct())
        links = cut_lineage(
            links.join(
                links.select(*keys, F.col("_t").alias("_next"), F.col("_next").alias("_far")),
                [*keys, "_next"],
            ).select(*keys, "_t", F.col("_far").alias("_next"))
        )
        reached = grown
        if links.isEmpty():
            return reached.join(starts, [*keys, "_t"], "left_anti")


def _links(nodes: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """For every time the first time at least `gap` later, looked up within small time cells."""

    def cell(c: Column) -> Column:
        return F.floor(c / CELL_MICROS)

    t = F.col("_t")
    no_time = F.lit(None).cast("bigint")
    seen = nodes.select(*keys, cell(t).alias("_cell"), t.alias("_x"), t.alias("_hit"), no_time.alias("_ask"))
    asked = nodes.select(
        *keys, cell(t + gap).alias("_cell"), (t + gap).alias("_x"), no_time.alias("_hit"), t.alias("_ask")
    )
    points = seen.unionByName(asked)
    # Going down in time, the smallest hit so far is the first one at or after the asked instant.
    falling = (
        Window.partitionBy(*keys, "_cell")
        .orderBy(F.col("_x").desc(), F.col("_hit").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = points.withColumn("_next", F.min("_hit").over(falling)).filter("_ask IS NOT NULL")
    later_cells = Window.partitionBy(*keys).orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        points.groupBy(*keys, "_cell")
        .agg(F.min("_hit").alias("_low"))
        .withColumn("_after", F.min("_low").over(later_cells))
        .select(*keys, "_cell", "_after")
    )
    return (
        inside.join(cells, [*keys, "_cell"])
        .select(*keys, F.col("_ask").alias("_t"), F.coalesce("_next", "_after").alias("_next"))
        .filter("_next IS NOT NULL")
    )
