"""As-of joins and running totals in time cells, so that no key's history stands in one task.

Time is cut into cells. A fact meets the steps of its own key and cell; what held when the cell began is carried into
it as one more step. A task thus has a cell's rows. A cell with many facts is cut further: its facts are dealt over
several tasks and its steps, at most one a microsecond, are copied to each. Only cells that hold facts are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.times import micros
from tidewire.operators.joins import fits
from tidewire.session import cut_lineage

CELL_MICROS = 60_000_000
# Facts of a key and cell that one task may take.
CELL_ROWS = 1_000_000


def _cell(at: Column, width: int) -> Column:
    return F.floor(at / width)


def as_of(
    facts: DataFrame,
    steps: DataFrame,
    keys: list[str],
    fact_time: str,
    step_time: str,
    values: list[str],
    salt_by: list[str],
    ties: tuple[str, ...] = (),
    strict: bool = False,
    ahead: bool = False,
    cell_micros: int = CELL_MICROS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Facts with the `values` of the last step of the same keys that is not later; nulls if there is none.

    `strict` leaves out steps of the fact's own time, `ahead` takes the first step that is not earlier. Columns in
    `ties`, which both sides have, order rows of one time. A fact with a null key or time has no step. `salt_by` are
    the facts' columns that deal a crowded cell's rows over tasks.
    """
    known = F.lit(True)
    for c in (*keys, fact_time):
        known = known & F.col(c).isNotNull()
    order = [*ties]
    fact = F.struct(*facts.columns)
    asked = facts.filter(known).select(
        *keys, micros(F.col(fact_time)).alias("_x"), *order, fact.alias("_f"), F.lit(1 if not strict else 0).alias("_kind"),
        F.xxhash64(*salt_by).alias("_deal"),
    ).withColumn("_cell", _cell(F.col("_x"), cell_micros))
    given = steps.select(
        *keys, micros(F.col(step_time)).alias("_x"), *order, F.struct(*values).alias("_v"), F.lit(0 if not strict else 1).alias("_kind")
    ).withColumn("_cell", _cell(F.col("_x"), cell_micros))
    given = given.dropna(subset=[*keys, "_x"])

    group = [*keys, "_cell"]
    sizes = cut_lineage(asked.groupBy(*group).count(), "cells")
    place = F.struct("_x", *order)
    edge = F.min_by("_v", place) if ahead else F.max_by("_v", place)
    # One row per key and cell.
    by_cell = Window.partitionBy(*keys).orderBy(F.col("_cell").desc() if ahead else F.col("_cell"))
    carried = (
        given.groupBy(*group).agg(edge.alias("_v"), F.lit(False).alias("_wanted"))
        .unionByName(sizes.select(*group, F.lit(True).alias("_wanted")), allowMissingColumns=True)
        .groupBy(*group).agg(F.first("_v", ignorenulls=True).alias("_v"), F.max("_wanted").alias("_wanted"))
        .withColumn("_v", F.last("_v", ignorenulls=True).over(by_cell.rowsBetween(Window.unboundedPreceding, -1)))
        .filter("_wanted AND _v IS NOT NULL")
        .select(*group, ((F.col("_cell") + (1 if ahead else 0)) * cell_micros).alias("_x"), "_v", F.lit(-1).alias("_kind"))
    )
    inside = given.join(sizes.select(*group), group, "left_semi")
    known_steps = inside.unionByName(carried, allowMissingColumns=True)

    crowded = sizes.filter(F.col("count") > cell_rows)
    if crowded.isEmpty():
        rows = asked.unionByName(known_steps, allowMissingColumns=True).withColumn("_salt", F.lit(0))
    else:
        tasks = crowded.select(*group, F.ceil(F.col("count") / cell_rows).cast("int").alias("_tasks"))
        tasks = F.broadcast(tasks) if fits(tasks) else tasks
        salt = F.coalesce(F.pmod("_deal", F.col("_tasks")).cast("int"), F.lit(0))
        copies = F.coalesce(F.sequence(F.lit(0), F.col("_tasks") - 1), F.array(F.lit(0)))
        dealt = asked.join(tasks, group, "left").withColumn("_salt", salt).drop("_tasks")
        copied = known_steps.join(tasks, group, "left").withColumn("_salt", F.explode(copies)).drop("_tasks")
        rows = dealt.unionByName(copied, allowMissingColumns=True)

    if ahead:
        sort = [F.col("_x").desc(), *[F.col(c).desc_nulls_first() for c in order], F.col("_kind")]
    else:
        sort = [F.col("_x"), *[F.col(c).asc_nulls_first() for c in order], F.col("_kind")]
    so_far = Window.partitionBy(*group, "_salt").orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_v", F.last("_v", ignorenulls=True).over(so_far)).filter("_f IS NOT NULL").select("_f.*", "_v.*")
    unknown = facts.filter(~known)
    return found.unionByName(unknown, allowMissingColumns=True)


def running_total(
    changes: DataFrame, keys: list[str], time: str, change: str, total: str, cell_micros: int = CELL_MICROS
) -> DataFrame:
    """One step (keys, `time`, `total`) per time at which something changes: the sum of all changes up to it."""
    summed = changes.groupBy(*keys, time).agg(F.sum(change).alias("_change"))
    summed = cut_lineage(summed.withColumn("_cell", _cell(micros(F.col(time)), cell_micros)), "changes")
    group = [*keys, "_cell"]
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = summed.groupBy(*group).agg(F.sum("_change").alias("_sum")).withColumn("_before", F.sum("_sum").over(earlier)).drop("_sum")
    within = Window.partitionBy(*group).orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        summed.withColumn("_within", F.sum("_change").over(within))
        .join(carried, group)
        .select(*keys, time, (F.coalesce("_before", F.lit(0)) + F.col("_within")).alias(total))
    )
