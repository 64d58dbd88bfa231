"""Lookup joins that stay balanced whatever the size of the lookup side or the skew of its keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.session import cut_lineage

BROADCAST_ROWS = 100_000
# Rows of one key that a task may take; a heavier key is spread.
HEAVY_ROWS = 1_000_000


def fits(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most `max_rows + 1` rows."""
    return dim.limit(max_rows + 1).count() <= max_rows


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: list[str],
    salt_by: list[str],
    max_rows: int = BROADCAST_ROWS,
    salts: int = 64,
    computed: bool = False,
) -> DataFrame:
    """Inner equi-join of facts with a narrow lookup table.

    At most `max_rows` rows are broadcast, so facts do not move. Beyond that, keys of more than
    `HEAVY_ROWS` facts are spread over `salts` tasks and their lookup rows replicated as often; all
    others meet as they are. A `computed` lookup is written first, as it is needed both for its
    size and for the join.
    """
    if computed:
        dim = cut_lineage(dim, "lookup")
    if fits(dim, max_rows):
        return facts.join(F.broadcast(dim), on)
    heavy = cut_lineage(facts.groupBy(*on).count().filter(F.col("count") > HEAVY_ROWS).drop("count"), "heavy-keys")
    heavy = heavy.withColumn("_heavy", F.lit(True))
    marks = F.broadcast(heavy) if fits(heavy, max_rows) else heavy
    salt = F.when(F.col("_heavy"), F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = facts.join(marks, on, "left").withColumn("_salt", salt).drop("_heavy")
    copied = dim.join(marks, on, "left").withColumn("_salt", F.explode(copies)).drop("_heavy")
    return spread.join(copied, [*on, "_salt"]).drop("_salt")
