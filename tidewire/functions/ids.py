"""Deterministic time-ordered ids in UUID version 7 shape.

The random bits come from a hash of where the row was read, so a retried task
assigns the same id again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.times import millis


def uuid_v7(ts: Column, *identity: Column) -> Column:
    clock = F.lpad(F.lower(F.hex(millis(ts))), 12, "0")
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in identity]))
    variant = F.translate(digest.substr(4, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        clock.substr(1, 8), F.lit("-"),
        clock.substr(9, 4), F.lit("-7"),
        digest.substr(1, 3), F.lit("-"),
        variant, digest.substr(5, 3), F.lit("-"),
        digest.substr(8, 12),
    )
