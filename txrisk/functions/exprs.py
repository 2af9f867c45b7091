"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUND_PLACES = 6


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int where an unknown (NULL) comparison counts as False,
    as NaN comparisons do in pandas (T3)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def clip_upper(c, cap) -> Column:
    """Upper clip that keeps NULL (``least`` alone would skip the NULL)."""
    c = col(c)
    return F.when(c.isNotNull(), F.least(c, cap if isinstance(cap, Column) else F.lit(cap)))


def present(c) -> Column:
    """A double with NaN as NULL: both mean "missing" in the data model."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x), x)


def safe_div(num, den, default: float | None = 0.0) -> Column:
    """Division whose zero/NULL denominator yields ``default`` (T21); never
    raises under ANSI mode."""
    q = F.try_divide(col(num), col(den))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def r6(c, places: int = ROUND_PLACES) -> Column:
    """Round computed doubles to a fixed number of places."""
    return F.round(col(c), places)


def digest(key, seed: int, tag: str | None = None) -> Column:
    """md5 hex digest of ``key:seed[:tag]`` — a partition-independent order."""
    parts = [col(key).cast("string"), F.lit(f":{seed}")]
    if tag is not None:
        parts.append(F.lit(f":{tag}"))
    return F.md5(F.concat(*parts))


def uniform(key, seed: int, tag: str) -> Column:
    """Deterministic draw in [0, 1) from the first 32 bits of the digest."""
    return F.conv(F.substring(digest(key, seed, tag), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def json_lit(value, ddl: str) -> Column:
    """One constant-folded literal for a small nested array (not a tree of
    thousands of literal nodes)."""
    return F.from_json(F.lit(json.dumps(value)), ddl)
