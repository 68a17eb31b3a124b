"""Column and SQL-expression builders shared by the statistics.

Every one becomes a built-in Spark expression (the ``*_sql`` forms are
parsed by Spark once per query), so every statistic stays inside whole-stage
codegen with no Python on the hot path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (output name, nested source) of the key every player statistic groups by.
PLAYER_KEY_FIELDS: list[tuple[str, str]] = [
    ("team_name", "team.name"),
    ("team_id", "team.id"),
    ("player_name", "player.name"),
    ("player_id", "player.id"),
]
PLAYER_KEYS = [name for name, _ in PLAYER_KEY_FIELDS]


def player_keys() -> list[Column]:
    return [F.col(src).alias(name) for name, src in PLAYER_KEY_FIELDS]


def type_is(name: str) -> Column:
    return F.col("type.name") == name


def count_if_sql(cond: str | None) -> str:
    """SQL for the rows where ``cond`` is true (null counts as false); all rows for None."""
    return "count(1)" if cond is None else f"count_if({cond})"


def pct_sql(part: str, whole: str, scale: int = 0) -> str:
    """``round(part / whole * 100, scale)``; 0.0 when ``whole`` is 0 or null.

    Division stays in double, the same operation order as the source, so the
    rounding matches an SQL engine doing the same double arithmetic.
    """
    return f"coalesce(round(try_divide({part}, {whole}) * 100, {scale}), 0.0)"


def minutes_rounded_sql(seconds: str) -> str:
    """Exact ``round(sum(seconds) / 60, 2)`` as a double.

    Summing doubles depends on the order rows arrive in; summing decimals does
    not, so the result is the same however the data is partitioned.
    """
    return f"cast(round(sum(cast({seconds} AS decimal(18,6))) / 60, 2) AS double)"


def mm_ss(minute: Column, second: Column) -> Column:
    """Match clock as ``mm:ss``; minutes of 100 and more keep all their digits."""
    mins = F.when(minute < 10, F.concat(F.lit("0"), minute.cast("string"))).otherwise(
        minute.cast("string")
    )
    return F.concat(mins, F.lit(":"), F.lpad(second.cast("string"), 2, "0"))


def coord(col: str | Column, i: int) -> Column:
    """Element ``i`` (0-based) of a point array; null when the array is shorter."""
    col = F.col(col) if isinstance(col, str) else col
    return F.try_element_at(col, F.lit(i + 1))
