"""Column expressions shared by every model.

All are built-in Spark expressions, so they stay inside whole-stage codegen.

Rounding: ``round`` on a double rounds the binary value, which disagrees between engines
on exact ties. ``round_half_up`` first snaps the double to ``decimal(38,10)`` and then rounds
the exact decimal HALF_UP, which is deterministic and portable (the oracle uses the same
text). Results are returned as double, matching the reference's Float64 percentages.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAP = "decimal(38,10)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(x: Column | str, scale: int) -> Column:
    """Round a double HALF_UP at ``scale`` digits via the exact decimal snap."""
    return F.round(col(x).cast(SNAP), scale).cast("double")


def ratio_pct(num: Column | str, den: Column | str) -> Column:
    """``num * 100.0 / den`` in double arithmetic (no rounding, no guard)."""
    return col(num).cast("double") * F.lit(100.0) / col(den).cast("double")


def pct(num: Column | str, den: Column | str, scale: int) -> Column:
    """Guarded percentage: ``round(num*100/den, scale)`` when ``den > 0`` else 0."""
    return F.when(col(den) > 0, round_half_up(ratio_pct(num, den), scale)).otherwise(F.lit(0.0))


def pct_nullif(num: Column | str, den: Column | str, scale: int) -> Column:
    """``round(num*100/nullif(den,0), scale)``: NULL when the denominator is 0."""
    return round_half_up(col(num).cast("double") * F.lit(100.0) / F.nullif(col(den), F.lit(0)).cast("double"),
                         scale)


def count_when(cond: Column) -> Column:
    """Conditional count as a bigint (``sum(if(cond,1,0))``)."""
    return F.count_if(cond)


def flag(cond: Column) -> Column:
    """0/1 int flag (kept as int, not boolean, like the source's UInt8 flags)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def money_sum(c: Column | str) -> Column:
    """Exact decimal sum of a money column, widened to decimal(38,6)."""
    return F.sum(col(c)).cast("decimal(38,6)")


def mean_double(c: Column | str) -> Column:
    """Mean of a decimal column as double: ``sum`` is exact, one double division at the end."""
    return F.try_divide(F.sum(col(c)).cast("double"), F.count(col(c)).cast("double"))
