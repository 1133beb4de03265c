"""Order-independent numeric aggregates.

Floating sums depend on the order rows are combined, which changes with the
partitioning. Means and weighted means that are reported are therefore computed
from exact decimal sums: the result is the same for any partition count and in
any engine that sums decimals exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(38,9)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c) -> Column:
    """Sum as ``decimal(38,9)`` (exact, associative)."""
    return F.sum(_col(c).cast(EXACT))


def exact_mean(c) -> Column:
    """Mean of the non-null values from an exact sum; null for an empty group."""
    c = _col(c)
    return exact_sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))


def exact_weighted_mean(value, weight) -> Column:
    """``sum(value·weight) / sum(weight)`` with exact sums (weight is an integer count).

    Values hold nine decimal places and must stay below 10**9 (larger ones raise).
    """
    v, w = _col(value), _col(weight)
    # 18 and 19 digits multiply into 38 without losing a decimal place.
    num = F.sum(v.cast("decimal(18,9)") * w.cast("decimal(19,0)"))
    den = F.sum(w)
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")
