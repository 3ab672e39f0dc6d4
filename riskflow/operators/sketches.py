"""Distinct counts and quantiles for keys with unbounded categories, from sketches of fixed size.

`sketch` makes one row per key and period: `n`, a theta sketch of each counted column and a KLL sketch of the number
column, as binary columns that can be stored. `merge_sketches` makes longer periods of them without reading rows again, and
`estimates` reads them. A theta sketch is exact up to 2^`DISTINCT_BITS` values and then has a standard error of
`distinct_error`; a quantile's rank is off by at most `rank_error`, with 99 % confidence. A key's sketches have a few dozen kB at
most, however many rows it has, and are made on the map side, so a hot key stays spread.

Nulls aren't counted, as by an exact distinct count; a null key is a key, a null time a period. A column with nulls only has 0
distinct values and null quantiles.
"""

from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DISTINCT_BITS = 12
KLL_SIZE = 200
QUANTILES = (0.25, 0.5, 0.9, 0.99)


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Standard error of a distinct count beyond 2^bits values, as a share of it."""
    return 1 / sqrt((1 << bits) - 1)


def rank_error(k: int = KLL_SIZE) -> float:
    """How far the rank of a quantile may be off, as a share of all rows, with 99 % confidence (two-sided).

    A bound for the sketch's k, from its published error curve: 2.446 / k^0.9433.
    """
    return 2.446 / k**0.9433


def sketch(
    rows: DataFrame, keys: list[str], distinct: list[str], number: str, period: Column | None = None, bits: int = DISTINCT_BITS
) -> DataFrame:
    """The keys, `period` if one is given, `n`, `<column>_distinct` for each counted column and `<number>_quantiles`."""
    if period is not None:
        rows, keys = rows.withColumn("period", period), [*keys, "period"]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.theta_sketch_agg(c, bits).alias(f"{c}_distinct") for c in distinct],
        F.kll_sketch_agg_double(F.col(number).cast("double"), KLL_SIZE).alias(f"{number}_quantiles"),
    )


def _columns(sketches: DataFrame, suffix: str) -> list[str]:
    return [c for c in sketches.columns if c.endswith(suffix)]


def merge_sketches(sketches: DataFrame, keys: list[str], bits: int = DISTINCT_BITS) -> DataFrame:
    """One row for each value of the keys, which are some of the columns the sketches were made by."""
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        *[F.theta_union_agg(c, bits).alias(c) for c in _columns(sketches, "_distinct")],
        *[F.kll_merge_agg_double(c, KLL_SIZE).alias(c) for c in _columns(sketches, "_quantiles")],
    )


def estimates(sketches: DataFrame, quantiles: tuple[float, ...] = QUANTILES) -> DataFrame:
    """The sketches read: `Num<column>` for each theta sketch, `<number>_q<percent>` for each quantile."""
    found = [F.theta_sketch_estimate(c).alias(f"Num{c.removesuffix('_distinct')}") for c in _columns(sketches, "_distinct")]
    for c in _columns(sketches, "_quantiles"):
        known = F.kll_sketch_get_n_double(c) > 0
        for q in quantiles:
            value = F.when(known, F.kll_sketch_get_quantile_double(c, F.lit(float(q))))
            found.append(value.alias(f"{c.removesuffix('_quantiles')}_q{q * 100:g}"))
    others = [c for c in sketches.columns if not c.endswith(("_distinct", "_quantiles"))]
    return sketches.select(*others, *found)
