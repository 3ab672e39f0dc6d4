"""Order-dependent operators that never put a whole source, or the whole table, in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions.columns import bucket_of

BEFORE = (Window.unboundedPreceding, -1)
UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def fill_forward(lines: DataFrame, event: str, out: str, *, source: str, segment: str, order: str) -> DataFrame:
    """`out` = last non-null `event` at or before the row, inside its source.

    Rows of a source are ordered by (segment, order); none of the three may be null. Each segment
    is filled on its own, and the value standing at its start comes from a table with one row per
    segment. Only that table is chained per source: for a file it has a row per split, so a single
    file of 30 TB in splits of 128 MB chains a quarter of a million short rows.
    """
    keys = [source, segment]
    here = Window.partitionBy(*keys).orderBy(order).rowsBetween(*UP_TO_HERE)
    earlier = Window.partitionBy(source).orderBy(segment).rowsBetween(*BEFORE)
    last_event = F.max_by(event, F.when(F.col(event).isNotNull(), F.col(order)))
    carried = (
        lines.groupBy(*keys)
        .agg(last_event.alias("_end"))
        .select(*keys, F.last("_end", ignorenulls=True).over(earlier).alias("_carried"), F.lit(True).alias("_found"))
    )
    # Both branches read the lines; if a source was cut into other segments the second time, that must not pass.
    lost = F.raise_error(F.lit("a segment of lines has no row in the table of segments; read the lines once more"))
    carried_name = F.when(F.col("_found"), F.col("_carried")).otherwise(lost.cast("string"))
    # No broadcast hint: the table grows with the data, and is small enough only at run time.
    return (
        lines.withColumn("_local", F.last(event, ignorenulls=True).over(here))
        .join(carried, keys, "left")
        .withColumn(out, F.coalesce(F.col("_local"), carried_name))
        .drop("_local", "_carried", "_found")
    )


def dense_index(
    rows: DataFrame,
    uniform: Column,
    ties: list[str],
    out: str,
    group: str | None = None,
    size: str | None = None,
    buckets: int = 1 << 16,
) -> DataFrame:
    """0-based position of each row in the order (uniform, *ties), per group; `size` adds the group's row count.

    `uniform` must be spread evenly over [0, 1), as a hash of a row's own key is: its buckets are
    then even whatever the data looks like. Rows are numbered inside a bucket; the start of a
    bucket is the row count of the earlier ones, at most `buckets` numbers per group.
    """
    # Both keys are non-null, so the join below keeps every row, also those without a group value.
    named = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    keyed = rows.withColumns({"_group": named, "_u": uniform}).withColumn("_bucket", bucket_of(F.col("_u"), buckets))
    keys = ["_group", "_bucket"]
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(*BEFORE)
    everything = Window.partitionBy("_group")
    starts = (
        keyed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            *keys,
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
            *([F.sum("_size").over(everything).alias(size)] if size else []),
        )
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy("_u", *ties))
    return (
        keyed.withColumn("_inside", inside)
        .join(starts, keys)
        .withColumn(out, F.col("_start") + F.col("_inside") - 1)
        .drop("_group", "_u", "_bucket", "_inside", "_start")
    )
