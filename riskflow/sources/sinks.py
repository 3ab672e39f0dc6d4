"""Writers. Output is a folder of part files written in parallel."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_lines(lines: DataFrame, path: str, column: str = "value") -> None:
    lines.select(column).write.mode("overwrite").text(path)


def through_table(rows: DataFrame, path: str) -> DataFrame:
    """Write the rows and read them back: cuts the lineage, survives lost executors."""
    write_table(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def bucketed_table(rows: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write the rows as a table `name` at a path, dealt by a hash of the key into buckets and sorted by it, and read it.

    Tables with the same key type and number of buckets join on the key without a shuffle, and aggregate by it without one.
    Rows are dealt before they are written, so that each bucket is one file. Made for tables with a row per key: rows without a
    key lie in one bucket. A table of that name is replaced.
    """
    dealt = rows.repartition(buckets, F.col(key))
    writer = dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path)
    writer.saveAsTable(name)
    return rows.sparkSession.table(name)
