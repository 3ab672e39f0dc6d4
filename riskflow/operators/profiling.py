"""Data-quality counts. Each is one pass over its input."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pattern_counts(rows: DataFrame) -> DataFrame:
    """Rows per pattern. Rows without a pattern form a group that counts 0."""
    return rows.sparkSession.sql(
        "SELECT Pattern_Type, COUNT(Pattern_Type) AS count FROM {rows} GROUP BY Pattern_Type", rows=rows
    )


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def empty_string_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.agg(*[F.count_if(F.col(c) == "").alias(c) for c in columns])


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column, next to the number of rows."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def row_counts(rows: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(rows.columns)))


def class_distribution(rows: DataFrame, label: str) -> DataFrame:
    """Count and share of each class, also where a class is rare or the column takes many values."""
    total = rows.agg(F.count(F.lit(1))).scalar()
    return value_counts(rows, label).withColumn("share", F.col("count") / total)
