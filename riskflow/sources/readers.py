"""Readers. CSV files are read by the names in their headers; a file that lacks a column fails."""

import csv
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskflow.schemas import CORRUPT, DEFAULT_FEATURES, ML_DATASET, PATTERN_LABELS, RAW_NAMES, RAW_TRANSACTIONS


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """CSV with a header line; columns are taken by position, unreadable values are null."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=True)


def read_named_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, optional: tuple[str, ...] = ()
) -> DataFrame:
    """CSV with a header line; columns are taken by name, in the order of `schema`.

    Unreadable values are null. A column that is absent fails, or is null if it is `optional`. All files
    must have the same header; Spark checks each one.
    """
    rows = spark.read.csv(path, header=True, enforceSchema=False)
    require_columns(rows, [f.name for f in schema if f.name not in optional])
    return rows.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


# Headers


@contextmanager
def _a_task_for_each_file(spark: SparkSession):
    whole = {"spark.sql.files.maxPartitionBytes": 1 << 40, "spark.sql.files.openCostInBytes": 1 << 40}
    before = {k: spark.conf.get(k, None) for k in whole}
    for k, v in whole.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _first_of_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves the rest of the file unread."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def files_by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files below a path by the column names in their first lines. Empty files have none and are left out.

    Each task reads one file's first rows and stops, so no text is read twice. The driver gets a line for each
    file, as many as Spark lists there for any read.
    """
    with _a_task_for_each_file(spark):
        lines = spark.read.text(path).select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("start"))
        firsts = lines.mapInArrow(_first_of_file, "value string, file_path string, start long").where("start = 0").collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(firsts, key=lambda r: r.file_path):
        names = tuple(next(csv.reader([r.value.removeprefix("\ufeff")]), ()))
        groups.setdefault(names, []).append(unquote(r.file_path))
    if not groups:
        raise ValueError(f"no file with a header at {path}")
    return groups


def _read_group(spark: SparkSession, names: tuple[str, ...], files: list[str], corrupt: bool) -> DataFrame:
    """Files with one header, as text columns _0, _1, .. by position, and `CORRUPT` if asked for."""
    fields = [StructField(f"_{k}", StringType()) for k in range(len(names))]
    if not corrupt:
        return spark.read.csv(files, schema=StructType(fields), header=True, enforceSchema=True)
    # Pruned columns aren't counted by the parser, so lines of a wrong length would pass.
    reader = spark.read.option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT)
    schema = StructType([*fields, StructField(CORRUPT, StringType())])
    rows = reader.csv(files, schema=schema, header=True, enforceSchema=True, mode="PERMISSIVE")
    # Spark refuses queries that read this column alone, so it depends on the first one; the condition always holds.
    return rows.withColumn(CORRUPT, F.when(F.coalesce(F.length("_0"), F.lit(0)) >= 0, F.col(CORRUPT)))


def raw_positions(header: tuple[str, ...]) -> dict[str, int]:
    """Which column of a raw file has which field, by its name; raises if one is missing or named twice.

    A column called just "Account" belongs to the bank named last before it. One with a name that means nothing is taken by
    its position, if no other column has the name of the field of that position.
    """
    found: dict[str, int] = {}
    unknown, bank = [], "From_Bank"
    for place, name in enumerate(header):
        plain = re.sub(r"[^a-z0-9]+", "_", name.strip().lower())
        field = RAW_NAMES.get(plain)
        if plain == "account":
            field = "To_Account" if bank == "To_Bank" else "From_Account"
        if field is None:
            unknown.append(place)
            continue
        bank = field if field.endswith("_Bank") else bank
        if field in found:
            raise ValueError(f"two columns for {field} in the header {','.join(header)}")
        found[field] = place
    for place, field in enumerate(RAW_TRANSACTIONS.names):
        if field not in found and place in unknown:
            found[field] = place
    if missing := [f for f in RAW_TRANSACTIONS.names if f not in found]:
        raise ValueError(f"no column for {', '.join(missing)} in the header {','.join(header)}")
    return found


def read_raw_transactions(spark: SparkSession, path: str | list[str], corrupt: bool = False) -> DataFrame:
    """Raw transfers, by the names of each file's header, in any order. Amounts stay text, see `clean`.

    `corrupt` adds a column of that name with the text of lines that don't have as many fields as the header; such rows
    are rejected by `clean` and counted by `malformed_counts`. Without it their fields are taken as they come.
    """
    groups = []
    for names, files in files_by_header(spark, path).items():
        places = raw_positions(names)
        rows = _read_group(spark, names, files, corrupt)
        columns = [F.col(f"_{places[f.name]}").try_cast(f.dataType).alias(f.name) for f in RAW_TRANSACTIONS]
        width = F.lit(len(names)).alias(f"{CORRUPT}_width")
        groups.append(rows.select(*columns, *([CORRUPT, width] if corrupt else [])))
    return reduce(DataFrame.unionByName, groups)


def malformed_counts(rows: DataFrame) -> DataFrame:
    """kind, n_rows of the lines that a reader marked as corrupt: short, long, or "quote" where a quoted field goes over the line's end.

    What follows such an end is a line of its own: short too, or, if the first field was the broken one, a row whose first field is unreadable.
    """
    line = F.col(CORRUPT)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    fields = F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ","))
    kind = F.when(quotes % 2 == 1, "quote").when(fields < F.col(f"{CORRUPT}_width"), "short").otherwise("long")
    return rows.where(line.isNotNull()).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_rows"))


def read_label_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Label rows, with or without the account column; without it the account is null."""
    return read_named_csv(spark, path, PATTERN_LABELS, optional=("From_Account",))


def read_ml_dataset(spark: SparkSession, path: str, csv: bool = False) -> DataFrame:
    """A dataset as `build_dataset` writes it, or the same as CSV with or without the spread."""
    if not csv:
        return spark.read.parquet(path)
    given = spark.read.csv(path, header=True, enforceSchema=False).columns
    spread = StructType().add("StdDevAmount", "double")
    return read_named_csv(spark, path, StructType([*ML_DATASET, *(spread if "StdDevAmount" in given else [])]))


def read_scoring_batch(spark: SparkSession, path: str | list[str], corrupt: bool = False) -> DataFrame:
    """CSV with any columns in any order, also another order in each file.

    Feature columns become numbers, the rest stays text; a value that is no number is null. A column that
    only some files have is null for the others. `corrupt` as in `read_raw_transactions`.
    """
    groups = []
    for names, files in files_by_header(spark, path).items():
        if len(set(names)) < len(names):
            raise ValueError(f"a column name occurs twice in the header {','.join(names)}")
        rows = _read_group(spark, names, files, corrupt)
        columns = [F.col(f"_{k}").alias(name) for k, name in enumerate(names)]
        width = F.lit(len(names)).alias(f"{CORRUPT}_width")
        groups.append(require_columns(rows.select(*columns, *([CORRUPT, width] if corrupt else [])), ["From_Account"]))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)
    present = [c for c in DEFAULT_FEATURES if c in rows.columns]
    return rows.withColumns({c: F.col(c).try_cast("double") for c in present})


def read_pattern_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines with `source` (file), `segment` (byte at which the split starts) and `line_no`.

    `line_no` grows within a split. It says nothing across splits, which Spark packs into tasks
    by size, so the order within a file is (segment, line_no).
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("segment"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )


def require_columns(rows: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in rows.columns]
    if missing:
        raise ValueError(f"input lacks the column(s) {', '.join(missing)}")
    return rows


def union_sources(sources: dict[str, DataFrame], name: str = "origin") -> DataFrame:
    """All rows of all sources, each marked with the name of its source.

    Pattern lines of two sources may have equal `source` values; fills keep them apart by this mark.
    """
    marked = [rows.withColumn(name, F.lit(key)) for key, rows in sources.items()]
    return reduce(DataFrame.unionByName, marked)
