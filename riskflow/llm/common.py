"""Helpers shared by the operators of this package."""

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.sources.scratch import scratch_path
from riskflow.sources.sinks import through_table

#: Text bytes that one task handles at a time.
CHUNK_BYTES = 1 << 20
#: What is sent to Python at once.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _dropping_shuffle_files(spark: SparkSession):
    """Shuffle files of what runs inside go when it ends; its result is a table by then."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(rows: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back, so that no lineage is left to repeat."""
    with _dropping_shuffle_files(rows.sparkSession):
        return through_table(rows, scratch_path(rows.sparkSession, name))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]
    for start, stop in zip(cuts, cuts[1:], strict=False):
        if stop > start:
            yield batch.slice(start, stop - start)


def bounded_batches(spark: SparkSession) -> None:
    """From now on tasks of this session send Python at most BATCH_ROWS rows or BATCH_BYTES at once, unless it is set to less.

    A batch lies in the memory of the executor and of the worker, beyond the heap; the usual 10,000 rows of text are many MB.
    """
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = int(re.match(r"-?\d+", spark.conf.get(name))[0])
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def total_bytes(rows: DataFrame, column: str = "text") -> int:
    return rows.agg(F.sum(F.octet_length(column))).first()[0] or 0


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows in tables that cut no group, with the number of each row's group; `keys` are integers."""
    pending: pa.Table | None = None

    def numbered(rows: pa.Table) -> np.ndarray:
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for k in keys:
            value = rows.column(k).to_numpy()
            new[1:] |= value[1:] != value[:-1]
        return np.cumsum(new) - 1

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if pending is None else pa.concat_tables([pending, rows])
        group = numbered(rows)
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield rows.slice(0, cut), group[:cut]
        pending = rows.slice(cut)
    if pending is not None and pending.num_rows:
        yield pending, numbered(pending)


def components(edges: DataFrame) -> DataFrame:
    """node, root for each node of the edges (a, b): root is the smallest node it is connected with.

    In each round a node takes the smallest root among its own and its neighbours', then its root's root.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("beside")).union(
        edges.select(F.col("b").alias("node"), F.col("a").alias("beside"))
    )
    both = materialize(both.where("node <> beside").distinct(), "links")
    least = F.least("node", F.min("beside"))
    roots = materialize(both.groupBy("node").agg(least.alias("root")), "roots")
    while True:
        beside = both.join(roots.select(F.col("node").alias("beside"), "root"), "beside").groupBy("node").agg(F.min("root").alias("near"))
        nearer = roots.join(beside, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        nearer = materialize(nearer, "nearer-roots")
        further = nearer.select(F.col("node").alias("root"), F.col("root").alias("further"))
        roots = nearer.join(further, "root").select("node", F.col("further").alias("root"), (F.col("further") != F.col("old")).alias("moved"))
        roots = materialize(roots, "roots")
        if roots.where("moved").isEmpty():
            return roots.drop("moved")
