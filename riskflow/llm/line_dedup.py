"""Removes lines that many documents share.

Each line of some length gives a row: 128 bits of its key, its document and its place. The rows are
dealt by ranges of (key, document, place) and sorted so, the largest document first, so even a key
that a third of all lines share spreads over many tasks. Each task streams its rows: the first
document of a key keeps its lines, and the others lose theirs once a third document is seen. A key whose rows reach the end of a
batch may go on in another one; only such rows wait for the counts of their keys, which are summed
before they are shuffled. The result is a compressed bitmap of the lines each document keeps, and
text is read only by those who apply it.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import materialize, text_or_empty

#: White space at the ends of a line that does not count, and letters that count as their small forms.
STRIPPED = " \t\n\x0b\x0c\r"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Identify a row of the input: equal ids with different texts are told apart, equal rows are one.
ROW = ["doc_id", "text_hash"]


def _lines(column: str):
    return F.split(text_or_empty(column), "\n", -1)


def keyed_lines(docs: DataFrame, text: str = "text", min_chars: int = 20) -> DataFrame:
    """A row for each line with a long enough key: doc_id, text_hash, place, h1, h2."""
    key = F.translate(F.btrim("line", F.lit(STRIPPED)), CAPITALS, SMALL)
    lines = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(_lines(text)).alias("place", "line"))
    return (
        lines.select(*ROW, "place", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select(*ROW, "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )


def _decide(batches: Iterator[pd.DataFrame], min_docs: int) -> Iterator[pd.DataFrame]:
    """Drops of sorted rows. A row is marked `open` if its key reaches an end of its batch."""
    for batch in batches:
        if batch.empty:
            continue
        h1, h2 = batch["h1"].to_numpy(), batch["h2"].to_numpy()
        doc = batch["doc"].to_numpy()
        new_key = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        new_doc = new_key | np.concatenate([[True], doc[1:] != doc[:-1]])
        key = np.cumsum(new_key) - 1
        docs_of_key = np.bincount(key, new_doc)
        first = doc[new_key][key]
        open_row = (key == 0) | (key == key[-1])
        drop = ~open_row & (docs_of_key[key] >= min_docs) & (doc != first)
        batch["open"] = open_row
        yield batch[drop | open_row]


def dropped_lines(docs: DataFrame, text: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The lines that go: doc_id, text_hash, place."""
    # Null ids are one document, smaller than any other.
    lowest = -(1 << 63)
    rows = keyed_lines(docs, text, min_chars).withColumn("doc", F.coalesce("doc_id", F.lit(lowest)))
    order = ["h1", "h2", F.desc("doc"), "place"]
    streamed = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(
            lambda batches: _decide(batches, min_docs),
            "doc_id long, text_hash long, place int, h1 long, h2 long, doc long, open boolean",
        )
    )
    marked = materialize(streamed, "line-marks")
    waiting = marked.where("open").drop("open")
    shared = (
        waiting.groupBy("h1", "h2")
        .agg(F.count_distinct("doc").alias("docs"), F.max("doc").alias("keeper"))
        .where(F.col("docs") >= min_docs)
    )
    # As a table its size is known when the join is planned: small, it leaves the rows of a common key where they are.
    shared = materialize(shared, "line-keepers")
    late = waiting.join(shared, ["h1", "h2"]).where("doc <> keeper")
    return marked.where("NOT open").select(*ROW, "place").unionByName(late.select(*ROW, "place"))


def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    def packed(n: int, places: np.ndarray) -> bytes:
        keep = np.ones(-(-n // 8) * 8, bool)
        keep[places] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return pd.Series([packed(n, p) for n, p in zip(n_lines, dropped, strict=True)], dtype=object)


def _apply(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    def kept(value: str, packed: bytes) -> str:
        lines = value.split("\n")
        keep = np.ones(len(lines), bool)
        bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))[: len(lines)]
        keep[: len(bits)] = bits
        return "\n".join(line for line, k in zip(lines, keep, strict=True) if k)

    return pd.Series([None if t is None else kept(t, b) for t, b in zip(text, bitmap, strict=True)], dtype=object)


def keep_bitmaps(docs: DataFrame, text: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """For each document that loses lines: doc_id, text_hash, n_dropped, keep (compressed bitmap, highest bit first).

    The bitmap is as long as the document's last dropped line; later lines stay.
    """
    drops = dropped_lines(docs, text, min_chars, min_docs).groupBy(*ROW).agg(F.collect_set("place").alias("places"))
    return drops.select(
        *ROW,
        F.size("places").cast("long").alias("n_dropped"),
        F.pandas_udf(_bitmap, "binary")(F.array_max("places") + 1, "places").alias("keep"),
    )


def dedup_lines(docs: DataFrame, text: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """All rows and columns of `docs`, with `n_lines`, `n_dropped` and the kept lines in `kept`.

    A line's key is the line without ASCII white space at its ends and with small ASCII letters. Lines
    whose key has at least `min_chars` characters and is in at least `min_docs` documents stay in the
    largest doc_id that has it only. Documents are told apart by doc_id: rows with equal ids are one
    document, null ids are one that is smaller than any other. A null text is one empty line. Columns of
    `docs` with the new names are replaced.
    """
    new = ("n_lines", "n_dropped", "kept")
    docs = docs.drop(*new)
    bitmaps = keep_bitmaps(docs, text, min_chars, min_docs).select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "n_dropped", "keep"
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64(text) == F.col("__hash"))
    joined = docs.join(bitmaps, same, "left")
    lines = F.size(_lines(text))
    changed = F.pandas_udf(_apply, "string")(F.when(F.col("keep").isNotNull(), F.col(text)), "keep")
    return joined.select(
        *docs.columns,
        lines.cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.coalesce(changed, text_or_empty(text)).alias("kept"),
    )
