"""Fingerprints of documents by locally consistent parsing.

A text is a string of symbols, its characters. Equal neighbours become one symbol, then deterministic
coin tossing shrinks the symbols to a few labels: a symbol's label is the lowest bit in which it differs
from its left neighbour, and that bit's value, four times over. A phrase starts at each label that is
larger than those beside it, and is named by a hash of its symbols; the names are the symbols of the next
level. A start depends on a few neighbours only, so equal substrings are cut alike inside, wherever they stand.
The fingerprint is the smallest names of the second level, each as often as it is met, so
likeness is the share of common names.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import CHUNK_BYTES, chunks, text_or_empty

#: Levels of phrases, rounds of coin tossing that bring 64 bits down to six labels, names in a fingerprint.
LEVELS, TOSSES, NAMES = 2, 4, 64
#: Characters parsed at a time, whose arrays fit in a core's cache.
PART = 64 << 10
#: Documents that are put in order together.
BLOCK_ROWS = 4_000
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Small labels of symbols that differ from their neighbours; `first` marks those that start a text."""
    label = symbols
    for _ in range(TOSSES):
        differs = label.copy()
        differs[1:] ^= label[:-1]
        differs[first] = 1
        differs[differs == 0] = 1  # beside a start, labels can come out equal
        low = np.bitwise_count((differs & (~differs + differs.dtype.type(1))) - differs.dtype.type(1))
        # Labels are less than 128 after the first toss.
        label = (2 * low + ((label >> low.astype(label.dtype)) & label.dtype.type(1)).astype(np.uint8)).astype(np.uint8)
    return label


def phrases(symbols: np.ndarray, text: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of the last level, and the number of the text that each is in.

    `symbols` are those of all texts one after another, `text` the number of each one's text.
    """
    for _ in range(levels):
        if not len(symbols):
            break
        at = np.flatnonzero(np.concatenate([[True], (symbols[1:] != symbols[:-1]) | (text[1:] != text[:-1])]))
        repeats = np.diff(np.append(at, len(symbols)))
        symbols, text = symbols[at], text[at]
        if symbols.dtype != np.uint64:  # characters have 21 bits; runs from 2047 on count as equally long
            symbols = symbols.astype(np.uint32) | (np.minimum(repeats, 2047).astype(np.uint32) << np.uint32(21))
        else:
            symbols = symbols + repeats.astype(np.uint64) * np.uint64(_BASE)
        first = np.concatenate([[True], text[1:] != text[:-1]])
        label = _toss(symbols, first)
        top = label[1:-1]
        peak = np.zeros(len(label), bool)
        peak[1:-1] = (top > label[:-2]) & (top > label[2:]) & ~first[2:]
        at = np.flatnonzero(first | peak)
        sizes = np.diff(np.append(at, len(symbols)))
        place = np.arange(len(symbols)) - np.repeat(at, sizes)
        powers = np.cumprod(np.full(int(sizes.max()) + 1, _BASE, np.uint64))
        symbols = _mix(np.add.reduceat(symbols * powers[place], at) + sizes.astype(np.uint64))
        text = text[at]
    return symbols, text


def fingerprints(texts: list[str], names: int = NAMES) -> list[np.ndarray]:
    """The smallest distinct names of each text, in order; an empty text has none."""
    sizes = np.array([len(t) for t in texts], np.int64)
    found: list[np.ndarray] = []
    start, size = 0, 0
    for stop, more in enumerate(sizes, 1):
        size += more
        if size >= PART or stop == len(sizes):
            found += _fingerprints(texts[start:stop], sizes[start:stop], names)
            start, size = stop, 0
    return found


def _fingerprints(texts: list[str], sizes: np.ndarray, names: int) -> list[np.ndarray]:
    symbols = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    found, text = phrases(symbols, np.repeat(np.arange(len(texts)), sizes))
    # The same name counts again each time it is met in a text. Names keep 40 bits.
    low = np.uint64(40)
    keys = np.sort((text.astype(np.uint64) << low) | (found.astype(np.uint64) >> (np.uint64(64) - low)))
    new = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]
    place = np.arange(len(keys))
    met = place - np.maximum.accumulate(np.where(new, place, 0))
    value = _mix((keys & np.uint64((1 << 40) - 1)) + met.astype(np.uint64) * np.uint64(_BASE)) >> np.uint64(32)
    keys = np.sort(((keys >> low) << np.uint64(32)) | value)
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)]]
    owner, value = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [value[a : min(b, a + names)] for a, b in zip(cuts, cuts[1:], strict=False)]


def likeness(a: np.ndarray, b: np.ndarray, names: int = NAMES) -> float:
    """Share of common names among the smallest of both; 1 for two empty texts."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:names]
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(both))


def written(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def fingerprint_documents(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """All rows and columns of `docs` with the fingerprint in `column`, which is replaced if it is there.

    A null text counts as empty and has the empty fingerprint. Equal texts have equal fingerprints.
    """
    kept = [c for c in docs.columns if c != column]
    schema = docs.select(*kept).schema.add(column, "string", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "__text__"):
                found = [written(x) for x in fingerprints(part.column("__text__").to_pylist())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(found, pa.string())], names=[*kept, column])

    return docs.select(*kept, text_or_empty(text).alias("__text__")).mapInArrow(run, schema)


def _in_blocks(docs: DataFrame, text: str) -> DataFrame:
    """Rows by block of doc_id, largest id first, and after them, marked, what the next block starts with."""
    lowest = -(1 << 63)
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(lowest)).alias("place"), text_or_empty(text).alias("text"))
    ids = rows.select("place")
    blocks = max(1, -(-ids.count() // BLOCK_ROWS))
    cuts = ids.approxQuantile("place", [k / blocks for k in range(1, blocks)], 0.2 / blocks) if blocks > 1 else []
    rows = rows.withColumn("as_double", F.col("place").cast("double"))
    if cuts:
        # A bucket is a growing function of the id, so blocks are ranges of ids however they round.
        splits = [-float("inf"), *sorted(set(cuts)), float("inf")]
        rows = Bucketizer(splits=splits, inputCol="as_double", outputCol="bucket").transform(rows)
    else:
        rows = rows.withColumn("bucket", F.lit(0))
    rows = rows.withColumn("block", F.col("bucket").cast("int")).drop("as_double", "bucket")
    # One id for each block, of thousands of rows.
    largest = dict(sorted((r[0], r[1]) for r in rows.groupBy("block").agg(F.max("place")).collect()))
    order = list(largest)
    after = [(largest[order[k - 1]], block) for k, block in enumerate(order)]
    starts = docs.sparkSession.createDataFrame(after, "place long, next_block int")
    edges = rows.join(F.broadcast(starts), "place").select("doc_id", "place", "text", F.col("next_block").alias("block"))
    both = rows.select("block", F.lit(False).alias("edge"), "doc_id", "place", "text").unionByName(edges.withColumn("edge", F.lit(True)))
    return both.repartitionById(blocks, "block").sortWithinPartitions("block", "edge", F.desc("place"), "text").drop("place")


def _compared(rows: list[tuple[int | None, str]]) -> Iterator[pa.RecordBatch]:
    """Results for all rows but the last, each compared with the row after it."""
    if len(rows) < 2:
        return
    texts = [t for _, t in rows]
    edited = [a[: len(a) - len(a) // 3] + b[: len(a) // 3] for a, b in zip(texts, texts[1:], strict=False)]
    own, other = fingerprints(texts), fingerprints(edited)
    columns = [
        pa.array([d for d, _ in rows[:-1]], pa.int64()),
        pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array([written(x) for x in own[:-1]], pa.string()),
        pa.array([written(x) for x in other], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(own, other, strict=False)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
    ]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    yield pa.RecordBatch.from_arrays(columns, names=names)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple[int | None, str]] = []
    block, closed, size = None, False, 0
    for batch in batches:
        for part in chunks(batch, "text"):
            columns = [part.column(c).to_pylist() for c in ("block", "edge", "doc_id", "text")]
            for b, edge, doc, text in zip(*columns, strict=True):
                if b != block:
                    waiting, block, closed, size = [], b, False, 0
                if closed:
                    continue  # rows with the same id as the one the next block starts with
                waiting.append((doc, text))
                size += len(text)
                if edge or size > CHUNK_BYTES:
                    yield from _compared(waiting)
                    waiting, size, closed = waiting[-1:], 0, edge


def compare_with_next(docs: DataFrame, text: str = "text") -> DataFrame:
    """For each row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller doc_id, after the smallest the largest; rows with
    equal ids follow one another by text, and null ids come after all others. The edited text has its
    last third replaced by as much of the start of the next one. A null text is empty; a single row is
    its own next. Text is shuffled once. An empty table gives no row.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return _in_blocks(docs, text).mapInArrow(_stream, schema)
