"""Finds test items in training text by BM25 search.

The test items are the index: postings of each term with its BM25 weight, cut in blocks with the largest
weight of each. Every passage of every document is a query, and all items above the threshold come back: weights are divided
by the score an item gives itself, so the threshold is the same for all. A passage whose terms can't
reach it together isn't searched at all; the others are searched by block-max WAND, which steps over
items, and over blocks, that can't reach it. What is found is verified on the words themselves: the
share of the item's question, and of its answer, whose five-word shingles are in the document.

Items are indexed in shards of a bounded size, and each shard is a pass over the documents. Document
frequencies, the mean length and the size of passages are of all items, so scores don't depend on the shards.
"""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from math import fsum, log
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import chunks, materialize

#: Items whose index goes to the executors at once, and the text bytes of these.
SHARD_ITEMS, SHARD_BYTES = 2_000, 8 << 20
K1, B = 1.2, 0.75
#: Items in a block of a posting list, and the ranges of items, first wide and then narrow, that passages
#: are tested by before the search.
BLOCK, RANGES = 64, (32, 256)
#: Share of an item's own score that a passage must reach, and share of the shingles of question and answer.
THRESHOLD, OVERLAP, SHINGLE = 0.5, 0.8, 5
_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before the last sentence, and those of the last sentence. One sentence is both."""
    sentences = [w for w in map(words, re.split(r"(?<=[.!?])\s+|\n+", text)) if w]
    if len(sentences) < 2:
        whole = sentences[0] if sentences else []
        return whole, whole
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def shingles(found: list[str]) -> set[tuple[str, ...]]:
    """Runs of five words; fewer words are one run."""
    return {tuple(found[i : i + SHINGLE]) for i in range(max(1, len(found) - SHINGLE + 1))} if found else set()


@dataclass
class Statistics:
    """Of all items: their count, mean and longest length in words, and by term the number of items that have it."""

    count: int
    mean: float
    longest: int
    df: dict[str, int]


def statistics(items: list[tuple[int, str]]) -> Statistics:
    found = [words(t) for _, t in items]
    lengths = [len(w) for w in found]
    return Statistics(len(items), sum(lengths) / max(1, len(lengths)), max(lengths, default=0), Counter(t for w in found for t in set(w)))


class Index:
    """BM25 postings of some items, with the largest weight of each block; `known` is of all items, of these if not given."""

    def __init__(self, items: list[tuple[int, str]], known: Statistics | None = None):
        known = known or statistics(items)
        self.items = [i for i, _ in items]
        parts = [question_and_answer(t) for _, t in items]
        self.parts = [(shingles(q), shingles(a)) for q, a in parts]
        bags = [Counter(words(t)) for _, t in items]
        lengths = [sum(b.values()) for b in bags]
        mean = known.mean or 1
        idf = {t: log(1 + (known.count - n + 0.5) / (n + 0.5)) for t, n in known.df.items()}
        postings = defaultdict(list)
        for n, (bag, length) in enumerate(zip(bags, lengths, strict=True)):
            weight = {t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * length / mean)) for t, f in bag.items()}
            own = sum(weight.values())
            for t, w in weight.items():
                postings[t].append((n, w / own))
        self.terms = {t: k for k, t in enumerate(postings)}
        self.postings = list(postings.values())
        self.best = np.array([max(w for _, w in p) for p in self.postings], np.float64)
        self.blocks = [[(p[min(k + BLOCK, len(p)) - 1][0], max(w for _, w in p[k : k + BLOCK])) for k in range(0, len(p), BLOCK)] for p in self.postings]
        # The largest weight of each term in each range of items.
        self.ranges = [np.zeros((len(self.postings), k), np.float32) for k in RANGES]
        for t, p in enumerate(self.postings):
            for n, w in p:
                for level in self.ranges:
                    r = n * level.shape[1] // len(items)
                    level[t, r] = max(level[t, r], w)
        #: Passages have twice the words of the longest item and overlap by half, so each item fits in one.
        self.window = 2 * max(SHINGLE, known.longest)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items that score `threshold` or more for the distinct terms, by block-max WAND."""
        lists = [[self.postings[t], 0, self.blocks[t], self.best[t]] for t in terms]
        found = []
        while lists:
            lists.sort(key=lambda c: c[0][c[1]][0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(lists):
                bound += c[3]
                if bound >= threshold - 1e-9:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[pivot][0][lists[pivot][1]][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][1]][0] == item:
                pivot += 1
            # The blocks that hold the pivot item, or come next after it, bound all items up to the first block's end.
            bound, end = 0.0, None
            for c in lists[: pivot + 1]:
                k = _block(c, item)
                if k < len(c[2]):
                    bound += c[2][k][1]
                    end = c[2][k][0] if end is None else min(end, c[2][k][0])
            if bound < threshold - 1e-9:
                to = (item if end is None else end) + 1
                if pivot + 1 < len(lists):  # a list that the bound left out; it stands after the pivot item
                    to = min(to, lists[pivot + 1][0][lists[pivot + 1][1]][0])
                moved = lists[: pivot + 1]
            elif lists[0][0][lists[0][1]][0] == item:
                # Exact, as the order of the lists differs from shard to shard.
                score = fsum(c[0][c[1]][1] for c in lists[: pivot + 1])
                if score >= threshold - 1e-9:
                    found.append((item, score))
                moved, to = lists[: pivot + 1], item + 1
            else:
                moved, to = lists[:pivot], item
            for c in moved:
                while c[1] < len(c[0]) and c[0][c[1]][0] < to:
                    c[1] += 1
            lists = [c for c in lists if c[1] < len(c[0])]
        return found


def _block(cursor: list, item: int) -> int:
    k = cursor[1] // BLOCK
    while k < len(cursor[2]) and cursor[2][k][0] < item:
        k += 1
    return k


def _open_passages(index: Index, ids: np.ndarray, threshold: float) -> Iterator[tuple[int, int, list[int]]]:
    """Passages whose distinct terms may reach the threshold in some range of items: start, stop, terms."""
    places = np.flatnonzero(ids >= 0)
    terms = ids[places]
    if index.best[terms].sum() < threshold - 1e-9:
        return
    half, count = index.window // 2, len(index.best)
    passages = max(1, -(-(len(ids) - half) // half))
    # A word is in the passage that starts in its half and in the one before.
    own = places // half
    pairs = np.concatenate([own * count + terms, (own - 1) * count + terms])
    pairs = np.unique(pairs[(pairs >= 0) & (pairs < passages * count)])
    passage, terms = np.divmod(pairs, count)
    may = np.bincount(passage, index.best[terms], passages) >= threshold - 1e-9
    for level in index.ranges:
        passage, terms = passage[may[passage]], terms[may[passage]]
        if not len(passage):
            return
        first = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        may = np.zeros(passages, bool)
        may[passage[first]] = np.add.reduceat(level[terms], first, axis=0).max(axis=1) >= threshold - 1e-5
    ends = [*first[1:], len(passage)]
    for k in np.flatnonzero(may[passage[first]]):
        start = int(passage[first[k]]) * half
        yield start, min(start + index.window, len(ids)), terms[first[k] : ends[k]].tolist()


def _hits(index: Index, text: str, threshold: float, overlap: float) -> list[tuple[int, float, float, float]]:
    """Items of the index that a text holds: place in the index, score, shares of question and answer."""
    found = words(text)
    number = index.terms.get
    ids = np.array([number(w, -1) for w in found], np.int64)
    scores: dict[int, float] = {}
    spans: dict[int, tuple[int, int]] = {}
    for a, b, terms in _open_passages(index, ids, threshold):
        for item, score in index.search(terms, threshold):
            scores[item] = max(score, scores.get(item, 0))
            old = spans.get(item, (a, b))
            spans[item] = (min(a, old[0]), max(b, old[1]))
    result = []
    for item, score in sorted(scores.items()):
        a, b = spans[item]
        own = shingles(found[a:b]) | {tuple(found[i : i + n]) for q in index.parts[item] for n in {len(s) for s in q} if n < SHINGLE for i in range(a, b - n + 1)}
        shares = [len(part & own) / len(part) if part else 0.0 for part in index.parts[item]]
        if min(shares) >= overlap:
            result.append((item, score, *shares))
    return result


def _known(rows: DataFrame) -> tuple[Statistics, DataFrame]:
    """Statistics of all items without `df`, and that as a table: term, df."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [len(words(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["length"])

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = [w for t in part.column("text").to_pylist() for w in set(words(t))]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["term"])

    total = rows.mapInArrow(lengths, "length long").agg(F.count("*"), F.sum("length"), F.max("length")).first()
    df = rows.mapInArrow(terms, "term string").groupBy("term").agg(F.count("*").alias("df"))
    return Statistics(total[0], (total[1] or 0) / max(1, total[0]), total[2] or 0, {}), materialize(df, "item-terms")


def _shards(items: DataFrame) -> Iterator[tuple[list[tuple[int, str]], Statistics]]:
    """Items in parts of a bounded size, with the statistics of all items for their terms; the driver holds one part at a time."""
    rows = items.where("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", "text").distinct()
    known, df = _known(rows)

    def with_statistics(shard: list[tuple[int, str]]) -> tuple[list[tuple[int, str]], Statistics]:
        own = sorted({w for _, t in shard for w in words(t)})
        wanted = items.sparkSession.createDataFrame([(w,) for w in own], "term string")
        found = {r.term: r.df for r in df.join(wanted, "term", "left_semi").collect()}
        return shard, Statistics(known.count, known.mean, known.longest, found)

    shard, size = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        if shard and (len(shard) >= SHARD_ITEMS or size + len(row[1]) > SHARD_BYTES):
            yield with_statistics(shard)
            shard, size = [], 0
        shard.append((row[0], row[1]))
        size += len(row[1])
    if shard:
        yield with_statistics(shard)


_indexes: dict[str, Index] = {}


def _index(key: str, items) -> Index:
    """The index of one shard for each Python process."""
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = Index(*items.value)
    return _indexes[key]


def _pairs(docs: DataFrame, items: DataFrame, keys: list[str], threshold: float, overlap: float) -> DataFrame:
    """For each row of `docs` and item that its text holds: the row's keys (longs), item_id, score, question, answer."""
    spark = docs.sparkSession
    names = [*keys, "item_id", "score", "question", "answer"]
    schema = ", ".join([*(f"{k} long" for k in keys), "item_id long", "score double", "question double", "answer double"])
    found = spark.createDataFrame([], schema)
    for shard in _shards(items):
        key, sent = uuid4().hex, spark.sparkContext.broadcast(shard)

        def run(batches: Iterator[pa.RecordBatch], key=key, sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index(key, sent)
            for batch in batches:
                for part in chunks(batch, "text"):
                    hits = [
                        (n, index.items[item], *numbers)
                        for n, t in enumerate(part.column("text").to_pylist())
                        if t
                        for item, *numbers in _hits(index, t, threshold, overlap)
                    ]
                    types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    rows, *columns = (pa.array(c, t) for c, t in zip(zip(*hits, strict=True) if hits else [[]] * 5, types, strict=True))
                    yield pa.RecordBatch.from_arrays([*(part.column(k).take(rows) for k in keys), *columns], names=names)

        found = found.union(docs.mapInArrow(run, schema))
    return found


def contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, text: str = "text"
) -> DataFrame:
    """Pairs of a document and a test item that it holds: doc_id, item_id, score, question, answer.

    `score` is the best BM25 score of a passage as a share of the item's own; `question` and `answer` are
    the shares of their shingles found around such passages. Both must be `overlap` or more. Words are
    runs of letters, digits and underscores, in small letters. Null and empty texts hold nothing; items that are null or have
    no word are never found. Rows with equal doc_id give one pair for an item, the best. No item gives no row.
    """
    found = _pairs(docs.select("doc_id", F.col(text).alias("text")), items, ["doc_id"], threshold, overlap)
    best = F.max(F.struct("score", "question", "answer")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def without_contaminated(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, text: str = "text"
) -> DataFrame:
    """The rows of `docs` that hold no test item, whatever their doc_id is; all columns stay.

    A row is known by its doc_id and two hashes of its text, so rows with a null or repeated id are judged each by its own text.
    """
    hashes = {"__h1": F.xxhash64(text), "__h2": F.xxhash64(F.lit(1), text)}
    rows = docs.select("doc_id", F.col(text).alias("text"), *(h.alias(n) for n, h in hashes.items()))
    bad = _pairs(rows, items, ["doc_id", *hashes], threshold, overlap).select("doc_id", *hashes).distinct()
    bad = bad.toDF("__bad", "__bad1", "__bad2")
    same = F.col("doc_id").eqNullSafe(F.col("__bad")) & (F.col("__h1") == F.col("__bad1")) & (F.col("__h2") == F.col("__bad2"))
    return docs.withColumns(hashes).join(bad, same, "left_anti").drop(*hashes)
