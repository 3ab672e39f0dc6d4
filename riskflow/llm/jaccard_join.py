"""Finds documents whose sets of five-word shingles are alike, with Bayesian pruning of candidate pairs.

Equal texts are one text. Texts that agree in some band of MinHash values are candidates; the threshold tells how many bands
there are. The values of
a pair are compared a few at a time; as soon as the probability that its similarity reaches the threshold, given the
values that agree so far, is below a tolerance, the pair is dropped. What is left joins texts to
clusters, and inside these every pair that passes the same test is verified on its whole shingle sets.

No stage writes out the pairs of a group: tasks compare the texts of a group among themselves, and
write links to the smallest text and counts. A large group is dealt into slots, and each pair of slots is
a group of its own.
"""

from collections.abc import Iterator
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import chunks, components, materialize, text_or_empty, whole_groups

SHINGLE, THRESHOLD = 5, 0.8
#: MinHash values of a text, those compared at a time, and the probability below which a pair is dropped.
VALUES, STEP, TOLERANCE = 128, 16, 1e-7
#: Values in a band at most, and the probability with which a pair at the threshold may share no band.
ROWS, MISS = 3, 3.4e-8
#: Texts in a slot of a large group.
SLOT = 400
#: Pairs compared at a time; words a task remembers the hashes of.
PAIRS, REMEMBERED_WORDS = 400_000, 150_000

_rng = np.random.default_rng(11)
_FACTORS = (_rng.integers(0, 1 << 31, VALUES, np.uint32) << np.uint32(1)) | np.uint32(1)
_TERMS = _rng.integers(0, 1 << 32, VALUES, np.uint32)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(SHINGLE + 1)], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words; fewer words are one run, no word gives none.

    Words are what white space separates.
    """
    found = text.split()
    if not found:
        return np.zeros(0, np.uint64)
    words = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, size * int(_POWERS[SHINGLE]) % (1 << 64), np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * _POWERS[k]
    return np.unique(_mix(total))


def signature(found: np.ndarray) -> np.ndarray:
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(low), 1024):
        least = np.minimum(least, (low[k : k + 1024, None] * _FACTORS + _TERMS).min(axis=0))
    return least


def banding(threshold: float = THRESHOLD) -> tuple[int, int]:
    """Number of bands and of values in each: the longest bands of which enough fit into a signature."""
    for rows in range(ROWS, 0, -1):
        bands = ceil(log(MISS) / log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows <= VALUES:
            return bands, rows
    raise ValueError(f"{VALUES} values are too few for a similarity of {threshold}")


def needed(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """By the number of values compared, how many must agree for a pair to stay.

    With a uniform prior, the chance that the similarity is `threshold` or more after m of n values agree is that
    of at most m successes in n + 1 trials with that probability.
    """
    least = {}
    for n in range(STEP, VALUES + 1, STEP):
        chance, m = 0.0, 0
        while True:
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= tolerance:
                break
            m += 1
        least[n] = m
    return least


def _pairs(group: np.ndarray, side: np.ndarray, lone: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a group; in a group of two slots only pairs of different slots."""
    left, right, count, distance = [], [], 0, 1
    while True:
        near = np.flatnonzero(group[:-distance] == group[distance:]) if distance < len(group) else np.zeros(0, int)
        if len(near):
            kept = near[lone[near] | (side[near] != side[near + distance])]
            left.append(kept)
            right.append(kept + distance)
            count += len(kept)
        if count and (count >= PAIRS or not len(near)):
            yield np.concatenate(left), np.concatenate(right)
            left, right, count = [], [], 0
        if not len(near):
            return
        distance += 1


def _prune(values: np.ndarray, left: np.ndarray, right: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    agree = np.zeros(len(left), np.int32)
    for at in range(0, values.shape[1], STEP):
        agree += (values[left, at : at + STEP] == values[right, at : at + STEP]).sum(axis=1, dtype=np.int32)
        kept = agree >= least[at + STEP]
        left, right, agree = left[kept], right[kept], agree[kept]
    return left, right


def _joined(rows: int, edges: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray) -> np.ndarray:
    """For each row the row with the smallest `order` that it is connected with."""
    root = order.copy()
    if not edges:
        return root
    left, right = (np.concatenate(x) for x in zip(*edges, strict=True))
    while True:
        least = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        # Roots are values of `order`; a row that holds its own value tells of its root's root.
        at = np.argsort(order)
        new = np.minimum(new, new[at[np.searchsorted(order[at], new)]])
        if (new == root).all():
            return root
        root = new


def _candidates(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links of texts whose values stay alike: a text and the smallest one of its group it hangs together with."""
    least = needed(threshold)
    for rows, group in whole_groups(batches, ["bucket", "low", "high"]):
        text = rows.column("text").to_numpy()
        side = rows.column("slot").to_numpy()
        values = np.frombuffer(b"".join(rows.column("values").to_pylist()), np.uint16).reshape(len(text), -1)
        lone = rows.column("low").to_numpy() == rows.column("high").to_numpy()
        edges = [_prune(values, a, b, least) for a, b in _pairs(group, side, lone)]
        # Texts are told apart by group here, so that a root is of the same group.
        order = np.lexsort((text, group)).argsort()
        root = np.argsort(order)[_joined(len(text), edges, order)]
        moved = text[root] != text
        yield pa.RecordBatch.from_arrays([pa.array(text[moved]), pa.array(text[root][moved])], names=["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """For each text of a group: the smallest text it is connected with and how many documents it is linked to."""
    least = needed(threshold)
    for rows, group in whole_groups(batches, ["cluster", "low", "high"]):
        # Equal rows of the input with equal ids bring a text more than once.
        text = rows.column("text").to_numpy()
        once = np.concatenate([[True], (text[1:] != text[:-1]) | (group[1:] != group[:-1])])
        rows, group = rows.filter(pa.array(once)), group[once]
        text, side = rows.column("text").to_numpy(), rows.column("slot").to_numpy()
        lone = rows.column("low").to_numpy() == rows.column("high").to_numpy()
        copies = rows.column("copies").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in rows.column("shingles").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        values = np.stack([signature(x) for x in sets])
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        seen = np.zeros(flat.max() + 1, bool)
        edges, links = [], np.zeros(len(text), np.int64)
        for left, right in _pairs(group, side, lone):
            kept = np.minimum(sizes[left], sizes[right]) >= threshold * np.maximum(sizes[left], sizes[right]) - 1e-9
            left, right = _prune(values, left[kept], right[kept], least)
            order = np.argsort(left, kind="stable")
            left, right = left[order], right[order]
            alike = np.zeros(len(left), bool)
            cuts = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1], [True]])) if len(left) else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                one, others = left[a], right[a:b]
                seen[flat[starts[one] : ends[one]]] = True
                places = np.repeat(starts[others] - (np.cumsum(sizes[others]) - sizes[others]), sizes[others])
                hit = seen[flat[places + np.arange(len(places))]]
                common = np.add.reduceat(hit, np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
                seen[flat[starts[one] : ends[one]]] = False
                alike[a:b] = common >= threshold * (sizes[one] + sizes[others] - common) - 1e-9
            left, right = left[alike], right[alike]
            np.add.at(links, left, copies[right])
            np.add.at(links, right, copies[left])
            edges.append((left, right))
        order = np.lexsort((text, group)).argsort()
        root = np.argsort(order)[_joined(len(text), edges, order)]
        yield pa.RecordBatch.from_arrays([pa.array(text), pa.array(text[root]), pa.array(links)], names=["a", "b", "links"])


def _in_slots(members: DataFrame, group: str, size: str) -> DataFrame:
    """A row for each pair of slots that a member takes part in: adds slot, low, high."""
    slots = F.ceil(F.col(size) / SLOT).cast("int")
    slotted = members.withColumn("slots", slots).withColumn("slot", F.pmod(F.xxhash64("text", group), F.col("slots")).cast("int"))
    paired = slotted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    return paired.withColumns({"low": F.least("slot", "other"), "high": F.greatest("slot", "other")}).drop("slots", "other", size)


def _signatures(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    n_bands, in_band = banding(threshold)
    for batch in batches:
        for part in chunks(batch, "text"):
            found = [shingles(t) for t in part.column("text").to_pylist()]
            signed = np.stack([signature(x) for x in found])
            with np.errstate(over="ignore"):
                bands = signed[:, : n_bands * in_band].reshape(-1, n_bands, in_band).astype(np.uint64)
                keys = np.arange(n_bands, dtype=np.uint64)[None, :] * _POWERS[SHINGLE]
                for k in range(in_band):
                    keys = _mix(keys + bands[:, :, k] * _POWERS[k])
            keys[[not len(x) for x in found]] = 0
            offsets = np.arange(0, len(found) * n_bands + 1, n_bands, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in ("doc_id", "h1", "h2")),
                    pa.array([len(x) for x in found], pa.int32()),
                    pa.array([x.astype(np.uint16).tobytes() for x in signed], pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64))),
                ],
                names=["doc_id", "h1", "h2", "size", "values", "bands"],
            )


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "body"):
            found = [shingles(t).tobytes() for t in part.column("body").to_pylist()]
            kept = ["cluster", "members", "text", "copies"]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(found, pa.binary())], names=[*kept, "shingles"])


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    rows = docs.select("doc_id", text_or_empty(text).alias("text"))
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})


def _linked_texts(keyed: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The rows with their signatures, and the distinct texts, written: h1, h2, first_id, copies, links, root.

    Texts of one class, and no others, have the same root.
    """
    signed = materialize(
        keyed.mapInArrow(lambda batches: _signatures(batches, threshold), "doc_id long, h1 long, h2 long, size int, values binary, bands array<long>"), "signatures"
    )
    texts = signed.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("first_id"),
        F.count("*").alias("copies"),
        F.first("size").alias("size"),
        F.first("values").alias("values"),
        F.first("bands").alias("bands"),
    )
    texts = materialize(texts.withColumn("text", F.monotonically_increasing_id()), "texts")

    # Buckets of two texts or more; of those with the same texts one.
    banded = texts.where("size > 0").select("text", F.explode("bands").alias("bucket"))
    mark = F.xxhash64("text")
    buckets = (
        banded.groupBy("bucket")
        .agg(F.count("*").alias("members"), F.bit_xor(mark).alias("mark"), F.min("text").alias("least"), F.max("text").alias("most"))
        .where("members > 1")
        .groupBy("members", "mark", "least", "most")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket", "members")
    )
    members = banded.join(materialize(buckets, "buckets"), "bucket")
    grouped = _in_slots(members, "bucket", "members").join(texts.select("text", "values"), "text")
    order = ["bucket", "low", "high"]
    links = grouped.repartition(*order).sortWithinPartitions(*order).mapInArrow(lambda batches: _candidates(batches, threshold), "a long, b long")
    clusters = components(materialize(links.distinct(), "candidate-links"))
    clusters = materialize(clusters.select(F.col("node").alias("text"), F.col("root").alias("cluster")), "clusters")

    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("members"))
    placed = clusters.join(sizes, "cluster").join(texts.select("text", "h1", "h2", "first_id", "copies"), "text")
    placed = materialize(placed, "clustered-texts")
    bodies = keyed.select(F.col("doc_id").alias("first_id"), F.col("text").alias("body"), "h1", "h2")
    same = placed["first_id"].eqNullSafe(bodies["first_id"]) & (placed["h1"] == bodies["h1"]) & (placed["h2"] == bodies["h2"])
    # Sorted and merged whatever the sizes are, so that the plan doesn't change as the clusters grow.
    shingled = placed.join(bodies.hint("merge"), same).select("cluster", "members", "text", "copies", "body")
    shingled = shingled.mapInArrow(_shingled, "cluster long, members long, text long, copies long, shingles binary")
    order = ["cluster", "low", "high"]
    verified = materialize(
        _in_slots(shingled, "cluster", "members")
        .repartition(*order)
        .sortWithinPartitions(*order, "text")
        .mapInArrow(lambda batches: _verify(batches, threshold), "a long, b long, links long"),
        "verified",
    )
    classes = components(verified.where("a <> b").select("a", "b").distinct())
    counted = verified.groupBy(F.col("a").alias("text")).agg(F.sum("links").alias("links"))
    known = texts.select("text", "h1", "h2", "first_id", "copies").join(counted, "text", "left")
    known = known.join(classes.withColumnRenamed("node", "text"), "text", "left").withColumn("root", F.coalesce("root", "text"))
    return signed, materialize(known, "linked-texts")


def similar_documents(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id and n_links for each row of `docs`.

    Two documents are linked if the Jaccard similarity of their shingle sets is `threshold` or more, or if their
    texts are equal. A class is what links connect; its id is its smallest doc_id, null if it has none.
    `n_links` counts the other rows that a row is linked to. A null text is empty; equal empty texts are
    linked. Rows with equal ids are rows of their own.
    """
    signed, known = _linked_texts(_keyed(docs, text), threshold)
    named = known.groupBy("root").agg(F.min("first_id").alias("class_id"))
    answers = known.join(named, "root").select(
        "h1", "h2", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return signed.select("doc_id", "h1", "h2").join(answers, ["h1", "h2"]).select("doc_id", "class_id", "n_links")


def one_of_each_class(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class of `similar_documents`, with all columns: that with the smallest doc_id, nulls last.

    Of rows with that id the text's hashes decide, of rows equal in both the place in a table written here.
    """
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered-documents")
    _, known = _linked_texts(_keyed(rows, text), threshold)
    body = text_or_empty(text)
    hashed = rows.select("doc_id", "__row", F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2"))
    # Rows are reduced to one for each text before they meet their class, so a common text is no heavy key.
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2", "__row")
    firsts = hashed.groupBy("h1", "h2").agg(F.min(rank).alias("first"))
    kept = firsts.join(known.select("h1", "h2", "root"), ["h1", "h2"]).groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(kept.select("first.__row"), "__row", "left_semi").select(*docs.columns)
