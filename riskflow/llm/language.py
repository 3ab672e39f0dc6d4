"""Names the language of documents with a linear-chain conditional random field over their words.

Each word is labelled. Its features are hashed: affixes, character n-grams with the word's ends, and the word itself
if the lexicon has it. Transitions between labels are learned on sequences that join runs of words from
several documents, so the model knows text that switches languages. Forward-backward gives each word's
probabilities, and a document's language is the one with the largest sum of them.

The model is fitted on the driver on a bounded sample of labelled documents; all documents are labelled
by tasks, whole. Long documents are cut in blocks whose transfer matrices are multiplied, which gives the same
numbers as one long pass.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import chunks, materialize

#: Documents of each language that the model is fitted on at most, and languages at most.
SAMPLE_DOCS, MAX_LANGUAGES = 120, 200
#: Hash buckets, a power of two; words of fewer documents of the sample aren't in the lexicon.
BUCKETS, LEXICON_DOCS = 1 << 16, 2
ROUNDS, RATE, PENALTY = 40, 0.1, 1e-5
#: Words in a training sequence, and in a block of a document.
SEQUENCE, BLOCK = 64, 64
#: Words that a task remembers. It forgets all when it has more.
REMEMBERED_WORDS = 120_000
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    """Runs of letters, small; runs without a letter proper, such as fractions, aren't words."""
    return [w for w in _WORD.findall(text.lower()) if w.isalpha() or any(c.isalpha() for c in w)] if text else []


def _mixed(*parts: np.ndarray | int) -> np.ndarray:
    value = np.zeros(1, np.uint64)  # an array, as only these wrap around silently
    for p in parts:
        value = (value ^ np.asarray(p, np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        value = value ^ (value >> np.uint64(29))
    return (value & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(found: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the features of some words, word after word, and where each word's begin."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in found).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in found], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    word = np.repeat(np.arange(len(found)), sizes)
    kinds = []
    for n in (2, 3):
        at = np.flatnonzero(word[: len(word) - n + 1] == word[n - 1 :])
        kinds.append((word[at], _mixed(n, *[codes[at + k] for k in range(n)])))
    for n in (1, 2, 3, 4):  # affixes of words that are long enough
        long = np.flatnonzero(sizes >= n + 2)
        kinds.append((long, _mixed(10 + n, *[codes[starts[long] + 1 + k] for k in range(n)])))
        kinds.append((long, _mixed(20 + n, *[codes[ends[long] - 2 - k] for k in range(n)])))
    owner = np.concatenate([o for o, _ in kinds])
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(found))
    return np.concatenate([b for _, b in kinds])[order], np.cumsum(counts) - counts


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # buckets x labels
    lexicon: dict[str, int]
    lexicon_weights: np.ndarray  # words x labels
    transitions: np.ndarray  # label before x label

    def emissions(self, found: list[str]) -> np.ndarray:
        buckets, starts = features(found)
        scores = np.add.reduceat(self.weights[buckets], starts, axis=0)
        known = np.fromiter((self.lexicon.get(w, -1) for w in found), np.int64, len(found))
        scores[known >= 0] += self.lexicon_weights[known[known >= 0]]
        return np.exp(scores - scores.max(axis=1, keepdims=True))


def _normal(x: np.ndarray, axes) -> np.ndarray:
    return x / x.sum(axis=axes, keepdims=True)


def marginals(potentials: np.ndarray, mask: np.ndarray, doc: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward: the probability of each label at each place.

    `potentials` is blocks x places x labels, `mask` tells which places have a word (those at the start),
    and `doc` numbers the document of each block, whose blocks follow one another.
    """
    blocks, places, labels = potentials.shape
    step = np.exp(transitions).astype(potentials.dtype)
    # What each block does to the state before it.
    through = np.broadcast_to(np.eye(labels, dtype=potentials.dtype), (blocks, labels, labels)).copy()
    for t in range(places):
        live = mask[:, t]
        through[live] = _normal((through[live] @ step) * potentials[live, t][:, None, :], (1, 2))
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    rank = np.arange(blocks) - np.maximum.accumulate(np.where(first, np.arange(blocks), 0))
    by_rank = np.argsort(rank, kind="stable")
    cuts = np.searchsorted(rank[by_rank], np.arange(rank.max() + 2)) if blocks else [0]
    before = np.full((blocks, labels), 1 / labels, potentials.dtype)
    after = np.ones((blocks, labels), potentials.dtype)
    for r in range(1, len(cuts) - 1):
        now = by_rank[cuts[r] : cuts[r + 1]]
        before[now] = _normal(np.einsum("bi,bij->bj", before[now - 1], through[now - 1]), 1)
    for r in range(len(cuts) - 2, 0, -1):
        now = by_rank[cuts[r] : cuts[r + 1]]
        after[now - 1] = _normal(np.einsum("bij,bj->bi", through[now], after[now]), 1)
    forward = np.zeros_like(potentials)
    state = before
    for t in range(places):
        state = np.where(mask[:, t, None], _normal((state @ step) * potentials[:, t], 1), state)
        forward[:, t] = state
    state = after
    for t in range(places - 1, -1, -1):
        live = mask[:, t, None]
        forward[:, t] *= np.where(live, state, 0)
        state = np.where(live, _normal((potentials[:, t] * state) @ step.T, 1), state)
    return forward / np.maximum(forward.sum(axis=2, keepdims=True), 1e-30)


def fit(sample: list[tuple[str, str]]) -> Model:
    """A model of (text, language) rows. Each word has its document's language as label."""
    docs = [(words(text), lang) for text, lang in sample]
    labels = sorted({lang for found, lang in docs if found})
    if not labels:
        return Model([], np.zeros((BUCKETS, 0), np.float32), {}, np.zeros((0, 0), np.float32), np.zeros((0, 0), np.float32))
    in_docs = Counter(w for found, _ in docs for w in set(found))
    lexicon = {w: n for n, w in enumerate(sorted(w for w, c in in_docs.items() if c >= LEXICON_DOCS))}
    number = {w: n for n, w in enumerate(in_docs)}
    unique = list(number)
    buckets, starts = features(unique)
    owner = np.repeat(np.arange(len(unique)), np.diff([*starts, len(buckets)]))
    in_lexicon = np.array([lexicon.get(w, -1) for w in unique])
    # Runs of words, dealt into sequences in a mixed order.
    rng = np.random.default_rng(7)
    runs = []
    for found, lang in docs:
        at = 0
        while at < len(found):
            size = int(rng.integers(8, 49))
            runs.append(([number[w] for w in found[at : at + size]], labels.index(lang)))
            at += size
    order = rng.permutation(len(runs))
    word = np.concatenate([np.array(runs[k][0]) for k in order])
    label = np.concatenate([np.full(len(runs[k][0]), runs[k][1]) for k in order])
    rows = -(-len(word) // SEQUENCE)
    pad = rows * SEQUENCE - len(word)
    mask = np.concatenate([np.ones(len(word), bool), np.zeros(pad, bool)]).reshape(rows, SEQUENCE)
    word, label = np.concatenate([word, np.zeros(pad, int)]), np.concatenate([label, np.zeros(pad, int)])
    target = np.zeros((rows, SEQUENCE, len(labels)))
    target[np.arange(rows)[:, None], np.arange(SEQUENCE), label.reshape(rows, -1)] = 1
    target *= mask[..., None]
    size = len(labels)
    values = [np.zeros((BUCKETS, size)), np.zeros((len(lexicon), size)), np.zeros((size, size))]
    means, squares = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    weight, each = 1 / mask.sum(), np.arange(rows)
    lab = label.reshape(rows, -1)
    pairs = np.zeros((size, size))
    np.add.at(pairs, (lab[:, :-1][mask[:, 1:]], lab[:, 1:][mask[:, 1:]]), 1)
    for turn in range(1, ROUNDS + 1):
        scores = np.add.reduceat(values[0][buckets], starts, axis=0)
        scores[in_lexicon >= 0] += values[1][in_lexicon[in_lexicon >= 0]]
        potentials = np.exp(scores - scores.max(axis=1, keepdims=True))[word].reshape(rows, SEQUENCE, size)
        found = marginals(potentials, mask, each, values[2])
        error = ((found - target) * mask[..., None]).reshape(-1, size)
        by_word = np.stack([np.bincount(word, error[:, k], len(unique)) for k in range(size)], 1)
        gradients = [
            np.stack([np.bincount(buckets, by_word[owner, k], BUCKETS) for k in range(size)], 1),
            np.zeros_like(values[1]),
            _expected_pairs(potentials, mask, values[2]) - pairs,
        ]
        np.add.at(gradients[1], in_lexicon[in_lexicon >= 0], by_word[in_lexicon >= 0])
        for v, m, s, g in zip(values, means, squares, gradients, strict=True):
            g = g * weight + PENALTY * v
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= RATE * (m / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.99**turn)) + 1e-8)
    weights, lexicon_weights, transitions = (v.astype(np.float32) for v in values)
    return Model(labels, weights, lexicon, lexicon_weights, transitions)


def _expected_pairs(potentials: np.ndarray, mask: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Expected number of each pair of neighbouring labels."""
    rows, places, labels = potentials.shape
    step = np.exp(transitions)
    forward = np.empty((places, rows, labels))
    state = np.full((rows, labels), 1 / labels)
    for t in range(places):
        state = np.where(mask[:, t, None], _normal((state @ step) * potentials[:, t], 1), state)
        forward[t] = state
    total, state = np.zeros((labels, labels)), np.ones((rows, labels))
    for t in range(places - 1, 0, -1):
        live = mask[:, t]
        ahead = potentials[:, t] * state
        both = forward[t - 1][:, :, None] * step * ahead[:, None, :]
        total += _normal(both[live], (1, 2)).sum(axis=0)
        state = np.where(live[:, None], _normal(ahead @ step.T, 1), state)
    return total


class Labeller:
    """Labels texts by a model and remembers the potentials of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, len(model.labels)), np.float32)

    def _numbers(self, found: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
            self.table = self.table[:0]
        known = self.known
        new = [w for w in dict.fromkeys(found) if w not in known]
        if new:
            for w in new:
                known[w] = len(known)
            self.table = np.concatenate([self.table, self.model.emissions(new).astype(np.float32)])
        return np.fromiter(map(known.__getitem__, found), np.int64, len(found))

    def label(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text; the score is the mean probability of that language over its words."""
        found = [words(t) for t in texts]
        sizes = np.array([len(w) for w in found])
        result = [(UNKNOWN, 0.0)] * len(texts)
        if not self.model.labels or not sizes.sum():
            return result
        number = self._numbers([w for ws in found for w in ws])
        blocks = -(-sizes // BLOCK)
        doc = np.repeat(np.arange(len(texts)), blocks)
        starts = np.concatenate([[0], np.cumsum(blocks)])[:-1] * BLOCK
        offsets = np.cumsum(sizes) - sizes
        place = np.arange(len(number)) + np.repeat(starts - offsets, sizes)
        shape = (len(doc), BLOCK)
        mask = np.zeros(shape[0] * BLOCK, bool)
        mask[place] = True
        potentials = np.ones((shape[0] * BLOCK, len(self.model.labels)), np.float32)
        potentials[place] = self.table[number]
        found = marginals(potentials.reshape(*shape, -1), mask.reshape(shape), doc, self.model.transitions)
        sums = found.sum(axis=1, dtype=np.float64)
        for d in np.flatnonzero(sizes):
            first = int(starts[d] // BLOCK)
            total = sums[first : first + int(blocks[d])].sum(axis=0)
            best = int(total.argmax())
            result[d] = (self.model.labels[best], float(min(1.0, total[best] / sizes[d])))
        return result


def held_out() -> Column:
    """Whether a document may not be learned from: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of at most `sample_docs` documents of each language: those with the smallest hashes of id and text.

    Held-out rows and rows without lang, text or doc_id aren't used. Rows equal in id and text count once, so a repeated id
    takes no more and no less than its texts' share; all of a language are taken if there are fewer.
    """
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.select("lang", "text", F.xxhash64("doc_id", "text").alias("chance"))
    # One number for each text. A share of them holds about four times the sample, so few are ordered however many tasks there are.
    numbers = materialize(rows.select("lang", "chance").distinct(), "text-numbers")
    sizes = {r[0]: r[1] for r in numbers.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return fit([])
    span = 1 << 31
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(span, 4 * (sample_docs + 25) * span // n))])
    drawn = numbers.where(F.pmod("chance", F.lit(span)) < share[F.col("lang")])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("chance", F.lit(span)), "chance"))
    first = drawn.withColumn("place", place).where(F.col("place") <= sample_docs).select("lang", "chance")
    first = first.limit(MAX_LANGUAGES * sample_docs).collect()
    chosen = F.broadcast(docs.sparkSession.createDataFrame(first, "lang string, chance long"))  # of the bounded sample
    picked = rows.join(chosen, ["lang", "chance"], "left_semi").groupBy("lang", "chance").agg(F.min("text").alias("text")).collect()
    return fit([(r.text, r.lang) for r in sorted(picked, key=lambda r: (r.lang, r.chance))])


_labellers: dict[str, Labeller] = {}


def _labeller(key: str, model) -> Labeller:
    if key not in _labellers:
        _labellers.clear()
        _labellers[key] = Labeller(model.value)
    return _labellers[key]


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns of `docs` with lang_pred and score; columns of these names are replaced.

    A text that is null or has no letter is `und` with score 0. Equal texts get equal answers.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = f"{id(sent)}:{hash(model.weights.tobytes())}"
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).schema.add("lang_pred", "string", False).add("score", "double", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = _labeller(key, sent)
        for batch in batches:
            for part in chunks(batch, "__text__"):
                found = labeller.label(part.column("__text__").to_pylist())
                new = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *new], names=[*kept, "lang_pred", "score"])

    return docs.select(*kept, F.col(text).alias("__text__")).mapInArrow(run, schema)
