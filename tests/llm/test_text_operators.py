"""Byte pairs, lines, repeated bytes, fingerprints, similar documents: against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskflow.llm import bpe, fingerprints, jaccard_join, line_dedup, suffix_dedup
from tests.llm.cases import LONG, ROWS, documents, empty

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(VOCABULARY)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def sample(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in rows] + [(i + 10_000 if i is not None else None, t) for i, t in ROWS if i != 5]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


# Byte pairs


def test_tokens_equal_the_library(spark, reference, sample):
    rows = bpe.encode(frame(spark, sample), VOCABULARY, decoded="decoded").collect()
    assert len(rows) == len(sample)
    for r in rows:
        expected = reference.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == expected
        assert r.decoded == reference.decode(expected, skip_special_tokens=False)


def test_tokens_of_odd_texts(reference):
    tokenizer = bpe.Tokenizer(open(VOCABULARY, encoding="utf-8").read())
    rng = random.Random(1)
    letters = "abcdehilnorst'é ßΣİΑ日́19!?.<|>\n "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += ["aaaa" * 500, "thethethe" * 300, "<|endoftext|><|startoftext|>a<|endoftext|", LONG[:50_000], "l" * 60_000]
    for text in texts:
        assert tokenizer.encode(text).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_merges_one_by_one_give_the_same():
    """Every pair of neighbours merged by rank, the slow way."""
    tokenizer = bpe.Tokenizer(open(VOCABULARY, encoding="utf-8").read())
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("aehilnorst") for _ in range(rng.randrange(1, 25)))
        parts = [tokenizer.text.index(c) for c in word[:-1]] + [tokenizer.text.index(chr(0xE000 + ord(word[-1])))]
        while ranked := [(tokenizer.merged[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in tokenizer.merged]:
            merged, i = min(ranked)
            parts[i : i + 2] = [merged]
        assert tokenizer.encode_word(word) == [tokenizer.id[n] for n in parts]


def test_encode_and_decode_edges(spark):
    rows = bpe.encode(documents(spark), VOCABULARY)
    assert rows.count() == len(ROWS) and [c for c in rows.columns if c == "ids"] == ["ids"]
    by_id = {r.doc_id: r for r in rows.collect()}
    assert by_id[1].ids == by_id[2].ids == by_id[3].ids == [] and by_id[4].kept == "kept"
    back = bpe.decode(rows.select("doc_id", "ids"), VOCABULARY).collect()
    assert {r.decoded for r in back if r.doc_id == 4} == {"word</w>"}
    assert bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), VOCABULARY).first().decoded == ""
    assert bpe.encode(empty(spark), VOCABULARY).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([([10**6],)], "ids array<int>"), VOCABULARY).collect()


# Lines


def expected_lines(rows, least=3):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(line_dedup.CAPITALS, line_dedup.SMALL))
    holders = defaultdict(set)
    order = lambda d: (d is not None, d or 0)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(order(doc))
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < least or max(holders[key(x)]) == order(doc)]
        result.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(result)


def test_lines_equal_plain_python(spark, sample):
    found = line_dedup.dedup_lines(frame(spark, sample)).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert Counter(map(tuple, found)) == expected_lines(sample)


def test_a_common_line_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = [(n, f"own line number {n} of this text\nthis line is shared by very many documents") for n in range(100)]
        found = line_dedup.dedup_lines(frame(spark, rows)).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Counter(map(tuple, found)) == expected_lines(rows)


def test_line_edges(spark):
    rows = line_dedup.dedup_lines(documents(spark))
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in rows.collect()) == expected_lines(ROWS)
    assert rows.columns.count("kept") == 1 and rows.first().block == "block"
    assert line_dedup.dedup_lines(empty(spark)).count() == 0
    assert line_dedup.keep_bitmaps(documents(spark)).columns == ["doc_id", "text_hash", "n_dropped", "keep"]


# Repeated bytes


def expected_bytes(rows, size=50):
    order = lambda d: (d is not None, d or 0)
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - size + 1):
            first[data[k : k + size]] = min(order(doc), first.get(data[k : k + size], order(doc)))
    result = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - size + 1):
            if first[data[k : k + size]] < order(doc):
                gone[k : k + size] = True
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        result.append((doc, len(data), int(gone.sum()), int(spans), hashlib.sha256(kept).hexdigest()))
    return Counter(result)


def removed(docs, **options):
    rows = suffix_dedup.remove_repeats(docs, **options)
    return Counter(map(tuple, rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()))


@pytest.mark.parametrize(("block_bytes", "common"), [(20_000, 50_000), (1 << 23, 50_000), (20_000, 1), (30_000, 4)])
def test_bytes_equal_plain_python(spark, sample, block_bytes, common):
    """Also with the windows of all or some contexts dealt out."""
    assert removed(frame(spark, sample), block_bytes=block_bytes, common=common) == expected_bytes(sample)


def test_bytes_with_few_letters(spark):
    """Ties between q-grams everywhere, and strings that overlap themselves."""
    rng = random.Random(3)
    rows = [(n, "".join(rng.choice("ab") * rng.randrange(1, 30) for _ in range(20))) for n in range(25)]
    rows += [(n, "a" * n) for n in range(40, 60)] + [(n, "ab" * n) for n in range(100, 110)]
    for common in (2, 50_000):
        assert removed(frame(spark, rows), block_bytes=1000, common=common) == expected_bytes(rows)


def test_byte_edges(spark):
    small = [r for r in ROWS if r[0] != 5] + [(5, LONG[:3000])]
    assert removed(documents(spark, small)) == expected_bytes(small)
    assert sum(removed(documents(spark)).values()) == len(ROWS)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


# Fingerprints


def test_next_documents(spark, sample):
    found = fingerprints.compare_with_next(frame(spark, sample)).collect()
    rows = sorted(((i, t or "") for i, t in sample), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = []
    for (doc, text), (_, other) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + other[:cut]
        names = [fingerprints.fingerprints([t])[0] for t in (text, edited, other)]
        near = [fingerprints.likeness(names[0], x) for x in names[1:]]
        expected.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), *map(fingerprints.written, names[:2]), *near))
    assert Counter(map(tuple, found)) == Counter(expected)


def test_blocks_follow_one_another(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 5)
    rows = [(n * 7, f"text {n} " * (n % 9 + 1)) for n in range(60)]
    found = {r.doc_id: r for r in fingerprints.compare_with_next(frame(spark, rows)).collect()}
    for n in range(60):
        text, other = rows[n][1], rows[n - 1][1]
        edited = text[: len(text) - len(text) // 3] + other[: len(text) // 3]
        assert found[n * 7].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_likeness_follows_the_share_that_stays():
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(2000))
    a = fingerprints.fingerprints([text, text[500:] + "x" * 500, text[: len(text) // 2] + text[::-1][: len(text) // 2], text[::-1]])
    near = [fingerprints.likeness(a[0], x) for x in a]
    assert near[0] == 1 and near[1] > 0.8 and 0.15 < near[2] < 0.55 and near[3] < 0.1
    # Equal insides are cut alike wherever they stand.
    inside = [set(fingerprints.phrases(np.array([*map(ord, t)]), np.zeros(len(t), int))[0]) for t in (text, "shifted " + text)]
    assert len(inside[0] & inside[1]) > 0.98 * len(inside[0])


def test_fingerprint_edges(spark):
    rows = fingerprints.fingerprint_documents(documents(spark)).collect()
    by_text = defaultdict(set)
    for r in rows:
        by_text[r.text or ""].add(r.fingerprint)
    assert len(rows) == len(ROWS) and all(len(x) == 1 for x in by_text.values()) and by_text[""] == {""}
    assert fingerprints.compare_with_next(documents(spark)).count() == len(ROWS)
    assert fingerprints.compare_with_next(empty(spark)).count() == 0
    one = fingerprints.compare_with_next(frame(spark, [(1, "only text")])).first()
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"only tonl").hexdigest()


# Similar documents


def expected_classes(rows, threshold=0.8):
    sets = [jaccard_sets(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)].append(doc)
    return Counter((doc, min(least[root(i)], default=None), links[i]) for i, (doc, _) in enumerate(rows))


def jaccard_sets(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_copies(count):
    rng = random.Random(5)
    base = ["w" + str(n) for n in range(200)]
    rows = []
    for n in range(count):
        words = list(base)
        for _ in range(rng.randrange(0, 12)):
            words[rng.randrange(200)] = f"new{rng.randrange(9)}"
        rows.append((n + 50_000, " ".join(words)))
    return rows


def test_classes_equal_all_pairs(spark, sample):
    rows = sample + near_copies(60)
    found = Counter(map(tuple, jaccard_join.similar_documents(frame(spark, rows)).collect()))
    assert found == expected_classes(rows)


def test_large_groups_in_slots(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SLOT", 7)
    rows = near_copies(80)
    assert Counter(map(tuple, jaccard_join.similar_documents(frame(spark, rows)).collect())) == expected_classes(rows)


def test_pruning_keeps_what_may_be_alike():
    least = jaccard_join.needed()
    assert all(least[n] < 0.8 * n for n in least) and least[128] > 64
    rng = random.Random(6)
    one = {f"s{n}" for n in range(500)}
    for _ in range(50):
        other = set(rng.sample(sorted(one), 470)) | {f"t{rng.random()}" for _ in range(30)}
        a, b = (jaccard_join.signature(np.unique(np.array([hash(x) % 2**64 for x in s], np.uint64))) for s in (one, other))
        values = np.stack([a, b])
        assert len(jaccard_join._prune(values, np.array([0]), np.array([1]), least)[0]) == 1


def test_similar_edges(spark):
    found = Counter(map(tuple, jaccard_join.similar_documents(documents(spark)).collect()))
    assert found == expected_classes(ROWS)
    assert jaccard_join.similar_documents(empty(spark)).count() == 0


# Wrong results of earlier versions


def test_every_code_point_is_encoded_as_the_library_does(reference):
    tokenizer = bpe.Tokenizer(open(VOCABULARY, encoding="utf-8").read())
    texts = [f"a{chr(c)}b1{chr(c)}.{chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x40000 or c % 997 == 0)]
    for text, expected in zip(texts, reference.encode_batch(texts, add_special_tokens=False), strict=True):
        assert tokenizer.encode(text).tolist() == expected.ids, [hex(ord(c)) for c in text]


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.8])
def test_similar_documents_at_other_thresholds(spark, threshold):
    pick = random.Random(threshold)
    base = [[f"w{pick.randrange(4000)}" for _ in range(60)] for _ in range(12)]
    rows = []
    for words in base:
        for _ in range(14):
            changed = list(words)
            for _ in range(pick.randrange(0, 9)):
                changed[pick.randrange(len(changed))] = f"x{pick.randrange(10**6)}"
            rows.append((len(rows), " ".join(changed)))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    links = Counter()
    for i, j in ((i, j) for i in sets for j in sets if i < j):
        if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
            links[i] += 1
            links[j] += 1
    assert sum(links.values()) > 40
    found = jaccard_join.similar_documents(frame(spark, rows), threshold=threshold).collect()
    assert {r.doc_id: r.n_links for r in found} == {i: links[i] for i in sets}


def test_banding():
    assert jaccard_join.banding(0.8) == (24, 3)
    for threshold in (0.3, 0.5, 0.6, 0.7, 0.9, 1.0):
        bands, in_band = jaccard_join.banding(threshold)
        assert bands * in_band <= jaccard_join.VALUES and (1 - threshold**in_band) ** bands <= jaccard_join.MISS
    with pytest.raises(ValueError, match="too few"):
        jaccard_join.banding(0.05)
