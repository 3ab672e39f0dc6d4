"""The registered queries, in the form of their contracts, against plain Python on the smallest tables."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskflow.llm.queries import QUERIES
from tests.llm.test_page_operators import FIXED, expected_rule, expected_spans
from tests.llm.test_text_operators import expected_bytes, expected_classes


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def types(result, expected):
    found = dict(result.dtypes)
    assert {k: found[k] for k in expected} == expected
    return result.collect()


def test_op1(spark, sf_dir, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_padding()
    library.no_truncation()
    rows = types(QUERIES["op1_bpe"](spark, sf_dir), {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"})
    expected = Counter()
    for doc, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == expected


def test_op3(spark, sf_dir):
    """Verdicts of pages that no listed rule fits are the method's; the rest follows from the url."""
    columns = {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"}
    rows = types(QUERIES["op3_url_rules"](spark, sf_dir), columns)
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(urls) == len({r.page_id for r in rows})
    for r in rows:
        host, path, rule, verdict = expected_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_op4(spark, sf_dir, texts):
    counts = {f"n_{k}": "bigint" for k in FIXED}
    rows = types(QUERIES["op4_pii"](spark, sf_dir), {"doc_id": "bigint", **counts, "base_sha256": "string", "spans": "string"})
    expected = {doc: expected_spans(text) for doc, text in texts}
    assert len(rows) == len(expected)
    for r in rows:
        base = expected[r.doc_id]
        kinds = Counter(s.split(":")[0] for s in base.split(",") if s)
        assert tuple(r[c] for c in counts) == tuple(kinds[k] for k in FIXED) and r.base_sha256 == sha(base)
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))


def test_op5(spark, sf_dir, texts):
    rows = types(QUERIES["op5_language"](spark, sf_dir), {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"})
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    assert {r.lang_pred for r in rows} <= {*known.values(), "und"} and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert 0 < len(held) < len(rows) and sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.95 * len(held)


def test_op6(spark, sf_dir, texts):
    columns = {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"}
    rows = types(QUERIES["op6_suffix_dedup"](spark, sf_dir), columns)
    assert Counter(tuple(r[c] for c in columns) for r in rows) == expected_bytes(texts)


def test_op8(spark, sf_dir, texts):
    rows = types(QUERIES["op8_jaccard_join"](spark, sf_dir), {"doc_id": "bigint", "class_id": "bigint", "n_links": "bigint"})
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in rows) == expected_classes(texts)


def test_op10(spark, sf_dir, texts):
    columns = {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string"}
    rows = types(QUERIES["op10_fingerprints"](spark, sf_dir), {**columns, "near_edited": "double", "near_next": "double"})
    ordered = sorted(texts, key=lambda r: -r[0])
    edited = {}
    for (doc, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following = text or "", following or ""
        gone = len(text) // 3
        edited[doc] = (len(text), sha(text[: len(text) - gone] + following[:gone]))
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in rows} == edited
    prints = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert prints.setdefault(dict(texts)[r.doc_id], r.fingerprint) == r.fingerprint
