"""URL rules, archives, personal data, languages, test items and the pipeline."""

import base64
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskflow.llm import decontaminate, language, line_dedup, oracles, pii, queries, url_rules, warc
from riskflow.sources.scratch import scratch_path
from tests.llm.cases import LONG, ROWS, documents, empty
from tests.llm.test_text_operators import expected_classes, expected_lines, frame
from tests.test_queries import canonical

PAGES = "page_id long, url string, html string"


# Queries with SQL


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_equals_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = queries.QUERIES[name](spark, sf_dir)
    found = con.execute(oracles.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(result.columns)
    assert canonical([tuple(r) for r in result.collect()], result.columns) == canonical(found.fetchall(), columns)


# URL rules

URLS = [
    None,
    "",
    "no scheme/at/all",
    "http://example.net",
    "http://example.net/",
    "HTTPS://WWW.Example.NET/en/x?y=/de/#/fr/",
    "https://example.com/de/1?a=b",
    "https://example.com?x=://b/de/",
    "https://notexample.com/de/",
    "ftp://a.org/fr/#t",
    "x://org/fr/",
    "https://ORG/FR/",
    "http://a.net:80/en/",
    "a://b://c/d",
    "https://host#frag/de/",
    "http://ünï.net/ß\n/q",
]


def expected_rule(url):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in url_rules.LISTED_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def test_listed_rules(spark):
    pages = spark.createDataFrame([(n, u, "x", "y") for n, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    labelled = spark.createDataFrame([], "url string, bad boolean")
    rows = url_rules.judge_urls(pages, labelled)
    assert rows.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    for r in rows.collect():
        host, path, rule, verdict = expected_rule(r.url)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), r.url


def test_mined_rules_block(spark):
    good = [(f"http://good{n % 7}.com/en/{n}?ref=x", False) for n in range(60)]
    bad = [(f"http://spam.com/offer/{n}?ref=x", True) for n in range(20)]
    mixed = [(f"http://mixed.com/en/{n}", n % 2 == 0) for n in range(10)]
    labelled = spark.createDataFrame([*good, *bad, *mixed, (None, True), ("http://x.com/", None)], "url string, bad boolean")
    rules = {tuple(r.tokens): (r.support, r.confidence) for r in url_rules.mine_rules(labelled, 0.05, 0.8).collect()}
    tokens = {}
    for url, label in good + bad + mixed:
        found = spark.createDataFrame([(url,)], "url string").select(url_rules.url_tokens(F.col("url"))).first()[0] if url not in tokens else None
        tokens[url] = (set(found), label)
    everything = sorted({t for s, _ in tokens.values() for t in s if sum(t in x for x, _ in tokens.values()) >= 4})
    brute = {}
    for size in (1, 2, 3, 4, 5):
        for combo in itertools.combinations(everything, size):
            has = [label for s, label in tokens.values() if set(combo) <= s]
            if sum(has) >= 0.05 * len(tokens) and sum(has) >= 0.8 * len(has) and not any(set(b) < set(combo) for b in brute):
                brute[combo] = (sum(has) / len(tokens), sum(has) / len(has))
    assert {k: tuple(map(lambda x: round(x, 9), v)) for k, v in rules.items()} == {k: tuple(map(lambda x: round(x, 9), v)) for k, v in brute.items()}
    pages = spark.createDataFrame([(1, "http://spam.com/offer/99", ""), (2, "http://good1.com/offer", ""), (3, "http://spam.com/de/", ""), (1, "http://spam.com/offer/99", "")], PAGES)
    verdicts = Counter((r.page_id, r.verdict) for r in url_rules.judge_urls(pages, labelled, min_support=0.05).collect())
    fits = lambda t: any(set(r) <= t for r in brute)
    assert fits({"h:spam", "h:com", "p:offer", "p:99"}) and verdicts[1, "block"] == 2
    assert verdicts[2, "block" if fits({"h:good1", "h:com", "p:offer"}) else "allow"] == 1
    assert url_rules.judge_urls(spark.createDataFrame([], PAGES), labelled).count() == 0


def test_a_bad_host_is_found_among_any_number_of_pages(spark):
    bad = [(f"http://spam.com/offer/{n}", True) for n in range(url_rules.MIN_PAGES)]
    few = [(f"http://rare.com/thing/{n}", True) for n in range(url_rules.MIN_PAGES - 1)]
    pages = spark.createDataFrame([(1, "http://spam.com/new", ""), (2, "http://rare.com/new", ""), (3, "http://good1.com/new", "")], PAGES)
    for others in (500, 5_000):
        good = [(f"http://good{n % 50}.com/en/{n}", False) for n in range(others)]
        labelled = spark.createDataFrame(bad + few + good, "url string, bad boolean")
        verdicts = {r.page_id: r.verdict for r in url_rules.judge_urls(pages, labelled).collect()}
        assert verdicts == {1: "block", 2: "allow", 3: "allow"}, others
    assert url_rules.mine_rules(spark.createDataFrame(few, "url string, bad boolean")).count() == 0


def test_pages_that_share_many_parts(spark):
    """Each shared part is a rule; half of another site's pages are bad, so its parts are rules only together with one more."""
    parts = "/".join(f"part{k}" for k in range(25))
    rows = [(f"http://spam.com/{parts}/{n}", True) for n in range(12)]
    half = "/".join(f"half{k}" for k in range(20))
    rows += [(f"http://half.com/{half}/{'buy' if n % 2 else 'read'}/{n}", n % 2 == 1) for n in range(24)]
    rows += [(f"http://buy.com/buy/{n}", False) for n in range(40)]
    rules = {tuple(r.tokens): (round(r.support * len(rows)), r.confidence) for r in url_rules.mine_rules(spark.createDataFrame(rows, "url string, bad boolean")).collect()}
    alone = {("h:spam",), *((f"p:part{k}",) for k in range(25))}
    together = {("h:half", "p:buy"), *(("p:buy", f"p:half{k}") for k in range(20))}
    assert rules.keys() == alone | together
    assert set(rules.values()) == {(12, 1.0)}


# Archives

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
HTML = [None, "", "<p>x</p>", "<p>x</p>", FAKE, FAKE * 3 + "tail", "WARC/1.1\r\n", "a\r\n\r\nWARC/1.1\r\n\r\n\r\nb", "é😀" * 3000, "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n", "x" * 70_000 + FAKE + "y" * 70_000, "", None]


def test_archives_round_trip(spark):
    pages = [(n, f"http://x/{n}", h) for n, h in enumerate(HTML)] + [(4, "http://again/", FAKE), (None, None, "<p>x</p>")]
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.archive_records(spark.createDataFrame(pages, PAGES + "").coalesce(2)), path)
    expected = Counter()
    for page, _, html in pages:
        data = (html or "").encode()
        same = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        again = page is None or page != min(same)
        digest = hashlib.sha1(data)
        expected[f"<urn:page:{'' if page is None else page}>", "revisit" if again else "response", str(len(data)), base64.b32encode(digest.digest()).decode(), None if again else digest.hexdigest(), f"<urn:page:{min(same)}>" if again else None] += 1
    for split in ("4096", "134217728"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            found = warc.read_records(spark, path).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        got = Counter((r.record_id, r.type, str(r.http_length), r.declared_digest, r.payload_sha1 if r.type == "response" else None, r.refers_to) for r in found)
        assert got == expected
        assert all(r.payload_size == r.http_length for r in found if r.type == "response")


def test_no_pages_give_no_records(spark):
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.archive_records(spark.createDataFrame([], PAGES)), path)
    assert warc.read_records(spark, path).count() == 0


def test_least_size_of_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], PAGES)
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.archive_records(pages, min_bytes=5), path)
    assert Counter(r.type for r in warc.read_records(spark, path).collect()) == {"response": 3, "revisit": 1}


# Personal data

FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def expected_spans(text):
    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        luhn = sum(d * (1 + i % 2) - 9 * (d * (1 + i % 2) > 9) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0
        return {
            "email": True,
            "ip": kind == "ip" and all(int(p) <= 255 for p in found.split(".")),
            "card": 12 <= len(digits) <= 19 and luhn,
            "phone": 9 <= len(digits) <= 15,
        }[kind]

    found = sorted((m.start(), n, k, m.end()) for n, k in enumerate(FIXED) for m in re.finditer(FIXED[k], text or "") if valid(k, m[0]))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in found)


def test_fixed_patterns_equal_plain_python(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("aZ09 .-@+()12é\n%_😀") for _ in range(rng.randrange(90))) for _ in range(1500)]
    texts += ["mail a.b+c@d-e.co.uk@x.y 4111 1111-1111 1111, 010.0.0.255 256.1.1.1 1.2.3.4.5.6.7.8 +1 (22) 333-4444", "x@y.z" * 400, "1." * 2000, "+1" * 3000]
    rows = list(enumerate(texts)) + [(None, None), (5_000, LONG), (5_000, LONG)]
    found = pii.find_pii(frame(spark, rows)).select("doc_id", pii.listed(F.col("base")), F.size("learned")).collect()
    assert Counter((r[0], r[1]) for r in found) == Counter((i, expected_spans(t)) for i, t in rows)


def test_long_runs_end_soon(spark):
    rows = [(1, "a" * 300_000), (2, "9" * 200_000), (3, "9 " * 100_000), (4, "a.b-" * 50_000 + "@"), (5, "+" * 100_000)]
    assert pii.find_pii(frame(spark, rows)).where(F.size("base") > 0).count() == 0


def test_contexts_find_what_the_patterns_miss(spark):
    rows = [(n, f"please reach account ip {n}.1.2.{n} today and the value{n % 3} abc12345{n % 4} here") for n in range(1, 60)]
    rows += [(1000, "please reach account ip 10-20-30-40x today"), (1001, "and the thing 99-88-77z here")]
    found = {r.doc_id: r for r in pii.find_pii(frame(spark, rows)).collect()}
    assert [(s.kind, s.found) for s in found[1000].learned] == [("ip", "10-20-30-40x")]
    assert not found[1001].learned and all(not found[n].learned for n in range(1, 60))


def test_pii_runs_no_python(spark):
    from tests.conftest import plan_of

    assert "Python" not in plan_of(pii.find_pii(documents(spark))) and "Arrow" not in plan_of(pii.find_pii(documents(spark)))
    assert pii.find_pii(empty(spark)).count() == 0
    assert pii.find_pii(documents(spark)).count() == len(ROWS)


# Languages


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(1)
    potentials, transitions = rng.random((1, 7, 3)), rng.normal(size=(3, 3))
    total = np.zeros((7, 3))
    for path in itertools.product(range(3), repeat=7):
        weight = sum(np.exp(transitions[k, path[0]]) for k in range(3)) / 3
        for t, y in enumerate(path):
            weight *= potentials[0, t, y] * (np.exp(transitions[path[t - 1], y]) if t else 1)
        for t, y in enumerate(path):
            total[t, y] += weight
    total /= total.sum(axis=1, keepdims=True)
    one = language.marginals(potentials, np.ones((1, 7), bool), np.zeros(1, int), transitions)
    assert abs(one[0] - total).max() < 1e-9
    cut, mask = np.ones((9, 3)), np.arange(9) < 7
    cut[:7] = potentials[0]
    blocks = language.marginals(cut.reshape(3, 3, 3), mask.reshape(3, 3), np.zeros(3, int), transitions)
    assert abs(blocks.reshape(9, 3)[:7] - total).max() < 1e-9


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = queries.op5_language(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_switched_text_is_labelled_word_by_word():
    english, german = "the of and with this that", "der die und nicht ist das"
    model = language.fit([(english + " ", "en")] * 30 + [(german, "de")] * 30)
    found = language.words("the of and this der die und nicht ist")
    potentials = model.emissions(found)[None]
    labels = language.marginals(potentials, np.ones((1, len(found)), bool), np.zeros(1, int), model.transitions)[0].argmax(axis=1)
    assert [model.labels[k] for k in labels] == ["en"] * 4 + ["de"] * 5


def test_language_edges(spark):
    docs = documents(spark)
    model = language.train(docs)
    rows = language.identify(docs, model)
    assert rows.columns.count("score") == 1 and rows.count() == len(ROWS)
    for r in rows.collect():
        assert (r.lang_pred == "und") == (not language.words(r.text)) and (r.lang_pred != "und" or r.score == 0)
    nothing = language.train(empty(spark))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(empty(spark), model).count() == 0


def test_sample_is_bounded(spark):
    rows = [(n, f"word{n}", "en") for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    original = language.fit
    language.fit = lambda sample: seen.extend(sample) or original(sample)
    try:
        language.train(docs, sample_docs=20)
    finally:
        language.fit = original
    assert 5 <= len(seen) <= 20 and all(zlib.crc32(t[4:].encode()) % 4 != 2 for t, _ in seen)


# Test items


def test_search_equals_scoring_every_item(spark, sf_dir):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    index = decontaminate.Index(items * 3)
    rng = random.Random(8)
    for _ in range(200):
        terms = sorted(set(rng.choices(range(len(index.postings)), k=rng.randrange(1, 50))))
        if rng.random() < 0.6:
            terms = sorted({index.terms[w] for w in decontaminate.words(rng.choice(items)[1])} | set(terms[:5]))
        threshold, scores = rng.choice([0.05, 0.2, 0.5]), Counter()
        for t in terms:
            for n, w in index.postings[t]:
                scores[n] += w
        found = dict(index.search(terms, threshold))
        assert found.keys() == {n for n, s in scores.items() if s >= threshold - 1e-9}
        assert all(abs(s - scores[n]) < 1e-9 for n, s in found.items())


def test_contaminated_equals_comparing_all(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    parts = {r.item_id: [decontaminate.shingles(p) for p in decontaminate.question_and_answer(r.text)] for r in items.collect()}
    expected = set()
    for r in docs.collect():
        found_words = decontaminate.words(r.text or "")
        # Questions and answers of fewer words than a shingle are one run.
        own = {tuple(found_words[i : i + n]) for n in (1, 2, 3, 4, 5) for i in range(len(found_words) - n + 1)}
        for item, both in parts.items():
            if min(len(p & own) / len(p) for p in both) >= 0.8:
                expected.add((r.doc_id, item))
    assert found == expected and found


def test_shards_find_the_same(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 15)
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} == whole


def test_scores_do_not_depend_on_shards(spark, sf_dir, monkeypatch):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").limit(7).collect()]
    docs = frame(spark, [(n, f"before it {t} and after it") for n, t in items])
    items = spark.createDataFrame([*items, (999, ""), (998, "longer " * 400)], "item_id long, text string")
    whole = Counter(map(tuple, decontaminate.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 3)
    assert Counter(map(tuple, decontaminate.contaminated(docs, items).collect())) == whole and len(whole) >= 7
    # A share of an item's words, whose score tells the statistics: half of them here, of different weight.
    texts = [" ".join(f"w{n}x{k}" if k % 2 else f"c{k}" for k in range(12)) for n in range(7)]
    items = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "item_id long, text string")
    docs = frame(spark, [(n, " ".join(t.split()[:7])) for n, t in enumerate(texts)])
    found = lambda: {(r.doc_id, r.item_id, r.score) for r in decontaminate.contaminated(docs, items, 0.1, 0.2).collect()}
    parts = found()
    monkeypatch.setattr(decontaminate, "SHARD_ITEMS", 100)
    assert found() == parts and {(n, n) for n in range(7)} <= {(d, i) for d, i, _ in parts}


def test_item_edges(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "word"), (3, "word"), (4, "fox jumps over the lazy dog near the river. The bank today? Yes!")], "item_id long, text string")
    found = Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(spark), items).collect())
    assert found == {(4, 3): 1}
    assert decontaminate.contaminated(documents(spark), items.where("item_id > 99")).count() == 0
    assert decontaminate.contaminated(empty(spark), items).count() == 0
    kept = decontaminate.without_contaminated(documents(spark), items)
    assert kept.count() == len(ROWS) - 1 and kept.columns == documents(spark).columns


def test_rows_are_judged_by_their_own_text(spark):
    item = "what is the color of the deep sea today? it is green and blue."
    rows = [(None, f"so {item} ok"), (None, "clean words"), (None, None), (7, f"x {item}"), (7, "other clean words"), (7, "other clean words"), (8, "fine")]
    kept = decontaminate.without_contaminated(frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert Counter(map(tuple, kept.collect())) == Counter([rows[1], rows[2], *rows[4:]])


# Pipeline


def test_pipeline_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    rows += [(90_001, "123 456 !!", "en", "src", 10), (90_002, None, None, None, None), (90_003, rows[0][1], "en", "src", 0)]
    docs = spark.createDataFrame(rows, docs.schema)
    stages = dict(corpus_pipeline.STAGES)
    named = stages["language"](spark, docs, sf_dir)
    assert named.columns == docs.columns and {90_001, 90_002} & {r.doc_id for r in named.collect()} == set()
    assert named.count() >= len(rows) - 4
    before = [tuple(r) for r in named.select("doc_id", "text").collect()]
    lined = stages["lines"](spark, named, sf_dir)
    assert lined.columns == docs.columns
    after = [tuple(r) for r in lined.select("doc_id", "text").collect()]
    assert Counter(after) == Counter((d, k) for d, _, _, k in expected_lines(before).elements())
    assert all(r.n_chars == len(r.text) for r in lined.collect())
    single = stages["near_copies"](spark, lined, sf_dir)
    assert Counter(r.doc_id for r in single.collect()) == Counter(d for d, c, _ in expected_classes(after) if d == c)
    clean = stages["test_items"](spark, single, sf_dir)
    bad = {r.doc_id for r in decontaminate.contaminated(single, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - bad
    last = stages["tokens"](spark, clean, sf_dir)
    assert last.columns == [*docs.columns, "ids", "n_tokens"] and last.count() == clean.count()


def test_near_copies_leave_one_row_of_each_class(spark):
    common = "the quick brown fox jumps over the lazy dog near the river bank today"
    rows = [(None, "no id at all one"), (None, "no id at all one"), (None, "another text without id"), (None, common)]
    rows += [(3, common), (3, common), (7, common), (7, "alone under a used id"), (7, "alone under a used id"), (9, "a third one")]
    kept = corpus_pipeline.one_of_each_group(spark, frame(spark, rows), None)
    assert Counter(map(tuple, kept.collect())) == Counter([rows[0], rows[2], rows[4], rows[7], rows[9]])
    edges = corpus_pipeline.one_of_each_group(spark, documents(spark), None)
    assert edges.columns == documents(spark).columns
    assert Counter(r.doc_id for r in edges.collect()) == Counter([1, 3, 4, 5, 6, 8, 9, 10])


def test_pipeline_keeps_clashing_columns(spark):
    docs = documents(spark).withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(0).cast("long"))
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, None)
        r = docs.first()
        assert (r.score, r.kept, r.h1, r.n_lines) == ("score", "kept", "h1", "n_lines"), name
    assert line_dedup.dedup_lines(docs).count() == docs.count()


def test_a_repeated_id_leaves_the_others_in_the_sample(spark, monkeypatch):
    """One id used for most rows, with one text or with many: the sample is full, bounded and has the others."""
    texts = {"en": "the river runs over the old stones", "de": "der alte Fluss und die grauen Steine"}
    seen = []
    monkeypatch.setattr(language, "fit", lambda sample: seen.append(sample))
    for hot in (1, 2, 3, 4):
        rows = [(n + 100, f"{t} number {n}", lang) for n in range(60) for lang, t in texts.items()]
        rows += [(hot, "one repeated text of one id", "en")] * 3000 + [(hot, f"another text {n}", "de") for n in range(500)] + [(None, "no id", "en")]
        language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=25)
        counts = Counter(lang for _, lang in seen[-1])
        assert counts == {"en": 25, "de": 25} and len(set(seen[-1])) == 50
    language.train(spark.createDataFrame(rows[:40], "doc_id long, text string, lang string"), sample_docs=25)
    assert 20 < len(seen[-1]) <= 40
