"""Spelling variants, repaired conversations, quality rules: against plain Python and SQL."""

import glob
import hashlib
import itertools
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from riskflow.llm import conversation_repair as repair
from riskflow.llm import quality_rules as rules
from riskflow.llm import spelling_variants as spelling
from riskflow.llm.oracles import ORACLES
from riskflow.llm.queries import QUERIES
from tests.llm.cases import LONG, ROWS, documents, empty


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_conversation_repair", "op13_quality_rules"])
def test_queries_equal_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = QUERIES[name](spark, sf_dir)
    expected = con.execute(f"SELECT {', '.join(result.columns)} FROM ({ORACLES[name]})").fetchall()
    assert Counter(map(tuple, result.collect())) == Counter(expected)


# Spelling variants


def variants(counts, factor=5):
    """word -> (form, root, n, n_near, form_n), by trying every edit."""
    letters = sorted({c for w in counts for c in w})

    def near(w):
        for i in range(len(w) + 1):
            yield from (w[:i] + c + w[i:] for c in letters)
            if i < len(w):
                yield w[:i] + w[i + 1 :]
                yield from (w[:i] + c + w[i + 1 :] for c in letters)

    found = {}
    for w, n in counts.items():
        others = {v for v in near(w) if v in counts and v != w}
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= factor * n else None
        found[w] = (form, n, len(others), counts[form] if form else None)
    root = lambda w: w if found[w][0] is None else root(found[w][0])
    return {w: (form, root(w), n, near_n, form_n) for w, (form, n, near_n, form_n) in found.items()}


def found_variants(spark, counts):
    rows = spelling.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)).collect()
    assert len(rows) == len(counts)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("letters", ["ab", "aéb", "abcdefghij"])
def test_variants_of_random_words(spark, letters):
    pick = random.Random(letters)
    words = {"".join(pick.choice(letters) for _ in range(pick.randrange(1, 9))) for _ in range(250)}
    counts = {w: pick.choice([1, 2, 5, 5, 25, 125, 700]) for w in sorted(words)}
    assert found_variants(spark, counts) == variants(counts)


def test_long_words_runs_and_chains(spark):
    counts = {"a" * k: 10**k for k in range(1, 12)}  # each the form of the one before
    counts |= {"x" * 3000: 7, "x" * 3001: 7, "x" * 1500 + "y" + "x" * 1499: 40, "öäü" * 400 + "z": 3, "öäü" * 400: 30}
    assert found_variants(spark, counts) == variants(counts)
    assert found_variants(spark, {"a" * k: 10**k for k in range(1, 12)})["a"][1] == "a" * 11


def test_one_hot_prefix(spark):
    counts = {f"commonbeginning{a}{b}": 1 + ord(a) * 7 % 30 for a, b in itertools.product("abcdefghijklmnopq", repeat=2)}
    assert found_variants(spark, counts) == variants(counts)


def test_runs_and_missing_letters(spark):
    text = "Straße ÉTÉ naïve123naïveté don't " + "x" * 20_000 + " été ×÷"
    rows = spark.createDataFrame([(1, text), (None, text), (2, None), (3, "")], "doc_id long, text string")
    found = Counter(map(tuple, spelling.runs(rows).collect()))
    plain = [r.translate(str.maketrans(spelling.UPPER, spelling.LOWER)) for r in re.findall("[A-Za-zÀ-ÿ]+", text)]
    assert found == Counter([(i, r) for i in (1, None) for r in plain])

    def damaged(i, r):
        h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
        return r[: h % len(r)] + r[h % len(r) + 1 :] if h % 3 == 0 else r

    cut = spelling.misspelled(spelling.runs(rows), every=3).collect()
    assert Counter(map(tuple, cut)) == Counter((i, damaged(i, r)) for i, r in found.elements())


def test_variants_of_odd_documents(spark):
    texts = [t for i, t in ROWS]
    plain = Counter(r.translate(str.maketrans(spelling.UPPER, spelling.LOWER)) for t in texts for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""))
    counted = spelling.counted_words(spelling.runs(documents(spark)), 1, 2)
    counts = {w: n for w, n in plain.items() if n >= 2}
    assert {r.word: r.n for r in counted.collect()} == counts
    rows = spelling.group_variants(counted).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == variants(counts)
    assert spelling.group_variants(spelling.counted_words(spelling.runs(empty(spark)))).collect() == []


# Conversations


def cheapest(rows):
    """(cost, audit) of the cheapest edits, by trying all of them: rows are (letter, fault)."""
    best = None
    for inserts in range(0, len(rows) + 3):
        if best is not None and 5 * inserts > best[0]:
            break
        for spots in itertools.combinations(range(len(rows) + inserts), inserts):
            for edits in itertools.product("DKR", repeat=len(rows)):
                own, audit, cost, roles = iter(zip(rows, edits, strict=True)), "", 0, ""
                for k in range(len(rows) + inserts):
                    if k in spots:
                        audit, cost, roles = audit + "I", cost + 5, roles + "?"
                        continue
                    (letter, fault), edit = next(own)
                    audit += edit
                    if edit == "D":
                        cost += 2
                        continue
                    if fault in (repair.BLANK, repair.DUPLICATE):
                        break
                    cost += (edit == "R") + 5 * (fault == repair.TRUNCATED)
                    roles += letter if edit == "K" else "?"
                else:
                    body = roles[1:] if roles[:1] == "s" else roles
                    if all(c in ("?", "ua"[i % 2]) for i, c in enumerate(body)) and len(body) % 2 == 0 and (body or not roles):
                        best = min(best or (cost, audit), (cost, audit))
    return best


def parsed(rows):
    span = repair.Span()
    for letter, fault in rows:
        span.push(repair.leaf(letter, fault))
    cells = span.cells()
    return min(cells[k] for k in repair.FINAL if cells[k] is not None)


def test_cells_are_the_cheapest_of_all_edits():
    pick = random.Random(3)
    for n in (0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 4):
        rows = [(pick.choice("suuaax"), pick.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
        assert parsed(rows) == cheapest(rows), rows


def test_any_split_gives_the_same_cells():
    pick = random.Random(4)
    rows = [(pick.choice("sua"), pick.choice([0, 0, 0, 0, 3])) for _ in range(40)]
    whole = parsed(rows)
    for cut in (0, 1, 13, 39, 40):
        parts = []
        for half in (rows[:cut], rows[cut:]):
            span = repair.Span()
            for r in half:
                span.push(repair.leaf(*r))
            parts.append(span.cells())
        cells = repair.combine(*parts)
        assert min(cells[k] for k in repair.FINAL if cells[k] is not None) == whole


def plain_report(rows):
    """The report of one conversation, from (turn, role, text) in any order; the parse is the tested one."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: ((r[0] is not None, r[0] or 0), r[1], r[2]))
    seen, faults, counts = set(), [], Counter()
    for _, role, text in rows:
        body = text.rstrip(repair.WHITE)
        fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
        seen.add((role, text))
        faults.append(fault)
        counts[fault] += 1
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit = parsed([(r[:1], f) for (_, r, _), f in zip(rows, faults, strict=True)])
    spoken, own, turn = [], iter(rows), 0
    for edit in audit:
        _, role, text = (None, None, "") if edit == "I" else next(own)
        if edit == "D":
            continue
        system = edit == "K" and role[:1] == "s"
        if edit != "K":
            role = ("user", "assistant")[turn % 2]
        turn += not system
        spoken.append(f"{role}:{text}")
    digest = hashlib.sha256("\n".join(spoken).encode()).hexdigest()
    return gaps, counts[1], counts[2], counts[3], illegal, cost, audit, digest


def random_rows(pick, n):
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \t", None, "Fine. ", "è finito.", "…"]
    return [(pick.choice([None, *range(n)]), pick.choice(["user", "assistant", "system", "", None, "tool"]), pick.choice(texts)) for _ in range(n)]


def reports(spark, conversations):
    rows = [(c, *r, "x", "y") for c, group in conversations.items() for r in group]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cost string, copies string").repartition(5)
    found = repair.repair_report(repair.repair(frame)).collect()
    assert len(found) == len(conversations)
    return {r.conv_id: tuple(r)[1:] for r in found}


def test_reports_of_random_conversations(spark):
    pick = random.Random(5)
    conversations = {c: random_rows(pick, pick.randrange(1, 9)) for c in [None, *range(60)]}
    assert reports(spark, conversations) == {c: plain_report(rows) for c, rows in conversations.items()}


def test_a_long_conversation_in_many_pieces(spark, monkeypatch):
    pick = random.Random(6)
    conversations = {7: random_rows(pick, 900), 8: random_rows(pick, 3), 9: [(1, "user", "Again.")] * 50}
    expected = {c: plain_report(rows) for c, rows in conversations.items()}
    assert reports(spark, conversations) == expected
    monkeypatch.setattr(repair, "PIECE_ROWS", 16)
    rows = [(c, *r) for c, group in conversations.items() for r in group]
    faulty = repair._faulty_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    ordered = sorted((r.asDict() for r in faulty.collect()), key=lambda r: (r["conv_id"], (r["turn"] is not None, r["turn"] or 0), r["role"], r["text"]))
    monkeypatch.setattr(repair.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    pieces = list(repair._pieces(iter(ordered)))
    assert len(pieces) > 60 and all(len(p["texts"]) <= 16 for p in pieces if not p["alone"])
    assert [p["conv_id"] for p in pieces if p["alone"]] == [8]  # 7 is the first, 9 the last one and both are cut
    split = [p for p in pieces if not p["alone"]]
    chosen = [c for p in repair._by_conversation(iter(split)) for c in repair._chosen(p)] + [p for p in pieces if p["alone"]]
    for c in conversations:
        own = [x for x in chosen if x["conv_id"] == c]
        assert "".join(x["part"] for x in own) == expected[c][6]
        assert tuple(own[0][k] for k in ("gaps", *repair.COUNTS, "cost")) == expected[c][:6]


def test_repaired_rows_are_right(spark):
    pick = random.Random(8)
    rows = [(c, *r) for c in range(20) for r in random_rows(pick, 7)]
    repaired = repair.repaired_rows(repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    by_conversation = {}
    for r in sorted(repaired.collect(), key=lambda r: (r.conv_id, r.piece, r.place)):
        by_conversation.setdefault(r.conv_id, []).append(r.role[:1])
    assert by_conversation and all(re.fullmatch("(s?(ua)+)?", "".join(v)) for v in by_conversation.values())


def test_no_conversations_and_damage(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair_report(repair.repair(repair.damaged(none))).collect() == []
    rows = [(c, t, "assistant", "One. Two! Three? four") for c in [None, *range(40)] for t in (None, 0, 1)]
    found = Counter(map(tuple, repair.damaged(spark.createDataFrame(rows, none.schema)).collect()))
    expected = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = "user" if kind == 4 else role, {1: "", 2: "One Two Three four"}.get(kind, text)
        expected[c, t, role, text] += {0: 0, 3: 2}.get(kind, 1)
    assert found == +expected


# Quality rules


def plain_measures(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    lettered = sum(any(c.isalpha() or (c.isnumeric() and not c.isdecimal()) for c in w) for w in words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines), lettered


def test_measures_equal_plain_python():
    pick = random.Random(9)
    for _ in range(400):
        words = [pick.choice(["a", "b", "ç", "12", "#|", "½x", " "]) for _ in range(pick.randrange(0, 60))]
        text = "".join(w + pick.choice([" ", "  ", "\n", "\t", "\r\n", "\x1c"]) for w in words)
        assert rules.measure(text) == plain_measures(text), text


def test_ledger_and_policies(spark):
    texts = [*(t for _, t in ROWS), "word " * 200, "a | b | c | d | e | f | g", "q. " * 3 + "one\ntwo\none\n" * 5]
    rows = spark.createDataFrame([(n if n % 3 else None, t, "own") for n, t in enumerate(texts)], "doc_id long, text string, failures string")
    stored = rules.ledger(rows.withColumnRenamed("failures", "n_words")).cache()
    found = Counter((r.doc_id, *(r[m] for m in rules.MEASURES)) for r in stored.collect())
    assert found == Counter((n if n % 3 else None, *plain_measures(t)) for n, t in enumerate(texts))
    held = {m: None for m in rules.MEASURES}
    for r in stored.collect():
        held.update({m: r[m] for m in rules.MEASURES})
        expected = sum(1 << k for k, (_, condition) in enumerate(rules.RULES) if eval(condition, {}, held))
        assert r.failures == expected
    for version, policy in rules.POLICIES.items():
        kept = [r.kept for r in rules.apply_policy(stored, version).orderBy("failures").collect()]
        failed = sorted(r.failures for r in stored.collect())
        keeps = lambda bits: not bits & policy.required and (bits & policy.tolerated).bit_count() <= policy.limit  # noqa: B023, E731
        assert kept == [keeps(f) for f in failed]
        for r in rules.ablations(stored, version).collect():
            bit, used = rules.BITS[r.rule], policy.required | policy.tolerated
            assert r.n_failed == sum(f & bit != 0 for f in failed)
            assert r.n_only == sum(f & used == bit for f in failed)
            assert r.n_kept == sum(map(keeps, failed)) and r.n_kept_without == sum(keeps(f & ~bit) for f in failed)
    with pytest.raises(ValueError, match="n_words"):
        rules.ledger(rows.withColumnRenamed("failures", "n_words"), keys=("n_words",))


def test_ledger_of_nothing(spark):
    stored = rules.ledger(empty(spark))
    assert rules.apply_policy(stored).collect() == []
    assert {(r.n_failed, r.n_only, r.n_kept, r.n_kept_without) for r in rules.ablations(stored).collect()} == {(0, 0, 0, 0)}
    one = rules.apply_policy(rules.ledger(spark.createDataFrame([(None, None)], "doc_id long, text string"))).first()
    assert one.n_words == 0 and one.failures == rules.BITS["few_words"] and not one.kept
    assert rules.ledger(documents(spark)).select(F.sum("n_words")).first()[0] > 80_000
