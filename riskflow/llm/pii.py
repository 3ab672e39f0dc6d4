r"""Finds personal data: by fixed patterns, and by the words around what these find.

The fixed patterns give seeds. Words left and right of a seed are contexts; so are those of other strings with digits.
Contexts and strings form a graph. A context is as sure of a kind as the share of its
strings that are of that kind, a string is as sure as its contexts together, and a few rounds carry this
from the seeds to strings the fixed patterns miss. Only contexts with many seeds and a high share count,
so a word like `the` teaches nothing. All of it is built-in functions; no Python runs on executors.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import materialize, text_or_empty

#: Kinds in the order in which spans at one start are listed, and what text without it can't hold any.
KINDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Written without repeated groups that give back, so that no text needs much time or a deep stack. A
#: run of letters or digits is tried from its start only, or from the end of the match before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Strings that may be identifiers: runs with a digit, of six characters or more.
OTHER = r"(?<![A-Za-z0-9@._%+-])(?=[A-Za-z@._%+-]*+[0-9])[A-Za-z0-9@._%+-]{6,}+"
#: Characters looked at for the word beside a string.
REACH = 40
#: Rounds over the graph, seeds that a context needs, its least share, and the least sureness of a string.
ROUNDS, MIN_SEEDS, MIN_SHARE, MIN_SURE = 3, 5, 0.6, 0.9

_SPAN = "struct<start: int, rank: int, kind: string, stop: int, found: string, before: string, after: string>"


def _luhn(digits: Column) -> Column:
    def value(digit: Column, place: Column) -> Column:
        doubled = digit.cast("int") * (F.lit(1) + place % 2)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)

    values = F.transform(F.split(F.reverse(digits), ""), value)
    return F.aggregate(F.filter(values, lambda v: v.isNotNull()), F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
        return found.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _spans(text: Column, pattern: str, rank: int, kind: str | None) -> Column:
    """All matches with their places, from the lengths of the matches and of what stands between."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    sizes = F.zip_with(between, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("own")))
    starts = F.aggregate(
        sizes,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda a, s: F.struct((a["at"] + s["gap"] + s["own"]).alias("at"), F.concat(a["all"], F.array(a["at"] + s["gap"])).alias("all")),
        lambda a: a["all"],
    )

    def span(start: Column, match: Column) -> Column:
        stop = start + F.length(match)
        left = F.substring(text, F.greatest(start - REACH, F.lit(0)) + 1, F.least(start, F.lit(REACH)))
        right = F.substring(text, stop + 1, F.lit(REACH))
        return F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            stop.alias("stop"),
            match.alias("found"),
            F.lower(F.regexp_extract(left, r"(\p{L}++)[^\p{L}]*$", 1)).alias("before"),
            F.lower(F.regexp_extract(right, r"^[^\p{L}]*(\p{L}++)", 1)).alias("after"),
        )

    return F.zip_with(starts, found, span).cast(f"array<{_SPAN}>")


def _only_valid(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: _valid(kind, s["found"]))


def _find(text: Column) -> tuple[Column, Column]:
    none = F.array().cast(f"array<{_SPAN}>")
    digits = text.rlike("[0-9]")
    each = []
    for rank, (kind, mark) in enumerate(KINDS.items()):
        may_hold = (text.contains(mark) if mark else F.lit(True)) & (F.lit(True) if kind == "email" else digits)
        valid = _only_valid(_spans(text, PATTERNS[kind], rank, kind), kind)
        each.append(F.when(may_hold, valid).otherwise(none))
    return F.array_sort(F.concat(*each)), F.when(digits, _spans(text, OTHER, len(KINDS), None)).otherwise(none)


def _edges(spans: DataFrame) -> DataFrame:
    """Distinct pairs of a context and a string."""
    contexts = F.array(
        F.struct(F.lit("before").alias("side"), F.col("span.before").alias("word")),
        F.struct(F.lit("after").alias("side"), F.col("span.after").alias("word")),
    )
    return (
        spans.select(F.col("span.found").alias("found"), F.explode(contexts).alias("c"))
        .where("c.word <> ''")
        .select("c.side", "c.word", "found")
        .distinct()
    )


def score_strings(spans: DataFrame) -> DataFrame:
    """Strings that aren't seeds and their kind, from rows with a `span`: found, kind, sure.

    A span with a kind is a seed. Of kinds that a string is equally sure of, the first by name is taken.
    """
    edges = materialize(_edges(spans), "pii-edges")
    seeds = materialize(
        spans.where("span.kind IS NOT NULL").select("span.found", "span.kind").distinct().withColumn("sure", F.lit(1.0)), "pii-seeds"
    )
    sizes = edges.groupBy("side", "word").agg(F.count("*").alias("strings"))
    scores = seeds
    for _ in range(ROUNDS):
        share = F.col("total") / F.col("strings")
        contexts = (
            edges.join(scores, "found")
            .groupBy("side", "word", "kind")
            .agg(F.sum("sure").alias("total"))
            .join(sizes, ["side", "word"])
            .where((F.col("total") >= MIN_SEEDS) & (share >= MIN_SHARE))
            .select("side", "word", "kind", F.least(share, F.lit(0.99)).alias("share"))
        )
        learned = (
            edges.join(contexts, ["side", "word"])
            .groupBy("found", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("share"))))).alias("sure"))
            .join(seeds.select("found").distinct(), "found", "left_anti")
        )
        scores = materialize(seeds.unionByName(learned), "pii-scores")
    best = F.max(F.struct("sure", "kind")).alias("best")
    found = scores.join(seeds.select("found").distinct(), "found", "left_anti").where(F.col("sure") >= MIN_SURE)
    return found.groupBy("found").agg(best).select("found", "best.kind", "best.sure")


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, base and learned for each row of `docs`: the spans of the fixed patterns and the added ones.

    Spans are structs with start and stop (code points, stop exclusive), kind, found, and the words
    before and after, ordered by start and kind. A null or empty text has none. Added spans overlap no
    base span of their row. Rows stay apart even if they are equal, and a null doc_id stays null.
    """
    base, other = _find(F.col("text"))
    rows = docs.select("doc_id", text_or_empty(text).alias("text")).select("doc_id", base.alias("base"), other.alias("other"))
    free = F.filter(
        "other", lambda o: ~F.exists("base", lambda b: (b["start"] < o["stop"]) & (o["start"] < b["stop"]))
    )
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", free.alias("other")), "pii-spans")
    every = rows.select("row", F.explode(F.concat("base", "other")).alias("span"))
    kinds = score_strings(every)
    ranks = reduce(lambda c, r: c.when(F.col("kind") == r[1], r[0]), enumerate(KINDS), F.when(F.lit(False), 0))
    added = (
        every.where("span.kind IS NULL")
        .join(kinds, F.col("span.found") == F.col("found"))
        .withColumn("span", F.col("span").withField("kind", F.col("kind")).withField("rank", ranks))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list("span")).alias("learned"))
    )
    return rows.join(added, "row", "left").select(
        "doc_id", "base", F.coalesce("learned", F.array().cast(f"array<{_SPAN}>")).alias("learned")
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, by start and kind, with commas between."""
    one = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(one, ",")
