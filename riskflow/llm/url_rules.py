"""Judges URLs by listed rules and by rules mined from labelled pages.

FP-growth finds the combinations of URL tokens that often come with a bad label. Rules of enough
support and confidence are kept, without those that a shorter rule already covers. To match, each rule
is filed under one of its tokens, the one that the fewest URLs have; a URL looks its tokens up there and
checks the whole rule. Only distinct URLs take part, so a page that is repeated often costs no more.
"""

from collections.abc import Sequence
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import materialize

#: Host, start of the path, verdict. A rule fits its host and the hosts below it; the longest rule wins.
LISTED_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Labelled pages that have a rule's tokens and a bad label, however many other pages there are, and share
#: of bad labels among the pages that have its tokens.
MIN_PAGES, MIN_CONFIDENCE = 10, 0.8


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in small ASCII letters and path; both empty if the URL is null or has no `://`."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s)(?:(?!://).)*+://(.*)$", 1)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^(?s)[^/?#]*+(/[^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = LISTED_RULES) -> tuple[Column, Column]:
    """The longest listed rule that fits, and its verdict; nulls if none does. Of equally long ones the first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens: the parts of the host, of the path and of the query, each marked with its place."""
    host, path = url_parts(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)

    def marked(mark: str, text: Column, pattern: str) -> Column:
        parts = F.filter(F.split(text, pattern, -1), lambda p: p != "")
        return F.transform(parts, lambda p: F.concat(F.lit(mark), p))

    return F.array_distinct(
        F.concat(marked("h:", host, r"\."), marked("p:", path, r"[/.]"), marked("q:", query, r"[&=]"))
    )


def _under_rarest(sets: DataFrame, key: str, tokens: str, weights: DataFrame, out: str = "token") -> DataFrame:
    """The sets with the token of theirs that the fewest pages have; `weights` has token and n."""
    wanted = sets.select(key, F.explode(tokens).alias("token")).join(weights.select("token", "n"), "token", "left")
    least = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).getField("token")
    return sets.join(wanted.groupBy(key).agg(least.alias(out)), key)


def _combinations(tokens: DataFrame, sums: DataFrame, needed: int, min_confidence: float) -> DataFrame | None:
    """Rules of two tokens or more, none of which is a rule alone: tokens, bad, n. None if there can't be any."""
    same = ["n", "bad", "h1", "h2"]
    classes = sums.where(F.col("bad") < min_confidence * F.col("n") - 1e-9).groupBy(*same)
    classes = materialize(classes.agg(F.min("token").alias("token"), F.collect_list("token").alias("members")), "token-classes")
    named = materialize(tokens.join(classes.select("token"), "token"), "page-tokens")
    baskets = materialize(named.where("bad").groupBy("id").agg(F.collect_list("token").alias("items")), "bad-pages")
    count = baskets.count()
    if count < needed:
        return None
    # Rounded up to a number of pages by FPGrowth; half a page less keeps that from being one too many.
    model = FPGrowth(itemsCol="items", minSupport=(needed - 0.5) / count).fit(baskets)
    sets = model.freqItemsets.where(F.size("items") > 1).select(F.array_sort("items").alias("names"), F.col("freq").alias("bad"))
    sets = materialize(sets.withColumn("set_id", F.xxhash64("names")), "token-sets")
    pages = named.groupBy("id").agg(F.collect_list("token").alias("has"))
    hits = pages.select("has", F.explode("has").alias("token")).join(_under_rarest(sets, "set_id", "names", classes), "token")
    totals = hits.where(F.size(F.array_except("names", "has")) == 0).groupBy("set_id").agg(F.count("*").alias("n"))
    rules = sets.join(totals, "set_id").where(F.col("bad") >= min_confidence * F.col("n") - 1e-9)
    rules = materialize(rules, "wide-url-rules")
    # A shorter rule covers a longer one that has all its tokens; it is looked up by its rarest one.
    short = _under_rarest(rules, "set_id", "names", classes).select(F.col("names").alias("covering"), "token")
    long = rules.select("set_id", "names", F.explode("names").alias("token"))
    covered = long.join(short, "token").where((F.size("covering") < F.size("names")) & (F.size(F.array_except("covering", "names")) == 0))
    rules = rules.join(covered.select("set_id").distinct(), "set_id", "left_anti")
    # Any member of a class may stand for it.
    lists = rules.select("set_id", "bad", "n", F.explode("names").alias("token")).join(classes.select("token", "members"), "token")
    lists = lists.groupBy("set_id", "bad", "n").agg(F.collect_list("members").alias("lists"))
    start = F.array(F.array().cast("array<string>"))
    combined = F.aggregate(
        "lists", start, lambda done, members: F.flatten(F.transform(done, lambda d: F.transform(members, lambda m: F.concat(d, F.array(m)))))
    )
    return lists.select(F.explode(combined).alias("tokens"), "bad", "n")


def mine_rules(
    labelled: DataFrame, min_support: float | None = None, min_confidence: float = MIN_CONFIDENCE, min_pages: int = MIN_PAGES
) -> DataFrame:
    """Token combinations that foretell a bad label: rule_id, tokens, support, confidence.

    `labelled` has columns url and bad (boolean); rows with a null in either teach nothing. A rule needs
    `min_pages` bad pages with its tokens or, if given, the share `min_support` of all labelled pages. It is
    left out if a rule with fewer tokens, all of them its own, is kept. No labelled row gives no rule.

    A token that is a rule alone covers every longer one with it, so such tokens are counted first and go no further. Tokens
    that the same labelled pages have are interchangeable: FP-growth gets one of them, of bad pages only. How many
    pages in all have a set is counted by an index. No rule is lost.
    """
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "rule_id long, tokens array<string>, support double, confidence double")
    rows = labelled.where("url IS NOT NULL AND bad IS NOT NULL").select("url", "bad", F.monotonically_increasing_id().alias("id"))
    rows = materialize(rows, "labelled-pages")
    count, bad = rows.agg(F.count("*"), F.count_if("bad")).first()
    needed = min_pages if min_support is None else max(1, ceil(min_support * count - 1e-9))
    if bad < max(1, needed):
        return empty
    tokens = rows.select("id", "url", "bad", F.explode(url_tokens(F.col("url"))).alias("token"))
    whole = lambda c: F.sum(c.cast("decimal(38,0)"))
    sums = tokens.groupBy("token").agg(
        F.count("*").alias("n"),
        F.count_if("bad").alias("bad"),
        whole(F.xxhash64("url")).alias("h1"),
        whole(F.xxhash64(F.lit(1), "url")).alias("h2"),
    )
    sums = materialize(sums.where(F.col("bad") >= needed), "bad-tokens")
    alone = sums.where(F.col("bad") >= min_confidence * F.col("n") - 1e-9).select(F.array("token").alias("tokens"), "bad", "n")
    wide = _combinations(tokens.drop("url"), sums, needed, min_confidence)
    found = (alone if wide is None else alone.union(wide)).withColumn("tokens", F.array_sort("tokens"))
    return found.select(
        F.xxhash64("tokens").alias("rule_id"), "tokens", (F.col("bad") / F.lit(count)).alias("support"), (F.col("bad") / F.col("n")).alias("confidence")
    )


def matched_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct URLs that some mined rule fits: url, rule_id of the most confident one, confidence."""
    tokens = urls.where("url IS NOT NULL").select("url").distinct().select("url", url_tokens(F.col("url")).alias("has"))
    wanted = rules.select("rule_id", F.explode("tokens").alias("token"))
    postings = tokens.select(F.explode("has").alias("token")).groupBy("token").count()
    lightest = wanted.join(postings, "token", "left").groupBy("rule_id").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token")).getField("token").alias("token")
    )
    index = rules.join(lightest, "rule_id").select("token", "rule_id", "tokens", "confidence")
    hits = (
        tokens.select("url", "has", F.explode("has").alias("token"))
        .join(index, "token")
        .where(F.size(F.array_except("tokens", "has")) == 0)
    )
    best = F.max(F.struct("confidence", "rule_id")).alias("best")
    return hits.groupBy("url").agg(best).select("url", "best.rule_id", "best.confidence")


def judge_urls(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[tuple[str, str, str]] = LISTED_RULES,
    min_support: float | None = None,
    min_confidence: float = MIN_CONFIDENCE,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """All rows and columns of `pages` with host, path, rule and verdict (`allow` or `block`).

    The listed rule decides where one fits; else a URL that a mined rule fits is blocked and any other
    is allowed. A null URL, or one without `://`, has an empty host and path, fits no rule and is allowed
    unless a mined rule fits its tokens. Repeated rows are judged alike. Columns of `pages` with the new
    names are replaced.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    mined = materialize(mine_rules(labelled, min_support, min_confidence, min_pages), "mined-url-rules")
    blocked = matched_urls(pages, mined).select(F.col("url").alias("__url"))
    host, path = url_parts(F.col("url"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    return (
        pages.join(blocked, F.col("url") == F.col("__url"), "left")
        .withColumns({"host": host, "path": path})
        .withColumns({"rule": rule, "verdict": F.coalesce(verdict, F.when(F.col("__url").isNotNull(), "block"), F.lit("allow"))})
        .drop("__url")
    )
