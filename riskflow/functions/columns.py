"""Column expressions shared by the operators. All of them run in the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow import schemas as S

HASH_DIGITS = 13  # 52 bits: the largest whole-hex width a double holds exactly


def wall_clock(text: Column) -> Column:
    """`yyyy/MM/dd HH:mm` or `yyyy/MM/dd HH:mm:ss` as a zone-free timestamp, null when malformed."""
    shaped = text.rlike(r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}(:\d{2})?$")
    return F.when(shaped, F.translate(text, "/", "-").try_cast("timestamp_ntz"))


def utc_instant(wall_clock_time: Column) -> Column:
    """The instant at which a UTC clock shows a zone-free time, whatever the session's zone is."""
    return F.concat(wall_clock_time.cast("string"), F.lit("Z")).cast("timestamp")


def utc_wall_clock(instant: Column) -> Column:
    """The zone-free time that a UTC clock shows at an instant."""
    seconds = (F.unix_micros(instant) / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)


def hash_uniform(key: str | Column, seed: int = S.SEED) -> Column:
    """A number in [0, 1) that depends only on the key and the seed.

    Unlike `rand(seed)` it does not change with partitioning, task retries or row order.
    """
    column = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(column.cast("string"), F.lit(""))
    digest = F.md5(F.concat(text, F.lit(f":{seed}")))
    head = F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double")
    return F.coalesce(head / F.lit(float(16**HASH_DIGITS)), F.lit(0.0))


def bucket_of(uniform: Column, buckets: int) -> Column:
    """Which of `buckets` equal parts of [0, 1) a number lies in.

    Declared non-null, so that a join on it adds no null filter that would hash every row again.
    """
    return F.coalesce(F.floor(uniform * buckets), F.lit(0).cast("bigint"))


def round_half_up(value: Column, digits: int) -> Column:
    scale = F.lit(float(10**digits))
    return F.floor(value * scale + F.lit(0.5)).cast("double") / scale


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, 0 where bottom is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / bottom.cast("double"))


def at_least(score: Column, threshold: float) -> Column:
    return (score >= F.lit(threshold)).cast("int")


def pattern_header(line: Column) -> Column:
    """Pattern name on a BEGIN line, null on any other line.

    The plain substring test spares most lines the regular expression. The captured group is never
    empty on a match, so "" can only mean no match.
    """
    name = F.regexp_extract(line, S.BEGIN_PATTERN, 1)
    return F.when(line.contains(S.BEGIN_MARKER), F.nullif(name, F.lit("")))


def is_end(line: Column) -> Column:
    return line.contains(S.END_MARKER)


def is_dated(line: Column) -> Column:
    return line.rlike(S.DATE_PATTERN)


def short_pattern_name(name: Column) -> Column:
    """Pattern name without the detail that follows a colon."""
    return F.regexp_replace(name, S.NAME_SUFFIX, "")


def hours_up_to(hour: str, weight: str) -> list[Column]:
    """24 aggregates: total weight of rows whose hour is at most 0, 1, .. 23."""
    return [F.expr(f"sum(CASE WHEN {hour} <= {h} THEN {weight} ELSE 0L END) AS _to{h}") for h in range(24)]


def median_hour() -> Column:
    """Lower median from the columns made by `hours_up_to`, null without any hour.

    The median is the number of leading hours that hold less than half of the rows.
    Exact for any row count, and its state is 24 numbers per key.
    """
    below = " + ".join(f"int(2 * _to{h} < _to23)" for h in range(23))
    return F.expr(f"CASE WHEN _to23 > 0 THEN {below} END")


def histogram_median(hours: str) -> Column:
    """Lower median from an array of 24 counts, null without any count."""
    total = F.aggregate(hours, F.lit(0).cast("bigint"), lambda a, h: a + h)
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(0).alias("hour"))

    def step(a: Column, h: Column) -> Column:
        seen = a["seen"] + h
        return F.struct(seen.alias("seen"), (a["hour"] + F.when(2 * seen < total, 1).otherwise(0)).alias("hour"))

    return F.when(total > 0, F.aggregate(hours, start, step)["hour"])
