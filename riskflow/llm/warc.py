r"""Writes WARC archives and reads them back, with records found by their chain of lengths.

Archives are text files whose records end with the blank lines that the format asks for, so Spark's
text writer makes them and its reader cuts them at the magic `WARC/1.1\r\n`, in as many tasks as a file
has splits. A cut may also be one inside a payload. So each piece is only a candidate record, with the
offset of its own successor from its declared length. Inside a split the chains are followed by each
task; between splits they are followed by pointer jumping from the start of the file, over the few
offsets that a chain enters a split by. Pieces that are not reached belong to the payload of the record
before them, whose bytes are put together again. The driver sees counts only.
"""

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.llm.common import materialize, text_or_empty

MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32(hexadecimal: Column) -> Column:
    """A SHA-1 in base 32 from its 40 hexadecimal digits, four characters from each five digits."""

    def four(i: Column) -> Column:
        bits = F.conv(F.substring(hexadecimal, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        places = [F.shiftright(bits, n).bitwiseAND(F.lit(31)) + 1 for n in (15, 10, 5, 0)]
        return F.concat(*[F.substring(F.lit(BASE32), p, F.lit(1)) for p in places])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def archive_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """A WARC record for each row of (page_id, url, html), without its end: column `record`.

    Of records whose payloads are equal and have at least `min_bytes` bytes, those with the smallest
    page_id are responses and the others revisits, without payload; null ids are the largest. A null
    html is an empty payload. A record without url has no target.
    """
    payload = text_or_empty("html")
    pages = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    # Only what is repeated is looked up, so that pages needn't move in the common case.
    repeated = materialize(
        pages.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select("sha1", "first_id"),
        "warc-repeated",
    )
    again = F.col("first_id").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first_id"), F.lit(False))
    length = F.octet_length("payload").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), length, F.lit(END))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    block = F.concat(http, F.when(again, "").otherwise(F.col("payload")))
    fields = {
        "WARC-Type": F.when(again, "revisit").otherwise("response"),
        "WARC-Record-ID": uri(F.col("page_id")),
        "WARC-Date": F.lit("1970-01-01T00:00:00Z"),
        "WARC-Target-URI": F.translate("url", "\r\n", ""),
        "WARC-Refers-To": F.when(again, uri(F.col("first_id"))),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), base32(F.col("sha1"))),
        "Content-Type": F.lit("application/http; msgtype=response"),
        "Content-Length": F.octet_length(block).cast("string"),
    }
    # A field that is null is left out.
    head = F.concat_ws("\r\n", *[F.concat(F.lit(f"{name}: "), value) for name, value in fields.items()])
    return pages.join(repeated, "sha1", "left").select(F.concat(F.lit(MAGIC), head, F.lit(END), block).alias("record"))


def write_archives(records: DataFrame, path: str) -> None:
    records.select("record").write.mode("overwrite").option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magics: file, split, seq (order in the split), value."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def _with_offsets(pieces: DataFrame) -> DataFrame:
    """Adds `offset`, where the magic of each piece starts in its file; needs file, split, seq and size."""
    taken = F.col("size") + len(MAGIC)
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = pieces.groupBy("file", "split").agg(F.sum(taken).alias("taken"))
    starts = splits.select("file", "split", F.coalesce(F.sum("taken").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("file", "split").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("start") + F.coalesce(F.sum(taken).over(inside), F.lit(0)) - len(MAGIC)
    return pieces.join(starts, ["file", "split"]).withColumn("offset", offset).drop("start")


def _parsed(value: Column) -> dict[str, Column]:
    """Fields of what follows a magic; the declared size includes the magic and the end."""
    head = F.substring_index(value, END, 1)
    bytes_of_head = F.octet_length(head)
    declared = F.regexp_extract(F.concat(F.lit("\r\n"), head), r"(?i)\r\nContent-Length:[ \t]*([0-9]{1,15})[ \t]*(?:\r\n|$)", 1)
    content = F.when(declared != "", declared.cast("long"))
    block = F.substring(value.cast("binary"), bytes_of_head + len(END) + 1, F.coalesce(content, F.lit(0)).cast("int"))
    http = F.octet_length(F.substring_index(block.cast("string"), END, 1)) + len(END)
    payload = F.substring(block, http + 1, F.octet_length(block))
    return {
        "head": head,
        "declared": content + bytes_of_head + len(MAGIC) + 2 * len(END),
        "http_head": F.substring_index(block.cast("string"), END, 1),
        "payload_sha1": F.sha1(payload),
        "payload_size": F.octet_length(payload).cast("long"),
    }


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a split: where its chain leaves the split, and the last record before."""
    group = group.sort_values("offset")
    place = {o: i for i, o in enumerate(group["offset"])}
    stop, last = list(group["stop"]), list(group["offset"])
    for i in range(len(stop) - 1, -1, -1):
        to = place.get(stop[i], -1)
        if to > i:
            stop[i], last[i] = stop[to], last[to]
    return group.assign(leaves=stop, last=last)[["file", "split", "offset", "leaves", "last"]]


def _owners(group: pd.DataFrame) -> pd.DataFrame:
    """Marks the pieces of a split with the record whose bytes they are; -1 for those of none."""
    group = group.sort_values("offset")
    owner, stop, due, found = group["carried"].iloc[0], group["carried_stop"].iloc[0], group["entry"].iloc[0], []
    for o, s in zip(group["offset"], group["stop"], strict=True):
        if o == due:
            owner, stop, due = o, s, s
        found.append(owner if o < stop else -1)
    return group.assign(owner=found)[["file", "offset", "owner"]]


def reached_pieces(candidates: DataFrame) -> DataFrame:
    """file, offset, owner for (file, split, offset, stop): the piece's record by the chain from offset 0.

    `stop` is the offset at which a candidate's successor would start, null if it declares no size.
    """
    known = candidates.select("file", "split", "offset", F.coalesce("stop", F.lit(-1)).alias("stop"))
    exits = materialize(
        known.groupBy("file", "split").applyInPandas(_exits, "file string, split long, offset long, leaves long, last long"),
        "warc-exits",
    )
    # Only offsets that some chain enters a split by can lie on the path.
    entered = exits.select("file", F.col("leaves").alias("offset")).union(exits.select("file", F.lit(0).cast("long"))).distinct()
    # Tables with a row for each candidate are merged, not broadcast.
    jumps = exits.hint("merge").join(entered, ["file", "offset"])
    hops = materialize(jumps.select("file", F.col("offset").alias("at"), F.col("leaves").alias("to")), "warc-hops")
    reached = exits.select("file", F.lit(0).cast("long").alias("at")).distinct()
    count = -1
    while True:
        reached = materialize(
            reached.union(reached.join(hops, ["file", "at"]).select("file", F.col("to").alias("at"))).distinct(), "warc-reached"
        )
        if (now := reached.count()) == count:
            break
        count = now
        onward = hops.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        hops = materialize(hops.join(onward, ["file", "to"]).select("file", "at", F.col("further").alias("to")), "warc-hops")
    way = jumps.join(reached.withColumnRenamed("at", "offset"), ["file", "offset"])
    entries = way.groupBy("file", "split").agg(F.min("offset").alias("entry"), F.max("last").alias("last"))
    stops = known.select("file", F.col("offset").alias("last"), F.col("stop").alias("last_stop"))
    splits = known.select("file", "split").distinct().join(entries, ["file", "split"], "left").join(stops.hint("merge"), ["file", "last"], "left")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = lambda c: F.coalesce(F.last(c, True).over(before), F.lit(-1))
    splits = splits.select(
        "file",
        "split",
        F.coalesce("entry", F.lit(-1)).alias("entry"),
        carried("last").alias("carried"),
        carried("last_stop").alias("carried_stop"),
    )
    return known.join(splits, ["file", "split"]).groupBy("file", "split").applyInPandas(_owners, "file string, offset long, owner long")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below `path`, whatever their payloads hold.

    Returns file, offset, type, record_id, target, refers_to, declared_digest, http_length, payload_size
    and payload_sha1. A record is real if it starts a file or starts where a real one ends; what follows
    a record that declares no size, or one past the end of the file, is left out, as is a file that doesn't start with
    a record. An empty folder gives no rows.
    """
    size = F.octet_length("value").cast("long")
    parsed = _pieces(spark, path).withColumns({"size": size, **_parsed(F.col("value"))}).drop("value")
    placed = materialize(_with_offsets(materialize(parsed, "warc-pieces")), "warc-placed").where("offset >= 0")
    stop = F.col("offset") + F.col("declared")
    candidates = placed.withColumn("stop", stop)
    ends = placed.groupBy("file").agg(F.max(F.col("offset") + len(MAGIC) + F.col("size")).alias("file_end"))
    owners = materialize(reached_pieces(candidates), "warc-owners").where("owner >= 0")
    fields = ["head", "http_head", "payload_sha1", "payload_size"]
    records = candidates.join(owners.where("offset = owner").select("file", "offset").hint("merge"), ["file", "offset"])
    records = records.join(ends, "file").where("stop <= file_end").drop("file_end")
    whole = (F.col("size") + len(MAGIC)) == F.col("declared")
    simple = records.where(whole).select("file", "offset", *fields)
    broken = records.where(~whole).select("file", F.col("offset").alias("owner"))
    if not broken.isEmpty():
        parts = owners.join(broken, ["file", "owner"])
        again = _with_offsets(_pieces(spark, path).withColumn("size", size)).select("file", "offset", "value")
        joined = (
            parts.join(again, ["file", "offset"])
            .groupBy("file", F.col("owner").alias("offset"))
            .agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("parts"))
            .select("file", "offset", F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC).alias("value"))
        )
        simple = simple.unionByName(joined.select("file", "offset", *[c.alias(n) for n, c in _parsed(F.col("value")).items() if n in fields]))

    def field(text: str, name: str) -> Column:
        found = F.regexp_extract(F.concat(F.lit("\r\n"), F.col(text)), rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
        return F.when(found != "", found)

    return simple.select(
        "file",
        "offset",
        field("head", "WARC-Type").alias("type"),
        field("head", "WARC-Record-ID").alias("record_id"),
        field("head", "WARC-Target-URI").alias("target"),
        field("head", "WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(field("head", "WARC-Payload-Digest"), "^sha1:", "").alias("declared_digest"),
        field("http_head", "Content-Length").cast("long").alias("http_length"),
        "payload_size",
        "payload_sha1",
    )
