"""Splits, samples and class balancing that give the same rows on every run and layout.

`key` names a column that identifies a row. All randomness is a hash of it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.functions.columns import bucket_of, hash_uniform
from riskflow.operators.ordering import BEFORE, dense_index
from riskflow.schemas import SEED

COPIES_PER_ROW = 1 << 16  # copies that one row of an intermediate table may expand to
COPIES_PER_TASK = 1 << 24


def split_name(key: str, train: float, seed: int = SEED) -> Column:
    return F.when(hash_uniform(key, seed) < train, F.lit("train")).otherwise(F.lit("test"))


def hash_split(rows: DataFrame, key: str, train: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows. A filter on each side: no shuffle, no dependence on the layout."""
    u = hash_uniform(key, seed)
    return rows.where(u < train), rows.where(u >= train)


def stratified_split(rows: DataFrame, label: str, key: str, train: float = 0.7, seed: int = SEED) -> DataFrame:
    """Add `split` so that each class has round(train * size) training rows, exactly.

    Rows of a class are ordered by the hash of their key, equal ones by the key. Counts per class and bucket of the hash tell which
    bucket the cut falls in; only that bucket's rows are ordered, to find the last training row, and every other
    row is decided by its own hash. Rows that are equal in both share a side only as far as the count
    allows: of those at the cut, a hash of the whole row decides, then chance of their order.
    """
    buckets = 1 << 16
    spread = {"_group": F.coalesce(F.col(label).cast("string"), F.lit("")), "_u": hash_uniform(key, seed)}
    # Rows without a key have one hash; that of the whole row spreads them.
    everything = F.xxhash64(*[F.col(c) for c in rows.columns])
    spread["_u"] = F.when(F.col(key).isNull(), hash_uniform(everything, seed)).otherwise(spread["_u"])
    spread["_tie"] = F.struct(F.col(key).alias("key"), everything.alias("all"))
    keyed = rows.withColumns(spread).withColumn("_bucket", bucket_of(F.col("_u"), buckets))
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(*BEFORE)
    sizes = keyed.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_size"))  # buckets x classes rows at most
    start = F.coalesce(F.sum("_size").over(before), F.lit(0))
    total = F.sum("_size").over(Window.partitionBy("_group"))
    take = F.floor(total * train + 0.5) - start
    cuts = sizes.withColumn("_take", take).where("_take > 0 AND _take <= _size").select("_group", "_bucket", "_take")
    # The bucket that holds a class's last training row; a class without training rows has none.
    cut = F.broadcast(cuts.select("_group", F.col("_bucket").alias("_cut"), "_take"))  # a row for each class
    marked = keyed.join(cut, "_group", "left")
    at_cut = marked.where("_bucket = _cut")
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_u", "_tie"))
    decided = at_cut.withColumn("split", F.when(place <= F.col("_take"), "train").otherwise("test"))
    others = marked.where("_cut IS NULL OR _bucket <> _cut")
    others = others.withColumn("split", F.when(F.col("_bucket") < F.col("_cut"), "train").otherwise("test"))
    return others.unionByName(decided).select(*rows.columns, "split")


def balanced_split(rows: DataFrame, label: str, key: str, train: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the smaller class of the training part is copied until both are equally large.

    Rows are split by key before any is copied, so no key is on both sides and the test rows are as they came.
    """
    training, testing = hash_split(rows, key, train, seed)
    return oversample_replicate(training, label, key, seed), testing


def class_weights(rows: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Rows with a weight that gives both classes the same sum, half the number of rows: balance without copies.

    One count per class; every row stays one row, so no key becomes hot. Raises unless both classes occur.
    """
    sizes = class_sizes(rows, label)
    total = sum(sizes.values())
    return rows.withColumn(out, F.when(F.col(label) == 1, total / (2 * sizes[1])).otherwise(total / (2 * sizes[0])))


def exact_sample(rows: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """`n` rows without replacement. Each task keeps its best `n`; there is no full sort."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return rows.orderBy(draw, key).limit(n)


def with_relabelled_sample(rows: DataFrame, label: str, key: str, n: int = 100, seed: int = SEED) -> DataFrame:
    """All rows plus a sample of them relabelled 1.

    This plants false labels. It exists to reproduce earlier experiments; nothing calls it by default.
    """
    sample = exact_sample(rows, key, n, seed).withColumn(label, F.lit(1).cast(rows.schema[label].dataType))
    return rows.unionByName(sample)


def class_sizes(rows: DataFrame, label: str) -> dict[int, int]:
    """Sizes of the classes 0 and 1; raises unless both occur and nothing else does."""
    found = rows.groupBy(label).count().limit(4).collect()
    sizes = {r[0]: r["count"] for r in found}
    if set(sizes) != {0, 1}:
        raise ValueError(f"{label} must take the values 0 and 1, both present; found {sorted(map(str, sizes))}")
    return {int(k): v for k, v in sizes.items()}


def _row_uniform(rows: DataFrame, key: str, seed: int) -> Column:
    """The hash of a row's key; rows without one are spread by the hash of the whole row."""
    everything = hash_uniform(F.xxhash64(*[F.col(c) for c in rows.columns]), seed)
    return F.when(F.col(key).isNull(), everything).otherwise(hash_uniform(key, seed))


def oversample_bootstrap(rows: DataFrame, label: str, key: str, seed: int = SEED) -> DataFrame:
    """All rows plus draws with replacement from the smaller class until both have equal size.

    The draws are counted per drawn row before they meet the data, so the join moves at most one
    row per pair (row, chunk) and no key of it is hot; the copies appear after it. The rows are read several times: hand over a
    table, not a plan that is dear to run. To train on balanced classes `class_weights` needs no copies.
    """
    small, size, missing = _shortfall(rows, label)
    if missing == 0:
        return rows
    spark = rows.sparkSession
    chunks = -(-missing // (size * COPIES_PER_ROW))
    draws = (
        spark.range(missing)
        .select(
            bucket_of(hash_uniform("id", seed), size).alias("_index"),
            F.pmod(F.col("id"), F.lit(chunks)).alias("_chunk"),
        )
        .groupBy("_index", "_chunk")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    indexed = dense_index(rows.where(F.col(label) == small), _row_uniform(rows, key, seed), [key], "_index")
    drawn = indexed.join(draws, "_index")
    return rows.unionByName(_repeat(drawn, missing, rows.columns))


def oversample_replicate(rows: DataFrame, label: str, key: str, seed: int = SEED) -> DataFrame:
    """Like `oversample_bootstrap`, but copies every row of the smaller class equally often (+-1)."""
    small, size, missing = _shortfall(rows, label)
    if missing == 0:
        return rows
    each, rest = divmod(missing, size)
    indexed = dense_index(rows.where(F.col(label) == small), _row_uniform(rows, key, seed), [key], "_index")
    copies = F.lit(each) + (F.col("_index") < rest).cast("int")
    chunks = -(-(each + 1) // COPIES_PER_ROW)
    chunked = (
        indexed.withColumn("_all", copies.cast("bigint"))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        .withColumn(
            "_copies",
            F.least(F.lit(COPIES_PER_ROW).cast("bigint"), F.col("_all") - F.col("_chunk") * COPIES_PER_ROW),
        )
        .where("_copies > 0")
    )
    return rows.unionByName(_repeat(chunked, missing, rows.columns))


def _shortfall(rows: DataFrame, label: str) -> tuple[int, int, int]:
    sizes = class_sizes(rows, label)
    small = min(sizes, key=lambda c: (sizes[c], -c))
    return small, sizes[small], sizes[1 - small] - sizes[small]


def _repeat(rows: DataFrame, copies: int, columns: list[str]) -> DataFrame:
    """Each row `_copies` times, `copies` in all.

    Where few rows make many, adaptive execution would judge them by their own small size and merge
    them into few tasks; a fixed number of partitions, set by the output, prevents that. It is
    round-robin because a repartition on keys the rows are already placed by is optimised away.
    """
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-copies // COPIES_PER_TASK))
    rows = rows.repartition(tasks)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).select(*columns)
