"""Repeatable train/test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.operators.groups import share_of_total
from staylens.operators.joins import anti_join
from staylens.operators.scan import running_totals
from staylens.session import settled

BUCKETS = 10_000


def split_bucket(keys: Sequence[str], seed: int) -> Column:
    """Bucket 0..9999 of a row, a function of its key values only.

    MD5 is used because every engine has it, so the split can be checked elsewhere.
    A random number would change when a lost task is run again.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % BUCKETS


def tag_split(
    df: DataFrame, keys: Sequence[str] | None = None, train_share: float = 0.8, seed: int = 1,
    fractions: dict | None = None, target: str | None = None,
) -> DataFrame:
    """Add ``dataset`` (Train or Test).

    ``keys`` default to all columns; identical rows then stay on the same side, so no
    test row is a copy of a training row. ``fractions`` gives each class its own share.
    """
    bucket = split_bucket(keys or df.columns, seed)
    limit = F.lit(round(train_share * BUCKETS))
    if fractions:
        for value, share in fractions.items():
            limit = F.when(F.col(target) == value, round(share * BUCKETS)).otherwise(limit)
    return df.withColumn("dataset", F.when(bucket < limit, "Train").otherwise("Test"))


def stratified_split(
    df: DataFrame, target: str, keys: Sequence[str] | None = None, train_share: float = 0.8,
    seed: int = 1, fractions: dict | None = None, method: str = "hash",
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, ``train_share`` of every class in train.

    ``hash`` needs no shuffle at all. ``anti_join`` forms the test set as "all rows whose
    key is not in train", for callers that bring a train set of their own; it needs keys.
    """
    tagged = tag_split(df, keys, train_share, seed, fractions, target)
    train = tagged.filter(F.col("dataset") == "Train").drop("dataset")
    if method == "anti_join":
        if not keys:
            raise ValueError("the anti_join form needs key columns")
        return train, anti_join(df, train, keys).select(*df.columns)
    return train, tagged.filter(F.col("dataset") == "Test").drop("dataset")


def balance_report(tagged: DataFrame, target: str) -> DataFrame:
    """Class counts and shares of both sets, from one aggregate."""
    return share_of_total(tagged, ["dataset", target], "count", "percentage", within=["dataset"])


HASH_BITS, STEP_BITS = 60, 12


def _split_hash(keys: Sequence[str], seed: int) -> Column:
    """60 bits of the same digest :func:`split_bucket` uses."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def class_thresholds(rows: DataFrame, shares: Column) -> DataFrame:
    """Per class ``(class, cut, left)`` of rows ``(class, hash)``: the class has as many hashes below ``cut`` as it
    gives away, less ``left`` of those equal to it.

    Nested histograms: count per class and 12-bit bucket, walk to the bucket in which the wanted
    number ends, look only at that bucket's rows in the next step. Five small steps, no sort.
    """
    totals = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    state = settled(
        totals.select(
            "class", F.floor(F.col("n") * shares + 0.5).cast("bigint").alias("left"), F.lit(0).cast("bigint").alias("cut")
        ),
        "split-classes",
    )
    for low in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        at = state.select(F.col("class").alias("_class"), F.col("cut").alias("_cut"))
        inside = rows.join(at, rows["class"].eqNullSafe(F.col("_class")) & (F.shiftright("hash", low + STEP_BITS) == F.col("_cut")))
        buckets = inside.groupBy("class", F.shiftright("hash", low).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
        upto = F.sum("rows").over(Window.partitionBy("class").orderBy("bucket"))
        walked = buckets.select(F.col("class").alias("_class"), "bucket", "rows", upto.alias("upto"))
        edge = state.join(walked, state["class"].eqNullSafe(F.col("_class")) & (F.col("upto") > F.col("left")), "left")
        first = edge.groupBy("class", "left", "cut").agg(F.min(F.struct("bucket", "rows", "upto")).alias("edge"))
        last = (F.col("cut") + 1) * (1 << STEP_BITS) - 1  # all rows are wanted
        state = settled(
            first.select(
                "class",
                F.when(F.col("edge").isNull(), F.lit(1 << 62)).otherwise(F.col("left") - F.col("edge.upto") + F.col("edge.rows")).alias("left"),
                F.coalesce(F.col("edge.bucket"), last).alias("cut"),
            ),
            "split-step",
        )
    return state


def exact_split(
    df: DataFrame, target: str, keys: Sequence[str] | None = None, train_share: float = 0.8, seed: int = 1, fractions: dict | None = None
) -> DataFrame:
    """Add ``dataset``: each class gives Train its share to the row (rounded half up), those with the smallest hashes.

    Rows that agree in class and ``keys`` share a hash; where the share ends among them they
    are numbered, and they alone are sorted. Null classes are a class.
    """
    hashed = settled(df.withColumn("_split_hash", _split_hash(keys or df.columns, seed)), "split-rows")
    share = F.lit(float(train_share))
    for value, own in (fractions or {}).items():
        share = F.when(F.col("class") == value, float(own)).otherwise(share)
    cuts = class_thresholds(hashed.select(F.col(target).alias("class"), F.col("_split_hash").alias("hash")), share)
    cuts = cuts.select(F.col("class").alias("_class"), F.col("cut").alias("_cut"), F.col("left").alias("_left"))
    joined = hashed.join(cuts, hashed[target].eqNullSafe(F.col("_class"))).drop("_class")
    edge = F.col("_split_hash") == F.col("_cut")
    # One hash per class, so nearly always one row per class.
    at_edge = running_totals(joined.filter(edge & (F.col("_left") < 1 << 62)), [target], [], {"_nth": F.lit(1)})
    away = joined.filter(~edge | (F.col("_left") == 1 << 62))
    side = F.when(F.col("_split_hash") <= F.col("_cut"), "Train").otherwise("Test")
    parted = F.when(F.col("_nth") <= F.col("_left"), "Train").otherwise("Test")
    return away.select(*df.columns, side.alias("dataset")).unionByName(at_edge.select(*df.columns, parted.alias("dataset")))
