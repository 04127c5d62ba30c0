"""Mix sources to target weights by nested hash-threshold histograms.

Every row has a 60-bit hash. A source takes the rows whose hash lies below its threshold, so
the choice needs no sort, and a larger budget takes a superset of a smaller one's rows. The
threshold is found 12 bits at a time: sum the sizes per source and bucket, walk the buckets to
the one in which the budget ends, and look only at that bucket's rows in the next step. A
source may be asked for more than it has: whole repeats are taken first, the rest by threshold.
In the end one hash value a source is left. Where several rows have it, as rows equal in id
and text do, they alone are numbered, and as many are taken as come nearest to the target.
Ranks and sums over sources go over ranges, so sources may be as many as addresses.

Defined results: null text has size 0; null sources are one source, ordered last; of rows equal in
id and text any may be the ones that are taken; a source without words gets target 0; an empty
table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import WORD, fresh_name, written
from staylens.operators.scan import running_totals

HASH_BITS, STEP_BITS = 60, 12
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mix_hash(id_: Column, text: Column, seed: int = 1) -> Column:
    """60 bits of MD5, which other engines can compute too."""
    parts = [F.coalesce(id_.cast("string"), F.lit("\\N")), F.coalesce(F.md5(text), F.lit("\\N"))]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """Add ``target`` to rows ``(source, source_size)``.

    All sources share ``share`` times the total by weight; a target stops at ``most`` times
    its source's size and the excess goes to the others by weight, until none is above. That
    end point is one common level: target = min(level * weight, most * size).
    """
    table = F.array(*[F.lit(w) for w in weights])
    capped = F.lit(most) * F.col("source_size")
    listed = sources.withColumns({"_last": F.col("source").isNull(), "_capped": capped})
    ranked = running_totals(listed, [], ["_last", "source"], {"_nth": F.lit(1)})
    ranked = ranked.withColumn("weight", F.get(table, ((F.col("_nth") - 1) % len(weights)).cast("int")))
    ranked = ranked.withColumn("_ratio", F.col("_capped") / F.col("weight"))
    # With k sources capped the level is (budget - their caps) / (the other weights); the true one is the largest.
    upto = {"_caps": F.col("_capped"), "_weights": F.col("weight")}
    walked = written(running_totals(ranked, [], ["_ratio", "_last", "source"], upto), "mix-sources")
    total, weight = walked.agg(F.sum("source_size"), F.sum("weight")).first()
    before = F.lit(total).cast("bigint") * F.lit(float(share)) - (F.col("_caps") - F.col("_capped"))
    level = walked.agg(F.max(before / (F.lit(weight).cast("bigint") - (F.col("_weights") - F.col("weight"))))).first()[0]
    return walked.select(
        "source", "source_size", F.least(capped.cast("double"), F.lit(level).cast("double") * F.col("weight")).alias("target")
    )


def mixture_plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source ``(source, source_size, target, whole, cut, left, at_cut)`` from rows ``(source, size, hash)``.

    A row is taken ``whole`` times, and once more if its hash is below ``cut``. Of the ``at_cut`` rows
    at ``cut`` itself those are taken, in any order, that bring their sum nearest to ``left``; a negative cut
    takes none. ``rows`` is read once per step, so it should be a written narrow table.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    state = written(
        targets.withColumn("whole", whole)
        .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("bigint")),
        "mix-targets",
    )
    keys = ["source", "source_size", "target", "whole"]
    for low in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        at = state.select(F.col("source").alias("_source"), F.col("prefix").alias("_prefix"))
        inside = rows.join(
            at, rows["source"].eqNullSafe(F.col("_source")) & (F.shiftright("hash", low + STEP_BITS) == F.col("_prefix"))
        )
        bucket = F.shiftright("hash", low)
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
        walk = Window.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("size").over(walk)).withColumnRenamed("source", "_source")
        crossed = state.join(sums, state["source"].eqNullSafe(F.col("_source")) & (F.col("upto") > F.col("left")), "left")
        first = crossed.groupBy(*keys, "left", "prefix").agg(F.min(F.struct("bucket", "upto", "size", "rows")).alias("edge"))
        last = ((F.col("prefix") + 1) * (1 << STEP_BITS)) - 1
        # No bucket reaches the budget only where nothing is left to take from: the empty end of the range.
        found = first.select(
            *keys,
            F.when(F.col("edge").isNull(), F.col("left")).otherwise(F.col("left") - F.col("edge.upto") + F.col("edge.size")).alias("left"),
            F.coalesce(F.col("edge.bucket"), last).alias("prefix"),
            F.coalesce(F.col("edge.rows"), F.lit(0)).alias("at_cut"),
        )
        state = written(found, "mix-step")
    # Nothing beyond the whole repeats is wanted: below every hash.
    cut = F.when(F.col("target") > F.col("whole") * F.col("source_size"), F.col("prefix")).otherwise(-1)
    return written(state.select(*keys, cut.alias("cut"), "left", "at_cut"), "mix-plan")


def _nearest(left: Column, size: Column, upto: Column) -> Column:
    """Whether a row at the cut brings the sum of those before it nearer to ``left``; ``upto`` is the sum with it."""
    return 2 * (left - (upto - size)) >= size


def with_takes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 1,
    weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, keep: Sequence[str] = (),
) -> tuple[DataFrame, dict[str, str]]:
    """``keep`` columns of ``docs`` with size, source size, target and number of takes; and those columns' names."""
    names = {n: fresh_name(docs, n) for n in ("size", "hash", "source_size", "target", "takes")}
    sized = docs.select(
        *keep, F.col(source_col).alias("_mix_source"), word_count(F.col(text_col)).alias(names["size"]),
        mix_hash(F.col(id_col), F.col(text_col), seed).alias(names["hash"]),
    )
    narrow = set(keep) <= {id_col}
    if narrow:  # the text is read once; the steps read this table
        sized = written(sized, "mix-rows")
    base = sized.select(F.col("_mix_source").alias("source"), F.col(names["size"]).alias("size"), F.col(names["hash"]).alias("hash"))
    plan = mixture_plan(base if narrow else written(base, "mix-rows"), weights, share, most)
    plan = plan.select(
        F.col("source").alias("_plan_source"), F.col("source_size").alias(names["source_size"]),
        F.col("target").alias(names["target"]), F.col("whole").alias("_whole"), F.col("cut").alias("_cut"),
        F.col("left").alias("_left"), F.col("at_cut").alias("_at_cut"),
    )
    joined = sized.join(plan, F.col("_mix_source").eqNullSafe(F.col("_plan_source")))
    size, hash_, left = F.col(names["size"]), F.col(names["hash"]), F.col("_left")
    columns = [*keep, names["size"], names["source_size"], names["target"]]

    def taken(rows: DataFrame, at_cut: Column) -> DataFrame:
        more = F.when(hash_ == F.col("_cut"), at_cut).otherwise(hash_ < F.col("_cut"))
        return rows.select(*columns, (F.col("_whole") + more.cast("bigint")).alias(names["takes"]))

    alone = _nearest(left, size, size)
    if plan.filter(F.col("_at_cut") > 1).isEmpty():
        return taken(joined, alone), names
    several = (hash_ == F.col("_cut")) & (F.col("_at_cut") > 1)
    equal = running_totals(joined.filter(several), ["_mix_source"], [], {"_upto": size})
    rest = taken(joined.filter(~several), alone)
    return rest.unionByName(taken(equal, _nearest(left, size, F.col("_upto")))), names


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken."""
    rows, names = with_takes(docs, keep=docs.columns, **options)
    repeat = F.explode(F.sequence(F.lit(1), F.col(names["takes"])))
    return rows.filter(F.col(names["takes"]) > 0).withColumn("_copy", repeat).select(*docs.columns)
