import json
import os

import pytest
from fixtures import PLAIN, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens import schemas
from staylens.plans import stream_questions as S
from staylens.session import scratch_dir
from staylens.streaming import events as E
from staylens.streaming import monitors as M
from staylens.streaming import paced, panes
from staylens.streaming.fanout import report, start_fan_out
from staylens.streaming.run import collect_stream, newest_rows, replay, start, update_writer
from staylens.streaming.watch import GroupFailed, run_watched

SCHEMA = "event_timestamp timestamp, k string, v double"
VALUE = T.StructType([T.StructField("value", T.StringType())])


def stream_of(spark, files, **options):
    """A stream over one file per list of rows, oldest first."""
    path = scratch_dir(spark, "test-stream")
    os.makedirs(path)
    for i, part in enumerate(files):
        own = scratch_dir(spark, "part")
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(own)
        name = next(f for f in os.listdir(own) if f.endswith(".parquet"))
        os.rename(f"{own}/{name}", f"{path}/{i:03d}.parquet")
        os.utime(f"{path}/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return E.read_stream(spark, "parquet", path, SCHEMA, **options)


def timed(spark, minutes, key="a", value=1.0):
    import datetime

    base = datetime.datetime(2024, 1, 1)
    return [(base + datetime.timedelta(minutes=m), key, value) for m in minutes]


def plain(df):
    return sorted(map(repr, df.collect()))


def test_restarts_give_the_result_of_one_run(spark, small):
    got = S.stream_restarted_counts(spark, small)
    assert plain(got) == plain(S.stream_counts(spark, small))


def test_a_stopped_query_goes_on_where_it_was(spark):
    """Each file is read once over all starts, whatever was cut off, and a batch has one file."""
    files = [timed(spark, range(i * 10, i * 10 + 5 + i)) for i in range(8)]
    path = scratch_dir(spark, "go-on")
    write = update_writer(f"{path}/out")
    source = stream_of(spark, files, maxFilesPerTrigger=1)
    counts = lambda: source.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    progress = []

    def launch():
        query = start(counts(), "go_on", f"{path}/checkpoint", mode="update", every=None, handler=write)
        progress.append(query)
        return query

    started = paced.in_stretches(launch, (2, 2, 1))
    assert started == 4
    total = sum(len(f) for f in files)
    assert rows(newest_rows(spark, f"{path}/out", counts().schema, ["k"]), "k", "n") == [("a", total)]
    batches = sorted(int(d.removeprefix("batch=")) for d in os.listdir(f"{path}/out") if d.startswith("batch="))
    assert batches == list(range(8))


def test_panes_equal_sliding_windows(spark, small):
    assert plain(S.stream_pane_mean(spark, small)) == plain(S.stream_sliding_mean(spark, small))
    assert plain(S.stream_pane_top(spark, small)) == plain(S.stream_top_groups(spark, small))


def state_rows(spark, result, name):
    path = scratch_dir(spark, name)
    query = start(result, name, f"{path}/c", "noop", "update", every=None)
    query.awaitTermination()
    return sum(s["numRowsUpdated"] for p in query.recentProgress for s in p["stateOperators"])


def test_state_of_panes_does_not_grow_with_the_window(spark):
    data = [timed(spark, range(0, 600, 30))]
    sliding = [
        state_rows(spark, M.sliding_mean(stream_of(spark, data), ["k"], F.col("v"), duration=f"{d} minutes", slide="1 minute", watermark="1 minute"), f"s{d}")
        for d in (5, 20)
    ]
    one = state_rows(spark, panes.panes(stream_of(spark, data), ["k"], F.col("v"), slide="1 minute", watermark="1 minute"), "p")
    assert one == 20 and sliding == [5 * one, 20 * one]


def test_chained_windows_over_several_batches(spark):
    """Files in order of time, one a batch; late rows within the watermark still count."""
    files = [timed(spark, range(0, 30)), timed(spark, range(28, 60)), timed(spark, [55, 57, *range(60, 90)])]
    everything = [r for f in files for r in f]
    end = [(files[-1][-1][0].replace(year=2025), "a", None)]
    source = stream_of(spark, [*files, end], maxFilesPerTrigger=1)
    parts = panes.panes(source, ["k"], F.col("v"), slide="5 minutes", watermark="20 minutes", counted=F.col("v").isNotNull())
    got = collect_stream(spark, panes.sliding_mean(parts, ["k"], "15 minutes", "5 minutes", min_count=1), "chained")
    want = M.sliding_mean(spark.createDataFrame(everything, SCHEMA), ["k"], F.col("v"), duration="15 minutes", slide="5 minutes", min_count=1)
    assert plain(got) == plain(want)


def test_hot_id_is_spread_and_kept_once(spark):
    data = timed(spark, [1] * 3000, "hot") + [r for i in range(3000) for r in timed(spark, [1, 1], f"id{i}")]
    source = stream_of(spark, [data[i::4] for i in range(4)])
    once = collect_stream(spark, E.dedupe(source, "k", salts=S.DEDUPE_SALTS), "hot")
    assert once.count() == 3001 and once.select("k").distinct().count() == 3001
    # What the first stage sends to a task: twice the median at most, where the id alone would be a third of all.
    salted = spark.createDataFrame(data, SCHEMA).withColumn("_salt", F.floor(F.rand(1) * S.DEDUPE_SALTS)).cache()
    tasks = sorted(r["count"] for r in salted.repartition(8, "k", "_salt").groupBy(F.spark_partition_id()).count().collect())
    assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[4]
    second = salted.dropDuplicates(["k", "_salt"]).groupBy("k").count().agg(F.max("count")).first()[0]
    assert second <= S.DEDUPE_SALTS


def message(**changes):
    body = {f.name: PLAIN.get(f.name) for f in schemas.EVENT.fields}
    return json.dumps(body | {"children": 0, "event_time": "2024-01-01T10:00:10", "event_id": "BKG-1"} | changes)


def test_no_number_is_no_rate_and_stops_nothing(spark):
    lines = [message(), message(adr=float("nan")), message(adr=float("inf")), message(adr=1e300), message(adr=-1), message(event_time="x"), "{"]
    path = scratch_dir(spark, "nan")
    spark.createDataFrame([(x,) for x in lines], VALUE).coalesce(1).write.text(path)
    source = E.read_stream(spark, "text", path, VALUE)
    events = E.parse_events(source)
    assert rows(replay(spark, E.rejected_counts(source), ["reason"], "reasons"), "reason", "messages") == [("no_rate", 3), ("no_time", 2)]
    got = replay(spark, M.sliding_mean(events, ["hotel"], F.col("adr"), min_count=1), ["period_start", "hotel"], "nan_mean")
    assert {(r["booking_count"], r["avg_daily_rate"]) for r in got.collect()} == {(2, PLAIN["adr"])}  # 1e300 is no amount
    out = scratch_dir(spark, "nan_fan")
    start_fan_out(events, f"{out}/s", f"{out}/c", every=None).awaitTermination()
    assert report(spark, f"{out}/s", "bookings_per_minute").first()["total_bookings"] == 2


def test_a_failing_query_ends_its_group(spark):
    source = stream_of(spark, [timed(spark, range(5))])
    root = scratch_dir(spark, "group")
    good = start(source, "good", f"{root}/good", "noop", every="1 second")
    bad = start(source.withColumn("x", F.raise_error(F.lit("broken monitor"))), "bad", f"{root}/bad", "noop", every="1 second")
    with pytest.raises(GroupFailed, match="(?s)bad.*broken monitor"):
        run_watched(spark, [good, bad])
    assert not good.isActive and not bad.isActive


def test_progress_of_a_group_is_recorded(spark):
    files = [timed(spark, range(i, i + 4)) for i in range(3)]
    source, root = stream_of(spark, files, maxFilesPerTrigger=1), scratch_dir(spark, "group")
    queries = [start(source.groupBy("k").count(), f"watched_{i}", f"{root}/{i}", "noop", "update", every=None) for i in range(2)]
    progress = run_watched(spark, queries)
    assert {(r["query"], r["n"]) for r in progress.groupBy("query").agg(F.sum("input_rows").alias("n")).collect()} <= {("watched_0", 12), ("watched_1", 12)}
    assert run_watched(spark, queries) is not None  # all have ended before
