import datetime
import json
import os

import pytest
from fixtures import PLAIN, bookings, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens import schemas
from staylens.operators import cleaning
from staylens.plans import stream_questions as S
from staylens.sources import read_table
from staylens.streaming import events as E
from staylens.streaming import monitors as M
from staylens.streaming.fanout import report, start_fan_out
from staylens.streaming.run import collect_stream, replay, run_all, start, start_monitors

VALUE = T.StructType([T.StructField("value", T.StringType())])


def message(**changes):
    body = {f.name: PLAIN.get(f.name) for f in schemas.EVENT.fields}
    body |= {"children": 0, "event_time": "2024-01-01T10:00:10", "event_id": "BKG-1"} | changes
    return json.dumps(body)


def write_text(folder, *batches):
    """One file per batch, oldest first."""
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(batches):
        path = os.path.join(folder, f"{i:03d}.txt")
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def text_stream(spark, folder):
    return E.parse_events(E.read_stream(spark, "text", folder, VALUE, maxFilesPerTrigger=1))


def test_parser_drops_bad_rows_and_survives(spark):
    lines = [
        message(), "not json", message(event_time="yesterday"), message(event_time=None), message(adults=0),
        message(adr=-1.0), message(hotel=None), message(adr=None), message(event_id="BKG-2", country="0"),
    ]
    df = spark.createDataFrame([(x,) for x in lines], VALUE)
    got = E.parse_events(df)
    assert rows(got, "event_id") == [("BKG-1",), ("BKG-2",)]
    assert got.columns == [f.name for f in schemas.EVENT.fields] + ["event_timestamp"]
    assert rows(got.filter(E.known_country()), "event_id") == [("BKG-1",)]
    assert E.parse_events(df.select(F.col("value").cast("binary").alias("value"))).count() == 2


def test_envelope_keeps_types_and_is_repeatable(spark):
    df = cleaning.fix_types(bookings(spark, {"hotel": None, "babies": None}, {}))
    sent = E.to_event_envelope(df)
    got = {r["key"]: json.loads(r["value"]) for r in sent.collect()}
    assert set(got) == {"Unknown", "City Hotel"}
    assert got["Unknown"]["babies"] == 0 and got["Unknown"]["children"] == 0 and got["Unknown"]["hotel"] == "Unknown"
    again = {r["key"]: json.loads(r["value"]) for r in E.to_event_envelope(df.repartition(3)).collect()}
    assert {k: v["event_id"] for k, v in got.items()} == {k: v["event_id"] for k, v in again.items()}
    back = E.parse_events(sent)
    assert rows(back, "children") == [(0,), (0,)]
    assert abs((back.first()["event_timestamp"] - datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)).total_seconds()) < 600


@pytest.mark.parametrize("name", ["stream_counts", "stream_rate_alert", "stream_sliding_mean", "stream_top_groups"])
def test_stream_equals_batch(spark, small, name, monkeypatch):
    streamed = getattr(S, name)(spark, small)
    monkeypatch.setattr(S, "event_stream", lambda sp, f: S.shape(read_table(sp, f, "events")))
    monkeypatch.setattr(S, "replay", lambda sp, result, keys, label: result)
    assert rows(streamed) == rows(getattr(S, name)(spark, small))


def test_replay_over_many_batches_keeps_the_newest_row(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_text(folder, [message()], [message(is_canceled=1), message(hotel="Resort Hotel")], [message()])
    result = M.bookings_per_minute(text_stream(spark, folder))
    got = replay(spark, result, ["window_start", "hotel"], "many")
    assert rows(got, "hotel", "total_bookings", "confirmed", "canceled") == [("City Hotel", 3, 2, 1), ("Resort Hotel", 1, 1, 0)]


LATE = ["10:00:10", "10:30:00", "10:00:20", "10:40:00", "10:00:30", "10:50:00"]


def late_counts(spark, tmp_path, mode, sink):
    folder = str(tmp_path / "late")
    write_text(folder, *[[message(event_time=f"2024-01-01T{t}")] for t in LATE])
    result = M.windowed_counts(text_stream(spark, folder), ["hotel"], F.col("is_canceled"), watermark="2 minutes")
    start(result, sink, str(tmp_path / "checkpoint"), "memory", mode, every=None).awaitTermination()
    return rows(spark.table(sink), F.date_format("window_start", "HH:mm"), "total_bookings")


def test_append_drops_what_is_late_and_keeps_open_windows_back(spark, tmp_path):
    assert late_counts(spark, tmp_path, "append", "late_append") == [("10:00", 2), ("10:30", 1), ("10:40", 1)]


def test_complete_keeps_everything(spark, tmp_path):
    assert late_counts(spark, tmp_path, "complete", "late_complete") == [
        ("10:00", 3), ("10:30", 1), ("10:40", 1), ("10:50", 1),
    ]


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    write_text(folder, [message(event_id="a")])
    for expected in (1, 2):
        start(text_stream(spark, folder), "restart", checkpoint, "parquet", every=None, path=out).awaitTermination()
        assert spark.read.parquet(out).count() == expected
        write_text(folder, [message(event_id="a")], [message(event_id="b")])


def test_dedupe(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_text(folder, [message(), message()], [message(), message(event_id="BKG-2", event_time="2024-01-01T10:01:00")])
    got = collect_stream(spark, E.dedupe(text_stream(spark, folder)), "dedupe")
    assert rows(got, "event_id") == [("BKG-1",), ("BKG-2",)]


def test_monitor_definitions_on_static_rows(spark):
    base = dict(event_timestamp=datetime.datetime(2024, 1, 1, 10, 0, 30))
    events = cleaning.fix_types(bookings(spark, *[{"is_canceled": int(i < 3), "adr": 10.0 * i} for i in range(5)], {"country": "NULL"}))
    events = events.withColumn("event_timestamp", F.lit(base["event_timestamp"]))
    assert rows(M.bookings_per_minute(events), "total_bookings", "confirmed", "canceled") == [(6, 3, 3)]
    assert rows(M.cancellation_alerts(events), "cancel_rate_pct", "alert") == [(50.0, "WARNING")]
    # Six windows of five minutes hold the minute; three kept reservations are too few.
    assert M.rate_over_time(events).count() == 0
    assert M.rate_over_time(events.union(events)).count() == 5
    assert rows(M.rate_over_time(events.union(events)), "booking_count", "avg_daily_rate", "revenue_proxy", "avg_stay_nights")[0] == (6, 56.67, 340.0, 3.0)
    top = rows(M.top_countries(events, None), "country", "booking_count", "avg_spend", "cancel_rate_pct")
    assert top == [("PRT", 5, 20.0, 60.0)] * 2


def test_all_monitors_run_from_one_source(spark, tmp_path, capfd):
    folder = str(tmp_path / "in")
    write_text(folder, [message() for _ in range(6)])
    queries = start_monitors(text_stream(spark, folder), str(tmp_path / "checkpoints"), every=None)
    run_all(spark, queries, finite=True)
    assert [q.exception() for q in queries] == [None] * 4
    assert {q.name for q in queries} == set(M.MONITORS)


def test_fan_out_equals_the_monitors_and_keeps_late_events(spark, tmp_path):
    folder = str(tmp_path / "in")
    first = [message(event_time=f"2024-01-01T10:0{i % 4}:10", is_canceled=int(i % 3 == 0), adr=33.35 + i) for i in range(40)]
    late = [message(event_time="2023-12-31T09:00:00", country="ESP", deposit_type="Non Refund") for _ in range(6)]
    write_text(folder, first[:20], late, first[20:])
    out = str(tmp_path / "out")
    start_fan_out(text_stream(spark, folder), out, str(tmp_path / "checkpoint"), every=None).awaitTermination()
    static = E.parse_events(spark.createDataFrame([(x,) for x in first + late], VALUE))
    for name, (monitor, _, _) in M.MONITORS.items():
        expected = monitor(static)
        assert rows(report(spark, out, name), *expected.columns) == rows(expected)
        assert expected.count() > 0


def test_sorting_needs_complete_output(spark, tmp_path):
    stream = E.read_stream(spark, "rate")
    with pytest.raises(ValueError):
        start(stream, "x", str(tmp_path), mode="append", order_by=[F.col("value")])


def test_message_options():
    options = E.kafka_options("host:9092", "reservations")
    assert "maxOffsetsPerTrigger" not in options and options["startingOffsets"] == "latest"
    assert E.kafka_options("host:9092", "reservations", 500)["maxOffsetsPerTrigger"] == "500"


def test_filters_do_not_parse_a_message_again(spark, tmp_path):
    lines = [message(), "not json", message(adr=-1.0), message(country="0", event_id="BKG-2"), message(lead_time="soon", event_id="BKG-3")]
    spark.createDataFrame([(x,) for x in [*lines, None]], VALUE).write.parquet(str(tmp_path / "in"))
    raw = spark.read.parquet(str(tmp_path / "in"))
    events = E.parse_events(raw)
    for report_ in (events, M.top_countries(events), M.rate_over_time(events), E.rejected_counts(raw)):
        plan = report_._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
    assert rows(events, "event_id", "lead_time") == [("BKG-1", 30), ("BKG-2", 30), ("BKG-3", None)]
    assert rows(E.rejected_counts(raw)) == [("no_rate", 1), ("no_time", 2)]
