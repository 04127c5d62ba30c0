import time
from contextlib import contextmanager

from pyspark.sql import functions as F

from staylens import session
from staylens.plans import booking_models, handover_questions as H
from staylens.streaming import events as E
from staylens.streaming import fanout


def test_first_rows_do_not_hang_on_the_order_of_partitions(spark):
    """Sorted partitions that arrive last first, as they may from several executors."""
    parts = [spark.range(start, start + 50, 1, 1) for start in (150, 100, 50, 0)]
    batch = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    got = H.first_rows(batch, [F.asc("id")], 20).collect()
    assert [(r["place"], r["id"]) for r in got] == [(i + 1, i) for i in range(20)]
    assert dict(H.first_rows(batch, [F.asc("id")], 20).dtypes)["place"] == "bigint"


def test_fan_out_keeps_sums_and_not_the_batch(spark, monkeypatch, tmp_path):
    """What stays of a batch between the monitors has a row a minute and key, however many events there are."""
    seen = []

    @contextmanager
    def watched(df):
        seen.append((df.count(), len(df.columns)))
        yield df

    monkeypatch.setattr(fanout, "kept", watched)
    one = '{"hotel": "%s", "is_canceled": %d, "adr": 10.5, "adults": 2, "country": "PRT", "deposit_type": "No Deposit", "reserved_room_type": "A", ' \
        '"stays_in_week_nights": 1, "stays_in_weekend_nights": 1, "event_time": "2020-01-01T00:0%d:07Z"}'
    messages = [(one % (hotel, flag, minute),) for hotel in ("City", "Resort") for flag in (0, 1) for minute in (0, 1) for _ in range(25)]
    spark.createDataFrame(messages, "value string").write.parquet(f"{tmp_path}/in")
    events = E.parse_events(E.read_stream(spark, "parquet", f"{tmp_path}/in", "value string"))
    fanout.start_fan_out(events, f"{tmp_path}/out", f"{tmp_path}/checkpoint", every=None).awaitTermination()
    assert seen == [(8, 11)]
    counts = fanout.report(spark, f"{tmp_path}/out", "bookings_per_minute").collect()
    assert {(r["hotel"], r["total_bookings"], r["confirmed"], r["canceled"]) for r in counts} == {("City", 50, 25, 25), ("Resort", 50, 25, 25)} and len(counts) == 4
    rates = fanout.report(spark, f"{tmp_path}/out", "rate_over_time").collect()
    assert {r["booking_count"] for r in rates} == {25, 50} and {r["avg_daily_rate"] for r in rates} == {10.5} and len(rates) == 12


def test_csv_stages_are_packed_and_hold_every_row(spark, small, monkeypatch, tmp_path):
    monkeypatch.setattr(H, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    got = H.booking_csv_features(spark, small)
    for stage, rows in (("raw", spark.read.parquet(f"{small}/lineitem.parquet").count()), ("features", got.count())):
        files = [f.name for f in tmp_path.glob(f"csv-stages/{stage}/part-*")]
        assert files and all(f.endswith(".csv.gz") for f in files)
        assert spark.read.csv(f"{tmp_path}/csv-stages/{stage}", header=True).count() == rows > 0


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def _left(spark, before):
    for _ in range(50):  # they are removed in the background
        left = {f for f in _shuffle_files(spark) - before if f.endswith(".data")}
        if not left:
            break
        time.sleep(0.1)
    return left


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", _shuffle_files(spark)
    with session.shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
        spark.range(1000).repartition(5, "id").write.parquet(f"{tmp_path}/rows")
    assert spark.conf.get(key) == "false"
    assert not _left(spark, before) and spark.read.parquet(f"{tmp_path}/rows").count() == 1000


def test_model_table_leaves_no_shuffle_files(spark, small):
    before = _shuffle_files(spark)
    with session.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        table = booking_models.model_table(spark, small)
    assert not _left(spark, before) and table.count() > 0
