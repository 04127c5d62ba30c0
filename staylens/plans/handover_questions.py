"""Whole hand-overs: CSV in and out, saved pipelines, sorted stream reports, slices of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylens.ml import facts, prep
from staylens.operators import cleaning, features, split
from staylens.plans import model_questions, questions as Q
from staylens.plans.booking_questions import _raw, cleaned
from staylens.plans.stream_questions import _plain_times, event_stream
from staylens.schemas import RAW
from staylens.session import scratch_dir, shuffles_dropped
from staylens.sources import read_bookings, read_csv_folder, read_features, write_csv, write_parquet
from staylens.streaming import monitors as M
from staylens.streaming.run import start

#: Rows that a display shows.
SHOWN = 20


def booking_csv_features(spark: SparkSession, folder: str) -> DataFrame:
    """Raw reservations written as CSV, read, cleaned, turned into features, written as CSV and read back.

    Both folders stay, so they are packed; the files of the join's shuffle go once the raw rows are written.
    """
    path = scratch_dir(spark, "csv-stages")
    with shuffles_dropped(spark):
        write_csv(_raw(spark, folder).select(*RAW.names), f"{path}/raw", "gzip")
    table = features.extract(cleaning.clean(read_bookings(spark, f"{path}/raw")))
    write_csv(table, f"{path}/features", "gzip")
    back = read_csv_folder(spark, f"{path}/features/*.csv.gz", table.schema).good
    return back.withColumn("cancellation_rate", F.round("cancellation_rate", 6))


def booking_segments_excluded(spark: SparkSession, folder: str) -> DataFrame:
    """The segment report without two segments, whose rows still count in the ranks."""
    return Q.segment_rank(cleaned(spark, folder, ("market_segment",)), exclude=("Undefined", "Corporate"))


def booking_hotel_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Top countries cut into one slice a hotel, and the rooms that occur there, in order."""
    top = Q.top_countries_per_hotel(cleaned(spark, folder, ("country",)))
    slices = top.groupBy("hotel").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", "country"))), lambda x: x["country"]), ",").alias("top_countries")
    )
    rooms = cleaned(spark, folder, ()).select("hotel", "reserved_room_type").distinct()
    listed = rooms.groupBy("hotel").agg(F.array_join(F.sort_array(F.collect_list("reserved_room_type")), ",").alias("rooms"))
    return slices.join(listed, "hotel")


def saved_pipeline_facts(spark: SparkSession, folder: str) -> DataFrame:
    """A fitted pipeline and its vectors saved and loaded again: stages, rows, and vectors that differ."""
    path = scratch_dir(spark, "saved-pipeline")
    write_parquet(model_questions.document_features(spark, folder), f"{path}/rows")
    rows = read_features(spark, f"{path}/rows")
    train, _ = split.stratified_split(rows, model_questions.COLUMNS.target, ["doc_id"])
    model = prep.fit(train, model_questions.COLUMNS)
    prep.save(model, f"{path}/pipeline")
    again = prep.load(f"{path}/pipeline")
    first = model.transform(rows).select(*rows.columns, F.col("features").alias("_first"))
    differ = F.count_if(F.col("_first").cast("string") != F.col("features").cast("string"))
    both = facts._long(again.transform(first), "pipeline", {"rows": F.count(F.lit(1)), "vectors_differ": differ})
    vectors = prep.transform(model, rows, model_questions.COLUMNS)
    write_parquet(vectors, f"{path}/vectors")
    stored = read_features(spark, f"{path}/vectors")
    names = [prep.feature_mapping(v, model_questions.COLUMNS).orderBy("feature_index").collect() for v in (vectors, stored)]
    shape = {
        "stages": len(again.stages),
        "stage_kinds_differ": sum(type(a) is not type(b) for a, b in zip(model.stages, again.stages)),
        "feature_names_differ": sum(a != b for a, b in zip(*names)) + abs(len(names[0]) - len(names[1])),
    }
    stored_rows = facts._long(stored, "vectors", {"rows": F.count("features"), "positives": F.sum("label")})
    return facts.union([facts.stated(spark, "pipeline", shape), both, stored_rows])


def first_rows(batch: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows and their ``place``, whatever order the partitions of a batch arrive in."""
    first = batch.orderBy(*order).limit(n)
    return first.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def stream_sorted_display(spark: SparkSession, folder: str) -> DataFrame:
    """What a console in complete mode shows: the windows with most events, sorted, the first rows only."""
    counts = M.windowed_counts(event_stream(spark, folder), ["event_type"], F.col("is_canceled"), duration="1 hour")
    path = scratch_dir(spark, "display")
    order = [F.desc("total_bookings"), F.asc("window_start"), F.asc("event_type")]

    def show(batch: DataFrame, number: int) -> None:
        first_rows(batch, order, SHOWN).write.mode("overwrite").parquet(f"{path}/shown")

    start(counts, "sorted_display", f"{path}/checkpoint", mode="complete", every=None, order_by=order, handler=show).awaitTermination()
    return _plain_times(spark.read.parquet(f"{path}/shown"))


QUERIES = {
    f.__name__: f
    for f in (booking_csv_features, booking_segments_excluded, booking_hotel_slices, saved_pipeline_facts, stream_sorted_display)
}


def oracle_sql(known: dict[str, str], clean: str) -> dict[str, str]:
    """``known`` has the SQL of the other queries; ``clean`` the cleaned reservations as common tables."""
    labelled = "documents JOIN labels USING (doc_id)"
    return {
        "booking_csv_features": known["booking_features"],
        "booking_segments_excluded": f"SELECT * FROM ({known['booking_segment_rank']}) s WHERE market_segment NOT IN ('Undefined', 'Corporate')",
        "booking_hotel_slices": f"""
            WITH {clean}, c AS (SELECT hotel, country, count(*) AS n FROM cleaned WHERE country IS NOT NULL GROUP BY ALL),
                 t AS (SELECT *, row_number() OVER (PARTITION BY hotel ORDER BY n DESC, country) AS rn FROM c)
            SELECT hotel, string_agg(country, ',' ORDER BY rn) FILTER (WHERE rn <= 5) AS top_countries,
                   (SELECT string_agg(DISTINCT reserved_room_type, ',' ORDER BY reserved_room_type) FROM cleaned AS r WHERE r.hotel = t.hotel) AS rooms
            FROM t GROUP BY hotel""",
        "saved_pipeline_facts": f"""
            SELECT 'pipeline' AS subject, fact, CAST(value AS BIGINT) AS value
            FROM (VALUES ('stages', 5), ('stage_kinds_differ', 0), ('feature_names_differ', 0), ('vectors_differ', 0)) v(fact, value)
            UNION ALL SELECT 'pipeline', 'rows', count(*) FROM {labelled}
            UNION ALL SELECT 'vectors', 'rows', count(*) FROM {labelled}
            UNION ALL SELECT 'vectors', 'positives', CAST(sum(quality) AS BIGINT) FROM {labelled}""",
        "stream_sorted_display": f"""
            WITH c AS ({known['stream_counts']})
            SELECT *, row_number() OVER (ORDER BY total_bookings DESC, window_start, event_type) AS place FROM c
            ORDER BY place LIMIT {SHOWN}""",
    }
