"""Questions whose groups, categories or sketches grow with the data, and hand-overs between runs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from staylens.functions import exact_sum, units
from staylens.ml import index_table
from staylens.operators import scan, sketches, split
from staylens.session import scratch_dir
from staylens.sources import read_csv_folder, read_table, replace_partitions, write_bucketed, write_csv

PROBABILITIES = (0.05, 0.25, 0.5, 0.75, 0.95)
RANK_ERROR, COUNT_ERROR = 0.01, 0.04


def customer_spend_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Rank of every customer by what they spent, of all customers and within their status of order."""
    orders = read_table(spark, folder, "orders")
    spent = orders.groupBy("o_custkey").agg(exact_sum(units(F.col("o_totalprice"))).alias("spent"), F.count(F.lit(1)).alias("orders"))
    ranked = scan.ranks(spent, [], ["-spent"], "rank", "dense_rank")
    return scan.ranks(ranked, ["orders"], ["-spent"], "rank_of_equal_orders").withColumn("spent", F.col("spent").cast("double"))


def supplier_month_change(spark: SparkSession, folder: str) -> DataFrame:
    """Lines a month and supplier, and the change to the supplier's month before."""
    lines = read_table(spark, folder, "lineitem")
    months = lines.groupBy("l_suppkey", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    found = scan.previous_value(months, ["l_suppkey"], ["year", "month"], "lines", "lines_before")
    return found.withColumn("change", F.col("lines") - F.col("lines_before"))


def cumulative_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and their value in cents up to and with each day and status, and the value's place among its kind."""
    orders = read_table(spark, folder, "orders")
    days = orders.groupBy(F.to_date("o_orderdate").alias("day"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(units(F.col("o_totalprice"))).alias("cents")
    )
    totals = {"orders_so_far": F.col("orders"), "cents_so_far": F.col("cents"), "nth_day": F.lit(1)}
    return scan.running_totals(days, ["o_orderstatus"], ["day"], totals)


def _price_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Stored sketches of every month's order values and customers."""
    orders = read_table(spark, folder, "orders")
    month = {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    table = sketches.period_sketches(orders, month, {"prices": F.col("o_totalprice")}, {"customers": F.col("o_custkey")})
    path = scratch_dir(spark, "month-sketches")
    replace_partitions(table, path, ("year",))
    return spark.read.schema("month int, prices binary, customers binary, year int").parquet(path)


def sketch_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles of order values per year from merged month sketches: is their rank right to 1 %?"""
    stored = _price_sketches(spark, folder)
    years = sketches.merged(stored, {"year": F.col("year")}, ranked=["prices"])
    wanted = years.select("year", sketches.values_seen("prices").alias("seen"), sketches.quantiles("prices", PROBABILITIES).alias("found"))
    orders = read_table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"))
    counts = []
    for i in range(len(PROBABILITIES)):
        counts += [F.count_if(F.col("price") < F.col("found")[i]).alias(f"below_{i}"), F.count_if(F.col("price") <= F.col("found")[i]).alias(f"upto_{i}")]
    exact = orders.join(wanted, "year").groupBy("year", "seen").agg(F.count(F.lit(1)).alias("n"), *counts)
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(p).alias("probability"),
            (
                (F.col(f"below_{i}") <= (p + RANK_ERROR) * F.col("n")) & (F.col(f"upto_{i}") >= (p - RANK_ERROR) * F.col("n"))
            ).alias("rank_within_1_pct"),
        )
        for i, p in enumerate(PROBABILITIES)
    ]))
    return exact.select("year", F.col("seen").alias("n"), rows.alias("r")).select("year", "n", "r.*")


def sketch_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per year from merged month sketches, beside the exact number: is the estimate right to 4 %?"""
    stored = _price_sketches(spark, folder)
    years = sketches.merged(stored, {"year": F.col("year")}, distinct=["customers"])
    estimates = years.select("year", sketches.distinct_estimate("customers").alias("estimate"))
    orders = read_table(spark, folder, "orders")
    exact = orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.countDistinct("o_custkey").alias("customers"))
    near = F.abs(F.col("estimate") - F.col("customers")) <= F.greatest(F.lit(1.0), COUNT_ERROR * F.col("customers"))
    return exact.join(estimates, "year").select("year", "customers", near.alias("estimate_within_4_pct"))


def part_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Index table of two columns with many categories."""
    lines = read_table(spark, folder, "lineitem").select("l_partkey", F.col("l_suppkey").cast("string").alias("l_suppkey"))
    return index_table.category_positions(lines, ["l_partkey", "l_suppkey"])


def indexed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines per position of their part, positions coming from the lines before 1995 only: later parts may be unseen."""
    lines = read_table(spark, folder, "lineitem").select("l_partkey", "l_shipdate")
    table = index_table.category_positions(lines.filter(F.col("l_shipdate") < "1995-01-01"), ["l_partkey"])
    indexed = index_table.with_positions(lines.filter(F.col("l_shipdate") >= "1995-01-01"), table, ["l_partkey"])
    return indexed.groupBy(F.col("l_partkey_idx").alias("position")).agg(F.count(F.lit(1)).alias("lines"))


def exact_split(spark: SparkSession, folder: str) -> DataFrame:
    """Every order's side: 80 % of every status to the row, 90 % of the pending ones."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return split.exact_split(orders, "o_orderstatus", ["o_orderkey"], fractions={"P": 0.9})


def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Orders sent as CSV in two layouts with some bad rows: what arrived and what was kept aside, per status.

    Every 50th price is no number; every 70th row has a field too many.
    """
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"), F.coalesce("o_orderstatus", F.lit("?")).alias("status"), F.to_date("o_orderdate").alias("day"),
        F.when(F.col("o_orderkey") % 50 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
    )
    path = scratch_dir(spark, "csv-orders")
    write_csv(orders.filter("key % 2 = 0"), f"{path}/even")
    odd = orders.filter("key % 2 = 1")
    write_csv(odd.filter("key % 70 <> 1").select("price", "day", "status", "key"), f"{path}/odd")
    # A field too many: the header has four.
    long_rows = odd.filter("key % 70 = 1").select(F.concat_ws(",", "price", "day", "status", "key", F.lit("more")).alias("value"))
    head = spark.range(1).select(F.lit("price,day,status,key").alias("value"), F.lit(0).alias("place"))
    lines = head.unionByName(long_rows.withColumn("place", F.lit(1))).repartitionByRange(1, "place").sortWithinPartitions("place")
    lines.select("value").write.text(f"{path}/long")
    schema = StructType([
        StructField("key", LongType()), StructField("price", DoubleType()), StructField("status", StringType()), StructField("day", DateType()),
    ])
    rows = read_csv_folder(spark, f"{path}/*", schema)
    kept = rows.good.groupBy("status").agg(
        F.count(F.lit(1)).alias("rows"), exact_sum(units(F.col("price"))).cast("double").alias("value"), F.max("day").alias("last_day")
    )
    nothing = F.lit(None)
    aside = rows.bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    return kept.select(F.lit("kept").alias("part"), F.col("status").alias("name"), "rows", "value", "last_day").unionByName(
        aside.select(F.lit("aside").alias("part"), F.col("reason").alias("name"), "rows", nothing.cast("double").alias("value"), nothing.cast("date").alias("last_day"))
    )


def rewritten_year(spark: SparkSession, folder: str) -> DataFrame:
    """Orders stored by year; 1995 is then run again without the failed ones, twice, and nothing else changes."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    path = scratch_dir(spark, "orders-by-year")
    replace_partitions(orders, path, ("year",))
    for _ in range(2):
        replace_partitions(orders.filter("year = 1995 AND o_orderstatus <> 'F'"), path, ("year",))
    stored = spark.read.schema("o_orderkey bigint, o_orderstatus string, year int").parquet(path)
    return stored.groupBy("year").agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("failed"))


def bucketed_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders and lines in the same number of buckets of the order key."""
    tag, buckets = uuid.uuid4().hex, max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    return (
        write_bucketed(orders, f"orders_{tag}", scratch_dir(spark, "bucketed-orders"), ("o_orderkey",), buckets),
        write_bucketed(lines, f"lines_{tag}", scratch_dir(spark, "bucketed-lines"), ("l_orderkey",), buckets),
    )


def bucketed_join(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and quantity per priority, joined bucket by bucket."""
    orders, lines = bucketed_orders(spark, folder)
    joined = orders.hint("merge").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))


QUERIES = {
    f.__name__: f
    for f in (
        customer_spend_rank, supplier_month_change, cumulative_orders, sketch_quantiles, sketch_distinct, part_positions,
        indexed_lines, exact_split, csv_quarantine, rewritten_year, bucketed_join,
    )
}


def oracle_sql() -> dict[str, str]:
    digest = "CAST('0x' || substr(md5('1|' || CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT)"
    parts = "SELECT 'l_partkey' AS c, CAST(l_partkey AS VARCHAR) AS v FROM lineitem"
    place = "row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, v) - 1 AS position"
    day = "CAST(o_orderdate AS DATE)"
    return {
        "customer_spend_rank": """
            WITH s AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent, count(*) AS orders FROM orders GROUP BY ALL)
            SELECT o_custkey, CAST(spent AS DOUBLE) AS spent, orders, rank() OVER (ORDER BY spent DESC) AS rank,
                   dense_rank() OVER (ORDER BY spent DESC) AS dense_rank,
                   rank() OVER (PARTITION BY orders ORDER BY spent DESC) AS rank_of_equal_orders FROM s""",
        "supplier_month_change": """
            WITH m AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month, count(*) AS lines FROM lineitem GROUP BY ALL),
                 b AS (SELECT *, lag(lines) OVER (PARTITION BY l_suppkey ORDER BY year, month) AS lines_before FROM m)
            SELECT *, lines - lines_before AS change FROM b""",
        "cumulative_orders": f"""
            WITH d AS (SELECT {day} AS day, o_orderstatus, count(*) AS orders,
                              CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY ALL)
            SELECT *, CAST(sum(orders) OVER w AS BIGINT) AS orders_so_far, CAST(sum(cents) OVER w AS BIGINT) AS cents_so_far,
                   row_number() OVER w AS nth_day FROM d WINDOW w AS (PARTITION BY o_orderstatus ORDER BY day)""",
        "sketch_quantiles": f"""
            SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n, p AS probability, true AS rank_within_1_pct
            FROM orders, (VALUES {', '.join(f'(CAST({p} AS DOUBLE))' for p in PROBABILITIES)}) v(p) GROUP BY ALL""",
        "sketch_distinct": """
            SELECT CAST(year(o_orderdate) AS INT) AS year, count(DISTINCT o_custkey) AS customers, true AS estimate_within_4_pct
            FROM orders GROUP BY ALL""",
        "part_positions": f"""
            SELECT c AS "column", v AS category, count(*) AS n, {place}
            FROM ({parts} UNION ALL SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR) FROM lineitem) s GROUP BY c, v""",
        "indexed_lines": f"""
            WITH i AS (SELECT v, {place} FROM ({parts} WHERE l_shipdate < '1995-01-01') s GROUP BY c, v)
            SELECT coalesce(position, (SELECT count(*) FROM i)) AS position, count(*) AS lines
            FROM lineitem LEFT JOIN i ON v = CAST(l_partkey AS VARCHAR) WHERE l_shipdate >= '1995-01-01' GROUP BY 1""",
        "exact_split": f"""
            WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {digest}) AS nth,
                              count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
            SELECT o_orderkey, o_orderstatus,
                   CASE WHEN nth <= floor(n * CASE WHEN o_orderstatus = 'P' THEN 0.9e0 ELSE 0.8e0 END + 0.5) THEN 'Train' ELSE 'Test' END AS dataset FROM r""",
        "csv_quarantine": f"""
            WITH o AS (SELECT o_orderkey AS key, coalesce(o_orderstatus, '?') AS status, {day} AS day, o_totalprice AS price,
                              CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 70 = 1 THEN 'malformed'
                                   WHEN o_orderkey % 50 = 0 THEN 'mistyped price' END AS reason FROM orders)
            SELECT 'kept' AS part, status AS name, count(*) AS rows, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS value, max(day) AS last_day
            FROM o WHERE reason IS NULL GROUP BY status
            UNION ALL SELECT 'aside', reason, count(*), NULL, NULL FROM o WHERE reason IS NOT NULL GROUP BY reason""",
        "rewritten_year": """
            SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS failed
            FROM orders WHERE year(o_orderdate) <> 1995 OR o_orderstatus <> 'F' GROUP BY 1""",
        "bucketed_join": """
            SELECT o_orderpriority, count(*) AS lines, sum(l_quantity) AS quantity
            FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""",
    }
