"""Shape of the physical plans, and of the registered queries as a whole."""

import os
import re

import duckdb
import pytest
from fixtures import rows

import __spark_entry__ as entry_points
from staylens.plans import booking_questions, table_questions as T
from staylens.plans.catalog import queries
from staylens.session import scratch_dir, shuffle_partitions

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
# Fits take long; tests/test_models.py covers them.
SLOW = re.compile(r"^(classify|tune|tuned|model_comparison|confusion|roc$|importance|cluster|centroid|pca|booking_model|booking_cluster)")
QUICK = [n for n in queries() if not SLOW.match(n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def checker(small):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
    return con


def value(x):
    return repr(x + 0.0) if isinstance(x, float) else repr(x)


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_its_checking_sql_and_has_a_sound_plan(spark, small, checker, name):
    df = queries()[name](spark, small)
    text = plan(df)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
        return
    result = checker.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted(tuple(value(r[c]) for c in sorted(names)) for r in df.collect())
    order = sorted(range(len(names)), key=names.__getitem__)
    assert got == sorted(tuple(value(r[i]) for i in order) for r in result.fetchall())


def test_every_checking_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_scan_reads_only_needed_columns(spark, small):
    text = plan(T.yearly_rate_change(spark, small))
    assert "ReadSchema: struct<o_orderstatus:string,o_orderdate:timestamp_ntz>" in text
    text = plan(T.line_copies(spark, small))
    assert "EqualTo(l_discount,0.0)" in text


def test_questions_without_customer_columns_join_nothing(spark, small):
    text = plan(booking_questions.QUERIES["booking_yearly_cancel_rate"](spark, small))
    assert "Join" not in text


def test_orders_are_counted_before_the_join(spark, small):
    text = plan(T.segment_rate_rank(spark, small))
    assert text.index("Join") < text.index("partial_count")


def test_hash_split_needs_no_shuffle_of_rows(spark, small):
    from staylens.operators import split

    train, test = split.stratified_split(spark.read.parquet(f"{small}/orders.parquet"), "o_orderstatus", ["o_orderkey"])
    assert "Exchange" not in plan(train) and "Exchange" not in plan(test)


def test_scratch_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(root)


def test_partitions_grow_with_the_data():
    assert shuffle_partitions(0, 8) == 16
    assert shuffle_partitions(100 << 40, 8000) == 819_200


def test_import_needs_no_session(tmp_path):
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_hot_order_key_in_a_join(spark, tmp_path):
    """One order holds a third of all lines: results stay equal to brute force."""
    lines = [(1, i) for i in range(3000)] + [(2 + i % 500, i) for i in range(6000)]
    df = spark.createDataFrame(lines, "l_orderkey long, d int").selectExpr(
        "l_orderkey", "timestamp_ntz'1995-01-01' + make_interval(0,0,0,d) AS l_shipdate"
    )
    orders = spark.createDataFrame(
        [(k, f"{k % 3}") for k in range(1, 502)], "o_orderkey long, o_orderpriority string"
    ).selectExpr("*", "timestamp_ntz'1994-12-31' AS o_orderdate")
    df.write.parquet(str(tmp_path / "lineitem.parquet"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    expected = {}
    for key, d in lines:
        expected.setdefault(f"{key % 3}", []).append(d + 1)
    got = rows(T.mean_gap_rank(spark, str(tmp_path)), "o_orderpriority", "avg_gap_days")
    assert got == [(k, pytest.approx(sum(v) / len(v), abs=1e-6)) for k, v in sorted(expected.items())]
