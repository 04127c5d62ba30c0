"""Queries on tables where one key, text or hour holds a third of the rows, in many files."""

import duckdb
import pyarrow.parquet as pq
import pytest
from test_plans import QUICK, TABLES, value

import __spark_entry__ as entry_points
from staylens.plans.catalog import queries

# Replacements for every third row.
HOT = {
    "lineitem": "l_orderkey: 7, l_partkey: 16, l_extendedprice: 42.5",
    "orders": "o_custkey: 7",
    "events": "user_id: 1, event_type: 'error', ts: timestamp '2024-01-05 10:00:00' + to_milliseconds(n)",
    "documents": "text: 'the same text', n_chars: 13",
    "customer": "c_nationkey: 3, c_mktsegment: 'BUILDING'",
}
SENSITIVE = [
    n
    for n in QUICK
    if n in entry_points.oracle_sql()
    and n.startswith(
        ("top_", "segment", "mean_gap", "rule_report", "duplicate", "line_copies", "summary_quartiles", "box", "iqr_bounds",
         "numeric", "derived", "anti_join", "stream_", "monthly", "booking_cleaned", "booking_top", "booking_segment",
         "booking_stream_countries", "booking_fan_out_rates", "booking_split")
    )
]


@pytest.fixture(scope="module")
def skewed(spark, small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        changes = ", ".join(
            f"CASE WHEN n % 3 = 0 THEN {v} ELSE {c} END AS {c}"
            for c, v in (part.split(": ", 1) for part in HOT.get(name, "").split(", ") if part)
        )
        star = f"* EXCLUDE (n) REPLACE ({changes})" if changes else "* EXCLUDE (n)"
        table = con.sql(
            f"SELECT {star} FROM (SELECT *, row_number() OVER () - 1 AS n FROM read_parquet('{small}/{name}.parquet'))"
        ).to_arrow_table()
        target = folder / f"{name}.parquet"
        target.mkdir()
        size = max(1, -(-table.num_rows // 6))
        for i in range(0, table.num_rows, size):
            pq.write_table(table.slice(i, size), target / f"part-{i:06d}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{target}/*.parquet')")
    return str(folder), con


@pytest.mark.parametrize("name", SENSITIVE)
def test_same_result_with_hot_keys(spark, skewed, name):
    folder, con = skewed
    df = queries()[name](spark, folder)
    result = con.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    got = sorted(tuple(value(r[c]) for c in sorted(names)) for r in df.collect())
    assert got == sorted(tuple(value(r[i]) for i in order) for r in result.fetchall())
    assert got
