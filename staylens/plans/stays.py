"""Reservation-shaped rows derived from the order tables.

There is no reservation file among the test tables, so every order line is read as one
reservation: hotel from the supplier, arrival from the ship date, country and market
segment from the customer. Some values are turned into tokens, nulls, contradictions
and extremes, so that profiling and cleaning have something to find. The same
expressions are given to the checking engine, which needs its own name for three dates.
"""

from __future__ import annotations

import calendar

from pyspark.sql import DataFrame, SparkSession

from staylens.schemas import RAW
from staylens.sources import read_table

_FROM_CUSTOMER = {"country", "market_segment"}
_FROM_ORDER = _FROM_CUSTOMER | {"distribution_channel", "customer_type", "lead_time"}
# Columns that come from a joined table, in schema order.
PARENT_COLUMNS = ("lead_time", "country", "market_segment", "distribution_channel", "customer_type")

EXPRESSIONS = {
    "hotel": "CASE WHEN l_suppkey % 3 = 0 THEN 'Resort Hotel' ELSE 'City Hotel' END",
    "is_canceled": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "lead_time": "greatest({days}, 0)",
    "arrival_date_year": "year(l_shipdate)",
    "arrival_date_month": "{month}",
    "arrival_date_week_number": "weekofyear(l_shipdate)",
    "arrival_date_day_of_month": "day(l_shipdate)",
    "stays_in_weekend_nights": "l_linenumber % 3",
    "stays_in_week_nights": "CAST(l_quantity AS INT) % 6",
    "adults": "CASE WHEN l_partkey % 50 = 0 THEN 0 WHEN l_partkey % 199 = 1 THEN 6 ELSE 1 + l_partkey % 3 END",
    "children": "CASE WHEN l_suppkey % 23 = 0 THEN 'NA' WHEN l_suppkey % 29 = 0 THEN NULL"
    " WHEN l_suppkey % 31 = 0 THEN '4' ELSE CAST(l_suppkey % 3 AS VARCHAR(9)) END",
    "babies": "CASE WHEN l_orderkey % 997 = 0 THEN 9 WHEN l_orderkey % 11 = 0 THEN 1 ELSE 0 END",
    "meal": "CASE l_linenumber % 4 WHEN 0 THEN 'BB' WHEN 1 THEN 'HB' WHEN 2 THEN 'SC' ELSE 'FB' END",
    "country": "CASE n_name WHEN 'NATION_24' THEN 'NULL' WHEN 'NATION_23' THEN NULL ELSE n_name END",
    "market_segment": "c_mktsegment",
    "distribution_channel": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Undefined' ELSE o_orderpriority END",
    "is_repeated_guest": "CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END",
    "previous_cancellations": "CAST(round(l_discount * 100) AS INT) % 3",
    "previous_bookings_not_canceled": "CAST(round(l_tax * 100) AS INT) % 4",
    "reserved_room_type": "chr(CAST(65 + l_partkey % 8 AS INT))",
    "assigned_room_type": "chr(CAST(65 + l_suppkey % 8 AS INT))",
    "booking_changes": "l_linenumber % 4",
    "deposit_type": "CASE WHEN l_linestatus = 'F' AND l_suppkey % 5 = 0 THEN 'Non Refund'"
    " WHEN l_suppkey % 17 = 0 THEN 'Refundable' ELSE 'No Deposit' END",
    "agent": "CASE WHEN l_suppkey % 13 = 0 THEN 'NULL' ELSE CAST(l_suppkey % 60 AS VARCHAR(9)) END",
    "company": "CASE WHEN l_partkey % 10 < 9 THEN 'NULL' ELSE CAST(l_partkey % 40 AS VARCHAR(9)) END",
    "days_in_waiting_list": "CASE WHEN l_orderkey % 5 = 0 THEN 20 ELSE 0 END",
    "customer_type": "CASE o_orderstatus WHEN 'F' THEN 'Transient' WHEN 'O' THEN 'Contract' ELSE 'Group' END",
    "adr": "CASE WHEN l_partkey % 300 = 7 THEN 0e0 WHEN l_partkey % 400 = 9 THEN -6.38e0"
    " WHEN l_partkey % 500 = 11 THEN 5400e0"
    " ELSE CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 30000 AS DOUBLE) / 100e0 END",
    "required_car_parking_spaces": "l_suppkey % 2",
    "total_of_special_requests": "l_linenumber % 6",
    "reservation_status": "CASE WHEN (l_returnflag = 'R') = (l_orderkey % 401 = 0) THEN 'Check-Out'"
    " WHEN l_linestatus = 'F' THEN 'Canceled' ELSE 'No-Show' END",
    "reservation_status_date": "CAST(l_shipdate AS DATE)",
}
# A table of names: formatting every date as text is far slower.
_NAMES = ", ".join(f"'{name}'" for name in calendar.month_name[1:])
_SPARK = {"days": "datediff(l_shipdate, o_orderdate)", "month": f"element_at(array({_NAMES}), month(l_shipdate))"}
_CHECK = {"days": "date_diff('day', o_orderdate, l_shipdate)", "month": "monthname(l_shipdate)"}
_SQL_TYPES = {"int": "INT", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE"}


def _projection(columns: list[str], dialect: dict[str, str]) -> list[str]:
    types = {f.name: _SQL_TYPES[f.dataType.simpleString()] for f in RAW.fields}
    out = []
    for name in columns:
        text = EXPRESSIONS[name].format(**dialect)
        if types[name] in ("INT", "DATE"):
            text = f"CAST({text} AS {types[name]})"
        out.append(f"{text} AS {name}")
    return out


def bookings(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    """Raw reservations; ``columns`` restricts them to what the caller reads.

    A parent table is joined only if one of the columns needs it. Parents are joined to
    each other first, so the order lines, by far the largest input, are shuffled once.
    """
    names = columns or list(EXPRESSIONS)
    rows = read_table(spark, folder, "lineitem")
    if _FROM_ORDER & set(names):
        parents = read_table(spark, folder, "orders").withColumnsRenamed({"o_orderkey": "l_orderkey", "o_custkey": "c_custkey"})
        if _FROM_CUSTOMER & set(names):
            customers = read_table(spark, folder, "customer")
            if "country" in names:
                nations = read_table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
                customers = customers.join(nations, "c_nationkey", "left")
            parents = parents.join(customers, "c_custkey", "left")
        rows = rows.join(parents, "l_orderkey", "left")
    return rows.selectExpr(*_projection(names, _SPARK))


def bookings_sql() -> str:
    """The same rows for the checking engine."""
    return (
        "SELECT " + ", ".join(_projection(list(EXPRESSIONS), _CHECK)) + " FROM lineitem"
        " LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey"
        " LEFT JOIN nation ON c_nationkey = n_nationkey"
    )
