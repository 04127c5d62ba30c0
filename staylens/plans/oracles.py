"""Checking SQL: the same results written independently for another engine.

Only the shaping of reservation rows shares its expressions with the Spark side.
"""

from __future__ import annotations

from staylens.plans import handover_questions, model_facts, scale_questions
from staylens.plans.questions import MONTHS
from staylens.plans.stays import EXPRESSIONS, bookings_sql


def _rate(flag: str) -> str:
    return f"round(avg(CAST(({flag}) AS DOUBLE)) * 100, 2)"


def _half_up(value: str, digits: int = 2) -> str:
    """For means of amounts, whose ties would otherwise hang on the order of the sum."""
    scale = 10**digits
    return f"floor(({value}) * ({scale}e0 * (1e0 + 1e-12)) + 0.5e0 + 1e-9) / {scale}e0"


_REVENUE = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
_FAILED = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"
_RETURNED = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"
_YM = "year(l_shipdate) AS year, month(l_shipdate) AS month"


def _matrix(row: str, column: str, value: str, source: str, values, prefix: str = "", kind: str = "DOUBLE") -> str:
    cells = ", ".join(
        f"coalesce(CAST(max(CASE WHEN {column} = '{v}' THEN {value} END) AS {kind}), 0) AS \"{prefix}{v}\""
        for v in values
    )
    return f"SELECT {row}, {cells} FROM ({source}) s GROUP BY {row}"


def _months_cte(period: str, amount: str, lost: str, source: str) -> str:
    return f"""
    sums AS (SELECT {period}, round(sum({amount}), 2) AS p,
                    round(sum(CASE WHEN {lost} THEN 0 ELSE {amount} END), 2) AS a
             FROM {source} GROUP BY ALL),
    months AS (SELECT * EXCLUDE (p, a), CAST(p AS DOUBLE) AS revenue_potential,
                      CAST(a AS DOUBLE) AS revenue_actual, CAST(p - a AS DOUBLE) AS revenue_lost,
                      round(CAST(p - a AS DOUBLE) / nullif(CAST(p AS DOUBLE), 0) * 100, 2) AS lost_pct
               FROM sums)"""


_TABLE_MONTHS = _months_cte(_YM, _REVENUE, "l_returnflag = 'R'", "lineitem")


def _growth(order: str) -> str:
    before = f"lag(revenue_actual) OVER (ORDER BY {order})"
    return f"round((revenue_actual - {before}) / nullif({before}, 0) * 100, 2) AS growth_actual_pct"


def _profile(table: str, columns: dict[str, str], all_columns: list[str]) -> str:
    """``columns`` maps a column to its missing test; others only have nulls."""
    parts = [
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {columns.get(c, f'{c} IS NULL')}) AS missing, count(*) AS n FROM {table}"
        for c in all_columns
    ]
    return (
        "SELECT \"column\", missing, n - missing AS valid, round(missing * 100e0 / n, 6) AS missing_pct FROM ("
        + " UNION ALL ".join(parts)
        + ") s"
    )


def _rules(tests: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {test}) AS violations, count(*) AS rows_checked FROM {source}"
        for name, test in tests.items()
    )


def _summary(numeric: list[str], text: list[str], source: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {_half_up(f"avg({c})", 6)} AS mean, round(stddev_samp({c}), 6) AS stddev,"
        f" CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,"
        + "".join(f" CAST(quantile_disc({c}, {q / 100}) AS DOUBLE) AS p{q}," for q in (25, 50, 75))
        + f" CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM {source}"
        for c in numeric
    ] + [
        f"SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, min({c}), max({c}) FROM {source}" for c in text
    ]
    return " UNION ALL ".join(parts)


def _bounds(columns: list[str], source: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,"
        f" quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {source}"
        for c in columns
    ]
    return f"""
    WITH q AS ({' UNION ALL '.join(parts)}), f AS (SELECT *, round(q3 - q1, 4) AS iqr FROM q)
    SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
           round(q1 - 1.5e0 * iqr, 6) AS lower_bound, round(q3 + 1.5e0 * iqr, 6) AS upper_bound FROM f"""


def _histogram(column: str, source: str, high: int, bins: int) -> str:
    width = high / bins
    return f"""
    WITH c AS (SELECT least(floor(least(greatest({column}, 0e0), {high}e0) / {width}e0), {bins - 1}) AS b FROM {source}
               WHERE {column} IS NOT NULL)
    SELECT i AS bin, i * {width}e0 AS bin_start, (i + 1) * {width}e0 AS bin_end,
           (SELECT count(*) FROM c WHERE b = i) AS count
    FROM range({bins}) t(i)"""


def _split_bucket(key: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', '1', CAST({key} AS VARCHAR))), 1, 8) AS BIGINT) % 10000"


def _balance(key: str, target: str, source: str) -> str:
    return f"""
    WITH t AS (SELECT {target}, CASE WHEN {_split_bucket(key)} < 8000 THEN 'Train' ELSE 'Test' END AS dataset FROM {source}),
         c AS (SELECT dataset, {target}, count(*) AS count FROM t GROUP BY ALL)
    SELECT dataset, {target}, count, round(count * 100e0 / sum(count) OVER (PARTITION BY dataset), 2) AS percentage FROM c"""


_SHAPED = """
    shaped AS (SELECT ts, event_type, user_id % 4 AS user_group, value,
                      CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_canceled FROM events)"""


def _slices(source: str, hours: int, condition: str = "true") -> str:
    """Rows repeated once per sliding one-hour-step window they fall into."""
    return f"""
    sliced AS (SELECT *, unnest([date_trunc('hour', ts) - to_hours(i) FOR i IN range(0, {hours})]) AS period_start
               FROM {source} WHERE {condition})"""


# -- reservation rows -------------------------------------------------------------------

_GUESTS = "adults + children + babies"
_NIGHTS = "stays_in_weekend_nights + stays_in_week_nights"
_ALONE = "(adults = 0 AND (children > 0 OR babies > 0))"
_FAKE = "is_repeated_guest = 1 AND previous_cancellations = 0 AND previous_bookings_not_canceled = 0"
_KEEP = f"({_GUESTS}) > 0 AND NOT (({_NIGHTS}) = 0 AND adr = 0) AND adr >= 0 AND NOT {_ALONE}"
_CAPS = "adr < 5000 AND adults <= 4 AND children <= 3 AND babies <= 3"

_FIXED = f"""
    raw AS ({bookings_sql()}),
    fixed AS (SELECT * REPLACE (CASE WHEN children IS NULL OR children IN ('NA', 'NULL') THEN 0
                                     ELSE CAST(children AS INT) END AS children) FROM raw)"""
_CLEAN = f"""{_FIXED},
    cleaned AS (SELECT * EXCLUDE (company) REPLACE (
                    CASE WHEN {_FAKE} THEN 0 ELSE is_repeated_guest END AS is_repeated_guest,
                    CASE WHEN country IS NULL OR country IN ('NULL', 'NA') THEN 'Unknown' ELSE country END AS country,
                    CASE WHEN agent IS NULL OR agent IN ('NULL', 'NA') THEN '9999' ELSE agent END AS agent)
                FROM fixed WHERE {_KEEP} AND {_CAPS})"""
_AMOUNT = f"CAST(CAST(adr AS DECIMAL(12,2)) * ({_NIGHTS}) AS DECIMAL(18,2))"
_MONTH_NUM = "strftime(strptime(arrival_date_month, '%B'), '%m')"
_BOOKING_MONTHS = _months_cte(
    f"arrival_date_year, {_MONTH_NUM} AS month_num, arrival_date_month AS month_name",
    _AMOUNT, "is_canceled <> 0", "cleaned",
)
_CANCEL = _rate("is_canceled")
_LEAK = (
    "arrival_date_year, arrival_date_week_number, arrival_date_day_of_month, arrival_date_month, assigned_room_type,"
    " booking_changes, reservation_status, reservation_status_date, stays_in_weekend_nights, stays_in_week_nights,"
    " adults, children, babies, previous_cancellations, previous_bookings_not_canceled, adr"
)
_FEATURES = f"""
    model AS (SELECT * EXCLUDE ({_LEAK}), {_GUESTS} AS total_guests, {_NIGHTS} AS total_nights,
                     CASE WHEN {_NIGHTS} = 0 THEN adr ELSE adr * ({_NIGHTS}) END AS total_estimated_cost,
                     CASE WHEN children > 0 OR babies > 0 THEN 1 ELSE 0 END AS is_family,
                     previous_cancellations + previous_bookings_not_canceled AS total_past_bookings,
                     round(CAST(previous_cancellations AS DOUBLE)
                           / (previous_cancellations + previous_bookings_not_canceled + 1), 6) AS cancellation_rate
              FROM cleaned)"""
# Text of all model columns in table order, as the split hashes it.
_MODEL_COLUMNS = [
    "hotel", "is_canceled", "lead_time", "meal", "country", "market_segment", "distribution_channel",
    "is_repeated_guest", "reserved_room_type", "deposit_type", "agent", "days_in_waiting_list", "customer_type",
    "required_car_parking_spaces", "total_of_special_requests", "total_guests", "total_nights",
    "total_estimated_cost", "is_family", "total_past_bookings", "cancellation_rate",
]
_MODEL_TEXT = "concat_ws('|', '1', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in _MODEL_COLUMNS) + ")"
_TAGGED = f"""{_FEATURES.replace("round(CAST", "(CAST").replace(", 6) AS cancellation_rate", ") AS cancellation_rate")},
    tagged AS (SELECT *, CASE WHEN CAST('0x' || substr(md5({_MODEL_TEXT}), 1, 8) AS BIGINT) % 10000 < 8000
                              THEN 'Train' ELSE 'Test' END AS dataset FROM model)"""
_CATEGORICAL = [
    "hotel", "meal", "country", "market_segment", "distribution_channel", "reserved_room_type", "deposit_type",
    "customer_type", "agent",
]
_NUMBERS = [
    "lead_time", "total_guests", "total_nights", "total_estimated_cost", "total_past_bookings", "cancellation_rate",
    "days_in_waiting_list", "required_car_parking_spaces", "total_of_special_requests", "is_repeated_guest", "is_family",
]
_SENT = f"""{_FIXED},
    sent AS (SELECT * REPLACE (coalesce(country, 'Unknown') AS country), CAST(date_trunc('week', reservation_status_date) AS TIMESTAMP) AS ts
             FROM fixed WHERE adr >= 0 AND adults > 0)"""


def _minute_slices(minutes: int, condition: str) -> str:
    return f"""
    sliced AS (SELECT *, unnest([ts - to_minutes(i) FOR i IN range(0, {minutes})]) AS period_start
               FROM sent WHERE {condition})"""


def _top(counts: str, group: str, order: str, n: int, name: str, method: str = "row_number") -> str:
    return f"""
    SELECT * FROM (SELECT *, {method}() OVER (PARTITION BY {group} ORDER BY {order}) AS {name} FROM ({counts}) c) r
    WHERE {name} <= {n}"""


def _values(names: list[str]) -> str:
    return ", ".join(f"({i}, '{name}')" for i, name in enumerate(names))


_LOGIC_TESTS = {
    "no_guests": f"({_GUESTS}) = 0",
    "no_nights_and_free": f"({_NIGHTS}) = 0 AND adr = 0",
    "waiting_beyond_lead_time": "days_in_waiting_list > lead_time",
    "negative_rate": "adr < 0",
    "status_contradicts_flag": "(is_canceled = 1 AND reservation_status = 'Check-Out')"
    " OR (is_canceled = 0 AND reservation_status IN ('Canceled', 'No-Show'))",
    "minors_alone": _ALONE,
    "repeated_without_history": _FAKE,
}
_SUMMARY_NUMBERS = [
    "is_canceled", "lead_time", "arrival_date_year", "arrival_date_week_number", "stays_in_weekend_nights",
    "stays_in_week_nights", "adults", "children", "babies", "is_repeated_guest", "previous_cancellations",
    "previous_bookings_not_canceled", "booking_changes", "days_in_waiting_list", "adr",
    "required_car_parking_spaces", "total_of_special_requests",
]


def _booking_sql() -> dict[str, str]:
    countries = "SELECT hotel, country, count(*) AS total_booking FROM cleaned WHERE country IS NOT NULL GROUP BY ALL"
    top_countries = _top(countries, "hotel", "total_booking DESC, country", 5, "rn")
    revenue = (
        f"SELECT arrival_date_year, {_MONTH_NUM} AS month_num, arrival_date_month AS month_name,"
        f" CAST(round(sum({_AMOUNT}), 0) AS DOUBLE) AS revenue FROM cleaned GROUP BY ALL"
    )
    season = (
        "CASE WHEN arrival_date_month IN ('December', 'January', 'February') THEN 'Winter'"
        " WHEN arrival_date_month IN ('March', 'April', 'May') THEN 'Spring'"
        " WHEN arrival_date_month IN ('June', 'July', 'August') THEN 'Summer' ELSE 'Autumn' END"
    )
    nobody = "(agent IS NULL OR agent IN ('NULL', 'NA')) AND (company IS NULL OR company IN ('NULL', 'NA'))"
    tokens = {c: f"{c} IS NULL OR {c} IN ('NULL', 'NA')" for c in ("children", "country", "agent", "company")}
    categories = " UNION ALL ".join(
        f"SELECT {p} AS c, {c} AS x FROM tagged WHERE dataset = 'Train'" for p, c in enumerate(_CATEGORICAL)
    )
    alert = (
        "CASE WHEN cancel_rate_pct >= 60 THEN 'CRITICAL' WHEN cancel_rate_pct >= 50 THEN 'WARNING'"
        " WHEN cancel_rate_pct >= 37 THEN 'ELEVATED' ELSE 'NORMAL' END AS alert"
    )
    clean = {
        "booking_cleaned": "SELECT * FROM cleaned",
        "booking_yearly_cancel_rate": f"""
            SELECT *, lag(cancel_rate) OVER (ORDER BY arrival_date_year) AS previous_year,
                   round(cancel_rate - lag(cancel_rate) OVER (ORDER BY arrival_date_year), 2) AS change_rate
            FROM (SELECT arrival_date_year, {_CANCEL} AS cancel_rate FROM cleaned GROUP BY ALL) y""",
        "booking_hotel_rank_per_year": f"""
            SELECT *, dense_rank() OVER (PARTITION BY arrival_date_year ORDER BY cancel_rate DESC) AS rank
            FROM (SELECT arrival_date_year, hotel, {_CANCEL} AS cancel_rate FROM cleaned GROUP BY ALL) y""",
        "booking_top_countries": top_countries,
        "booking_country_matrix": f"""
            SELECT country, coalesce(max(CASE WHEN hotel = 'City Hotel' THEN total_booking END), 0) AS "City_Hotel",
                   coalesce(max(CASE WHEN hotel = 'Resort Hotel' THEN total_booking END), 0) AS "Resort_Hotel"
            FROM ({top_countries}) t GROUP BY country""",
        "booking_peak_season": _top(
            f"SELECT arrival_date_year, {season} AS season, count(*) AS total_booking FROM cleaned GROUP BY ALL",
            "arrival_date_year", "total_booking DESC", 1, "rnk", "rank",
        ),
        "booking_top_rooms": _top(
            "SELECT hotel, reserved_room_type, count(*) AS total_booking FROM cleaned GROUP BY ALL",
            "hotel", "total_booking DESC, reserved_room_type", 3, "rank",
        ),
        "booking_main_channel": _top(
            "SELECT market_segment, distribution_channel, count(*) AS total_booking FROM cleaned GROUP BY ALL",
            "market_segment", "total_booking DESC, distribution_channel", 1, "rn",
        ),
        "booking_segment_rank": f"""
            SELECT *, dense_rank() OVER (ORDER BY cancel_rate DESC) AS rank
            FROM (SELECT market_segment, count(*) AS total_booking, {_CANCEL} AS cancel_rate FROM cleaned GROUP BY ALL) s""",
        "booking_guest_loyalty": f"""
            SELECT CASE WHEN is_repeated_guest = 1 THEN 'Repeated' ELSE 'New' END AS guest_type,
                   count(*) AS total_booking, {_CANCEL} AS cancel_rate FROM cleaned GROUP BY 1""",
        "booking_request_rank": f"""
            SELECT *, dense_rank() OVER (ORDER BY total_of_special_requests DESC) AS request_rank
            FROM (SELECT total_of_special_requests, count(*) AS total_booking, {_CANCEL} AS cancel_rate
                  FROM cleaned GROUP BY ALL) s""",
        "booking_lead_time_rank": """
            SELECT customer_type, round(m, 6) AS avg_lead_time, dense_rank() OVER (ORDER BY m DESC) AS ranking
            FROM (SELECT customer_type, avg(lead_time) AS m FROM cleaned GROUP BY ALL) s""",
        "booking_top_months": f"""
            SELECT *, substr(month_name, 1, 3) AS month_short
            FROM ({_top(revenue, "arrival_date_year", "revenue DESC", 3, "rank", "dense_rank")}) t""",
        "booking_month_matrix": _matrix("arrival_date_year", "month_num", "revenue", revenue, MONTHS, "m"),
        "booking_class_share": """
            SELECT *, round(booking_count * 100e0 / sum(booking_count) OVER (), 2) AS percentage
            FROM (SELECT is_canceled, count(*) AS booking_count FROM cleaned GROUP BY ALL) s""",
    }
    sql = {name: f"WITH {_CLEAN} {body}" for name, body in clean.items()}
    sql |= {
        "booking_monthly_revenue": f"""
            WITH {_CLEAN}, {_BOOKING_MONTHS}
            SELECT *, {_growth("arrival_date_year, month_num")} FROM months""",
        "booking_revenue_peaks": f"""
            WITH {_CLEAN}, {_BOOKING_MONTHS}
            SELECT arrival_date_year, time_label, revenue_actual, mean_lost_pct FROM (
                SELECT *, arrival_date_year || '-' || month_num AS time_label,
                       round(avg(lost_pct) OVER (PARTITION BY arrival_date_year), 6) AS mean_lost_pct,
                       row_number() OVER (PARTITION BY arrival_date_year ORDER BY revenue_actual DESC, month_num) AS r
                FROM months) t WHERE r = 1""",
        "booking_sql_report": f"""
            WITH {_CLEAN}
            SELECT hotel, deposit_type, count(*) AS total_booking, {_CANCEL} AS cancel_rate FROM cleaned GROUP BY ALL""",
        "booking_features": f"WITH {_CLEAN}, {_FEATURES} SELECT * FROM model",
        "booking_split_balance": f"""
            WITH {_CLEAN}, {_TAGGED}, c AS (SELECT dataset, is_canceled, count(*) AS count FROM tagged GROUP BY ALL)
            SELECT *, round(count * 100e0 / sum(count) OVER (PARTITION BY dataset), 2) AS percentage FROM c""",
        "booking_feature_mapping": f"""
            WITH {_CLEAN}, {_TAGGED}, v AS ({categories}),
                 i AS (SELECT c, x, row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, x) AS r FROM v GROUP BY c, x),
                 o AS (SELECT row_number() OVER (ORDER BY c, r) - 1 AS k, name || '_vec_' || x AS name
                       FROM i JOIN (VALUES {_values(_CATEGORICAL)}) n(p, name) ON c = p)
            SELECT CAST(k AS INT) AS feature_index, name AS feature_name FROM o UNION ALL
            SELECT CAST(p + (SELECT count(*) FROM o) AS INT), name FROM (VALUES {_values(_NUMBERS)}) t(p, name)""",
        "booking_missing_profile": f"WITH {_FIXED} SELECT * FROM ("
        + _profile("raw", tokens, ["children", "country", "agent", "company"])
        + ") p WHERE missing > 0",
        "booking_rule_report": f"WITH {_FIXED} " + _rules(_LOGIC_TESTS, "fixed"),
        "booking_duplicate_groups": f"""
            WITH {_FIXED}
            SELECT hotel, is_canceled, meal, reserved_room_type, adults, stays_in_week_nights, agent, company,
                   count(*) AS copies FROM raw WHERE {nobody} GROUP BY ALL HAVING count(*) > 1""",
        "booking_full_row_duplicates": f"""
            WITH {_FIXED} SELECT *, count(*) AS copies FROM raw GROUP BY ALL HAVING count(*) > 1""",
        "booking_full_row_summary": f"""
            WITH {_FIXED}, g AS (SELECT count(*) AS copies FROM (SELECT * FROM raw) r GROUP BY {', '.join(EXPRESSIONS)})
            SELECT CAST(sum(copies) AS BIGINT) AS total_rows, count(*) AS distinct_rows,
                   count(*) FILTER (WHERE copies > 1) AS repeated_groups, CAST(sum(copies - 1) AS BIGINT) AS surplus_rows FROM g""",
        "booking_numeric_summary": f"WITH {_FIXED} "
        + _summary(_SUMMARY_NUMBERS, ["arrival_date_month", "meal"], "fixed"),
        "booking_iqr_bounds": _bounds(["adr", "adults", "children", "babies"], "fixed").replace(
            "WITH q", f"WITH {_FIXED}, q"
        ),
        "booking_rate_histogram": _histogram("adr", "raw", 500, 50).replace("WITH c", f"WITH {_FIXED}, c"),
        "booking_clean_counts": f"""
            WITH {_FIXED}
            SELECT count(*) AS rows_raw,
                   (SELECT count(*) FROM raw WHERE children NOT IN ('NA', 'NULL') AND TRY_CAST(children AS DOUBLE) IS NULL) AS rows_unreadable,
                   count(*) FILTER (WHERE {_KEEP}) AS rows_after_rules,
                   count(*) FILTER (WHERE {_KEEP} AND {_CAPS}) AS rows_after_caps FROM fixed""",
        "booking_stream_counts": f"""
            WITH {_SENT}
            SELECT ts AS window_start, ts + to_minutes(1) AS window_end, hotel, count(*) AS total_bookings,
                   count(*) FILTER (WHERE is_canceled = 0) AS confirmed,
                   count(*) FILTER (WHERE is_canceled = 1) AS canceled FROM sent GROUP BY ts, hotel""",
        "booking_stream_alerts": f"""
            WITH {_SENT}, r AS (
                SELECT ts AS window_start, hotel, deposit_type, count(*) AS total_bookings,
                       CAST(sum(is_canceled) AS BIGINT) AS total_canceled, {_CANCEL} AS cancel_rate_pct
                FROM sent GROUP BY ALL)
            SELECT *, {alert} FROM r""",
        "booking_stream_rates": f"""
            WITH {_SENT}, {_minute_slices(5, "is_canceled = 0")}
            SELECT period_start, period_start + to_minutes(5) AS period_end, hotel, reserved_room_type AS room_type,
                   count(*) AS booking_count, {_half_up("avg(adr)")} AS avg_daily_rate,
                   CAST(round(sum(CAST(adr AS DECIMAL(18,6))), 2) AS DOUBLE) AS revenue_proxy,
                   {_half_up(f"avg({_NIGHTS})", 1)} AS avg_stay_nights
            FROM sliced GROUP BY period_start, hotel, reserved_room_type HAVING count(*) >= 5""",
        "booking_stream_countries": f"""
            WITH {_SENT}, {_minute_slices(2, "country NOT IN ('NULL', 'NA', '0', 'Unknown')")}
            SELECT period_start, country, hotel, count(*) AS booking_count, {_half_up("avg(adr)")} AS avg_spend,
                   round(avg(is_canceled) * 100, 1) AS cancel_rate_pct
            FROM sliced GROUP BY period_start, country, hotel""",
    }
    sql["booking_fan_out_counts"] = sql["booking_stream_counts"]
    sql["booking_fan_out_countries"] = sql["booking_stream_countries"]
    sql["booking_fan_out_alerts"] = sql["booking_stream_alerts"]
    sql["booking_fan_out_rates"] = sql["booking_stream_rates"]
    return sql


_LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,"
    " l_linestatus, l_shipdate"
)
_COPIES = "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_partkey % 10 = 0"


def _table_sql() -> dict[str, str]:
    nations = """SELECT c_mktsegment, n_name, count(*) AS total_booking
                 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""
    top_nations = _top(nations, "c_mktsegment", "total_booking DESC, n_name", 5, "rn")
    month = "month(o_orderdate)"
    season = (
        f"CASE WHEN {month} IN (12, 1, 2) THEN 'Winter' WHEN {month} IN (3, 4, 5) THEN 'Spring'"
        f" WHEN {month} IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"
    )
    month_revenue = f"SELECT {_YM}, CAST(round(sum({_REVENUE}), 0) AS DOUBLE) AS revenue FROM lineitem GROUP BY ALL"
    line_columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return {
        "monthly_revenue_growth": f"WITH {_TABLE_MONTHS} SELECT *, {_growth('year, month')} FROM months",
        "peak_month_per_year": f"""
            WITH {_TABLE_MONTHS}
            SELECT year, revenue_actual, month FROM (
                SELECT *, row_number() OVER (PARTITION BY year ORDER BY revenue_actual DESC, month) AS r FROM months) t
            WHERE r = 1""",
        "yearly_rate_change": f"""
            SELECT *, lag(cancel_rate) OVER (ORDER BY year) AS previous_year,
                   round(cancel_rate - lag(cancel_rate) OVER (ORDER BY year), 2) AS change_rate
            FROM (SELECT year(o_orderdate) AS year, {_rate(_FAILED)} AS cancel_rate FROM orders GROUP BY 1) y""",
        "yearly_rate_rank": f"""
            SELECT *, dense_rank() OVER (PARTITION BY year ORDER BY cancel_rate DESC) AS rank
            FROM (SELECT year(o_orderdate) AS year, o_orderpriority, {_rate(_FAILED)} AS cancel_rate
                  FROM orders GROUP BY 1, 2) y""",
        "top_nations_per_segment": top_nations,
        "nation_segment_matrix": _matrix(
            "n_name", "c_mktsegment", "total_booking", top_nations,
            ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"], kind="BIGINT",
        ),
        "peak_season_per_year": _top(
            f"SELECT year(o_orderdate) AS year, {season} AS season, count(*) AS total_booking FROM orders GROUP BY 1, 2",
            "year", "total_booking DESC", 1, "rnk", "rank",
        ),
        "top_brands_per_type": _top(
            "SELECT p_type, p_brand, count(*) AS total_booking FROM part GROUP BY ALL",
            "p_type", "total_booking DESC, p_brand", 3, "rank",
        ),
        "top_priority_per_segment": _top(
            "SELECT c_mktsegment, o_orderpriority, count(*) AS total_booking FROM orders"
            " JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
            "c_mktsegment", "total_booking DESC, o_orderpriority", 1, "rn",
        ),
        "segment_rate_rank": f"""
            SELECT *, dense_rank() OVER (ORDER BY cancel_rate DESC) AS rank
            FROM (SELECT c_mktsegment, count(*) AS total_booking, {_rate(_FAILED)} AS cancel_rate
                  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) s""",
        "flag_label_rate": f"""
            SELECT CASE WHEN l_linestatus = 'O' THEN 'Open' ELSE 'Closed' END AS line_label,
                   count(*) AS total_booking, {_rate(_RETURNED)} AS cancel_rate FROM lineitem GROUP BY 1""",
        "ordinal_rate_rank": f"""
            SELECT *, dense_rank() OVER (ORDER BY l_linenumber DESC) AS request_rank
            FROM (SELECT l_linenumber, count(*) AS total_booking, {_rate(_RETURNED)} AS cancel_rate
                  FROM lineitem GROUP BY ALL) s""",
        "mean_gap_rank": """
            SELECT o_orderpriority, avg_gap_days, dense_rank() OVER (ORDER BY avg_gap_days DESC) AS ranking
            FROM (SELECT o_orderpriority, round(avg(date_diff('day', o_orderdate, l_shipdate)), 6) AS avg_gap_days
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL) s""",
        "top_months_per_year": _top(month_revenue, "year", "revenue DESC", 3, "rank", "dense_rank"),
        "month_year_matrix": _matrix(
            "year", "month_num", "revenue",
            f"SELECT year, lpad(CAST(month AS VARCHAR), 2, '0') AS month_num, revenue FROM ({month_revenue}) r",
            MONTHS, "m",
        ),
        "status_share": """
            SELECT *, round(booking_count * 100e0 / sum(booking_count) OVER (), 2) AS percentage
            FROM (SELECT o_orderstatus, count(*) AS booking_count FROM orders GROUP BY ALL) s""",
        "missing_profile": _profile(
            "orders",
            {
                "o_orderpriority": "o_orderpriority IS NULL OR o_orderpriority IN ('NULL', 'NA', '4-NOT SPECIFIED')",
                "o_orderstatus": "o_orderstatus IS NULL OR o_orderstatus IN ('NULL', 'NA', '4-NOT SPECIFIED')",
            },
            ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        ).replace("round(missing * 100e0 / n, 6)", "missing * 100e0 / n"),
        "rule_report": _rules(
            {
                "shipped_before_order": "l_shipdate < o_orderdate",
                "no_discount_and_no_tax": "l_discount = 0 AND l_tax = 0",
                "quantity_over_45": "l_quantity > 45",
                "negative_price": "l_extendedprice < 0",
                "returned_but_order_open": "l_returnflag = 'R' AND o_orderstatus IN ('O', 'P')",
                "open_line_of_failed_order": "l_linestatus = 'O' AND o_orderstatus = 'F'",
                "large_line_small_order": "l_extendedprice > 90000 AND o_totalprice < 5000",
            },
            "(SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey) j",
        ),
        "duplicate_summary": """
            SELECT CAST(sum(copies) AS BIGINT) AS total_rows, count(*) AS distinct_rows,
                   count(*) FILTER (WHERE copies > 1) AS repeated_groups, CAST(sum(copies - 1) AS BIGINT) AS surplus_rows
            FROM (SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY ALL) g""",
        "duplicate_groups": """
            SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY ALL HAVING count(*) > 1""",
        "full_row_summary": f"""
            SELECT CAST(sum(copies) AS BIGINT) AS total_rows, count(*) AS distinct_rows,
                   count(*) FILTER (WHERE copies > 1) AS repeated_groups, CAST(sum(copies - 1) AS BIGINT) AS surplus_rows
            FROM (SELECT count(*) AS copies FROM ({_COPIES}) c GROUP BY {_LINE_COLUMNS}) g""",
        "full_row_duplicates": f"""
            SELECT {_LINE_COLUMNS}, count(*) AS copies FROM ({_COPIES}) c GROUP BY ALL HAVING count(*) > 1""",
        "duplicate_documents": """
            SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first_doc_id
            FROM documents GROUP BY text HAVING count(*) > 1""",
        "line_copies": """
            SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem WHERE l_discount = 0
            GROUP BY ALL HAVING count(*) > 1""",
        "numeric_summary": _summary(line_columns, ["l_returnflag"], "lineitem"),
        "summary_quartiles": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {p}e0 AS probability, count({c}) AS n,"
            f" CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM lineitem"
            for c in line_columns
            for p in (0.25, 0.5, 0.75)
        ),
        "iqr_bounds": _bounds(["value"], "events"),
        "box_stats": """
            WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
                              quantile_cont(value, 0.75) AS q3 FROM events),
                 f AS (SELECT *, q1 - 1.5e0 * (q3 - q1) AS lo, q3 + 1.5e0 * (q3 - q1) AS hi FROM q)
            SELECT count(value) AS n, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median,
                   round(any_value(q3), 6) AS q3,
                   round(min(value) FILTER (WHERE value >= lo), 6) AS whisker_low,
                   round(max(value) FILTER (WHERE value <= hi), 6) AS whisker_high,
                   count(*) FILTER (WHERE value < lo) AS outliers_low,
                   count(*) FILTER (WHERE value > hi) AS outliers_high
            FROM events, f""",
        "clipped_histogram": _histogram("value", "events", 100, 50),
        "discrete_distribution": "SELECT l_quantity, count(*) AS count FROM lineitem GROUP BY ALL",
        "clean_orders": """
            SELECT * REPLACE (CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Unknown' ELSE o_orderpriority END AS o_orderpriority)
            FROM orders WHERE o_totalprice >= 0 AND NOT (o_orderstatus = 'P' AND o_totalprice < 1000)
              AND o_totalprice < 450000""",
        "impute_sentinel": """
            SELECT o_orderkey,
                   CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Unknown' ELSE o_orderpriority END AS o_orderpriority,
                   CASE WHEN o_orderstatus = 'P' THEN '9999' ELSE o_orderstatus END AS o_orderstatus FROM orders""",
        "cap_outliers": """
            SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM lineitem
            WHERE l_extendedprice < 90000 AND l_quantity <= 45""",
        "derived_features": """
            SELECT o_custkey, count(*) AS total_past_bookings,
                   count(*) FILTER (WHERE o_orderstatus = 'F') AS previous_cancellations,
                   round(count(*) FILTER (WHERE o_orderstatus = 'F') / (count(*) + 1e0), 6) AS cancellation_rate
            FROM orders GROUP BY o_custkey""",
        "anti_join_orders": """
            SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
        "hash_split_balance": _balance("o_orderkey", "o_orderstatus", "orders"),
        "anti_join_test_set": f"SELECT o_orderkey, o_orderstatus FROM orders WHERE {_split_bucket('o_orderkey')} >= 8000",
    }


def _stream_sql() -> dict[str, str]:
    sql = {
        "parse_events": "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events",
        "event_envelope": """
            SELECT event_type AS key, CAST(to_json(struct_pack(
                source_id := event_id, user_id := user_id, event_type := event_type, value := value,
                sent := strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), event_time := strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
                event_id := 'BKG-' || sha256(CAST(event_id AS VARCHAR)))) AS VARCHAR) AS value FROM events""",
        "stream_counts": f"""
            WITH {_SHAPED}
            SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + to_hours(1) AS window_end, event_type,
                   count(*) AS total_bookings, count(*) FILTER (WHERE is_canceled = 0) AS confirmed,
                   count(*) FILTER (WHERE is_canceled = 1) AS canceled FROM shaped GROUP BY 1, 2, 3""",
        "stream_rate_alert": f"""
            WITH {_SHAPED}, r AS (
                SELECT date_trunc('hour', ts) AS window_start, user_group, count(*) AS total_bookings,
                       CAST(sum(is_canceled) AS BIGINT) AS total_canceled, {_rate("is_canceled")} AS cancel_rate_pct
                FROM shaped GROUP BY 1, 2)
            SELECT *, CASE WHEN cancel_rate_pct >= 60 THEN 'CRITICAL' WHEN cancel_rate_pct >= 50 THEN 'WARNING'
                           WHEN cancel_rate_pct >= 37 THEN 'ELEVATED' ELSE 'NORMAL' END AS alert FROM r""",
        "stream_sliding_mean": f"""
            WITH {_SHAPED}, {_slices("shaped", 5, "is_canceled = 0")}
            SELECT period_start, period_start + to_hours(5) AS period_end, event_type, count(*) AS booking_count,
                   {_half_up("avg(value)")} AS avg_daily_rate,
                   CAST(round(sum(CAST(value AS DECIMAL(18,6))), 2) AS DOUBLE) AS revenue_proxy
            FROM sliced GROUP BY period_start, event_type HAVING count(*) >= 5""",
        "stream_top_groups": f"""
            WITH {_SHAPED}, {_slices("shaped", 2)}
            SELECT period_start, event_type, user_group, count(*) AS booking_count,
                   {_half_up("avg(value)")} AS avg_spend, round(avg(is_canceled) * 100, 1) AS cancel_rate_pct
            FROM sliced GROUP BY period_start, event_type, user_group""",
        "stream_dedupe": "SELECT event_type, count(DISTINCT event_id) AS events FROM events GROUP BY event_type",
        "stream_dedupe_hot": """
            SELECT DISTINCT CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE CAST(event_id AS VARCHAR) END AS message, CAST(1 AS BIGINT) AS kept
            FROM events""",
        "stream_watched": """
            SELECT 'counts' AS monitor, count(*) AS rows_read FROM events UNION ALL SELECT 'alerts', count(*) FROM events""",
        "message_rejections": """
            SELECT CASE WHEN event_id % 19 = 0 OR event_id % 11 = 0 THEN 'no_time' WHEN event_id % 7 IN (1, 2, 3) THEN 'no_rate'
                        WHEN event_id % 13 = 0 THEN 'no_adults' WHEN event_id % 17 = 0 THEN 'no_hotel' ELSE 'accepted' END AS reason,
                   count(*) AS messages FROM events GROUP BY 1""",
    }
    sql["stream_restarted_counts"] = sql["stream_counts"]
    sql["stream_pane_mean"] = sql["stream_sliding_mean"]
    sql["stream_pane_top"] = sql["stream_top_groups"]
    return sql


_DOCUMENTS = f"""
    measured AS (
        SELECT doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars, quality,
               CAST(len(regexp_split_to_array(trim(text), '\\s+')) AS DOUBLE) AS n_words,
               CAST(len(text) - len(replace(text, chr(10), '')) AS DOUBLE) AS n_lines,
               CAST(len(text) - len(regexp_replace(text, '[0-9]', '', 'g')) AS DOUBLE) AS n_digits,
               CAST(len(text) - len(regexp_replace(text, '[.,;:!?]', '', 'g')) AS DOUBLE) AS n_marks
        FROM documents JOIN labels USING (doc_id)),
    train AS (SELECT *, n_chars / n_words AS mean_word FROM measured WHERE {_split_bucket('doc_id')} < 8000)"""
_SCORED = """
    scored AS (SELECT CAST(quality AS DOUBLE) AS label, least(n_chars / 8000e0, 1e0) AS score,
                      CASE WHEN n_chars / 8000e0 >= 0.05 THEN 1e0 ELSE 0e0 END AS prediction
               FROM documents JOIN labels USING (doc_id))"""
_CURVE = f"""{_SCORED},
    curve AS (SELECT DISTINCT score AS threshold,
                     count(*) FILTER (WHERE label = 0) OVER d / CAST(count(*) FILTER (WHERE label = 0) OVER () AS DOUBLE) AS fpr,
                     count(*) FILTER (WHERE label = 1) OVER d / CAST(count(*) FILTER (WHERE label = 1) OVER () AS DOUBLE) AS tpr
              FROM scored WINDOW d AS (ORDER BY score DESC))"""


def _model_sql() -> dict[str, str]:
    categories = "SELECT 'lang' AS c, lang AS v FROM train UNION ALL SELECT 'source', source FROM train"
    numeric = ["n_chars", "n_words", "n_lines", "n_digits", "n_marks", "mean_word"]
    indexed = f"""
        SELECT c AS "column", v AS category, row_number() OVER (PARTITION BY c ORDER BY count(*) DESC, v) - 1 AS position
        FROM ({categories}) s GROUP BY c, v"""
    tail = ", ".join(f"({i}, '{name}')" for i, name in enumerate([*numeric, "is_toxic", "has_link"]))
    return {
        "document_split_balance": _balance("doc_id", "quality", "labels"),
        "category_index": f"WITH {_DOCUMENTS} {indexed}",
        "feature_mapping": f"""
            WITH {_DOCUMENTS}, i AS ({indexed}),
                 o AS (SELECT row_number() OVER (ORDER BY "column", position) - 1 AS k, "column" || '_vec_' || category AS name FROM i)
            SELECT CAST(k AS INT) AS feature_index, name AS feature_name FROM o
            UNION ALL
            SELECT CAST(p + (SELECT count(*) FROM o) AS INT), name FROM (VALUES {tail}) t(p, name)""",
        "scaling_parameters": f"WITH {_DOCUMENTS} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev FROM train"
            for c in numeric
        ),
        "rule_confusion": f"""
            WITH {_SCORED}
            SELECT label, count(*) FILTER (WHERE prediction = 0) AS predicted_0,
                   count(*) FILTER (WHERE prediction = 1) AS predicted_1 FROM scored GROUP BY label""",
        "rule_roc": f"""
            WITH {_CURVE} SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM curve
            UNION ALL SELECT CAST(NULL AS DOUBLE), 0e0, 0e0""",
        "rule_metrics": f"""
            WITH {_CURVE},
                 classes AS (SELECT c, (SELECT count(*) FROM scored WHERE label = c) AS actual,
                                    (SELECT count(*) FROM scored WHERE prediction = c) AS predicted,
                                    (SELECT count(*) FROM scored WHERE prediction = c AND label = c) AS hits
                             FROM (VALUES (0e0), (1e0)) v(c)),
                 rates AS (SELECT *, coalesce(hits / nullif(CAST(predicted AS DOUBLE), 0), 0) AS pr,
                                  coalesce(hits / nullif(CAST(actual AS DOUBLE), 0), 0) AS re FROM classes)
            SELECT round(sum(hits) / CAST(sum(actual) AS DOUBLE), 6) AS accuracy,
                   round(sum(pr * actual) / sum(actual), 6) AS weighted_precision,
                   round(sum(re * actual) / sum(actual), 6) AS weighted_recall,
                   round(sum(coalesce(2 * pr * re / nullif(pr + re, 0), 0) * actual) / sum(actual), 6) AS f1,
                   round((SELECT avg(CASE WHEN a.score > b.score THEN 1e0 WHEN a.score = b.score THEN 0.5e0 ELSE 0e0 END)
                          FROM scored a JOIN scored b ON a.label = 1 AND b.label = 0), 6) AS roc_auc
            FROM rates""",
    }


def oracle_sql() -> dict[str, str]:
    facts = model_facts.oracle_sql(_split_bucket("doc_id"), f"{_CLEAN}, {_TAGGED}")
    known = _table_sql() | _stream_sql() | _booking_sql() | _model_sql() | scale_questions.oracle_sql() | facts
    return known | handover_questions.oracle_sql(known, _CLEAN)
