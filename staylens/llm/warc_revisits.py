"""Resolve not-modified revisits of a web archive against the response they refer to.

An as-of join: a revisit refers to the latest strictly earlier full response of the same
canonical URL. Its validators must agree with that response: equal entity tags (weak marks
aside), or, where one side has no tag, equal modification dates. The resolved record has the
response's headers, brought up to date by those headers of the revisit that a not-modified
answer may change.

Records are put in order of URL and time over all tasks, so a URL with a third of all captures
is spread over many; within a task a window finds the latest response, and for the few URLs
that cross from task to task (one a border) the latest response of earlier tasks is carried over.
Payloads stay out of this and are joined to resolved revisits on request.

Defined results: a revisit with null URL or time finds nothing; of responses at one time the
larger record id counts; header names are compared in lower case, of repeated ones the last
counts; a full response without payload is still one; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import written

# Headers that a not-modified answer may bring up to date.
PERMITTED = ("age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
RESOLVED, NO_RESPONSE, NO_VALIDATOR, MISMATCH = "resolved", "no_response", "no_validator", "validator_mismatch"
TASK_BITS = 33  # monotonically_increasing_id: the task is above, the row in it below


def canonical_url(url: Column) -> Column:
    """One form for addresses of one page: no scheme, ``www.``, default port, fragment, tracking or trailing slash; ordered query."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^(?i:https?)://(?:(?i:www)\d*\.)?", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*", 0), r":(?:80|443)$", ""))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    parts = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike("^(?i:utm_[a-z]+)="))
    query = F.array_join(F.array_sort(parts), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def header_list(headers: Column) -> Column:
    """Map of headers as sorted entries with lower-case names, the last of a repeated name."""
    named = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("name"), e["value"].alias("value")))
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda later: later["name"] == e["name"]))
    return F.coalesce(F.array_sort(last), F.array().cast("array<struct<name:string,value:string>>"))


def merged_headers(base: Column, revisit: Column) -> Column:
    """The response's headers, with the permitted ones of the revisit in their place."""
    allowed = F.filter(revisit, lambda e: e["name"].isin(*PERMITTED))
    kept = F.filter(base, lambda b: ~F.exists(allowed, lambda a: a["name"] == b["name"]))
    return F.array_sort(F.concat(kept, allowed))


def _header(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["name"] == name), F.lit(0))["value"]


def _tag(entries: Column) -> Column:
    return F.regexp_replace(_header(entries, "etag"), "^W/", "")


def resolve(
    records: DataFrame, id_col: str = "record_id", url_col: str = "url", time_col: str = "captured", full_col: str = "is_full",
    headers_col: str = "headers",
) -> DataFrame:
    """``(id, canonical_url, outcome, refers_to, headers)``, one row a revisit (rows with ``full_col`` false).

    ``time_col`` is a timestamp or a long; ``headers`` of the result are sorted entries, the
    revisit's own where it is not resolved.
    """
    time = F.col(time_col).cast("timestamp").cast("double") * 1_000_000 if dict(records.dtypes)[time_col].startswith("timestamp") else F.col(time_col)
    rows = records.select(
        F.col(id_col).alias("id"), canonical_url(F.col(url_col)).alias("url"), time.cast("bigint").alias("time"),
        F.coalesce(F.col(full_col), F.lit(False)).alias("full"), header_list(F.col(headers_col)).alias("headers"),
    )
    ranged = rows.repartitionByRange("url", "time").sortWithinPartitions("url", "time")
    placed = written(ranged.withColumn("task", F.shiftright(F.monotonically_increasing_id(), TASK_BITS)), "captures")
    response = F.when(F.col("full") & F.col("url").isNotNull() & F.col("time").isNotNull(), F.struct("time", "id", "headers"))

    # The latest response of each task for URLs that more than one task holds: at most one URL a border.
    ends = placed.groupBy("url", "task").agg(F.max(response).alias("latest"))
    spread = ends.groupBy("url").agg(F.count("*").alias("tasks")).filter(F.col("tasks") > 1).select("url")
    earlier = Window.partitionBy("url").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.join(spread, "url", "left_semi").withColumn("carried", F.max("latest").over(earlier))
    carried = written(carried.select(F.col("url").alias("_url"), F.col("task").alias("_task"), "carried"), "captures-carried")

    before = Window.partitionBy("task", "url").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    near = placed.withColumn("near", F.max(response).over(before)).filter(~F.col("full"))
    seen = near.join(carried, (F.col("url") == F.col("_url")) & (F.col("task") == F.col("_task")), "left")
    found = F.when(F.col("time").isNotNull() & F.col("url").isNotNull(), F.coalesce("near", "carried"))
    seen = seen.withColumn("found", found)
    tag, of = _tag(F.col("headers")), _tag(F.col("found.headers"))
    date, of_date = _header(F.col("headers"), "last-modified"), _header(F.col("found.headers"), "last-modified")
    outcome = (
        F.when(F.col("found").isNull(), NO_RESPONSE)
        .when(tag.isNotNull() & of.isNotNull(), F.when(tag == of, RESOLVED).otherwise(MISMATCH))
        .when(date.isNotNull() & of_date.isNotNull(), F.when(date == of_date, RESOLVED).otherwise(MISMATCH))
        .otherwise(NO_VALIDATOR)
    )
    good = F.col("outcome") == RESOLVED
    return seen.withColumn("outcome", outcome).select(
        F.col("id").alias(id_col), F.col("url").alias("canonical_url"), "outcome",
        F.when(good, F.col("found.id")).alias("refers_to"),
        F.when(good, merged_headers(F.col("found.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )


def with_payload(resolved: DataFrame, records: DataFrame, id_col: str = "record_id", payload_col: str = "payload") -> DataFrame:
    """Resolved revisits with the payload of the response they refer to; the others keep a null."""
    payload = records.select(F.col(id_col).alias("_id"), F.col(payload_col).alias("payload"))
    return resolved.join(payload, F.col("refers_to") == F.col("_id"), "left").drop("_id")


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Capture records made from a table of pages, as the pages have no capture log of their own.

    Pages are an hour apart. Each with content gives two full responses, a quarter of an hour apart, of
    which every ninth page's second one has no validators; and each page gives one revisit under
    another spelling of its address. Most come half an hour after the second response, every ninth between the two
    (with the first one's validators), every ninth before both. A fifth come with another entity tag,
    a seventh with a date alone.
    """
    page, place = F.col("page_id"), F.col("page_id") % 9
    size = F.coalesce(F.octet_length("html"), F.lit(0)).cast("string")

    def quoted(mark: str) -> Column:
        return F.concat(F.lit('"'), F.md5(F.concat("html", F.lit(mark))), F.lit('"'))

    def dated(mark: str) -> Column:
        return F.concat(F.lit("t"), page.cast("string"), F.lit(mark))

    def headers(**values: Column) -> Column:
        names = [F.lit(n.replace("_", "-")) for n in values]
        return F.map_filter(F.map_from_arrays(F.array(*names), F.array(*values.values())), lambda k, v: v.isNotNull())

    def response(id_: Column, time: Column, mark: str, checked: Column) -> Column:
        own = headers(
            Content_Type=F.lit("text/html"), Content_Length=size, ETag=F.when(checked, quoted(mark)),
            Last_Modified=F.when(checked, dated(mark)), Cache_Control=F.lit("max-age=60"), Date=dated(mark),
        )
        return _capture(id_, F.col("url"), time, True, own)

    first = response(-page - 1, page * 3600 - 900, "-", F.lit(True))
    second = response(page * 2, page * 3600, "", place != 2)
    between = place == 1
    tag = F.when(page % 5 == 4, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), F.when(between, quoted("-")).otherwise(quoted(""))))
    again = headers(
        ETag=F.when(page % 7 != 6, tag), Last_Modified=F.when(between, dated("-")).otherwise(dated("")),
        Cache_Control=F.lit("max-age=120"), Content_Length=F.lit("0"), Server=F.lit("cache"),
    )
    time = page * 3600 + F.when(place == 0, -1000).when(between, -100).otherwise(1800)
    revisit = _capture(page * 2 + 1, F.concat(F.col("url"), F.lit("#again")), time, False, again)
    records = F.when(F.col("html").isNotNull(), F.array(first, second, revisit)).otherwise(F.array(revisit))
    return pages.select(F.explode(records).alias("r")).select("r.*")


def _capture(id_: Column, url: Column, time: Column, full: bool, headers: Column) -> Column:
    return F.struct(
        id_.alias("record_id"), url.alias("url"), time.cast("bigint").alias("captured"), F.lit(full).alias("is_full"), headers.alias("headers")
    )
