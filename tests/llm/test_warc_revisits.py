import random

from pyspark.sql import functions as F

from staylens.llm import queries
from staylens.llm import warc_revisits as W

SCHEMA = "record_id bigint, url string, captured bigint, is_full boolean, headers map<string,string>"


def plain_outcome(rows):
    """Latest strictly earlier response of the canonical URL, checked and merged, by a plain loop over all."""
    out = {}
    for i, url, t, full, headers in rows:
        if full:
            continue
        mine = {k.lower(): v for k, v in (headers or {}).items()}
        earlier = [r for r in rows if r[3] and url is not None and t is not None and r[1] == url and r[2] is not None and r[2] < t]
        if not earlier:
            out[i] = ("no_response", None, mine)
            continue
        base = max(earlier, key=lambda r: (r[2], r[0]))
        theirs = {k.lower(): v for k, v in (base[4] or {}).items()}
        tag, of = (h.get("etag", "").removeprefix("W/") or None for h in (mine, theirs))
        date, of_date = mine.get("last-modified"), theirs.get("last-modified")
        if tag and of:
            outcome = "resolved" if tag == of else "validator_mismatch"
        elif date and of_date:
            outcome = "resolved" if date == of_date else "validator_mismatch"
        else:
            outcome = "no_validator"
        good = outcome == "resolved"
        out[i] = (outcome, base[0] if good else None, theirs | {k: v for k, v in mine.items() if k in W.PERMITTED} if good else mine)
    return out


def got(df):
    return {r["record_id"]: (r["outcome"], r["refers_to"], {h["name"]: h["value"] for h in r["headers"]}) for r in df.collect()}


def log(n, urls, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        headers = {k: v for k, v in {
            "ETag": rng.choice([None, '"a"', 'W/"a"', '"b"']), "Last-Modified": rng.choice([None, "mon", "tue"]), "Cache-Control": f"max-age={i}",
            "Content-Length": str(i), "X-Own": "x",
        }.items() if v}
        rows.append((i, rng.choice(urls), rng.randrange(n // 2), rng.random() < 0.4, headers))
    return rows


def test_equals_plain_version(spark):
    rows = log(1500, ["h/a", "h/b", "h/c"] + [f"h/{i}" for i in range(200)])
    rows += [(9000, None, 5, False, {"ETag": '"a"'}), (9001, "h/a", None, False, {}), (9002, "h/a", None, True, {}), (9003, None, 1, True, None), (9004, "h/zz", 3, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("task", F.lit("x")).withColumn("time", F.lit(1)).withColumn("id", F.lit(2))
    assert got(W.resolve(df)) == plain_outcome(rows)


def test_hot_url_over_many_tasks(spark):
    rows = log(4000, ["h/hot"] * 30 + [f"h/{i}" for i in range(20)], seed=5)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(W.resolve(spark.createDataFrame(rows, SCHEMA))) == plain_outcome(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_canonical_urls(spark):
    same = ["http://www.Example.org:80/A/b/?b=2&a=1&utm_source=x#frag", "https://example.org:443/A/b?a=1&b=2", "HTTPS://WWW2.example.org/A/b/?a=1&b=2&", " http://example.org/A/b?a=1&b=2#"]
    rows = spark.createDataFrame([(u,) for u in [*same, "http://example.org/a/b", None, "", "ftp://x/y"]], "u string").select(W.canonical_url(F.col("u")).alias("c")).collect()
    assert {r["c"] for r in rows[:4]} == {"example.org/A/b?a=1&b=2"}
    assert [r["c"] for r in rows[4:]] == ["example.org/a/b", None, "", "ftp://x/y"]


def test_timestamps_payloads_and_empty_table(spark):
    df = spark.createDataFrame([(1, "h/a", 10, True, {"ETag": "1", "etag": "2"}), (2, "h/a", 20, False, {"Etag": "2"}), (3, "h/b", 20, False, {"Etag": "2"})], SCHEMA)
    timed = df.withColumn("captured", F.timestamp_seconds("captured")).withColumn("payload", F.concat(F.lit("p"), "record_id"))
    out = W.with_payload(W.resolve(timed), timed)
    assert {r["record_id"]: (r["outcome"], r["payload"]) for r in out.collect()} == {2: ("resolved", "p1"), 3: ("no_response", None)}
    assert W.resolve(df.limit(0)).count() == 0


def test_query_has_every_kind(spark):
    rows = queries.op3_resolve_revisits(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 250 and {r["outcome"] for r in rows} >= {"resolved", "validator_mismatch"}


def test_query_tells_all_outcomes_apart(spark):
    """Responses before and after, without validators, and none at all: each does its work in the query."""
    rows = queries.op3_resolve_revisits(spark, "/root/testdata/sf0.01").collect()
    counts = {}
    for r in rows:
        counts[r["outcome"]] = counts.get(r["outcome"], 0) + 1
    assert set(counts) == {W.RESOLVED, W.NO_RESPONSE, W.NO_VALIDATOR, W.MISMATCH} and min(counts.values()) >= 20
    targets = [r["refers_to"] for r in rows if r["refers_to"] is not None]
    assert any(t < 0 for t in targets) and any(t >= 0 for t in targets)  # the first and the second response
