"""Secrets in texts: fixed patterns, and a battery of randomness tests; DataFrame functions only.

Three patterns give the base spans. The battery looks at every further run of at least 20
characters of the base64 alphabet (standard or URL form). Its encoding is inferred (hex,
base32, lower-case alphanumeric, base64), its characters become numbers in that alphabet, and
three tests ask whether they look drawn evenly and independently: chi-squared over four equal
parts of the alphabet, runs above and below its middle, and correlation of neighbours. Fisher's
method joins the three; a run that is clearly not random is out.

Not being non-random is weak evidence for a short run, so the rest must stand against ordinary
text. The ratio of the run's chance under a model of text to its chance under even draws is a
valid p-value (Markov's inequality), and falls with every character. Benjamini-Hochberg at
``FALSE_SHARE`` is applied within each band of lengths to all runs of the corpus, so many short
words cannot hide or let through anything among long ones. p-values are rounded up to powers
of two: the step-up rule needs only a table of (band, bits), and three numbers reach the driver.

Defined results: null text is empty; runs that touch a base span are left to it; a run of
digits alone is no candidate; a corpus without candidates has no added spans; equal rows get equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import let, positions, written

# The base patterns, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
#: Greedy runs of at least so many characters are those that the open pattern finds and the length keeps.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"

BANDS = (20, 32, 64)
BATTERY_LEVEL = 0.001
FALSE_SHARE = 0.01
MOST_BITS = 1000

HEX_ALPHABET = "0123456789abcdef"
BASE32_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LOWER_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
BASE64_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
# Share in percent of each letter a to z in English text.
LETTER_SHARE = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
#: Shares of capitals, digits and signs in runs of ordinary text; the rest are small letters.
CAPITALS, DIGITS, SIGNS = 0.06, 0.06, 0.06

SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _text_bits() -> list[float]:
    """Bits of surprise of each character of ``BASE64_ALPHABET`` under the model of text."""
    total = sum(LETTER_SHARE)
    small = [(1 - CAPITALS - DIGITS - SIGNS) * s / total for s in LETTER_SHARE]
    shares = [CAPITALS / 26] * 26 + small + [DIGITS / 10] * 10 + [SIGNS / 2] * 2
    return [-math.log2(s) for s in shares]


def _numbers(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _found(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches as ``array<struct<start, size, value>>`` in code points; ``value`` is the group's text.

    The pieces between matches and the matches themselves give every start.
    """
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    sizes = F.zip_with(
        F.transform(matches, lambda m: F.char_length(m).cast("bigint")), F.transform(gaps, lambda g: F.char_length(g).cast("bigint")),
        lambda size, gap: F.struct(gap.alias("gap"), F.coalesce(size, F.lit(0).cast("bigint")).alias("size")),
    )

    def placed(s: Column) -> Column:
        before = positions(F.transform(s, lambda x: x["gap"] + x["size"]))
        spans = F.zip_with(s, before, lambda x, b: F.struct((b + x["gap"]).alias("start"), x["size"].alias("size")))
        valued = F.zip_with(spans, values, lambda x, v: F.struct(x["start"].alias("start"), x["size"].alias("size"), v.alias("value")))
        return F.filter(valued, lambda x: x["value"].isNotNull())  # the last gap has no match

    none = F.array().cast("array<struct<start:bigint,size:bigint,value:string>>")
    return F.when(F.rlike(text, F.lit(pattern)), let(sizes, placed)).otherwise(none)


def _spans(found: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), F.lit(number).alias("kind"), (x["start"] + x["size"]).alias("end"))
    )


def base_spans(text: Column) -> Column:
    assign = F.filter(_found(text, ASSIGN, 1), lambda x: F.char_length(x["value"]) >= ASSIGN_LEAST)
    parts = [_spans(assign, "assign"), _spans(_found(text, ACCESS), "access"), _spans(_found(text, HEX), "hex")]
    return F.array_sort(F.concat(*parts)).cast(SPAN)


def _erfc(x: Column) -> Column:
    """Complementary error function for x >= 0; absolute error below 2e-7 (Abramowitz and Stegun 7.1.26)."""
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _p_even(v: Column, size: Column) -> Column:
    """Chi-squared test, three degrees of freedom, of places (0 to 1) over four equal parts."""
    quarter = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.size(F.filter(v, lambda x: F.floor(x * 4) == q)).cast("double"))
    squares = F.aggregate(quarter, F.lit(0.0), lambda acc, x: acc + x * x)
    return let(squares * 4 / size - size, lambda x: _erfc(F.sqrt(x / 2)) + F.sqrt(2 * x / math.pi) * F.exp(-x / 2))


def _p_runs(v: Column, size: Column) -> Column:
    """Wald-Wolfowitz test of runs above and below the middle."""
    high = F.transform(v, lambda x: F.when(x >= 0.5, 1.0).otherwise(0.0))

    def test(h: Column) -> Column:
        n = size.cast("int")
        changes = F.zip_with(F.slice(h, 1, n - 1), F.slice(h, F.lit(2), n - 1), lambda a, b: F.abs(a - b))
        return let(
            F.struct(_total(h).alias("n1"), (1 + _total(changes)).alias("runs")),
            lambda s: let(
                1 + 2 * s["n1"] * (size - s["n1"]) / size,
                lambda mean: F.when(mean > 2, _erfc(F.abs(s["runs"] - mean) / F.sqrt(2 * (mean - 1) * (mean - 2) / (size - 1)))).otherwise(0.0),
            ),
        )

    return let(high, test)


def _p_serial(v: Column, size: Column) -> Column:
    """Correlation of neighbours, about normal with variance 1 / size if they are independent."""

    def test(d: Column) -> Column:
        n = size.cast("int")
        products = F.zip_with(F.slice(d, 1, n - 1), F.slice(d, F.lit(2), n - 1), lambda a, b: a * b)
        spread = _total(F.transform(d, lambda x: x * x))
        return let(spread, lambda s: F.when(s > 1e-9, _erfc(F.abs(_total(products)) / s * F.sqrt(size / 2))).otherwise(0.0))

    return let(_total(v) / size, lambda mean: let(F.transform(v, lambda x: x - mean), test))


def _judged(value: Column) -> Column:
    """Struct ``(band, bits, random)`` of one candidate."""
    body = F.translate(F.rtrim(value, F.lit("=")), "-_", "+/")

    def of(body: Column) -> Column:
        size = F.char_length(body).cast("double")
        hexadecimal = body.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
        encoding = (
            F.when(hexadecimal, F.lit(HEX_ALPHABET)).when(body.rlike("^[A-Z2-7]+$"), F.lit(BASE32_ALPHABET))
            .when(body.rlike("^[a-z0-9]+$"), F.lit(LOWER_ALPHABET)).otherwise(F.lit(BASE64_ALPHABET))
        )
        shown = F.when(hexadecimal, F.lower(body)).otherwise(body)
        places = F.transform(F.split(shown, "(?!^)"), lambda c: (F.instr(encoding, c) - 0.5) / F.char_length(encoding))
        # Capitals alone are one way of writing: they are as common as small letters then.
        plain = F.when(body.rlike("[a-z]"), body).otherwise(F.lower(body))
        table = _numbers(_text_bits())
        surprise = _total(F.transform(F.split(plain, "(?!^)"), lambda c: F.get(table, F.instr(F.lit(BASE64_ALPHABET), c) - 1)))
        bits = surprise - size * F.log2(F.char_length(encoding).cast("double"))

        def joined(v: Column) -> Column:
            logs = [F.ln(F.greatest(p(v, size), F.lit(1e-30))) for p in (_p_even, _p_runs, _p_serial)]
            half = -(logs[0] + logs[1] + logs[2])
            return let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))  # Fisher, six degrees of freedom

        band = F.when(size >= BANDS[2], 2).when(size >= BANDS[1], 1).otherwise(0)
        return F.struct(
            band.alias("band"), F.greatest(F.lit(0), F.least(F.lit(MOST_BITS), F.floor(bits))).cast("int").alias("bits"),
            (let(places, joined) >= BATTERY_LEVEL).alias("random"),
        )

    return let(body, of)


def _candidates(text: Column, base: Column) -> Column:
    found = F.filter(_found(text, CANDIDATE), lambda x: ~x["value"].rlike("^[0-9]+=*$"))
    free = F.filter(found, lambda x: ~F.exists(base, lambda b: (b["start"] < x["start"] + x["size"]) & (x["start"] < b["end"])))
    return F.transform(
        free, lambda x: F.struct(x["start"].alias("start"), (x["start"] + x["size"]).alias("end"), _judged(x["value"]).alias("test"))
    )


def thresholds(tested: DataFrame) -> dict[int, int]:
    """Benjamini-Hochberg in each band: the fewest bits that make a find, from rows ``(band, bits, random)``."""
    table = tested.groupBy("band", "bits").agg(F.count("*").alias("n"), F.count_if("random").alias("good"))
    down = Window.partitionBy("band").orderBy(F.desc("bits"))  # at most MOST_BITS + 1 rows a band
    walk = table.select(
        "band", "bits", F.sum("n").over(Window.partitionBy("band")).alias("m"), F.sum("good").over(down).alias("found")
    )
    fits = F.col("m") * F.pow(F.lit(2.0), -F.col("bits")) <= F.lit(FALSE_SHARE) * F.col("found")
    rows = walk.filter(fits & (F.col("found") > 0)).groupBy("band").agg(F.min("bits").alias("bits")).collect()
    return {r["band"]: r["bits"] for r in rows}


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, base, spans)``: arrays of ``(start, kind, end)``, one row a row of ``docs``.

    The texts are read once; the thresholds and the result come from the small table of spans.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    based = docs.select(F.col(id_col), text.alias("text")).select(
        id_col, let(base_spans(F.col("text")), lambda b: F.struct(b.alias("base"), _candidates(F.col("text"), b).alias("tested"))).alias("s")
    )
    table = written(based.select(id_col, "s.base", "s.tested"), "secret-spans")
    least = thresholds(table.select(F.explode("tested.test").alias("t")).select("t.*"))

    def keep(x: Column) -> Column:
        enough = F.lit(False)
        for band, bits in least.items():
            enough = enough | ((x["test"]["band"] == band) & (x["test"]["bits"] >= bits))
        return x["test"]["random"] & enough

    added = F.transform(
        F.filter("tested", keep), lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), x["end"].alias("end"))
    )
    return table.select(id_col, "base", F.array_sort(F.concat("base", added.cast(SPAN))).alias("spans"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base kinds, the digest of the base spans, and all spans as text."""
    found = scanned(docs, id_col, text_col)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        id_col, count("assign"), count("access"), count("hex"), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"), count("random"),
    )
