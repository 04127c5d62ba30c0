"""Benchmark decontamination by template windows; DataFrame functions only.

Texts are brought to templates: numbers, names (capitalised words inside a sentence) and units
after a number become typed slots, the rest is lower case without punctuation. Windows of eight
template words are hashed and joined with those of the benchmark. Matches of one document and
one item on one alignment form a run. In a run a value of the item stands for the value the document
has at more than half of its places; windows with another value there, or with a value that stands
for nothing so, do not count. Windows without slots always do. So an item with other numbers and
names is caught, and text that only shares a pattern is not.

A document leaks an item if its consistent runs cover at least ``NEEDED`` windows (eight words
and five more), or all windows of a shorter item. Windows in which more than half are slots say
too little and do not count. An item's first word may be a name or unit only inside running text, so
its first window is looked for in these readings too; ``windows`` counts them only where the others
are too few.

Items without any such window (too short, or mostly slots) are looked for as they are, in plain
words and as a whole: :func:`whole_item_leaks`. Those below ``SHORTEST`` words are in much clean text, so
only a document that consists of one leaks it.

Documents are cut, hashed and joined in one stage of generated code when the benchmark's windows
are small enough for Spark to send them to every task; otherwise both sides are shuffled by hash.
Windows that more than ``COMMON`` items share (a stem of many questions) need not be joined to all of
them: a leak takes ``k`` of an item's ``n`` places, so it has at least one of any ``n - k + 1``. The ``k - 1``
places whose windows most items share are therefore left out of the first join, and looked up, at every place of the
document, where another window of the item was found. No leak is lost.

Items with the same windows whose slot values are equal at the same places (re-parameterisations of each other)
are judged alike by any document. Of more than ``COMMON`` such items the one with the smallest id and text stands for
the class; :func:`item_classes` says which, and ``every_item`` gives a row for each of them, with its own values.

Defined results: null texts match nothing; rows equal in id and text are judged once; items are told
apart by id (null is one) and text: equal texts are reported under each id, and of several texts of
one id the one with the most windows is; an empty table gives no leaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import fresh_name, let, written

WINDOW = 8
NEEDED = 6
#: Words of the shortest item that is looked for inside longer texts.
SHORTEST = 5
#: Items that may share a window that is joined as it is.
COMMON = 64
#: Texts are cut into pieces of so many windows: a window's row carries its piece's words, if those have a slot.
PIECE = 64

#: What tells an item; and a document.
ITEM, DOC = ["item", "item_hash"], ["id", "text_hash"]

# Marks from the private use area: before a name, and in place of a slot.
NAME, NAME_SLOT, NUMBER_SLOT, UNIT_SLOT, PAST = "\ue000", "\ue001", "\ue002", "\ue003", "\ue004"
# What parts words besides blanks (white space; ASCII, Latin-1 and general punctuation).
PARTING = r"[\x09-\x0D\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E\xA1\xA7\xAB\xB6\xB7\xBB\xBF\u2010-\u205E]"
# Units of measure, lower case, that count as slots right after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz pound pounds ounce ounces gram grams "
    "kilogram kilograms ton tons meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters "
    "ml cl l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years hz khz mhz ghz w kw mw v kv a j kj cal kcal pa kpa c f k kmh mph percent dollar dollars cent "
    "cents euro euros usd eur kb mb gb tb bit bits byte bytes"
).split()


def marked_text(text: Column) -> Column:
    """Lower case, with a mark in front of each name."""
    marks = (NAME, NAME_SLOT, NUMBER_SLOT, UNIT_SLOT)
    own = F.contains(text, F.lit(marks[0]))
    for m in marks[1:]:
        own = own | F.contains(text, F.lit(m))
    free = F.when(own, F.regexp_replace(text, f"[{NAME}-{UNIT_SLOT}]+", "")).otherwise(text)
    # The capital first: at most letters the search then ends at once.
    name = r"\p{Lu}(?=\p{Ll})(?<=[^\x09-\x0D\x20.!?:;][\x09-\x0D\x20]{1,3}\p{Lu})"
    return F.lower(F.regexp_replace(free, name, f"{NAME}$0"))


def words(marked: Column, any_slot: Column) -> Column:
    """Words of marked text; a number is one word. Parting by one blank has a fast way, parting by a pattern has not."""
    joined = F.when(any_slot, F.regexp_replace(marked, r"([0-9])[.,:/](?=[0-9])", "$1")).otherwise(marked)
    return F.array_remove(F.split(F.regexp_replace(joined, PARTING, " "), " "), "")


def _is_number(word: Column) -> Column:
    return (word >= "0") & (word < ":")


def _is_name(word: Column) -> Column:
    return (word >= NAME) & (word < NAME_SLOT)


def template_words(w: Column) -> Column:
    """The words with slots in place of names, numbers and units after a number."""

    def slot(word: Column, at: Column) -> Column:
        unit = word.isin(UNITS) & (at > 0) & F.coalesce(_is_number(F.get(w, at - 1)), F.lit(False))
        return F.when(_is_number(word), NUMBER_SLOT).when(_is_name(word), NAME_SLOT).when(unit, UNIT_SLOT).otherwise(word)

    return F.transform(w, slot)


def _windows(rows: DataFrame, key: list[str], text_col: str) -> DataFrame:
    """``key``, ``pos``, ``hash`` and, for a window whose piece has slots, its words and its template words.

    Windows are made by zipping a piece with itself shifted, which stays in generated code.
    Each piece has one word more in front, as a unit is told by the number before it.
    """
    marked = rows.select(*key, marked_text(F.col(text_col)).alias("marked"))
    flagged = marked.withColumn("any", F.rlike("marked", F.lit(f"[0-9{NAME}]")))
    split = flagged.select(*key, "any", F.concat(F.array(F.lit("")), words(F.col("marked"), F.col("any"))).alias("words"))
    last = F.floor((F.size("words") - 1 - WINDOW) / PIECE).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda p: F.slice("words", p * PIECE + 1, PIECE + WINDOW))
    # A filter on the size would be moved below the split, and split twice.
    pieces = split.select(*key, "any", F.posexplode(F.when(F.size("words") > WINDOW, cut)).alias("piece", "w"))
    slotted = F.exists("w", lambda x: _is_number(x) | _is_name(x))
    pieces = pieces.withColumn("t", F.when(F.col("any") & slotted, template_words(F.col("w"))))
    pieces = pieces.select(*key, "piece", F.coalesce("t", "w").alias("t"), F.when(F.col("t").isNotNull(), F.col("w")).alias("w"))
    shifted = [F.slice("t", i + 2, F.size("t")).alias(f"w{i}") for i in range(WINDOW)]
    each = pieces.select(*key, "piece", "w", F.posexplode(F.arrays_zip(*shifted)).alias("first", "z"))
    parts = [F.col(f"z.w{i}") for i in range(WINDOW)]
    return each.filter(parts[-1].isNotNull()).select(
        *key, (F.col("piece") * PIECE + F.col("first")).alias("pos"), F.xxhash64(*parts).alias("hash"),
        F.when(F.col("w").isNotNull(), F.slice("w", F.col("first") + 2, WINDOW)).alias("words"),
        F.when(F.col("w").isNotNull(), F.array(*parts)).alias("slotted"),
    )


def _slots(words: Column, slotted: Column) -> Column:
    """``(at, value)`` of a window's slots."""
    named = F.zip_with(
        F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("value"))), slotted,
        lambda w, t: F.struct(w["at"].alias("at"), w["value"].alias("value"), ((t >= NAME_SLOT) & (t < PAST)).alias("is")),
    )
    own = F.transform(F.filter(named, lambda s: s["is"]), lambda s: F.struct(s["at"].alias("at"), s["value"].alias("value")))
    return F.coalesce(own, F.array().cast("array<struct<at:int,value:string>>"))


def _item_windows(items: DataFrame) -> DataFrame:
    """Windows of the items; ``inside`` has the first one again as it reads after a word and after a number."""
    bare = F.regexp_replace("text", r"^[\x09-\x0D\x20]+", "")
    out = _windows(items, ITEM, "text").withColumn("inside", F.lit(False))
    for before in ("x ", "1. "):
        after = _windows(items.select(*ITEM, F.concat(F.lit(before), bare).alias("text")), ITEM, "text").filter(F.col("pos") == 1)
        out = out.unionByName(after.withColumn("pos", F.col("pos") - 1).withColumn("inside", F.lit(True)))
    return out


def _fitting(windows: Column, known: Column) -> Column:
    """Windows that agree with themselves and with the values already known."""

    def fits(w: Column, known: Column) -> Column:
        own = F.array_distinct(F.transform(w["pairs"], lambda s: s["pair"]))
        alone = F.size(own) == F.size(F.array_distinct(F.transform(own, lambda p: p["item"])))
        return alone & F.forall(own, lambda p: F.forall(known, lambda k: (k["item"] != p["item"]) | (k["doc"] == p["doc"])))

    return let(known, lambda k: F.filter(windows, lambda w: fits(w, k)))


def _pairs(windows: Column) -> Column:
    """The different ``(item, doc)`` values of a run's windows."""
    return F.array_distinct(F.transform(F.flatten(F.transform(windows, lambda w: w["pairs"])), lambda s: s["pair"]))


def _consistent(windows: Column) -> Column:
    """The windows of a run that agree on what the item's values stand for."""

    def agreeing(windows: Column) -> Column:
        def leading(slots: Column) -> Column:
            def leads(pair: Column) -> Column:
                own = F.filter(slots, lambda s: s["pair"]["item"] == pair["item"])
                return 2 * F.size(F.filter(own, lambda s: s["pair"]["doc"] == pair["doc"])) > F.size(own)

            return F.filter(F.array_distinct(F.transform(slots, lambda s: s["pair"])), leads)

        slots = F.array_distinct(F.flatten(F.transform(windows, lambda w: w["pairs"])))
        meaning = let(slots, leading)
        return let(meaning, lambda m: F.filter(windows, lambda w: F.forall(w["pairs"], lambda s: F.array_contains(m, s["pair"]))))

    pairs = _pairs(windows)
    several = F.size(pairs) > F.size(F.array_distinct(F.transform(pairs, lambda p: p["item"])))
    return F.when(several, agreeing(windows)).otherwise(windows)


def _same(left: DataFrame, right: DataFrame, names: list[str], prefix: str = "_") -> Column:
    """Equality on ``names``, the first of them null-safe; on the right they have a prefix."""
    test = left[names[0]].eqNullSafe(right[f"{prefix}{names[0]}"])
    for n in names[1:]:
        test = test & (left[n] == right[f"{prefix}{n}"])
    return test


def _prefixed(df: DataFrame, names: list[str], prefix: str = "_") -> DataFrame:
    return df.withColumnsRenamed({n: f"{prefix}{n}" for n in names})


def _items(benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    text = F.col(item_text_col)
    return benchmark.select(F.col(item_col).alias("item"), F.xxhash64(text).alias("item_hash"), text.alias("text")).dropDuplicates(ITEM)


def _all_windows(items: DataFrame) -> DataFrame:
    """Windows of the items that count, with the values of their slots."""
    found = _item_windows(items).select(*ITEM, "pos", "hash", "inside", _slots(F.col("words"), F.col("slotted")).alias("slots"))
    found = found.filter(F.size("slots") <= WINDOW // 2).groupBy(*ITEM, "pos", "hash", "slots").agg(F.min("inside").alias("inside"))
    return written(found, "benchmark-windows")


def _classes(found: DataFrame) -> DataFrame:
    """``(item, item_hash, first, values)`` of the items in large classes; equal places in ``values`` stand for each other.

    A class has the same windows in every reading, with values that are equal at the same places; its sums and
    decisions do not depend on the values themselves. An item's windows are as many as its words, so they are a bounded array.
    """
    own = F.sort_array(F.collect_list(F.struct("pos", "hash", "inside", "slots")))
    rows = found.groupBy(*ITEM).agg(own.alias("own"))
    placed = F.flatten(F.transform("own", lambda w: F.transform(w["slots"], lambda s: F.struct((w["pos"] + s["at"]).alias("place"), s["value"].alias("value")))))
    rows = rows.withColumn("values", F.array_distinct(F.transform(F.sort_array(placed), lambda s: s["value"])))
    shape = let(
        F.col("values"),
        lambda known: F.transform(
            "own",
            lambda w: F.struct(
                w["pos"].alias("pos"), w["hash"].alias("hash"), w["inside"].alias("inside"),
                F.transform(w["slots"], lambda s: F.struct(s["at"].alias("at"), F.array_position(known, s["value"]).alias("value"))).alias("slots"),
            ),
        ),
    )
    rows = rows.select(*ITEM, "values", F.sha2(F.to_json(shape), 256).alias("shape"))
    classes = rows.groupBy("shape").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct(*ITEM)).alias("first"))
    return written(rows.join(classes.filter(F.col("members") > COMMON), "shape").select(*ITEM, "first", "values"), "benchmark-classes")


def item_classes(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item, item_hash, first)``: items of large classes and the item, by id and hash, that stands for them."""
    return _classes(_all_windows(_items(benchmark, item_col, item_text_col))).select(F.col("item").alias(item_col), "item_hash", "first")


def benchmark_windows(items: DataFrame) -> DataFrame:
    """Windows of the items, with ``anchor`` where they are joined as they are; large classes by one item."""
    found = _all_windows(items)
    return _anchored(found, _classes(found))


def _anchored(found: DataFrame, classes: DataFrame) -> DataFrame:
    spare = _prefixed(classes.filter(~F.col("first").eqNullSafe(F.struct(*ITEM))).select(*ITEM), ITEM)
    found = found.join(spare, _same(found, spare, ITEM), "left_anti")
    shared = found.groupBy("hash").agg(F.countDistinct(F.struct(*ITEM)).alias("shared"))
    joined = written(found.join(shared, "hash"), "benchmark-shared")
    places = joined.groupBy(*ITEM, "pos").agg(F.max("shared").alias("most"), F.min("inside").alias("inside"))
    item = Window.partitionBy(*ITEM)
    rank = F.row_number().over(item.orderBy(F.desc("most"), "pos"))
    needed = F.least(F.lit(NEEDED), F.count_if(~F.col("inside")).over(item))
    spared = _prefixed(places.select(*ITEM, "pos", (rank < needed).alias("spared")), [*ITEM, "pos"])
    marked = joined.join(spared, _same(joined, spared, [*ITEM, "pos"]))
    anchor = (F.col("shared") <= COMMON) | ~F.col("spared")
    return written(marked.select(*ITEM, "pos", "hash", "slots", "inside", anchor.alias("anchor")), "benchmark-anchors")


def _matches(rows: DataFrame, item_windows: DataFrame) -> DataFrame:
    """Windows of documents that are an item's: by hash for anchors; the others where an anchor of the item was found."""
    named = [*DOC, *ITEM, "item_pos", "inside", "shift", "item_slots", "words"]
    right = item_windows.select("hash", *ITEM, "inside", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"), "anchor")
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    of_docs = _windows(rows, DOC, "text").drop("slotted")
    met = of_docs.join(right.filter("anchor"), "hash").withColumn("shift", shift).select(*named)
    common = right.filter(~F.col("anchor")).drop("anchor")
    if common.isEmpty():
        return met
    met = written(met, "leak-anchors")
    side = _prefixed(common, ITEM)
    hits = met.select(*DOC, *ITEM).distinct()
    # Only where the item has such a window at all: the others need no second look.
    wanted = hits.join(side, _same(hits, side, ITEM)).select(*DOC, *ITEM, "item_pos", "inside", "item_slots", "hash")
    touched = _prefixed(wanted.select(*DOC).distinct(), DOC)
    again = _windows(rows.join(touched, _same(rows, touched, DOC), "left_semi"), DOC, "text").drop("slotted")
    place = [*DOC, "hash"]
    again = _prefixed(again, place)
    others = wanted.join(again, _same(wanted, again, place)).withColumn("shift", shift)
    return met.unionByName(others.select(*named))


def _changed(pairs: Column) -> Column:
    """How many of a run's values are not the item's own."""
    return F.size(F.filter(pairs, lambda p: p["item"] != p["doc"]))


def _members(found: DataFrame, classes: DataFrame) -> DataFrame:
    """``found`` with a row for every item of a class; what was changed is told by the item's own values."""
    key = [F.col(f"first.{n}").alias(f"_first_{n}") for n in ITEM]
    firsts = classes.filter(F.col("first").eqNullSafe(F.struct(*ITEM))).select(F.col("first").alias("of"), F.col("values").alias("first_values"))
    members = _prefixed(classes, ITEM, "_own_").join(firsts, F.col("first").eqNullSafe(F.col("of")))
    members = members.select(*key, *[f"_own_{n}" for n in ITEM], "values", "first_values")
    joined = found.join(members, _same(found, members, ITEM, "_first_"), "left")
    own = F.col("values").isNotNull()

    def value(p: Column) -> Column:
        return F.get("values", (F.array_position("first_values", p["item"]) - 1).cast("int"))

    renamed = F.transform("runs", lambda r: F.transform(r, lambda p: F.struct(value(p).alias("item"), p["doc"].alias("doc"))))
    changed = F.array_max(F.transform(renamed, _changed)).cast("bigint")
    return joined.select(
        *DOC, *[F.when(own, F.col(f"_own_{n}")).otherwise(F.col(n)).alias(n) for n in ITEM], "windows", "item_windows", "slots",
        F.when(own, changed).otherwise(F.col("changed")).alias("changed"),
    )


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", every_item: bool = False,
) -> DataFrame:
    """``(id, hash, item, windows, item_windows, slots, changed, kind)``, one row a document and item that leaks by its template.

    ``hash`` is the text's, so that id and hash name a row where ids repeat. The benchmark's
    windows are written first: their size is then known, and Spark sends them to every task
    only if they are small. Items of a large class are one row, under the item that stands for them; with ``every_item``
    each has its own.
    """
    all_windows = _all_windows(_items(benchmark, item_col, item_text_col))
    classes = _classes(all_windows)
    every_item = every_item and not classes.isEmpty()
    item_windows = _anchored(all_windows, classes)
    needed = item_windows.filter(~F.col("inside")).groupBy(*ITEM).agg(F.countDistinct("pos").alias("item_windows"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    met = _matches(rows, item_windows)
    # Equal templates have their slots at the same places.
    pairs = F.transform(
        "item_slots",
        lambda s: F.struct(
            (F.col("item_pos") + s["at"]).alias("place"), F.struct(s["value"].alias("item"), F.get(F.col("words"), s["at"]).alias("doc")).alias("pair")
        ),
    )
    # A run has at most the item's windows, so what is gathered here is bounded by the item.
    runs = met.groupBy(*DOC, *ITEM, "shift").agg(F.collect_set(F.struct("item_pos", "inside", pairs.alias("pairs"))).alias("met"))
    own = _consistent(F.filter("met", lambda w: ~w["inside"]))
    runs = runs.withColumn("own", own)
    runs = runs.withColumn("met", F.concat("own", _fitting(F.filter("met", lambda w: w["inside"]), _pairs(F.col("own"))))).filter(F.size("met") > 0)
    runs = runs.select(*DOC, *ITEM, F.col("own.item_pos").alias("own"), F.col("met.item_pos").alias("places"), _pairs(F.col("met")).alias("pairs"))

    def places(name: str) -> Column:
        return F.size(F.array_distinct(F.flatten(F.collect_list(name)))).cast("bigint")

    found = runs.groupBy(*DOC, *ITEM).agg(
        places("own").alias("own"), places("places").alias("all"),
        F.max(F.size("pairs")).cast("bigint").alias("slots"),
        F.max(_changed(F.col("pairs"))).cast("bigint").alias("changed"),
        *([F.collect_set("pairs").alias("runs")] if every_item else []),
    )
    needed = _prefixed(needed, ITEM)
    least = F.least(F.lit(NEEDED), F.col("item_windows"))
    enough = found.join(needed, _same(found, needed, ITEM)).filter(F.col("all") >= least)
    enough = enough.withColumn("windows", F.when(F.col("own") >= least, F.col("own")).otherwise(F.col("all")))
    if every_item:
        enough = _members(enough, classes)
    names = ["windows", "item_windows", "slots", "changed"]
    best = enough.groupBy(*DOC, "item").agg(F.max(F.struct(*names)).alias("best"))
    kind = F.when(F.col("best.changed") > 0, "reparameterised").otherwise("verbatim")
    return best.select(F.col("id").alias(id_col), "text_hash", F.col("item").alias(item_col), "best.*", kind.alias("kind"))


def _plain_words(text: Column) -> Column:
    marked = F.regexp_replace(marked_text(text), NAME, "")
    return words(marked, F.lit(True))


def whole_item_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Like :func:`leaks`, for the items that have no template window: the same plain words in a row, all of them.

    Documents are read once for each length of window that these items need (five to eight words), and not
    at all if there are none.
    """
    items = _items(benchmark, item_col, item_text_col)
    usable = _prefixed(benchmark_usable(items), ITEM)
    left = items.join(usable, _same(items, usable, ITEM), "left_anti").select(*ITEM, _plain_words(F.col("text")).alias("words"))
    left = written(left.withColumn("n_words", F.size("words")).filter("n_words > 0"), "benchmark-whole")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    widths = [r[0] for r in left.select(F.least("n_words", F.lit(WINDOW)).alias("width")).distinct().collect()]
    none = F.lit(0).cast("bigint")
    kind = dict(rows.dtypes)["id"]
    found = left.select(F.lit(None).cast(kind).alias("id"), none.alias("text_hash"), "item", none.alias("windows")).filter(F.lit(False))
    whole = F.sha2(F.concat_ws(" ", "words"), 256).alias("whole")
    if any(w < SHORTEST for w in widths):
        alone = left.filter(F.col("n_words") < SHORTEST).select(*ITEM, whole)
        # A text that is no longer than these words can be is all that need be looked at.
        of_docs = rows.select(*DOC, _plain_words(F.col("text")).alias("words")).filter(F.size("words").between(1, SHORTEST - 1))
        found = found.unionByName(of_docs.select(*DOC, whole).distinct().join(alone, "whole").select(*DOC, "item", F.lit(1).cast("bigint").alias("windows")))
    for width in sorted(w for w in widths if w >= SHORTEST):
        own = left.filter(F.least("n_words", F.lit(WINDOW)) == width)
        right = own.select(*ITEM, (F.col("n_words") - width + 1).alias("needed"), F.posexplode(_hashed_windows(F.col("words"), width)).alias("item_pos", "hash"))
        right = written(right, "benchmark-plain")
        # Every piece has its own windows: the words of the next that its last windows need are in it too.
        cut = F.transform(
            F.sequence(F.lit(0), F.floor((F.size("all") - width) / PIECE).cast("int")), lambda p: F.slice("all", p * PIECE + 1, PIECE + width - 1)
        )
        pieces = rows.select(*DOC, _plain_words(F.col("text")).alias("all")).select(
            *DOC, F.posexplode(F.when(F.size("all") >= width, cut)).alias("piece", "words")
        )
        left_windows = pieces.select(*DOC, "piece", F.posexplode(_hashed_windows(F.col("words"), width)).alias("first", "hash"))
        met = left_windows.join(right, "hash").select(
            *DOC, *ITEM, "needed", "item_pos", (F.col("piece") * PIECE + F.col("first") - F.col("item_pos")).alias("shift")
        )
        runs = met.groupBy(*DOC, *ITEM, "needed", "shift").agg(F.countDistinct("item_pos").alias("windows"))
        found = found.unionByName(runs.filter(F.col("windows") == F.col("needed")).select(*DOC, "item", "windows"))
    best = found.groupBy(*DOC, "item").agg(F.max("windows").alias("windows"))
    zero = F.lit(0).cast("bigint")
    return best.select(
        F.col("id").alias(id_col), "text_hash", F.col("item").alias(item_col), "windows", F.col("windows").alias("item_windows"),
        zero.alias("slots"), zero.alias("changed"), F.lit("verbatim").alias("kind"),
    )


def _hashed_windows(all_: Column, width: int) -> Column:
    """Hashes of the windows of ``width`` words of an array."""
    shifted = [F.slice(all_, i + 1, F.size(all_)).alias(f"w{i}") for i in range(width)]
    full = F.slice(F.arrays_zip(*shifted), 1, F.greatest(F.size(all_) - width + 1, F.lit(0)))
    return F.transform(full, lambda z: F.xxhash64(*[z[f"w{i}"] for i in range(width)]))


def benchmark_usable(items: DataFrame) -> DataFrame:
    """The items that have a template window that counts."""
    found = _windows(items, ITEM, "text").select(*ITEM, _slots(F.col("words"), F.col("slotted")).alias("slots"))
    return found.filter(F.size("slots") <= WINDOW // 2).select(*ITEM).distinct()


def all_leaks(docs: DataFrame, benchmark: DataFrame, every_item: bool = False, **columns) -> DataFrame:
    """Leaks by template and, of items without one, as a whole."""
    return leaks(docs, benchmark, every_item=every_item, **columns).unionByName(whole_item_leaks(docs, benchmark, **columns))


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that leak no item."""
    found = all_leaks(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    key, hash_ = fresh_name(docs, "_key"), fresh_name(docs, "_hash")
    keys = written(found.select(F.col(id_col).alias(key), F.col("text_hash").alias(hash_)).distinct(), "leaking-keys")
    return docs.join(keys, F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(text_col) == F.col(hash_)), "left_anti")
