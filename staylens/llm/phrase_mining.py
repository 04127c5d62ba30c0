"""Collocations by SETM: sorted occurrence relations, joined with themselves at adjacent positions.

The relation of length k holds the occurrences of frequent phrases of k words, in order of piece
and position. It is kept as runs: a run is a stretch of adjacent occurrences within one piece,
stored as the keys of its words, so the merge join of the relation with itself on (piece,
position + 1) is a walk along each run and needs no shuffle. Each length does the same steps:

1. merge-join: the windows of k + 1 words of all runs;
2. group-count: windows are counted per task, the counts are shuffled and added;
3. semi-join: occurrences of infrequent phrases go, which cuts the runs into shorter ones, and
   the next relation is written.

The semi-join runs in place against a filter of at most ``FILTER_BITS`` bits of the frequent phrases. It
never loses a frequent one. It may let an infrequent one through, which costs a window and changes
no result: every count is exact, and only counted phrases with enough occurrences come out.

Words stand for themselves as 64-bit hashes of language and word. Whether two words share a hash
is tested over all words of the corpus, and another seed taken until none do: keys are exact.

Defined results: null text is empty; null languages count as ``und``; a text without words gives
nothing; a table without frequent phrases gives no rows; repeated rows count each time.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.session import scratch_dir

UNKNOWN = "und"
MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
#: A candidate goes if a longer one has at least this share of its occurrences, in percent.
COVERED = 50
SCALE = 1_000_000
#: Bits of the semi-join's filter at most (32 MB), and bits a phrase while fewer are needed.
FILTER_BITS, BITS_EACH = 1 << 28, 16
#: Words of a run in one row; windows and words that a task counts before it sends them on.
RUN, BUFFER, WORD_BUFFER = 1 << 11, 1 << 21, 1 << 19
#: Words whose keys a task remembers.
KNOWN_WORDS = 1 << 19
#: Parts in which a language's phrases are ranked before its best meet.
PARTS = 64

_FOLD = bytes.maketrans(bytes(range(65, 91)) + b".,;:!?\x0b\x0c\r\t", bytes(range(97, 123)) + b"\n" * 9 + b" ")
_RUNS = "piece bigint, first bigint, own int, words array<bigint>"


def _pieces(text: str | None) -> Iterator[list[bytes]]:
    """Words of each piece: only ASCII letters, separators and blanks are touched, so bytes will do."""
    for piece in (text or "").encode().translate(_FOLD).split(b"\n"):
        words = [w for w in piece.split(b" ") if w]
        if words:
            yield words


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, str | None]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, n)`` over rows ``(lang, text)``, counted per task first."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[bytes, int]] = {}
        held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, own in counts.items():
                words = pa.array(list(own), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), words, pa.array(list(own.values()), pa.int64())], ["lang", "word", "n"]
                )
            counts.clear()

        for lang, text in _texts(batches):
            own = counts.setdefault(lang, {})
            held -= len(own)
            for words in _pieces(text):
                for w in words:
                    own[w] = own.get(w, 0) + 1
            held += len(own)
            if held >= WORD_BUFFER:
                yield from sent()
                held = 0
        yield from sent()

    return docs.mapInArrow(counted, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _key(seed: int):
    return F.xxhash64(F.lit(str(seed)), "lang", "word")


def _python_key(seed: int):
    """The same hash in a task, with each language's words seen lately at hand."""
    import xxhash

    known: dict[str, dict[bytes, int]] = {}
    size = 0
    base = xxhash.xxh64_intdigest(str(seed).encode(), 42)

    def keys(lang: str, words: list[bytes]) -> list[int]:
        nonlocal size
        if size > KNOWN_WORDS:
            known.clear()
            size = 0
        own = known.setdefault(lang, {})
        try:
            return [own[w] for w in words]
        except KeyError:
            start = xxhash.xxh64_intdigest(lang.encode(), base)
            size -= len(own)
            for w in words:
                if w not in own:
                    key = xxhash.xxh64_intdigest(w, start)
                    own[w] = key - (1 << 64) if key >> 63 else key
            size += len(own)
            return [own[w] for w in words]

    return keys


def exact_seed(words: DataFrame) -> int:
    """A seed under which no two of the words share a key."""
    seed = 0
    while True:
        if words.groupBy(_key(seed).alias("key")).count().filter("count > 1").isEmpty():
            return seed
        seed += 1


def _slots(columns: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a filter of ``bits`` (a power of two) for each phrase, from its word keys."""
    with np.errstate(over="ignore"):
        h = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            h = (h ^ c.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h & np.uint64(bits - 1), (h >> np.uint64(36)) & np.uint64(bits - 1)


def frequent_filter(frequent: DataFrame, k: int) -> np.ndarray:
    """Bytes of a filter that holds every row of ``frequent`` (columns w1..wk): at most FILTER_BITS bits reach the driver."""
    wanted = max(1, frequent.count()) * BITS_EACH
    bits = 1 << 16
    while bits < min(wanted, FILTER_BITS):
        bits *= 2
    page = 1 << 13  # bytes of one row of the result
    names = [f"w{i + 1}" for i in range(k)]

    def pages(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own: dict[int, np.ndarray] = {}
        for part in parts:
            if part.empty:
                continue
            at = np.unique(np.concatenate(_slots([part[c].to_numpy() for c in names], bits)).astype(np.int64))
            for number in np.unique(at >> 16).tolist():
                inside = at[at >> 16 == number] & 0xFFFF
                np.bitwise_or.at(own.setdefault(number, np.zeros(page, np.uint8)), inside >> 3, np.left_shift(1, inside & 7).astype(np.uint8))
        yield pd.DataFrame({"page": list(own), "bits": [v.tobytes() for v in own.values()]})

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(page, np.uint8)
        for bits_ in group["bits"]:
            total |= np.frombuffer(bits_, np.uint8)
        return pd.DataFrame({"page": [group["page"].iloc[0]], "bits": [total.tobytes()]})

    schema = "page bigint, bits binary"
    found = frequent.select(*names).mapInPandas(pages, schema).groupBy("page").applyInPandas(merged, schema)
    table = np.zeros(bits >> 3, np.uint8)
    for row in found.collect():
        table[row["page"] * page : (row["page"] + 1) * page] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return table


def _holds(table: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    one, two = _slots(columns, len(table) << 3)

    def bit(at: np.ndarray) -> np.ndarray:
        return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1

    return (bit(one) & bit(two)).astype(bool)


def _batch(piece: np.ndarray, first: np.ndarray, own: np.ndarray, starts: np.ndarray, stops: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    """Runs as a batch: run i holds values[starts[i]:stops[i]]."""
    sizes = stops - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    words = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values[index]))
    return pa.RecordBatch.from_arrays(
        [pa.array(piece), pa.array(first), pa.array(own.astype(np.int32)), words], ["piece", "first", "own", "words"]
    )


def _cut(alive: np.ndarray, row: np.ndarray, pos: np.ndarray, own: np.ndarray, k: int):
    """Runs of surviving occurrences of k words: (their row, start and stop in the flat words, own starts).

    ``own`` counts the positions of a row that are its own; the rest repeats the next row's words.
    A run of occurrences from a to b spans the words from a to b + k - 1. Occurrences without a
    neighbour are in no longer phrase and go too.
    """
    edge = np.flatnonzero(alive & np.concatenate([[True], ~alive[:-1] | (row[1:] != row[:-1])]))
    last = np.flatnonzero(alive & np.concatenate([~alive[1:] | (row[1:] != row[:-1]), [True]]))
    owned = np.minimum(own[row[edge]] - pos[edge], last - edge + 1)
    kept = (owned > 0) & (last > edge)
    edge, last, owned = edge[kept], last[kept], owned[kept]
    return row[edge], edge, last + k, owned


def _flat(batch: pa.RecordBatch):
    """Flat words of a batch's runs, with each word's row and its position in the row; and words left from it on."""
    lists = batch.column(3)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    pos = np.arange(len(values)) - offsets[row]
    return values, row, pos, sizes[row] - pos


def first_relation(docs: DataFrame, table: np.ndarray, seed: int, max_words: int = MAX_WORDS) -> DataFrame:
    """Runs of frequent words, from rows ``(lang, text)``. A row has up to RUN own words and the max_words - 1 that follow."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, number = _python_key(seed), TaskContext.get().partitionId() << 40
        held = array("q")
        spans: list[tuple[int, int, int, int]] = []  # piece, first position, own, size

        def sent() -> Iterator[pa.RecordBatch]:
            if not spans:
                return
            values = np.array(held)
            piece, first, own, sizes = (np.array(x, np.int64) for x in zip(*spans))
            row = np.repeat(np.arange(len(sizes)), sizes)
            pos = np.arange(len(values)) - (np.cumsum(sizes) - sizes)[row]
            row, start, stop, owned = _cut(_holds(shared.value, [values]), row, pos, own, 1)
            del held[:]
            spans.clear()
            if len(row):
                yield _batch(piece[row], first[row] + pos[start], owned, start, stop, values)

        for lang, text in _texts(batches):
            for words in _pieces(text):
                number += 1
                if len(words) < 2:
                    continue
                found = keys(lang, words)
                for at in range(0, len(found), RUN):
                    part = found[at : at + RUN + max_words - 1]
                    held.fromlist(part)
                    spans.append((number, at, min(RUN, len(part)), len(part)))
                    if len(held) >= BUFFER:
                        yield from sent()
        yield from sent()

    return docs.mapInArrow(runs, _RUNS)


def next_relation(relation: DataFrame, table: np.ndarray, k: int) -> DataFrame:
    """R(k) from R(k-1): the semi-join with frequent phrases of ``k`` words."""
    shared = relation.sparkSession.sparkContext.broadcast(table)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, row, pos, left = _flat(batch)
            if len(values) < k:
                continue
            piece, first, own = (batch.column(i).to_numpy() for i in range(3))
            alive = np.zeros(len(values), bool)
            at = np.flatnonzero(left >= k)
            alive[at] = _holds(shared.value, [values[at + i] for i in range(k)])
            row, start, stop, owned = _cut(alive, row, pos, own, k)
            if len(row):
                yield _batch(piece[row], first[row] + pos[start], owned, start, stop, values)

    return relation.mapInArrow(runs, _RUNS)


def window_counts(relation: DataFrame, k: int) -> DataFrame:
    """``(w1, .., wk, n)``: the merge join at adjacent positions, counted per task, then over all."""
    names = [f"w{i + 1}" for i in range(k)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held)]
            order = np.lexsort(columns)
            columns = [c[order] for c in columns]
            fresh = np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])
            at = np.flatnonzero(fresh)
            n = np.diff(np.concatenate([at, [len(order)]]))
            held.clear()
            yield pa.RecordBatch.from_arrays([*[pa.array(c[at]) for c in columns], pa.array(n)], [*names, "n"])

        for batch in batches:
            values, row, pos, left = _flat(batch)
            at = np.flatnonzero((left >= k) & (pos < batch.column(2).to_numpy()[row]))
            if len(at):
                held.append([values[at + i] for i in range(k)])
                size += len(at)
            if size >= BUFFER:
                yield from sent()
                size = 0
        if held:
            yield from sent()

    schema = ", ".join(f"{c} bigint" for c in [*names, "n"])
    return relation.mapInArrow(counted, schema).groupBy(*names).agg(F.sum("n").alias("n"))


def _kept(df: DataFrame, label: str, dictionary: bool = False) -> DataFrame:
    """``df`` written and reread; runs repeat their words, so a dictionary a row group makes them short."""
    path = scratch_dir(df.sparkSession, label)
    writer = df.write
    if dictionary:
        writer = writer.option("parquet.block.size", 32 << 20).option("parquet.dictionary.page.size", 8 << 20)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def frequent_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS
) -> tuple[DataFrame, dict[int, DataFrame]]:
    """All words ``(lang, word, key, n)`` and the frequent phrases ``(w1, .., wk, n)`` by length."""
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    words = _kept(word_counts(rows), "phrase-words")
    seed = exact_seed(words)
    words = words.withColumn("key", _key(seed))
    frequent = {1: words.filter(F.col("n") >= min_count).select(F.col("key").alias("w1"), "n")}
    relation = _kept(first_relation(rows, frequent_filter(frequent[1], 1), seed, max_words), "phrase-occurrences", True)
    for k in range(2, max_words + 1):
        counts = window_counts(relation, k).filter(F.col("n") >= min_count)
        frequent[k] = _kept(counts, f"phrase-frequent-{k}")
        if k < max_words:
            relation = _kept(next_relation(relation, frequent_filter(frequent[k], k), k), "phrase-occurrences", True)
    return words, frequent


def _with_counts(phrases: DataFrame, part: DataFrame, size: int, start: int, name: str) -> DataFrame:
    """Add the count of the ``size`` words from ``start`` on. Parts of frequent phrases are frequent."""
    on = {f"w{i + 1}": f"w{start + i}" for i in range(size)}
    side = part.withColumnsRenamed({**{c: f"_{c}" for c in on}, "n": name})
    test = F.lit(True)
    for c, other in on.items():
        test = test & (F.col(f"_{c}") == F.col(other))
    return phrases.join(side, test).drop(*[f"_{c}" for c in on])


def scored(frequent: dict[int, DataFrame], k: int) -> DataFrame:
    """Phrases of ``k`` words with a, the lowest-scoring cut's l and r, and its score."""
    found = frequent[k].withColumnRenamed("n", "a")
    for cut in range(1, k):
        found = _with_counts(found, frequent[cut], cut, 1, f"_l{cut}")
        found = _with_counts(found, frequent[k - cut], k - cut, cut + 1, f"_r{cut}")
    wide = T.DecimalType(38, 0)
    cuts = []
    for cut in range(1, k):
        top = F.lit(SCALE).cast(wide) * F.col("a").cast("decimal(15,0)") * F.col("a").cast("decimal(15,0)")
        below = F.col(f"_l{cut}").cast("decimal(19,0)") * F.col(f"_r{cut}").cast("decimal(19,0)")
        score = F.call_function("div", top.cast(wide), below.cast(wide))
        cuts.append(F.struct(score.alias("score"), F.lit(cut).alias("cut"), F.col(f"_l{cut}").alias("l"), F.col(f"_r{cut}").alias("r")))
    best = F.array_min(F.array(*cuts)).alias("best")
    names = [f"w{i + 1}" for i in range(k)]
    return found.select(*names, "a", best).select(*names, "a", "best.l", "best.r", "best.score")


def uncovered(phrases: DataFrame, frequent: dict[int, DataFrame], k: int, covered: int = COVERED) -> DataFrame:
    """Phrases of ``k`` words that no longer candidate has within it at ``covered`` percent of their occurrences."""
    names = [f"w{i + 1}" for i in range(k)]
    inside = None
    for longer, table in frequent.items():
        for start in range(longer - k + 1 if longer > k else 0):
            part = table.select(*[F.col(f"w{start + i + 1}").alias(f"_{names[i]}") for i in range(k)], F.col("n").alias("_most"))
            inside = part if inside is None else inside.unionByName(part)
    if inside is None:
        return phrases
    others = [f"_{c}" for c in names]
    most = inside.groupBy(*others).agg(F.max("_most").alias("_most"))
    test = F.lit(True)
    for c in names:
        test = test & (F.col(f"_{c}") == F.col(c))
    joined = phrases.join(most, test, "left")
    return joined.filter(F.col("_most").isNull() | (100 * F.col("_most") < covered * F.col("a"))).drop(*others, "_most")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS, top: int = TOP, covered: int = COVERED,
) -> DataFrame:
    """Each language's best phrases: ``(lang, rank, phrase, a, l, r, n, score)``."""
    words, frequent = frequent_phrases(docs, text_col, lang_col, min_count, max_words)
    spelled = words.filter(F.col("n") >= min_count).select("key", "word", "lang")
    tables = []
    for k in range(2, max_words + 1):
        found = uncovered(scored(frequent, k), frequent, k, covered)
        for i in range(k):
            side = spelled.select(F.col("key").alias("_key"), F.col("word").alias(f"_s{i}"), *([F.col("lang")] if i == 0 else []))
            found = found.join(side, F.col("_key") == F.col(f"w{i + 1}")).drop("_key")
        phrase = F.concat_ws(" ", *[F.col(f"_s{i}") for i in range(k)])
        tables.append(found.select("lang", phrase.alias("phrase"), "a", "l", "r", "score"))
    phrases = tables[0]
    for t in tables[1:]:
        phrases = phrases.unionByName(t)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))  # the best of all are among the best of each part
    best = phrases.withColumn("_part", part)
    for within in (["lang", "_part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
        best = best.withColumn("rank", place).filter(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    joined = best.join(sizes.withColumnRenamed("lang", "_lang"), F.col("lang") == F.col("_lang"))
    return joined.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
