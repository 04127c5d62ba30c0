"""Reversible line dedup: sharded cuckoo filters over exact reference-count tables.

An index in the shared folder holds, per operation, what changed:

- ``references``: one row ``(shard, key, doc, change)`` per distinct line and document that came or
  went. A document refers to a line while its changes add up to more than 0; a line's reference
  count is the number of such documents. These tables are the truth.
- ``filters``: per shard a chain of cuckoo tables with a 16-bit mark of every line whose reference
  count is ``min_docs`` or more. Marks are added when a count reaches that number and taken out when a deletion
  brings it below, so the lines of a deleted document's neighbours come back.

Reading sends a line's key past the filter of its shard. A miss is final: the line stays. Only
what may be marked is looked up in the exact counts, which decide.

Sums are made per (line, document), then per line, so a line that a third of all documents
hold meets as partial counts. For the probe a shard is dealt over ``SALTS`` tasks with a copy of
its filter each. An operation counts once its row in ``operations`` is written; what a lost
driver left behind before that is not read.

Defined results: null or empty text is one empty line; a document is all rows with one id (null
is an id, below all others), so inserting it twice counts once and one deletion takes it out; rows
with one id and different texts hold the lines of all of them; documents that the index does not
hold are judged by it like any other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.common import fresh_name, let, written
from staylens.session import scratch_dir

MIN_DOCS, MIN_CHARS = 3, 20
SHARDS, SALTS, LINES_PER_SHARD = 64, 8, 1 << 20
#: Size of one cuckoo table: buckets (a power of two) of four 16-bit marks. Fuller ones start another table.
BUCKETS, SLOTS, MOST_KICKS = 1 << 12, 4, 200

_BLANK = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space, ASCII capitals lowered."""
    return F.translate(F.trim(line, F.lit(_BLANK)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``(doc, text_key, pos, key)`` of every line long enough to count; the key is 128 bits of its SHA-256."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = docs.select(F.col(id_col).alias("doc"), F.md5(text).alias("text_key"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keyed = lines.select("doc", "text_key", "pos", line_key(F.col("line")).alias("line")).filter(F.length("line") >= min_chars)
    return keyed.select("doc", "text_key", "pos", F.unhex(F.substring(F.sha2("line", 256), 1, 32)).alias("key"))


class CuckooTables:
    """A chain of cuckoo tables of one size; marks may be taken out again."""

    def __init__(self, packed: bytes = b"") -> None:
        size = BUCKETS * SLOTS
        flat = np.frombuffer(packed, np.uint16)
        self.tables = [flat[i : i + size].reshape(BUCKETS, SLOTS).copy() for i in range(0, len(flat), size)]

    def pack(self) -> bytes:
        return b"".join(t.tobytes() for t in self.tables)

    @staticmethod
    def places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mark and both buckets of keys given as rows of two 64-bit numbers."""
        mark = (keys[:, 0] & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        one = ((keys[:, 0] >> np.uint64(16)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        return mark, one, CuckooTables._other(one, mark)

    @staticmethod
    def _other(bucket, mark):
        """The other bucket follows from this one and the mark alone, so a mark can move without its key."""
        return bucket ^ ((mark.astype(np.int64) * 0x5BD1E995 >> 7) & (BUCKETS - 1))

    def holds(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(keys)
        found = np.zeros(len(keys), bool)
        for t in self.tables:
            found |= (t[one] == mark[:, None]).any(axis=1) | (t[two] == mark[:, None]).any(axis=1)
        return found

    def _put(self, table: np.ndarray, mark: np.uint16, bucket: int) -> np.uint16 | None:
        """Put a mark in, moving others; the mark left over if the table is full."""
        for bucket in (bucket, int(self._other(bucket, mark))):
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = mark
                return None
        moved = []
        for kick in range(MOST_KICKS):
            slot = kick % SLOTS
            moved.append((bucket, slot, mark))
            mark, table[bucket, slot] = table[bucket, slot], mark
            bucket = int(self._other(bucket, mark))
            free = np.flatnonzero(table[bucket] == 0)
            if len(free):
                table[bucket, free[0]] = mark
                return None
        for bucket, slot, put in reversed(moved):  # as it was before
            mark, table[bucket, slot] = table[bucket, slot], mark
        return mark

    def add(self, keys: np.ndarray) -> None:
        mark, one, _ = self.places(keys)
        for m, bucket in zip(mark, one.tolist()):
            if not self.tables or self._put(self.tables[-1], m, bucket) is not None:
                self.tables.append(np.zeros((BUCKETS, SLOTS), np.uint16))
                self._put(self.tables[-1], m, bucket)

    def take_out(self, keys: np.ndarray) -> None:
        """Only for keys that were added: one equal mark in either bucket stands for the key."""
        for m, one, two in zip(*[p.tolist() for p in self.places(keys)]):
            for table, bucket in ((t, b) for t in self.tables for b in (one, two)):
                at = np.flatnonzero(table[bucket] == m)
                if len(at):
                    table[bucket, at[0]] = 0
                    break


def _numbers(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)


@dataclass(frozen=True)
class LineIndex:
    """An index as of one operation."""

    spark: SparkSession
    path: str
    id_type: str
    operation: int = 0
    min_docs: int = MIN_DOCS
    shards: int = SHARDS

    def shard(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.shards)).cast("int")

    def _read(self, name: str, schema: str) -> DataFrame:
        rows = self.spark.read.schema(f"{schema}, operation int").parquet(f"{self.path}/{name}")
        return rows.filter(F.col("operation") <= self.operation)

    def references(self) -> DataFrame:
        return self._read("references", f"shard int, key binary, doc {self.id_type}, change bigint")

    def filters(self) -> DataFrame:
        """The newest filter of every shard."""
        rows = self._read("filters", "shard int, marks binary")
        return rows.groupBy("shard").agg(F.max_by("marks", "operation").alias("marks"))

    def counts(self) -> DataFrame:
        """Exact ``(key, n_docs, top_doc)`` of all lines that a document refers to."""
        live = self.references().groupBy("key", "doc").agg(F.sum("change").alias("n")).filter("n > 0")
        return live.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("top_doc"))


def create(spark: SparkSession, path: str, id_type: str = "bigint", min_docs: int = MIN_DOCS, shards: int = SHARDS) -> LineIndex:
    """An empty index."""
    index = LineIndex(spark, path, id_type, 0, min_docs, shards)
    empty = spark.range(0)
    for name, schema in (("references", f"shard int, key binary, doc {id_type}, change bigint"), ("filters", "shard int, marks binary")):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{name}/operation=0")
    empty.selectExpr("CAST(id AS INT) AS number").write.mode("overwrite").parquet(f"{path}/operations/operation=0")
    settings = [(id_type, min_docs, shards)]
    spark.createDataFrame(settings, "id_type string, min_docs int, shards int").write.mode("overwrite").parquet(f"{path}/settings")
    return index


def open_index(spark: SparkSession, path: str) -> LineIndex:
    """The index after its last whole operation."""
    settings = spark.read.parquet(f"{path}/settings").first()
    done = spark.read.schema("number int, operation int").parquet(f"{path}/operations").agg(F.max("number")).first()[0]
    return LineIndex(spark, path, settings["id_type"], done or 0, settings["min_docs"], settings["shards"])


def _commit(index: LineIndex, changes: DataFrame) -> LineIndex:
    """Write ``changes`` (key, doc, change) as the next operation and bring the filters up to date."""
    new = replace(index, operation=index.operation + 1)
    number, least = new.operation, index.min_docs
    shaped = changes.select(index.shard(F.col("key")).alias("shard"), "key", F.col("doc").cast(index.id_type).alias("doc"), F.col("change").cast("bigint").alias("change"))
    shaped.write.mode("overwrite").parquet(f"{index.path}/references/operation={number}")
    rows = new.references()
    if index.operation:  # only lines that this operation touches can cross the threshold
        touched = rows.filter(F.col("operation") == number).select("key").distinct()
        rows = rows.join(touched, "key", "left_semi")
    per_doc = rows.groupBy("shard", "key", "doc").agg(
        F.sum(F.when(F.col("operation") < number, F.col("change")).otherwise(0)).alias("before"), F.sum("change").alias("after")
    )
    per_key = per_doc.groupBy("shard", "key").agg(F.count_if(F.col("before") > 0).alias("before"), F.count_if(F.col("after") > 0).alias("after"))
    crossed = per_key.filter((F.col("before") >= least) != (F.col("after") >= least))
    crossed = crossed.select("shard", "key", (F.col("after") >= least).alias("marked"))

    def updated(key: tuple, old: pd.DataFrame, turned: pd.DataFrame) -> pd.DataFrame:
        if turned.empty:
            return pd.DataFrame({"shard": [], "marks": []})
        tables = CuckooTables(old["marks"].iloc[0] if len(old) else b"")
        turned = turned.sort_values("key")
        tables.take_out(_numbers(turned.loc[~turned["marked"], "key"]))
        tables.add(_numbers(turned.loc[turned["marked"], "key"]))
        return pd.DataFrame({"shard": [key[0]], "marks": [tables.pack()]})

    joined = index.filters().groupBy("shard").cogroup(crossed.groupBy("shard"))
    joined.applyInPandas(updated, "shard int, marks binary").write.mode("overwrite").parquet(f"{index.path}/filters/operation={number}")
    done = index.spark.range(1).select(F.lit(number).cast("int").alias("number"))
    done.write.mode("overwrite").parquet(f"{index.path}/operations/operation={number}")
    return new


def insert_lines(index: LineIndex, lines: DataFrame) -> LineIndex:
    """Add the documents whose lines (see :func:`lines_of`) are given."""
    return _commit(index, lines.select("key", "doc").distinct().withColumn("change", F.lit(1)))


def insert(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
    return insert_lines(index, lines_of(docs, id_col, text_col))


def delete(index: LineIndex, ids: DataFrame, id_col: str = "doc_id") -> LineIndex:
    """Take out the documents with these ids; ids that the index does not hold change nothing."""
    gone = ids.select(F.col(id_col).cast(index.id_type).alias("_gone")).distinct()
    live = index.references().groupBy("key", "doc").agg(F.sum("change").alias("n")).filter("n > 0")
    doomed = live.join(gone, F.col("doc").eqNullSafe(F.col("_gone")), "left_semi")
    return _commit(index, written(doomed.select("key", "doc", (-F.col("n")).alias("change")), "line-deletions"))


def probed(index: LineIndex, lines: DataFrame) -> DataFrame:
    """Lines whose key may be marked. Filter rows come first in every (shard, salt), then its lines."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    kind = lines.schema["doc"].dataType.simpleString()
    filters = index.filters().select(
        "shard", salts.alias("salt"), "marks", F.lit(None).cast(kind).alias("doc"), F.lit(None).cast("string").alias("text_key"),
        F.lit(-1).alias("pos"), F.lit(None).cast("binary").alias("key"),
    )
    asked = lines.select(
        index.shard(F.col("key")).alias("shard"), F.pmod(F.xxhash64("doc", "text_key", "pos"), F.lit(SALTS)).cast("int").alias("salt"),
        F.lit(None).cast("binary").alias("marks"), "doc", "text_key", "pos", "key",
    )
    dealt = filters.unionByName(asked).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "pos")
    schema = f"doc {kind}, text_key string, pos int, key binary"

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, tables = None, None
        for batch in batches:
            shard, salt, pos = (batch.column(i).to_numpy() for i in (0, 1, 5))
            names = shard.astype(np.int64) * SALTS + salt
            edges = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]) | (pos[:-1] < 0)]))
            keep = np.zeros(len(pos), bool)
            for a, b in zip(edges, [*edges[1:], len(pos)]):
                if pos[a] < 0:
                    place, tables = names[a], CuckooTables(batch.column(2)[int(a)].as_py())
                elif names[a] == place:
                    keep[a:b] = tables.holds(_numbers(batch.column(6).slice(a, b - a).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in (3, 4, 5, 6)], ["doc", "text_key", "pos", "key"]).filter(pa.array(keep))

    return dealt.mapInArrow(passed, schema)


def dropped_lines(index: LineIndex, lines: DataFrame) -> DataFrame:
    """``(doc, text_key, positions)``: lines held by ``min_docs`` documents or more, save the largest id's.

    The exact counts of such lines are written, so that the join with them is one of two plain
    tables: Spark broadcasts the counts while they are small, and parts hot keys otherwise.
    """
    exact = index.counts().filter(F.col("n_docs") >= index.min_docs).select(F.col("key").alias("_key"), "top_doc")
    exact = written(exact, "line-counts")
    hits = probed(index, lines).join(exact, F.col("key") == F.col("_key"))
    gone = hits.filter(~F.col("doc").eqNullSafe(F.col("top_doc"))).select("doc", "text_key", "pos").distinct()
    return gone.groupBy("doc", "text_key").agg(F.collect_list("pos").alias("positions"))


def cleaned(
    index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: DataFrame | None = None
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the text that stays, the number of lines and of dropped ones; and the names of the new columns."""
    names = {n: fresh_name(docs, n) for n in ("kept_text", "n_lines", "n_dropped")}
    gone = dropped_lines(index, lines_of(docs, id_col, text_col) if lines is None else lines)
    gone = gone.select(F.col("doc").alias("_line_doc"), F.col("text_key").alias("_line_text"), F.col("positions").alias("_line_gone"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.join(gone, F.col(id_col).eqNullSafe(F.col("_line_doc")) & (F.md5(text) == F.col("_line_text")), "left")
    parts = F.split(text, "\n")
    left = let(
        parts,
        lambda all_: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(all_) - 1), F.col("_line_gone")), lambda i: F.get(all_, i)), "\n"
        ),
    )
    found = joined.select(
        *[docs[c] for c in docs.columns],
        F.when(F.col("_line_gone").isNull(), text).otherwise(left).alias(names["kept_text"]),
        F.size(parts).cast("bigint").alias(names["n_lines"]),
        F.coalesce(F.size("_line_gone"), F.lit(0)).cast("bigint").alias(names["n_dropped"]),
    )
    return found, names


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> tuple[DataFrame, dict[str, str]]:
    """:func:`cleaned` by an index of these documents alone, with a shard for every million lines."""
    spark = docs.sparkSession
    lines = written(lines_of(docs, id_col, text_col), "line-keys")
    settings = {"shards": max(SHARDS, lines.count() // LINES_PER_SHARD)} | settings
    index = create(spark, scratch_dir(spark, "line-index"), dict(docs.dtypes)[id_col], **settings)
    return cleaned(insert_lines(index, lines), docs, id_col, text_col, lines)
