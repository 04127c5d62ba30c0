"""Token ids as length-delimited binary records with an offset index.

A record file holds, for each document: payload length (u64), masked checksum of those eight
bytes (u32), payload, masked checksum of the payload (u32), all little-endian. The payload is
the document id (i64; its flag says whether there is one), the width of an id in bytes, and the
ids. The index file beside it has one entry of 32 bytes a record: offset (u64), framed length
(u64), number of ids (u64), ids before it in this file (u64). So a reader that shuffles can
fetch any record with one seek. Checksums are zlib's CRC-32, rotated right by 15 bits and
shifted by a constant, so that a checksum stored inside data does not check itself.

Files are written by tasks straight into the shared folder under names that no other attempt
uses; the list of files that count goes through Spark's own commit, so a lost or repeated task
leaves at worst a file that nobody lists.

Defined results: null text is encoded as empty (the end id alone); null ids come first; rows
with the same id are ordered by a hash of their text; an empty table gives no records.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import worker_state, written
from staylens.session import scratch_dir

MASK_SHIFT = 0xA282EAD8
ENTRY, ENTRY_SIZE = "<QQQQ", 32
HEAD, HEAD_SIZE = "<qBB", 10
#: White space that not all engines agree on: texts that have any are encoded in one piece.
UNSURE_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
CACHED_WORDS = 600_000
#: Letters that are composed already and whose lower case is one letter: ASCII and Latin-1.
PLAIN_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: What the vocabulary parts a word into: letters, one digit, or signs; apostrophes and special tokens are left out.
SEGMENT = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:;=>?@\[-`{-~]+")
SEGMENTS = re.compile(f"(?:{SEGMENT.pattern})+")


def byte_letters() -> dict[int, str]:
    """Latin-1 letters as the byte-level vocabularies spell their two UTF-8 bytes.

    Bytes that print in Latin-1 stand for themselves there, the others for code points from 256 on, in order.
    """
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in printed]
    spelled = {b: chr(b) for b in printed} | {b: chr(0x100 + i) for i, b in enumerate(others)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


BYTE_LETTERS = byte_letters()


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + MASK_SHIFT) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(data: bytes, offset: int = 0) -> tuple[bytes, int]:
    """The payload at ``offset`` and where the next record begins; raises on any damage."""
    length = data[offset : offset + 8]
    if len(length) < 8 or struct.unpack_from("<I", data, offset + 8)[0] != masked(length):
        raise ValueError(f"damaged record length at {offset}")
    start, size = offset + 12, struct.unpack("<Q", length)[0]
    payload = data[start : start + size]
    if len(payload) < size or struct.unpack_from("<I", data, start + size)[0] != masked(payload):
        raise ValueError(f"damaged record at {offset}")
    return payload, start + size + 4


def open_stream(path: str, mode: str):
    """A binary stream on a mounted folder (plain path or file:) or any store that pyarrow can reach."""
    local = re.sub(r"^file:(//)?(?=/)", "", path)
    if "://" not in local:
        if mode == "w":
            os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, mode + "b")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_output_stream(inner) if mode == "w" else store.open_input_file(inner)


#: The settings under which a text's ids are those of its words in a row.
WORDWISE = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pre_tokenizer": [
        {
            "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed", "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def is_wordwise(settings: dict) -> bool:
    """Whether a vocabulary file normalises and parts texts as the short ways of :class:`Encoder` expect."""
    normalizer, parting = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    return (
        normalizer.get("normalizers") == WORDWISE["normalizer"] and parting.get("pretokenizers") == WORDWISE["pre_tokenizer"]
        and settings["model"].get("type") == "BPE" and not settings["model"].get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in settings["added_tokens"])
    )


class Words(dict):
    """Ids of the words seen lately; an unseen word is encoded where it is looked up."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts from the tokenizers library.

    The vocabulary drops white space and merges only inside a word, so a text's ids are its
    words' ids in a row, and a word seen before need not be encoded again. Texts with unusual
    white space go through the library in one piece, and all texts do under a vocabulary with
    other settings.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.wordwise = is_wordwise(json.loads(self.library.to_str()))
        self.words = Words(self.word)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def word(self, word: str) -> bytes:
        if PLAIN_LETTERS.fullmatch(word):  # such a word is lowered and spelled in bytes before the merges
            return self.packed([t.id for t in self.library.model.tokenize(word.lower().translate(BYTE_LETTERS))])
        if SEGMENTS.fullmatch(word):
            parts = SEGMENT.findall(word)
            return b"".join(map(self.words.__getitem__, parts)) if len(parts) > 1 else self.whole(word)
        core = word.rstrip(".,")
        # A letter whose lower case ends in a combining sign joins the signs behind it.
        if core != word and core.isalpha() and core.lower().isalpha():
            return self.words[core] + self.words[word[len(core) :]]
        return self.whole(word)

    def __call__(self, text: str) -> bytes:
        if not self.wordwise or UNSURE_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.words.__getitem__, text.split()))


def encoder(path: str) -> Encoder:
    """One per Python worker; its words stay known from task to task."""
    made = worker_state().__dict__.setdefault("encoders", {})
    return made.get(path) or made.setdefault(path, Encoder(path))


MANIFEST = "part int, records string, index string, n_records bigint, n_ids bigint, n_bytes bigint"


def write_records(
    docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None,
) -> DataFrame:
    """Write record and index files in ascending id order; return the manifest, one row a file pair.

    Texts are sent to their range of ids and encoded there, as text packs better than ids do.
    """
    folder = folder or scratch_dir(docs.sparkSession, "records")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = None
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        n = ids = offset = 0
        records = index = None
        try:
            for batch in batches:
                if encode is None:
                    encode = encoder(vocabulary)
                    end = np.array([end_id], dtype=encode.dtype).tobytes()
                    records, index = open_stream(f"{name}.rec", "w"), open_stream(f"{name}.idx", "w")
                for key, known, text in zip(batch["id"], batch["known"], batch["text"]):
                    body = encode(text) + end
                    framed = frame(struct.pack(HEAD, key, known, encode.width) + body)
                    count = len(body) // encode.width
                    index.write(struct.pack(ENTRY, offset, len(framed), count, ids))
                    records.write(framed)
                    n, ids, offset = n + 1, ids + count, offset + len(framed)
        finally:
            for stream in (records, index):
                if stream is not None:
                    stream.close()
        if n:
            yield pd.DataFrame({"part": [part], "records": [f"{name}.rec"], "index": [f"{name}.idx"], "n_records": [n], "n_ids": [ids], "n_bytes": [offset]})

    key = F.col(id_col)
    rows = docs.select(
        F.coalesce(key.cast("bigint"), F.lit(0)).alias("id"), key.isNotNull().cast("int").alias("known"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    order = ["known", "id", "tie"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return written(ranged.mapInPandas(write, MANIFEST), "records-manifest")


def _per_file(manifest: DataFrame) -> DataFrame:
    """One file a task, each with the number of ids before it. There are as many rows as files."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return based.repartition(max(1, manifest.count()), "part")


def _ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    key, known, width = struct.unpack_from(HEAD, payload)
    return (key if known else None), np.frombuffer(payload, f"<u{width}", offset=HEAD_SIZE)


def read_records(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Read the files through and check every record: id, ``start``, ``n_tokens``, ``ids_crc32``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for f in files.itertuples():
                rows, start = [], int(f.base)
                with open_stream(f.records, "r") as records, open_stream(f.index, "r") as index:
                    while entry := index.read(ENTRY_SIZE):
                        _, length, count, before = struct.unpack(ENTRY, entry)
                        key, ids = _ids(unframe(records.read(length))[0])
                        if len(ids) != count or before != start - f.base:
                            raise ValueError(f"index and records differ in {f.records}")
                        rows.append((key, start, count, zlib.crc32(ids.astype("<u4").tobytes())))
                        start += count
                        if len(rows) >= 20_000:
                            yield pd.DataFrame(rows, columns=["id", "start", "n_tokens", "ids_crc32"]).astype({"id": "Int64"})
                            rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=["id", "start", "n_tokens", "ids_crc32"]).astype({"id": "Int64"})

    rows = _per_file(manifest).mapInPandas(read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.withColumnRenamed("id", id_col)


def index_entries(manifest: DataFrame) -> DataFrame:
    """The offset index as rows ``(records, offset, length, n_ids, start)``, to be shuffled or sampled at will."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for f in files.itertuples():
                with open_stream(f.index, "r") as index:
                    while block := index.read(ENTRY_SIZE * 50_000):
                        e = np.frombuffer(block, "<i8").reshape(-1, 4)
                        yield pd.DataFrame({"records": f.records, "offset": e[:, 0], "length": e[:, 1], "n_ids": e[:, 2], "start": e[:, 3] + int(f.base)})

    return _per_file(manifest).mapInPandas(read, "records string, offset bigint, length bigint, n_ids bigint, start bigint")


def fetch_records(entries: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The records that ``entries`` point at, in their order: id, ``start`` and the ids themselves."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            streams: dict[str, object] = {}
            try:
                rows = []
                for e in batch.itertuples():
                    if e.records not in streams:
                        if len(streams) >= 64:
                            streams.pop(next(iter(streams))).close()
                        streams[e.records] = open_stream(e.records, "r")
                    streams[e.records].seek(e.offset)
                    key, ids = _ids(unframe(streams[e.records].read(e.length))[0])
                    rows.append((key, e.start, ids.astype(np.int64).tolist()))
                yield pd.DataFrame(rows, columns=["id", "start", "ids"]).astype({"id": "Int64"})
            finally:
                for s in streams.values():
                    s.close()

    return entries.mapInPandas(fetch, "id bigint, start bigint, ids array<bigint>").withColumnRenamed("id", id_col)
