"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of letter trigrams (lower case, runs of other characters as one
gap), hashed into ``DIMENSIONS`` and normalised. Each language has several centroids, found by
spherical clustering of its sample, as one language is written in more than one style. Starts
are not the farthest texts and the smallest clusters are left out, so that a few texts in two
languages get no centroid. A text gets the language of the centroid with the largest cosine,
and is rejected if the cosine is below the floor of that language and the text's length class.

The length class counts different trigrams, as a word said a hundred times is no long text. A
floor is ``MARGIN`` of a low quantile of the sample's own cosines, each to centroids learned
without it. A class with few texts takes those of all languages, then the floor of the next
longer class; below the shortest known class floors fall with the root of the length.

The fit reads all labels to count them but takes vectors of at most ``SAMPLE_PER_LANGUAGE``
different texts a language, drawn by a hash of the id. The model is ``CENTROIDS`` vectors a
language and is the only thing sent to executors.

Defined results: a text that is null or has no letter is ``und`` with score 0 and rejected; so
is every text when nothing could be learned; between equal scores the first language by name
wins; rows with null text, no letters or null label are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.llm.common import worker_state, written

DIMENSIONS = 4096
SAMPLE_PER_LANGUAGE = 1000
CENTROIDS = 4
#: A rejected text is less similar than MARGIN of this quantile of the sample texts of its language and length class.
LOW = 0.01
MARGIN = 0.5
#: A length class with fewer sample texts has no quantile of its own.
LEAST_TEXTS = 20
FOLDS = 5
#: Clustering starts pass over this share of the farthest texts; clusters of a smaller share than SMALLEST are left out.
OUTLIERS = 0.05
SMALLEST = 0.02
ROUNDS = 12
BLOCK = 128
CLASSES = 16
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(DIMENSIONS, np.float32))
    centroids: np.ndarray = field(default_factory=lambda: np.zeros((0, DIMENSIONS), np.float32))
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    floors: np.ndarray = field(default_factory=lambda: np.zeros((0, CLASSES)))


def _letters() -> np.ndarray:
    state = worker_state().__dict__
    if "letters" not in state:
        state["letters"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return state["letters"]


def trigrams(text: str | None) -> np.ndarray:
    """Hashed trigrams of a text's letters, one gap at either end; empty without a letter."""
    if not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    codes = np.where(letter, codes, 32)
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first of a run of other characters is the gap
    codes = np.concatenate(([32], codes[kept], [32])).astype(np.uint32)
    mixed = codes[:-2] * np.uint32(0x9E3779B1) ^ codes[1:-1] * np.uint32(0x85EBCA6B) ^ codes[2:] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    return ((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(20)).astype(np.int64)


def counts(texts: list[str | None]) -> np.ndarray:
    """Trigram counts, a row a text."""
    grams = [trigrams(t) for t in texts]
    row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    flat = np.concatenate([*grams, np.zeros(0, np.int64)]) + row * DIMENSIONS
    return np.bincount(flat, minlength=len(grams) * DIMENSIONS).reshape(len(grams), DIMENSIONS).astype(np.float32)


def weighted(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows with damped term counts; a row of zeros stays one."""
    v = np.log1p(count) * idf
    size = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(size > 0, size, 1)


def length_class(count: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum((count > 0).sum(axis=1), 1)).astype(np.int64)


def cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` unit centroids by cosine, started far apart; the same rows give the same ones."""
    start = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    near = vectors @ vectors[start[0]]
    while len(start) < min(k, len(vectors)):
        far = int(np.argsort(near, kind="stable")[int(len(near) * OUTLIERS)])
        if near[far] >= 1 - 1e-6:
            break
        start.append(far)
        near = np.maximum(near, vectors @ vectors[far])
    centroids = vectors[start]
    for _ in range(ROUNDS):
        own = np.argmax(vectors @ centroids.T, axis=1)
        moved = np.array([vectors[own == i].mean(axis=0) if (own == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = moved / np.linalg.norm(moved, axis=1, keepdims=True)
    size = np.bincount(np.argmax(vectors @ centroids.T, axis=1), minlength=len(centroids))
    return centroids[size >= min(size.max(), max(1, SMALLEST * len(vectors)))]


def own_cosines(vectors: np.ndarray, k: int) -> np.ndarray:
    """Each row's cosine to the centroids of the other folds; 1 for a row alone."""
    fold, out = np.arange(len(vectors)) % FOLDS, np.ones(len(vectors))
    for f in range(FOLDS if len(vectors) > 1 else 0):
        if (fold == f).any():
            out[fold == f] = (vectors[fold == f] @ cluster(vectors[fold != f], k).T).max(axis=1)
    return out


def class_floors(low: dict[tuple[str | None, int], float], languages: list[str]) -> np.ndarray:
    """Floors by language and length class from the quantiles that are known; those of language None are of all."""
    floors = np.full((len(languages), CLASSES), np.inf)
    for row, lang in zip(floors, languages):
        for size in range(CLASSES):
            row[size] = low.get((lang, size), low.get((None, size), np.inf))
        shortest = int(np.isfinite(row).argmax())
        row[:] = np.minimum.accumulate(row[::-1])[::-1]
        row[np.isinf(row)] = row[np.isfinite(row)].max()
        row[:shortest] = row[shortest] * 0.5 ** ((shortest - np.arange(shortest)) / 2)
    return floors * MARGIN


def fit(
    labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
    sample: int = SAMPLE_PER_LANGUAGE, centroids: int = CENTROIDS,
) -> Model:
    """Learn from at most ``sample`` different texts of each label."""
    rows = labelled.select(F.col(label_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("draw"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One row a label, written so that its size is known before the join and no text is shuffled by label.
    share = labelled.groupBy(F.col(label_col).alias("lang")).agg((F.lit(2.0 * sample) / F.count("*")).alias("share"))
    share = written(share, "language-shares")
    # About twice the sample by chance first, so that the exact cut only ever sees a few rows a label.
    place = F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53))
    few = rows.join(share, "lang").filter(place < F.col("share")).drop("share")
    order = Window.partitionBy("lang").orderBy("draw", "text")
    few = few.dropDuplicates(["lang", "text"]).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= sample)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.iloc[at : at + BLOCK]
                count = counts(part["text"].tolist())
                some = count.any(axis=1)
                yield pd.DataFrame({"lang": part["lang"][some], "count": [c.tobytes() for c in count[some]]})

    drawn = written(few.select("lang", "text").mapInPandas(vectors, "lang string, count binary"), "language-sample")

    def document_frequency(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = sum((np.frombuffer(c, np.float32) > 0).astype(np.int64) for c in batch["count"])
            if len(batch):
                yield pd.DataFrame({"gram": np.arange(DIMENSIONS), "df": seen})

    # At most DIMENSIONS rows come back.
    table = drawn.mapInPandas(document_frequency, "gram int, df bigint").groupBy("gram").agg(F.sum("df").alias("df")).collect()
    model = Model()
    if not table:
        return model
    df = np.zeros(DIMENSIONS)
    df[[r["gram"] for r in table]] = [r["df"] for r in table]
    n = drawn.count()
    model.idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    idf = model.idf

    def clustered(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("count")
        count = np.stack([np.frombuffer(c, np.float32) for c in group["count"]])
        vectors, lang = weighted(count, idf), group["lang"].iloc[0]
        found = pd.DataFrame({"lang": lang, "centroid": [c.astype(np.float32).tobytes() for c in cluster(vectors, centroids)]})
        own = pd.DataFrame({"lang": lang, "size": length_class(count), "score": own_cosines(vectors, centroids).astype(float)})
        found["size"], found["score"], own["centroid"] = -1, 0.0, None
        return pd.concat([found, own[found.columns]], ignore_index=True)

    # A group is one label's sample, so it is bounded.
    learned = drawn.groupBy("lang").applyInPandas(clustered, "lang string, centroid binary, size int, score double")
    learned = written(learned, "language-centroids")
    found = learned.filter(F.col("centroid").isNotNull()).select("lang", "centroid").collect()
    found = sorted((r["lang"], bytes(r["centroid"])) for r in found)
    model.languages = sorted({lang for lang, _ in found})
    model.centroids = np.stack([np.frombuffer(c, np.float32) for _, c in found])
    model.owner = np.array([model.languages.index(lang) for lang, _ in found])

    # A row a label and length class comes back, a row a class and a row for all: labels are never null here.
    scores = learned.filter(F.col("centroid").isNull())
    low = scores.groupingSets([["lang", "size"], ["size"], []], "lang", "size").agg(
        F.percentile("score", F.lit(LOW)).alias("low"), F.count("*").alias("n")
    ).collect()
    known = {(r["lang"], r["size"]): r["low"] for r in low if r["size"] is not None and r["n"] >= LEAST_TEXTS}
    # Too few texts for any class: what they have together stands for the longest.
    together = next(r["low"] for r in low if r["size"] is None)
    if not any(lang is None for lang, _ in known):
        longest = max(r["size"] for r in low if r["size"] is not None)
        known[None, longest] = together
    model.floors = class_floors(known, model.languages)
    return model


def identify(model: Model, text: Column) -> Column:
    """Struct ``(lang_pred, score, accepted)`` of a text column."""

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = [nearest(model, texts.iloc[at : at + BLOCK].tolist()) for at in range(0, len(texts), BLOCK)]
            yield pd.concat(out, ignore_index=True)

    return predict(text)


def nearest(model: Model, texts: list[str | None]) -> pd.DataFrame:
    count = counts(texts)
    some = count.any(axis=1)
    lang, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
    accepted = np.zeros(len(texts), bool)
    if model.languages and some.any():
        cosine = weighted(count[some], model.idf) @ model.centroids.T
        best = cosine.argmax(axis=1)
        score[some] = np.round(np.clip(cosine.max(axis=1), 0, 1), 6)
        lang[some] = np.array(model.languages, dtype=object)[model.owner[best]]
        accepted[some] = score[some] >= np.maximum(model.floors[model.owner[best], length_class(count[some])], 1e-9)
    return pd.DataFrame({"lang_pred": lang, "score": score, "accepted": accepted})


def held_out(id_: Column, folds: int = 5) -> Column:
    """True for the rows that are never learned from; rows without an id are among them."""
    return F.coalesce(F.crc32(id_.cast("string")), F.lit(0)) % folds == 0
