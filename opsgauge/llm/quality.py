"""Quality by compression: a text is good if a dictionary of good texts shrinks it more than one of
bad texts does. The difference of the compressed sizes, over the text's size, becomes a score
between 0 and 1 by logistic regression on labelled texts that the dictionaries have not seen. The
regression also knows how short a text is: a short one's difference is near 0 whatever it is, and its
score should then be near the share of good texts among short ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsgauge.llm.workspace import ship_package

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
PER_CLASS = 2000
LONGEST = 20_000
DICTIONARY = 112_640
CHUNK = 2048
HALF_SHORT = 64
LEVEL = 3


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the weights of the evidence and of 1 in the log odds of a good text."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def score(self, text: str) -> float:
        z = sum(w * x for w, x in zip(self.weights, (*evidence(self.good, self.bad, text), 1.0)))
        return 1 / (1 + math.exp(-min(max(z, -700.0), 700.0)))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is never learned from; a null id has none to learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


@lru_cache(maxsize=4)
def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    options = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **options)


def size_difference(good: bytes, bad: bytes, text: str) -> float:
    """Compressed size with the bad dictionary less that with the good one, per byte of the whole
    text. It is compressed in pieces, so that a long text's end is compared with the dictionaries
    and not with its own beginning."""
    data = text.encode("utf-8", "replace")
    by_good, by_bad = compressor(good), compressor(bad)
    gain = 0
    for at in range(0, len(data), CHUNK):
        piece = data[at : at + CHUNK]
        gain += len(by_bad.compress(piece)) - len(by_good.compress(piece))
    return gain / max(1, len(data))


def evidence(good: bytes, bad: bytes, text: str) -> tuple[float, float, float]:
    """The size difference, the text's shortness (1 for an empty one, 1/2 at ``HALF_SHORT`` bytes), and
    their product."""
    difference = size_difference(good, bad, text)
    short = HALF_SHORT / (HALF_SHORT + len(text.encode("utf-8", "replace")))
    return difference, short, difference * short


def dictionary(texts: list[str]) -> bytes:
    """A dictionary of these texts: trained, or where they are too few to train on, their own bytes."""
    data = [x.encode("utf-8", "replace") for x in texts]
    pieces = [x[at : at + CHUNK] for x in data for at in range(0, len(x), CHUNK)]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:DICTIONARY]


def fit_weights(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, ...]:
    """Weights of a logistic regression, the constant's last, with a weak pull of the others to 0."""
    if not len(x):
        return (0.0,) * 4
    scale = np.std(x, axis=0)
    scale[scale == 0] = 1.0
    features = np.concatenate((x / scale, np.ones((len(x), 1))), 1)
    # targets a little inside 0 and 1, so that separable classes have a finite best fit
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weights, pull = np.zeros(features.shape[1]), np.diag([1e-3] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (p - target) + pull @ weights
        curve = (features * (p * (1 - p))[:, None]).T @ features + pull
        step = np.linalg.solve(curve, slope)
        weights = weights - step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
    return tuple((weights / np.append(scale, 1.0)).tolist())


def fit(labelled: list[tuple[str, int]]) -> Model:
    """Dictionaries from every other text of each class, the weights from the rest."""
    parts = {c: [t for t, label in labelled if label == c] for c in (0, 1)}
    good, bad = (dictionary(parts[c][::2]) if parts[c] else b"" for c in (1, 0))
    rest = [(t, c) for c in (0, 1) for t in parts[c][1::2]]
    x = np.array([evidence(good, bad, t) for t, _ in rest])
    return Model(good, bad, fit_weights(x, np.array([c for _, c in rest])))


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> list[tuple[str, int]]:
    """Labelled texts to learn from: of each class ``per_class`` labels at most, those with the
    smallest hash of doc_id, whose document is not held out and has 1 to ``LONGEST`` characters.
    That bounds what the driver gets to 2 * per_class * LONGEST characters."""
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = None
    for c in (0, 1):
        mine = usable.where(F.col("quality") == c).select("doc_id", F.lit(c).alias("label")).distinct()
        mine = mine.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = mine if chosen is None else chosen.union(mine)
    texts = docs.select("doc_id", "text").where(F.length("text").between(1, LONGEST))
    # at most 2 * per_class ids; of an id with several texts, the least one in order of their digests
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    found = found.agg(F.min_by("text", F.struct(F.md5("text"), "text")).alias("text")).select("doc_id", "text", "label")
    rows = found.collect()
    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["label"], r["text"]))]


def score_documents(docs: DataFrame, model: Model, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """All rows and columns, with the score of the whole text and whether it reaches the threshold.

    A null or empty text has no size difference and gets the score of the shortest texts. Columns
    named like the new ones are replaced.
    """
    ship_package(docs.sparkSession)
    docs = docs.drop(*(c for c in docs.columns if c.lower() in (score.lower(), predicted.lower())))
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType()), T.StructField(predicted, T.IntegerType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            values = [model.score(x.as_py() or "") for x in texts]
            columns = [*batch.columns, pa.array(values, pa.float64()), pa.array([int(v >= THRESHOLD) for v in values], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, score, predicted])

    return docs.mapInArrow(scored, schema)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Learn from ``labels`` (doc_id, quality) over ``docs`` and score all documents."""
    return score_documents(docs, fit(training_sample(docs, labels, per_class)))
