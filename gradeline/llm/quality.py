"""A quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader updates."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.frames import held_out, map_batches
from gradeline.session import reach_package

BITS = 18
#: The classifier is fitted on at most this many labelled rows, chosen by the hash of their id.
TRAIN_ROWS = 20_000
#: Learners that each see a share of the rows; their weights are averaged.
LEARNERS = 4
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.2, 1.0, 0.02, 0.1
#: Words remembered per worker.
REMEMBERED = 500_000

_words: dict[bytes, int] = {}


def word_code(word: bytes) -> int:
    """A hash of the lower-case word above, its shape in the low 16 bits.

    The shape keeps runs of upper case, lower case, digits and other bytes, one character each, so
    that words never seen in training still say something.
    """
    kinds = word.translate(_shapes())
    shape = bytes(k for k, before in zip(kinds, b"\0" + kinds) if k != before)
    return xxhash.xxh64_intdigest(word.lower()) & ~0xFFFF | xxhash.xxh64_intdigest(shape) & 0xFFFF


@functools.cache
def _shapes() -> bytes:
    table = bytearray(range(256))
    for b in range(256):
        if 0x41 <= b <= 0x5A:
            table[b] = ord("X")
        elif 0x61 <= b <= 0x7A or b >= 0x80:
            table[b] = ord("x")
        elif 0x30 <= b <= 0x39:
            table[b] = ord("0")
    return bytes(table)


def _mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C159E3779B9))
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def features(text: bytes | None) -> np.ndarray:
    """The hashed places of a text's n-grams, with repeats; place 0 is the constant.

    n-grams are single words, pairs of neighbours, and pairs of neighbours' shapes with a mark for
    equal words.
    """
    found = (text or b"").split()
    if len(_words) > REMEMBERED:
        _words.clear()
    for word in set(found).difference(_words):
        _words[word] = word_code(word)
    codes = np.array([_words[word] for word in found], np.uint64)
    shape = codes & np.uint64(0xFFFF)
    first, second = codes[:-1], codes[1:]
    same = (first >> np.uint64(16) == second >> np.uint64(16)).astype(np.uint64)
    parts = [
        _mix(codes >> np.uint64(16), np.uint64(1)),
        _mix(first >> np.uint64(16), second),
        _mix(shape[:-1] << np.uint64(17) | shape[1:] << np.uint64(1) | same, np.uint64(3)),
    ]
    places = np.concatenate(parts) >> np.uint64(64 - BITS)
    return np.append(np.maximum(places, 1), 0).astype(np.int64)


def vector(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, values): counts over the square root of the number of n-grams; the constant is 1."""
    places, counts = np.unique(features(text), return_counts=True)
    values = counts / np.sqrt(counts.sum())
    values[places == 0] = 1.0
    return places, values


def follow_the_leader(examples: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> np.ndarray:
    """The weights after the updates of ``epochs`` passes over (label, places, values)."""
    z, n = np.zeros((2, 1 << BITS))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        pull = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, pull)

    for _ in range(epochs):
        for label, places, values in examples:
            w = weights(places)
            gradient = (1 / (1 + np.exp(-np.clip(w @ values, -35, 35))) - label) * values
            sigma = (np.sqrt(n[places] + gradient**2) - np.sqrt(n[places])) / ALPHA
            z[places] += gradient - sigma * w
            n[places] += gradient**2
    return weights(slice(None))


def fit(rows: DataFrame, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from (doc_id, text, label), which the caller bounds; all zero without rows.

    Each learner goes through its rows in the order of a hash of the id, so the result does not
    depend on how the rows are stored. Only hashed vectors are shuffled, and one vector of weights per
    learner reaches the driver.
    """
    reach_package(rows.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors = [vector(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(2),
                pa.array([v[0].astype(np.int32) for v in vectors], pa.list_(pa.int32())),
                pa.array([v[1].astype(np.float32) for v in vectors], pa.list_(pa.float32())),
            ],
            names=["doc_id", "label", "places", "values"],
        )

    ddl = "doc_id long, label int, places array<int>, values array<float>"
    vectors = map_batches(rows, ["doc_id", "text", "label"], run, ddl)

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["turn", "doc_id"], kind="stable")
        examples = [
            (y, np.asarray(p, np.int64), np.asarray(v, np.float64))
            for y, p, v in zip(ordered["label"], ordered["places"], ordered["values"])
        ]
        return pd.DataFrame({"rows": [len(examples)], "weights": [follow_the_leader(examples, epochs).tobytes()]})

    dealt = vectors.withColumns({
        "turn": F.xxhash64(F.lit("turn"), "doc_id"), "learner": F.pmod(F.xxhash64("doc_id"), F.lit(LEARNERS)),
    })
    found = dealt.groupBy("learner").applyInPandas(learn, "rows long, weights binary").toPandas()
    if not len(found):
        return np.zeros(1 << BITS)
    learned = np.array([np.frombuffer(w, np.float64) for w in found["weights"]])
    return np.average(learned, axis=0, weights=found["rows"])


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs`` (doc_id, text).

    NULL and empty texts have only the constant; without any training row every score is 0.5.
    Repeated rows and rows without id each get their row; other columns are never looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = shared.value
        sums = []
        for text in batch.column(2).cast(pa.binary()).to_pylist():
            places = features(text)
            sums.append(w[places[:-1]].sum() / np.sqrt(len(places)) + w[0])
        found = 1 / (1 + np.exp(-np.clip(np.array(sums), -35, 35)))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    ddl = "doc_id long, held_out boolean, score double, predicted int"
    return map_batches(asked, ["doc_id", "held_out", "text"], run, ddl)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from labelled rows that are not held out.

    Where labels repeat an id, the lowest label counts; rows without label or id teach nothing.
    """
    usable = labels.where(~held_out() & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    each = usable.groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("label"))
    chosen = F.broadcast(each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(docs, fit(texts.join(chosen, "doc_id")))
