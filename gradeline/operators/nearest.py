"""Nearest vectors by blocks: matrix products of packed vectors, so that pairs are never rows.

Both sides are packed into matrices of up to CHUNK vectors, one row each. Every chunk of the searched
side meets every block of the asking side in some task, which keeps the best of that product only. The
searched side is read once, however many ask.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions.vectors import has_direction
from gradeline.session import reach_package
from gradeline.sources.tables import keep

CHUNK = 1024
SCORE_DIGITS = 9


def is_whole(vector: str) -> Column:
    """Whether a vector can be compared: not NULL, without NULL parts and with a direction."""
    return has_direction(F.col(vector)) & ~F.exists(vector, lambda x: x.isNull())


def pack(rows: DataFrame, vector: str, carried: list[str], name: str, sort_by: str | None = None) -> DataFrame:
    """(number, size, matrix, *carried as arrays), kept: a row for up to CHUNK vectors of one size.

    Vectors that are NULL, have a NULL part or no direction drop out. With ``sort_by`` vectors with like
    values of that column share chunks.
    """
    reach_package(rows.sparkSession)
    held = rows.where(is_whole(vector)).select(*carried, F.col(vector).cast("array<double>").alias(vector))
    if sort_by:
        held = held.repartitionByRange(sort_by).sortWithinPartitions(sort_by)
    kinds = ", ".join(f"`{c}` array<{rows.schema[c].dataType.simpleString()}>" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for low in range(0, whole_batch.num_rows, CHUNK):
                batch = whole_batch.slice(low, CHUNK)
                vectors = batch.column(len(carried)).to_pylist()
                sizes = np.array([len(v) for v in vectors])
                for size in np.unique(sizes).tolist():
                    at = np.flatnonzero(sizes == size)
                    matrix = np.array([vectors[i] for i in at], np.float64)
                    lists = [pa.array([batch.column(k).take(pa.array(at)).to_pylist()], pa.list_(batch.schema.types[k])) for k in range(len(carried))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([size], pa.int32()), pa.array([matrix.tobytes()], pa.binary()), *lists],
                        names=["size", "matrix", *carried],
                    )

    packed = held.mapInArrow(run, f"size int, matrix binary, {kinds}")
    return keep(packed.withColumn("number", F.monotonically_increasing_id()), name)


def products(
    searched: DataFrame, asking: DataFrame, use: Callable[[np.ndarray, dict, dict], list[dict]], schema: pa.Schema, ddl: str,
    on: str | None = None,
) -> DataFrame:
    """``use(scores, searched row, asking row)`` for every chunk and block of equal vector size, and of equal ``on`` if it is given.

    scores[i, j] is the rounded cosine of searched vector i and asking vector j. A block is named in
    each chunk's list of blocks, so they meet by an equality; Spark broadcasts the blocks if they are
    small and otherwise moves the chunks.
    """
    left = searched.select(*[F.col(c).alias(f"s_{c}") for c in searched.columns])
    right = asking.select(*[F.col(c).alias(f"a_{c}") for c in asking.columns])
    if on is None:
        blocks = asking.agg(F.collect_list("number")).scalar()
        pairs = left.withColumn("a_number", F.explode(blocks)).join(right, "a_number")
    else:
        pairs = left.join(right, F.col(f"s_{on}") == F.col(f"a_{on}"))
    met = pairs.where("s_size = a_size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(batch.num_rows):
                row = batch.slice(low, 1).to_pylist()[0]
                ours = {k[2:]: v for k, v in row.items() if k.startswith("s_")}
                theirs = {k[2:]: v for k, v in row.items() if k.startswith("a_")}
                a, b = (np.frombuffer(x["matrix"], np.float64).reshape(-1, x["size"]) for x in (ours, theirs))
                lengths = np.sqrt((a * a).sum(1))[:, None] * np.sqrt((b * b).sum(1))[None, :]
                scores = np.round(a @ b.T / lengths, SCORE_DIGITS) + 0.0
                yield pa.RecordBatch.from_pylist(use(scores, ours, theirs), schema=schema)

    return met.mapInArrow(run, ddl)


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType.elementType)


def nearest(searched: DataFrame, asking: DataFrame, k: int, per_day: bool, on: str | None = None) -> DataFrame:
    """(entity, doc_id, published_date, score): the ``k`` best of every chunk for each entity, and with
    ``per_day`` of each day. Ties go to the smaller id. Whatever a caller cuts to ``k`` later is in it."""

    def use(scores: np.ndarray, ours: dict, theirs: dict) -> list[dict]:
        ids, days = ours["doc_id"], ours["published_date"]
        by_id = sorted(range(len(ids)), key=lambda i: ids[i])
        groups: dict[dt.date | None, list[int]] = {}
        for i in by_id:
            groups.setdefault(days[i] if per_day else None, []).append(i)
        out = []
        for members in groups.values():
            rows = np.array(members)
            best = np.argsort(-scores[rows], axis=0, kind="stable")[:k]
            for j, entity in enumerate(theirs["entity"]):
                out += [
                    {"entity": entity, "doc_id": ids[i], "published_date": days[i], "score": float(scores[i, j])}
                    for i in rows[best[:, j]].tolist()
                ]
        return out

    kinds = {c: _arrow(df, c) for df, c in ((asking, "entity"), (searched, "doc_id"), (searched, "published_date"))}
    schema = pa.schema([*kinds.items(), ("score", pa.float64())])
    names = [f"`{c}` {df.schema[c].dataType.elementType.simpleString()}" for df, c in
             ((asking, "entity"), (searched, "doc_id"), (searched, "published_date"))]
    return products(searched, asking, use, schema, ", ".join([*names, "score double"]), on)


def places(searched: DataFrame, asking: DataFrame) -> DataFrame:
    """(entity, place, n): how many searched vectors have exactly ``place`` of the entity's marks before
    them. Marks are an array of (loss = -score, doc_id) in ascending order in the column ``marks``."""

    def use(scores: np.ndarray, ours: dict, theirs: dict) -> list[dict]:
        out = []
        for j, (entity, marks) in enumerate(zip(theirs["entity"], theirs["marks"])):
            losses = np.array([m["loss"] for m in marks])
            loss = -scores[:, j]
            place = np.searchsorted(losses, loss, "left")
            last = np.searchsorted(losses, loss, "right")
            for i in np.flatnonzero(place < last).tolist():  # equal scores: the ids decide
                place[i] += sum(m["doc_id"] < ours["doc_id"][i] for m in marks[place[i] : last[i]])
            found, n = np.unique(place, return_counts=True)
            out += [{"entity": entity, "place": p, "n": c} for p, c in zip(found.tolist(), n.tolist())]
        return out

    schema = pa.schema([("entity", _arrow(asking, "entity")), ("place", pa.int32()), ("n", pa.int64())])
    kind = asking.schema["entity"].dataType.elementType.simpleString()
    return products(searched, asking, use, schema, f"entity {kind}, place int, n long")


def dated_places(searched: DataFrame, asking: DataFrame) -> DataFrame:
    """(entity, as_of, place, n): ``places`` among the vectors published by each day that an entity has marks for.

    Marks are an array of (as_of, marks) in the column ``dated_marks``.
    """

    def use(scores: np.ndarray, ours: dict, theirs: dict) -> list[dict]:
        out = []
        dates = np.array(ours["published_date"], "datetime64[D]")
        for j, (entity, dated) in enumerate(zip(theirs["entity"], theirs["dated_marks"])):
            for day in dated:
                here = np.flatnonzero(dates <= np.datetime64(day["as_of"]))
                losses = np.array([m["loss"] for m in day["marks"]])
                loss = -scores[here, j]
                place, last = np.searchsorted(losses, loss, "left"), np.searchsorted(losses, loss, "right")
                for i in np.flatnonzero(place < last).tolist():  # equal scores: the ids decide
                    place[i] += sum(m["doc_id"] < ours["doc_id"][here[i]] for m in day["marks"][place[i] : last[i]])
                found, n = np.unique(place, return_counts=True)
                out += [{"entity": entity, "as_of": day["as_of"], "place": p, "n": c} for p, c in zip(found.tolist(), n.tolist())]
        return out

    schema = pa.schema([("entity", _arrow(asking, "entity")), ("as_of", pa.date32()), ("place", pa.int32()), ("n", pa.int64())])
    kind = asking.schema["entity"].dataType.elementType.simpleString()
    return products(searched, asking, use, schema, f"entity {kind}, as_of date, place int, n long")


def cosine_of(pairs: DataFrame, documents: DataFrame, questions: DataFrame, cosine: Callable[[Column, Column], Column]) -> DataFrame:
    """(entity, doc_id, score) of the given (entity, doc_id) pairs only; pairs without a direction have no row."""
    ours = documents.where(has_direction(F.col("embedding"))).select("doc_id", F.col("embedding").cast("array<double>").alias("_d"))
    theirs = questions.where(has_direction(F.col("query_vector"))).select("entity", F.col("query_vector").cast("array<double>").alias("_q"))
    score = F.round(cosine(F.col("_d"), F.col("_q")), SCORE_DIGITS)
    found = pairs.select("entity", "doc_id").join(ours, "doc_id").join(theirs, "entity").withColumn("score", score)
    return found.where(F.col("score").isNotNull()).select("entity", "doc_id", "score")
