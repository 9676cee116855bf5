"""A stored index of vectors by cells: fitted centroids, every vector in its nearest cell, searches that read few cells.

Centroids are fitted on a bounded sample; every vector is indexed. A search by ``probes`` reads the cells nearest to
each question. An exact search goes on to the cells whose bound says that they may hold something better: a vector is
no nearer to a question than its cell's centre is, less the widest angle in the cell.

The index is a folder. Each version adds entries and tombstones of its own, and counts once its number is written, so a
failed upkeep leaves the index as it was and a rerun replaces what it left behind.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.operators.nearest import CHUNK, is_whole, nearest
from gradeline.operators.topk import as_of_top_k
from gradeline.operators.versions import Versioned
from gradeline.session import reach_package
from gradeline.sources.tables import keep

#: Vectors that centroids are fitted on, those of the smallest hashes of the id.
SAMPLE_ROWS = 20_000
#: Cells at most; below that about as many as the square root of the number of vectors.
MAX_CELLS = 4096
ROUNDS = 10
PROBES = 8
#: The cell of vectors of another size than the centroids; every search reads it.
OTHER = -1
#: What rounding may take from a bound.
SLACK = 1e-8
ENTRY = "doc_id {id}, published_date date, embedding array<double>, angle double, version int, cell int"


def unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.sqrt((matrix * matrix).sum(1))[:, None]


def fitted(vectors: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids by spherical k-means from evenly chosen vectors; an empty cell keeps its centroid."""
    vectors = unit(vectors)
    centroids = vectors[np.linspace(0, len(vectors) - 1, min(cells, len(vectors))).astype(int)]
    for _ in range(rounds):
        nearest_cell = (vectors @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest_cell, vectors)
        filled = np.sqrt((sums * sums).sum(1)) > 1e-12
        centroids[filled] = unit(sums[filled])
    return centroids


@dataclass(frozen=True)
class Found:
    """A search's rows and the cells it read."""

    rows: DataFrame
    cells: list[int]


class CellIndex(Versioned):
    """Vectors (doc_id, published_date, embedding) by cells under one shared folder."""

    def centroids(self) -> np.ndarray:
        """The unit centroids, a row for each cell; at most MAX_CELLS."""
        rows = self.spark.read.parquet(self._path("centroids")).orderBy("cell").collect()
        return np.array([r["centroid"] for r in rows], np.float64)

    # building and upkeep

    def build(self, vectors: DataFrame, version: int = 1, cells: int | None = None, sample_rows: int = SAMPLE_ROWS) -> None:
        """Fit centroids and index every vector; vectors that are NULL or have no direction have no entry."""
        whole = vectors.where(is_whole("embedding"))
        sizes = whole.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n"))
        common = sizes.orderBy(F.col("n").desc(), "size").first()
        size, n = common if common else (1, 0)
        wanted = cells or min(MAX_CELLS, max(1, round(math.sqrt(n))))
        alike = whole.where(F.size("embedding") == size)
        sample = alike.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).select(F.col("embedding").cast("array<double>").alias("v"))
        chosen = [r["v"] for r in sample.collect()]
        centroids = fitted(np.array(chosen, np.float64), wanted) if chosen else np.ones((1, size))
        stored = self.spark.createDataFrame(
            pd.DataFrame({"cell": range(len(centroids)), "centroid": centroids.tolist()}), "cell int, centroid array<double>"
        )
        stored.coalesce(1).write.mode("overwrite").parquet(self._path("centroids"))
        self._remember_ids(vectors)
        self._add(whole, version)
        self._commit(version)

    def _add(self, rows: DataFrame, version: int) -> None:
        placed = assigned(rows.where(is_whole("embedding")), self.centroids())
        # A cell is one folder; a large one is split over tasks by Spark.
        (
            placed.hint("rebalance", "cell").sortWithinPartitions("cell", "published_date")
            .write.mode("overwrite").partitionBy("cell").parquet(self._path(f"entries/version={version}"))
        )

    def entries(self, cells: list[int] | None = None) -> DataFrame:
        """(doc_id, published_date, embedding, angle, version, cell) of all live entries, or of those in some cells only."""
        stored = self._read("entries", ENTRY)
        return self._live(stored if cells is None else stored.where(F.col("cell").isin(cells)))

    # search

    def search(
        self, questions: DataFrame, requests: DataFrame, k: int, probes: int | None = PROBES, exact: bool = False
    ) -> Found:
        """The ``k`` nearest entries published by each requested (entity, as_of), ties to the smaller id.

        Approximate in the ``probes`` cells nearest to each question; ``exact`` then reads every cell that may hold
        something better than the k-th found for some request of the question.
        """
        centroids = self.centroids()
        asked = keep(cell_angles(questions, centroids), "cell_angles")
        near = F.col("place") < (probes or len(centroids))
        first = keep(self._hits(asked.where(near | (F.col("cell") == OTHER)), k), "first_hits")
        rows = as_of_top_k(first, requests, "entity", "published_date", "as_of", best_first(), k)
        read = cells_of(asked.where(near | (F.col("cell") == OTHER)))
        if not exact:
            return Found(rows, read)
        kth = rows.groupBy("entity", "as_of").agg(F.count("*").alias("n"), F.min("score").alias("score"))
        worst = requests.select("entity", "as_of").distinct().join(kth, ["entity", "as_of"], "left").groupBy("entity").agg(
            F.min(F.when(F.col("n") == k, F.col("score")).otherwise(F.lit(-2.0))).alias("least")
        )
        widest = self.entries().groupBy("cell").agg(F.max("angle").alias("widest"))
        bound = F.cos(F.greatest(F.lit(0.0), F.col("angle") - F.col("widest"))) + SLACK
        left = asked.where(~near & (F.col("cell") != OTHER)).join(widest, "cell").join(worst, "entity").where(bound >= F.col("least"))
        left = keep(left.select(asked.columns), "cells_left")
        more = self._hits(left, k)
        return Found(
            as_of_top_k(first.unionByName(more), requests, "entity", "published_date", "as_of", best_first(), k),
            sorted({*read, *cells_of(left)}),
        )

    def probes_for(self, questions: DataFrame, requests: DataFrame, k: int, recall: float = 0.95) -> int:
        """The fewest probes that find ``recall`` of the true answers to some example questions.

        The examples are answered exactly; what counts is how near to its question the cell of each answer is.
        """
        truth = self.search(questions, requests, k, exact=True).rows.select("entity", "as_of", "doc_id")
        homes = truth.join(self.entries().select("doc_id", "cell"), "doc_id")
        placed = cell_angles(questions, self.centroids()).where(F.col("cell") != OTHER).select("entity", "cell", "place")
        counts = homes.join(placed, ["entity", "cell"]).groupBy("place").count().orderBy("place").collect()  # a row for each cell
        wanted = recall * sum(r["count"] for r in counts)
        seen = 0
        for r in counts:
            seen += r["count"]
            if seen >= wanted:
                return r["place"] + 1
        return PROBES

    def _hits(self, asked: DataFrame, k: int) -> DataFrame:
        entries = packed_by_cell(
            self.entries(cells_of(asked)).select("cell", "embedding", "doc_id", "published_date"), "embedding", ["doc_id", "published_date"]
        )
        asking = packed_by_cell(asked.select("cell", "query_vector", "entity").repartition("cell"), "query_vector", ["entity"])
        return nearest(entries, asking, k, per_day=True, on="cell")


def best_first() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc()]


def cells_of(asked: DataFrame) -> list[int]:
    """The cells that some question asks for: not more than there are centroids."""
    return sorted(r["cell"] for r in asked.select("cell").distinct().collect())


def angles(matrix: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit(matrix) @ centroids.T, -1.0, 1.0))


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(doc_id, published_date, embedding, angle, cell): every vector with its nearest cell and the angle to its centre."""
    spark = vectors.sparkSession
    reach_package(spark)
    shared = spark.sparkContext.broadcast(centroids)
    rows = vectors.select("doc_id", "published_date", F.col("embedding").cast("array<double>").alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(low, CHUNK)
                vectors_ = batch.column(2).to_pylist()
                cell, angle = np.full(len(vectors_), OTHER, np.int32), np.full(len(vectors_), np.pi)
                at = np.array([i for i, v in enumerate(vectors_) if len(v) == shared.value.shape[1]], np.int64)
                if len(at):
                    found = angles(np.array([vectors_[i] for i in at.tolist()], np.float64), shared.value)
                    cell[at], angle[at] = found.argmin(1), found.min(1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(angle), pa.array(cell)], names=["doc_id", "published_date", "embedding", "angle", "cell"]
                )

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rows.columns)
    return rows.mapInArrow(run, f"{kinds}, angle double, cell int")


def cell_angles(questions: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(entity, query_vector, cell, angle, place): every question with every cell, the nearest first, and with OTHER.

    A question costs a row for each centroid, not for each vector; its vector is joined to the few cells it asks for.
    """
    spark = questions.sparkSession
    reach_package(spark)
    shared = spark.sparkContext.broadcast(centroids)
    rows = questions.where(is_whole("query_vector")).select("entity", F.col("query_vector").cast("array<double>").alias("query_vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 64):
                batch = whole.slice(low, 64)
                cells, found, places = [], [], []
                for vector in batch.column(1).to_pylist():
                    alike = len(vector) == shared.value.shape[1]
                    angle = angles(np.array([vector]), shared.value)[0] if alike else np.zeros(0)
                    order = np.argsort(angle, kind="stable").tolist()
                    cells.append([*order, OTHER])
                    found.append([*angle[order].tolist(), 0.0])
                    places.append([*range(len(order)), 0])
                lists = [pa.array(cells, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.float64())), pa.array(places, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=["entity", "query_vector", "cells", "angles", "places"])

    kind = rows.schema["entity"].dataType.simpleString()
    listed = rows.mapInArrow(run, f"entity {kind}, query_vector array<double>, cells array<int>, angles array<double>, places array<int>")
    return listed.select(
        "entity", "query_vector", F.inline(F.arrays_zip(F.col("cells").alias("cell"), F.col("angles").alias("angle"), F.col("places").alias("place")))
    )


def packed_by_cell(rows: DataFrame, vector: str, carried: list[str]) -> DataFrame:
    """(cell, size, matrix, *carried as arrays), kept: a row for up to CHUNK vectors of one cell and size.

    Entries lie in folders by cell, so those of a cell come together without being moved.
    """
    reach_package(rows.sparkSession)
    kinds = ", ".join(f"`{c}` array<{rows.schema[c].dataType.simpleString()}>" for c in carried)
    held = rows.select("cell", vector, *carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(low, CHUNK)
                vectors = batch.column(1).to_pylist()
                groups: dict[tuple[int, int], list[int]] = {}
                for i, (cell, v) in enumerate(zip(batch.column(0).to_pylist(), vectors)):
                    groups.setdefault((cell, len(v)), []).append(i)
                for (cell, size), at in groups.items():
                    matrix = np.array([vectors[i] for i in at], np.float64)
                    lists = [
                        pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), batch.column(2 + n).take(pa.array(at)))
                        for n in range(len(carried))
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([cell], pa.int32()), pa.array([size], pa.int32()), pa.array([matrix.tobytes()], pa.binary()), *lists],
                        names=["cell", "size", "matrix", *carried],
                    )

    return keep(held.mapInArrow(run, f"cell int, size int, matrix binary, {kinds}"), "packed_cells")
