"""Benchmark decontamination by greedy string tiling.

Seeds are runs of MIN_MATCH tokens that a document and a test item share. A document and an item with
seeds enough are tiled: the longest match of unmarked tokens is found by running Karp-Rabin hashes,
marked in both, and so on until no match of MIN_MATCH tokens is left. The share of the item's tokens
under tiles tells how much of it the document holds, in whatever order its passages come.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.frames import map_batches
from gradeline.sources.tables import keep

MIN_MATCH = 5
COVERAGE = 0.5
#: Bytes of test items that are searched for in one pass over the documents; more items take more passes.
BLOCK_BYTES = 8 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)

_token = re.compile(r"\w+")


def tokens(text: str | None) -> np.ndarray:
    """A 64-bit hash of each run of word characters, lower case; punctuation and spacing don't count."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(t) for t in _token.findall((text or "").lower())], np.uint64)


def rolling(values: np.ndarray, size: int) -> np.ndarray:
    """The Karp-Rabin hash, modulo 2^64, of every run of ``size`` values."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Runs of powers of two are joined to the wanted length.
    out, done, power, width = np.zeros(n, np.uint64), 0, values.copy(), 1
    scale = np.array([BASE])  # arrays wrap around, scalars warn
    left = size
    while left:
        if left & 1:
            out = out * scale + power[done : done + n]
            done += width
        left >>= 1
        if left:
            power = power[: len(power) - width] * scale + power[width:]
            scale = scale * scale
            width *= 2
    return out


def longest_match(item: np.ndarray, doc: np.ndarray, least: int) -> tuple[int, int, int]:
    """(length, place in item, place in doc) of the longest run in both, the first in the item among
    equals; length 0 if it is shorter than ``least``. Lengths are bisected, hashes compared, and the
    match is verified token by token."""

    def find(size: int) -> tuple[int, int] | None:
        ours, theirs = rolling(item, size), rolling(doc, size)
        order = np.argsort(theirs, kind="stable")
        at = np.searchsorted(theirs[order], ours)
        hit = at < len(theirs)
        hit[hit] = theirs[order][at[hit]] == ours[hit]
        for i in np.flatnonzero(hit).tolist():
            j = int(order[at[i]])
            if np.array_equal(item[i : i + size], doc[j : j + size]):
                return i, j
        return None

    best = find(least) if least <= min(len(item), len(doc)) else None
    if best is None:
        return 0, 0, 0
    low, high = least, min(len(item), len(doc)) + 1
    while high - low > 1:
        middle = (low + high) // 2
        found = find(middle)
        if found is None:
            high = middle
        else:
            low, best = middle, found
    return low, *best


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, place in item, place in doc) of the tiles, longest first, none overlapping another."""
    item, doc, tiles = item.copy(), doc.copy(), []
    # A marked token gets a value of its own, so that no later match reaches over it.
    marked = 1
    while True:
        size, i, j = longest_match(item, doc, least)
        if not size:
            return tiles
        tiles.append((size, i, j))
        marks = np.arange(marked, marked + 2 * size, dtype=np.uint64) * BASE
        item[i : i + size], doc[j : j + size] = marks[:size], marks[size:]
        marked += 2 * size


@dataclass
class Items:
    """A block of test items: their tokens, and their seeds sorted by hash."""

    ids: list[int]
    texts: list[np.ndarray]
    least: list[int]
    sizes: list[int]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, ids: list[int], texts: list[str | None], least: int) -> Items:
        hashed = [tokens(t) for t in texts]
        some = [(i, h) for i, h in zip(ids, hashed) if len(h)]
        needed = [min(least, len(h)) for _, h in some]
        seeds = {}
        for size in sorted(set(needed)):
            group = [(k, rolling(h, size)) for k, ((_, h), m) in enumerate(zip(some, needed)) if m == size]
            all_hashes = np.concatenate([r for _, r in group])
            owners = np.concatenate([np.full(len(r), k) for k, r in group])
            places = np.concatenate([np.arange(len(r)) for _, r in group])
            order = np.argsort(all_hashes, kind="stable")
            seeds[size] = all_hashes[order], owners[order], places[order]
        return cls([i for i, _ in some], [h for _, h in some], needed, sorted(seeds), seeds)


def matches(doc: np.ndarray, items: Items, coverage: float) -> list[tuple[int, int, int, list[tuple[int, int, int]]]]:
    """(item id, its tokens, tokens under tiles, tiles) of the items that the document covers enough.

    Every token under a tile lies in a seed, so items whose seeds in the document cover too little
    are left out, and of the document only the tokens in seeds are tiled.
    """
    out = []
    for size in items.sizes:
        hashes, owners, places = items.seeds[size]
        ours = rolling(doc, size)
        first = np.searchsorted(hashes, ours)
        first[first == len(hashes)] = 0
        at = np.flatnonzero(hashes[first] == ours)
        if not len(at):
            continue
        present = np.unique(ours[at])
        low, high = np.searchsorted(hashes, present), np.searchsorted(hashes, present, "right")
        rows = np.concatenate([np.arange(a, b) for a, b in zip(low.tolist(), high.tolist())])
        for k in np.unique(owners[rows]).tolist():
            item = items.texts[k]
            mine = rows[owners[rows] == k]
            under = np.zeros(len(item) + 1, np.int64)
            np.add.at(under, places[mine], 1)
            np.add.at(under, places[mine] + size, -1)
            if (np.cumsum(under)[:-1] > 0).sum() < coverage * len(item):
                continue
            kept = at[np.isin(ours[at], hashes[mine])]
            near = np.zeros(len(doc) + 1, np.int64)
            np.add.at(near, kept, 1)
            np.add.at(near, kept + size, -1)
            where = np.flatnonzero(np.cumsum(near)[:-1] > 0)
            # Runs of the document that lie apart are kept apart by a value no item has.
            gaps = np.flatnonzero(np.diff(where) > 1) + 1
            part = np.insert(doc[where], gaps, ~(np.arange(len(gaps), dtype=np.uint64) * BASE))
            origin = np.insert(where, gaps, -1)
            tiles = [(n, i, int(origin[j])) for n, i, j in tile(item, part, items.least[k])]
            covered = sum(n for n, _, _ in tiles)
            if covered >= coverage * len(item):
                out.append((items.ids[k], len(item), covered, tiles))
    return out


def item_blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> list[DataFrame]:
    """Parts of the benchmark of at most ``limit`` bytes each, a single larger item aside."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), t.alias("text"))
    sized = keep(items.dropDuplicates(), "items")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // limit) * 2 if total > limit else 1
    if count == 1:
        return [sized]
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [sized.where(spread == k) for k in range(count)]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
    item_text: str = "text", least: int = MIN_MATCH, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, item_id, item_tokens, covered_tokens, coverage, tiles): a row for each document and
    test item of which the document's tiles cover at least ``coverage``; clean documents have no row.

    tiles are (length, place in the item, place in the document) in tokens. Tokens are lower-case runs of
    word characters. Items with fewer tokens than ``least`` must occur as a whole; items without
    tokens (NULL, empty) match nothing, as do documents without. Repeated documents give a row each,
    repeated items (equal id and text) count once, rows without id keep a NULL id. An empty table on
    either side gives no rows; other columns are left out.

    Items are searched in blocks of bounded size, each sent to all tasks, in one pass over the
    documents per block; documents are never shuffled, so none of their passages can be a hot key.
    """
    found = None
    for block in item_blocks(benchmark, item_id, item_text, block_bytes):
        rows = block.orderBy("item_id", "text").collect()  # bounded by block_bytes
        items = Items.of([r["item_id"] for r in rows], [r["text"] for r in rows], least)
        part = _search(docs, items, text, doc_id, coverage)
        found = part if found is None else found.unionByName(part)
    return found


SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_tokens", pa.int64()), ("covered_tokens", pa.int64()),
    ("coverage", pa.float64()), ("tiles", pa.list_(pa.struct([(c, pa.int32()) for c in ("length", "item_at", "doc_at")]))),
])
DDL = (
    "doc_id long, item_id long, item_tokens long, covered_tokens long, coverage double, "
    "tiles array<struct<length: int, item_at: int, doc_at: int>>"
)


def _search(docs: DataFrame, items: Items, text: str, doc_id: str, coverage: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for item, size, covered, tiles in matches(tokens(whole), shared.value, coverage):
                places = [{"length": n, "item_at": i, "doc_at": j} for n, i, j in tiles]
                rows.append({
                    "doc_id": doc, "item_id": item, "item_tokens": size, "covered_tokens": covered,
                    "coverage": covered / size, "tiles": places,
                })
        return pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    return map_batches(docs, [doc_id, text], run, DDL)


def clean_documents(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id has no row in ``found``; rows without id can't be named and stay."""
    leaking = found.select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(leaking, doc_id, "left_anti")


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    least: int = MIN_MATCH, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that ``contaminated`` finds in no test item, whatever their ids.

    A row's verdict depends on its text alone and goes by the text's 64-bit hash: leaking rows without id go, and
    clean rows that share an id with a leaking one stay.
    """
    keyed = docs.withColumn("_text_hash", F.xxhash64(F.col(f"`{text}`")))
    found = contaminated(keyed, benchmark, text, "_text_hash", item_id, item_text, least, coverage, block_bytes)
    leaking = found.select(F.col("doc_id").alias("_text_hash")).distinct()
    return keyed.join(leaking, "_text_hash", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
