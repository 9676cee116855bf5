"""Periodic runs: stretches of words that repeat a period, found from the suffixes of each text.

Suffixes are ordered by prefix doubling. Going down the common prefixes (LCP) of neighbours, as Kruskal goes
along edges, classes of suffixes are united; each holds its positions in order. Two positions that become neighbours when
the prefix is ``l``, at a distance within it, seed a run: it has that distance as its smallest period and ends where the
prefix ends. Classes whose prefixes are too short for any wanted run are never built.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.llm.frames import bind, map_batches, words

#: A run repeats its period at least so often and has at least so many words.
EXPONENT = 4
LENGTH = 6
#: Positions in one block of an ordered set.
BLOCK = 1024
RUN_DDL = "array<struct<start: bigint, length: bigint, period: bigint>>"


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, starts): all texts behind each other; no two texts share a symbol, and each ends in one of its own."""
    symbols, starts, first = [], [], 0
    for found in texts:
        starts.append(len(symbols))
        known: defaultdict[bytes, int] = defaultdict()
        known.default_factory = lambda known=known, first=first: first + len(known)
        symbols += map(known.__getitem__, found)
        first += len(known) + 1
        symbols.append(first - 1)
    return np.array(symbols, np.int64), np.array([*starts, len(symbols)], np.int64)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of keys in order: (their order, the place of each group's first, whether the group has more than one)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    sizes = np.diff(np.append(starts, len(ordered)))
    return order, np.repeat(starts, sizes), np.repeat(sizes > 1, sizes)


def shared_suffixes(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, lcp): the suffixes that share ``least`` symbols or more with another one, in suffix order, and the
    common prefix of each but the first with the one before it.

    Symbols may be ordered in any way. Ranks are places, so a suffix that is alone keeps its rank and is not
    sorted again. What shares ``width`` symbols with another suffix ends before the last symbol, which is unique.
    """
    order, group, more = grouped(symbols)
    rank = np.empty(len(symbols), np.int32)
    rank[order] = group
    levels, active, width = [rank], np.sort(order[more]), 1
    shared = active if least <= 1 else active[:0]
    while len(active):
        whole = rank[active].astype(np.int64) * len(symbols)
        if width < least <= 2 * width:
            order, _, more = grouped(whole + rank[active + least - width])
            shared = active[order[more]]
        order, group, more = grouped(whole + rank[active + width])
        old = rank[active[order]]
        heads = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        rank = rank.copy()
        rank[active[order]] = old + group - np.repeat(heads, np.diff(np.append(heads, len(order))))
        levels.append(rank)
        active, width = np.sort(active[order[more]]), 2 * width
    shared = shared[np.argsort(rank[shared])]
    a, b = shared[:-1].copy(), shared[1:].copy()
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        equal = levels[k][a] == levels[k][b]
        for side in (lcp, a, b):
            side[equal] += 1 << k
    return shared, lcp


class Ordered:
    """A set of positions in blocks of bounded size, so that adding to a large one moves few of them."""

    def __init__(self, position: int):
        self.blocks, self.lasts, self.size = [[position]], [position], 1

    def __iter__(self):
        for block in self.blocks:
            yield from block

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The positions before and after ``x``, which is not in the set."""
        at = bisect_left(self.lasts, x)
        if at == len(self.blocks):
            return self.lasts[-1], None
        block = self.blocks[at]
        i = bisect_left(block, x)
        before = block[i - 1] if i else self.lasts[at - 1] if at else None
        return before, block[i]

    def add(self, x: int) -> None:
        at = min(bisect_left(self.lasts, x), len(self.blocks) - 1)
        block = self.blocks[at]
        insort(block, x)
        if len(block) > 2 * BLOCK:
            self.blocks[at : at + 1] = [block[:BLOCK], block[BLOCK:]]
            self.lasts[at : at + 1] = [block[BLOCK - 1], block[-1]]
        else:
            self.lasts[at] = block[-1]
        self.size += 1


def neighbours(positions: np.ndarray, lcp: np.ndarray, exponent: int) -> list[tuple[int, int, int]]:
    """(position, distance, l): pairs that become neighbours when classes are united at common prefix ``l``, if ``l`` is
    at least ``exponent - 1`` times the distance."""
    root = list(range(len(positions)))
    sets: list[Ordered | None] = [Ordered(p) for p in positions.tolist()]
    out = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = np.argsort(-lcp, kind="stable")
    for edge, l in zip(order.tolist(), lcp[order].tolist()):
        a, b = find(edge), find(edge + 1)
        if sets[a].size < sets[b].size:
            a, b = b, a
        large, small = sets[a], sets[b]
        reach = l // (exponent - 1)
        moved = list(small)
        for i, x in enumerate(moved):
            before, after = large.around(x)
            if before is not None and x - before <= reach and (i == 0 or moved[i - 1] < before):
                out.append((before, x - before, l))
            if after is not None and after - x <= reach and (i + 1 == len(moved) or moved[i + 1] > after):
                out.append((x, after - x, l))
        for x in moved:
            large.add(x)
        root[b], sets[b] = a, None
    return out


def found_runs(symbols: np.ndarray, exponent: int = EXPONENT, length: int = LENGTH) -> np.ndarray:
    """(start, length, period) of every run of ``symbols``, by start and period."""
    least = min(max(length - p, (exponent - 1) * p) for p in range(1, length + 1))
    positions, lcp = shared_suffixes(symbols, least)
    none = np.zeros((0, 3), np.int64)
    if not len(positions):
        return none
    # A class whose positions are all too far apart for its longest prefix has no run in it.
    group = np.append(0, np.cumsum(lcp < least))
    inner = np.flatnonzero(lcp >= least)
    longest = np.zeros(group[-1] + 1, np.int64)
    np.maximum.at(longest, group[inner], lcp[inner])
    by_place = np.lexsort((positions, group))
    gaps, same = np.diff(positions[by_place]), np.diff(group[by_place]) == 0
    nearest = np.full(group[-1] + 1, len(symbols), np.int64)
    np.minimum.at(nearest, group[by_place][1:][same], gaps[same])
    wanted = (longest >= (exponent - 1) * nearest)[group]
    if not wanted.any():
        return none
    inside = wanted[1:] & wanted[:-1] & (lcp >= least)
    seeds: list[tuple[int, int, int]] = []
    bounds = np.flatnonzero(np.diff(np.append(False, np.append(inside, False)).astype(np.int8)))
    for low, high in bounds.reshape(-1, 2).tolist():
        seeds += neighbours(positions[low : high + 1], lcp[low:high], exponent)
    if not seeds:
        return none
    at, period, l = np.array(seeds, np.int64).T
    # Of the pairs of a position at one prefix only the nearest is left when all classes of that prefix are united.
    order = np.lexsort((period, l, at))
    at, period, l = at[order], period[order], l[order]
    nearest_pair = np.append(True, (at[1:] != at[:-1]) | (l[1:] != l[:-1]))
    begins = (at == 0) | (symbols[at - 1] != symbols[at - 1 + period])
    good = nearest_pair & begins & (l + period >= length) & (l >= (exponent - 1) * period)
    runs = np.stack([at[good], l[good] + period[good], period[good]], 1)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words are in no run or only among the first words, one period of them, of those they are in."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def find_runs(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", exponent: int = EXPONENT, length: int = LENGTH
) -> DataFrame:
    """(doc_id, runs, collapsed), one row per row of ``docs``; other columns are left out.

    ``runs`` lists start, length and period in words, by start and then period, of every stretch of at least ``length`` words
    that repeats its smallest period at least ``exponent`` times (2 or more) and that no neighbouring word extends.
    ``collapsed`` has the words that no run contains beyond its first period, joined by one space. Words are
    what ASCII white space separates. NULL, empty and blank texts have no runs and an empty text. Repeated rows and
    rows without id are judged each by themselves; an empty table gives an empty table.

    A text is judged in one task; memory is about 10 numbers a word and one more for each doubling of its longest repeat.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
        symbols, starts = numbered(texts)
        runs = found_runs(symbols, exponent, length)
        cuts = np.searchsorted(runs[:, 0], starts)
        collapsed = []
        for found, start, low, high in zip(texts, starts.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
            runs[low:high, 0] -= start
            if high > low:
                found = [found[i] for i in np.flatnonzero(kept_words(len(found), runs[low:high])).tolist()]
            collapsed.append(b" ".join(found))
        rows = pa.StructArray.from_arrays([pa.array(c) for c in runs.T.copy()], names=["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows), pa.array(collapsed, pa.binary()).cast(pa.string())],
            names=["doc_id", "runs", "collapsed"],
        )

    return map_batches(docs, [doc_id, text], run, f"doc_id long, runs {RUN_DDL}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of the greatest length by period, the first of equal ones; NULL without runs."""
    def better(best: Column, x: Column) -> Column:
        return F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def with_repeats(doc_id: Column, text: Column) -> Column:
    """The text of a document of the report: of every tenth, by CRC-32 of the id, the end repeats a period of its words."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeated(found: Column) -> Column:
        n = F.size(found)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        end = F.transform(F.sequence(a, n - 1), lambda i: F.get(found, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(found, 1, a), end), " ")).otherwise(F.lit(""))

    return F.when(h % 10 == 0, bind(words(text), repeated)).otherwise(text)


def run_report(docs: DataFrame) -> DataFrame:
    """One row per document: the number of runs, the strongest one, digests of all runs and of the collapsed text."""
    rows = docs.select("doc_id", with_repeats(F.col("doc_id"), F.col("text")).alias("text"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    best = F.col("best")
    return find_runs(rows).withColumn("best", strongest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
