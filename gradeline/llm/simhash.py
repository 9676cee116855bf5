"""SimHash near-dedup: fingerprints of word shingles, pigeonhole blocks, verified Hamming links.

Fingerprints are cut into blocks; two that differ in at most ``distance`` bits agree on all blocks
but ``distance``, so they meet under a key of the remaining ones. The fingerprints of a key are compared in one
place and leave a spanning forest of their links, never their pairs. Links are joined to components. Equal
fingerprints are one node from the start.

A key with more fingerprints than one place may hold is compared chunk by chunk. Where that leaves it in more
than one component, it is cut by further blocks of the bits it does not use yet, and so on: keys only get longer, and
keys that are one component already need no more work.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.llm.components import components
from gradeline.llm.frames import map_batches
from gradeline.sources.tables import keep

SHINGLE = 4
DISTANCE = 4
#: Keys are so long that about this many fingerprints, in bits, share one by chance.
SHARED_BITS = 7
SEED = 42
#: Keys shared by more fingerprints than CROWD are compared in chunks of about CHUNK and then made longer.
CROWD = 8192
CHUNK = 8192
#: Shingles whose bits are counted at a time.
STEP = 1 << 16


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """The bits that more than half of the shingles' hashes have; 0 without words."""
    found = (text or b"").lower().split()  # of bytes: ASCII case and ASCII white space only
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(found) - size + 1)
    last = ends[min(size, len(found)) - 1 :]
    digest, bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for low in range(0, n, STEP):
        bounds = zip(starts[low : min(n, low + STEP)].tolist(), last[low : low + STEP].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in bounds], "<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE
) -> DataFrame:
    """(doc_id, text_key, fp): one row per row of ``docs``; fp holds the 64 bits as a signed long.

    text_key is the text's XXH64, which tells apart rows that share an id.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        found = np.array([fingerprint(t, size) for t in texts], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(2), pa.array(found)], names=["doc_id", "text_key", "fp"]
        )

    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), text_key(text).alias("text_key")
    )
    return map_batches(rows, ["doc_id", "text", "text_key"], run, "doc_id long, text_key long, fp long")


def text_key(text: str) -> Column:
    return F.xxhash64(F.col(f"`{text}`"))


def blocks_for(n: int, distance: int = DISTANCE) -> int:
    """The fewest blocks whose keys are long enough that of ``n`` fingerprints few share one by chance.

    Any number of blocks above ``distance`` finds all close pairs; more blocks mean longer keys, so
    fewer comparisons, and more keys: 5 up to half a million fingerprints, 35 at 10^10.
    """
    wanted = min(max(n, 1).bit_length() - SHARED_BITS, 48)
    blocks = distance + 1
    while 64 * (blocks - distance) // blocks < wanted:
        blocks += 1
    return blocks


def block_masks(distance: int, blocks: int) -> list[int]:
    """A mask, as a signed long, for each choice of the blocks that a close pair may agree on."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    return [signed(sum(chosen)) for chosen in combinations(parts, blocks - distance)]


def longer_masks(mask: int, distance: int) -> list[int]:
    """The masks that add one of ``distance + 1`` blocks of the bits that ``mask`` leaves out."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    edges = [round(len(free) * i / (distance + 1)) for i in range(distance + 2)]
    return [signed(mask % (1 << 64) | sum(1 << b for b in free[a:z])) for a, z in zip(edges, edges[1:])]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def forest(values: np.ndarray, distance: int) -> np.ndarray:
    """Pairs of positions, fewer than values, that join all that close pairs join."""
    n = len(values)
    step = max(1, (1 << 20) // n)
    near = np.concatenate([
        (np.bitwise_count(values[low : low + step, None] ^ values[None, :]) <= distance).sum(1) for low in range(0, n, step)
    ])
    rest, out = np.flatnonzero(near > 1), []
    while len(rest):
        waiting, rest = [rest[-1]], rest[:-1]
        while waiting and len(rest):
            i = waiting.pop()
            met = np.bitwise_count(values[rest] ^ values[i]) <= distance
            found = rest[met]
            if len(found):
                out.append(np.stack([np.full(len(found), i), found], 1))
                waiting.extend(found.tolist())
                rest = rest[~met]
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def forests(keys: DataFrame, distance: int, chunk: Column | None = None) -> DataFrame:
    """(a, b): links among the fingerprints of every (mask, key), or of every chunk of it."""
    grouped = keys.groupBy("mask", "key", (F.lit(0) if chunk is None else chunk).alias("chunk"))
    groups = grouped.agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [np.zeros((0, 2), np.int64)]
        for row in range(batch.num_rows):
            values = batch.column(0)[row].values.to_numpy()
            out.append(values[forest(values.view(np.uint64), distance)])
        links = np.concatenate(out)
        return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    return map_batches(groups, ["fps"], run, "a long, b long")


def keyed(rows: DataFrame, masks: Column) -> DataFrame:
    """(mask, key, ...): each row once for each of its masks."""
    others = [c for c in rows.columns if c not in ("mask", "key")]
    return rows.select(*others, F.explode(masks).alias("mask")).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), *others
    )


def near_links(fps: DataFrame, distance: int, blocks: int) -> DataFrame:
    """(a, b): links among distinct fingerprints (fp) that join whatever differs in few enough bits."""
    band = ["mask", "key"]
    keys = keyed(fps.select("fp"), F.array(*[F.lit(m).cast("long") for m in block_masks(distance, blocks)]))
    crowds = keep(keys.groupBy(*band).agg(F.count("*").alias("n")).where(F.col("n") > CROWD), "crowds")
    if crowds.isEmpty():
        return forests(keys, distance)
    links = keep(forests(keys.join(crowds, band, "left_anti"), distance), "links")
    crowded = keep(keys.join(crowds, band), "crowded")
    while not crowded.isEmpty():
        chunk = F.pmod(F.xxhash64(F.lit("chunk"), "fp"), F.ceil(F.col("n") / CHUNK))
        links = links.unionByName(keep(forests(crowded, distance, chunk), "links"))
        crowded, few = _lengthened(crowded, links, distance)
        links = links.unionByName(keep(forests(few, distance), "links"))
    return links


def _lengthened(crowded: DataFrame, links: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of crowded keys under longer keys: (those still crowded, the others).

    Keys whose fingerprints are in one component by now have nothing left to find and go.
    """
    band = ["mask", "key"]
    roots = components(links)
    named = crowded.drop("n").withColumn("root", F.col("fp"))
    if roots is not None:
        joined = crowded.drop("n").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        named = keep(joined.withColumn("root", F.coalesce("root", "fp")), "named")

    def mixed(rows: DataFrame, name: str) -> DataFrame:
        sizes = rows.groupBy(*band).agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most"))
        return keep(sizes.where("least <> most").select(*band, "n"), name)

    left = named.join(mixed(named, "mixed").drop("n"), band, "left_semi")
    masks = [r["mask"] for r in left.select("mask").distinct().collect()]  # of settings, not of data
    if not masks:
        none = crowded.limit(0)
        return none, none.drop("n")
    longer = F.create_map(*[
        part for m in masks for part in (F.lit(m).cast("long"), F.array(*[F.lit(x).cast("long") for x in longer_masks(m, distance)]))
    ])
    keys = keep(keyed(left.select("mask", "fp", "root"), longer[F.col("mask")]).distinct(), "longer")
    sizes = mixed(keys, "sizes")
    met = keys.drop("root").join(sizes, band)
    return keep(met.where(F.col("n") > CROWD), "crowded"), met.where(F.col("n") <= CROWD).drop("n")


def rooted(marked: DataFrame, distance: int, blocks: int | None) -> DataFrame:
    """(fp, first, root): every distinct fingerprint with its smallest id and the component it is in."""
    nodes = keep(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    blocks = blocks or blocks_for(nodes.count(), distance)
    roots = components(near_links(nodes, distance, blocks))
    if roots is None:
        return nodes.withColumn("root", F.col("fp"))
    joined = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return keep(joined.select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE, blocks: int | None = None,
    size: int = SHINGLE,
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    The fingerprint is 16 hexadecimal digits. Fingerprints that differ in at most ``distance`` bits
    are linked through ``blocks`` blocks, by default as many as their number asks for, and component_id is the
    smallest id that links reach, the row's own included. Texts
    without words (NULL, empty, blank) have fingerprint 0 and are linked like others. Repeated rows are in one
    component; rows without id belong to components but never name one, unless it has no other
    rows: then component_id is NULL. An empty table gives an empty table; other columns are left out.
    """
    marked = keep(fingerprints(docs, text, doc_id, size), "fingerprints")
    nodes = rooted(marked, distance, blocks)
    smallest = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = nodes.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_each(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", distance: int = DISTANCE, blocks: int | None = None,
    size: int = SHINGLE,
) -> DataFrame:
    """One row of ``docs`` for each component of ``near_duplicates``: of the smallest id, rows without id last.

    Rows are told apart by id and text, so repeated and missing ids lose no other text. Equal ids in a component
    are settled by the text's hash, rows equal in both by their other columns. All columns stay as they are, whatever
    their names.
    """
    marked = keep(fingerprints(docs, text, doc_id, size), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    chosen = (
        marked.join(rooted(marked, distance, blocks).select("fp", "root"), "fp")
        .groupBy("root").agg(F.min(order).alias("k"))
        .select(F.col("k.doc_id").alias("chosen_id"), F.col("k.text_key").alias("chosen_key"))
    )
    whole = docs.select(F.struct("*").alias("row"), F.col(f"`{doc_id}`").cast("long").alias("id"), text_key(text).alias("key"))
    same = F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("key") == F.col("chosen_key"))
    order = [F.col("row").getField(c) for c in docs.columns]
    place = F.row_number().over(Window.partitionBy("id", "key").orderBy(*order))
    return whole.join(chosen, same, "left_semi").withColumn("place", place).where("place = 1").select("row.*")
