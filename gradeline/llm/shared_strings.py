"""Suffix-array dedup: bytes go that a string of some length covers which a document of a smaller id has as well.

Every string of ``length`` bytes belongs to one stretch of its text: consecutive strings whose smallest hash of ``gram``
bytes is the same. The hash depends on the string alone, so equal strings have equal keys wherever they are. Keys that one
text alone has are sifted out. What is left, the different contexts of each key, is dealt to shards. Contexts that no other
one of their key resembles have nothing to be compared with; of the others each shard's suffix array is induced
linearly, and its permuted common prefixes tell which strings are equal and the smallest id that has them.

Nothing grows with a group of copies: keys travel in sorted blocks, keys that many documents have are known from a sample
and do not travel at all, equal contexts are combined before they are shuffled, and a key with too many
different contexts is replaced by one key for each of their strings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.frames import LAST_ID, id_key, map_batches
from gradeline.llm.suffixes import permuted_prefixes, suffix_array
from gradeline.session import reach_package
from gradeline.sources.tables import discard, keep

LENGTH = 50
#: Bytes that are hashed for keys; longer ones repeat less by chance and make shorter stretches.
GRAM = 24
#: Text that is looked through for keys which very many documents have; they decide work, not results.
SAMPLE_BYTES = 64 << 20
#: Such a key is in this share of the sample's documents, and in OFTEN of them at least.
SHARE, OFTEN = 1 / 1000, 20
#: Stretches that one task compares at a time, and bytes of a shard.
BUCKET_STRETCHES = 1_000_000
SHARD_BYTES = 256 << 10
#: Contexts of one key beyond which the key is replaced.
CROWD = 20_000
KEY_BITS = 48

_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
#: An odd number and its inverse modulo 2 ** 16: places in an order without pattern, and back.
_SHUFFLE = 40503
_BACK = pow(_SHUFFLE, -1, 1 << 16)


def stretches(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, n, place): all strings of ``length`` bytes, as stretches of ``n`` that start next to each other, and
    where the bytes of the smallest hash begin.

    Among equal hashes a shuffled order of places decides, so that long repeats have long stretches too.
    """
    n, window = len(data) - gram + 1, length - gram + 1
    if len(data) < length:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    bytes_ = np.frombuffer(data, np.uint8)
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(bytes_, 8)).view("<u8").ravel()
    h = np.zeros(n, np.uint64)
    for offset in [*range(0, gram - 8, 8), gram - 8]:
        h = (h ^ words[offset : offset + n]) * _MIX[0]
        h ^= h >> np.uint64(29)
    h *= _MIX[1]
    h ^= h >> np.uint64(32)
    tie = (np.arange(n, dtype=np.uint64) * np.uint64(_SHUFFLE)) & np.uint64(0xFFFF)
    least, width = (h & ~np.uint64(0xFFFF)) | tie, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if window > width:
        least = np.minimum(least[: width - window], least[window - width :])
    starts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    place = (least[starts] & np.uint64(0xFFFF)).astype(np.int64) * _BACK
    # Smallest hashes are small numbers; keys are dealt evenly.
    key = (least[starts] >> np.uint64(16)) * _MIX[0]
    key = (key ^ (key >> np.uint64(32))) * _MIX[1]
    n = np.diff(np.append(starts, len(least)))
    return key >> np.uint64(64 - KEY_BITS), starts, n, starts + (place - starts) % (1 << 16)


def per_document(texts: list[bytes | None]) -> Iterator[tuple[int, bytes, tuple[np.ndarray, ...]]]:
    for row, data in enumerate(texts):
        if data and len(data) >= LENGTH:
            yield row, data, stretches(data)


def frequent_keys(texts: DataFrame, n_bytes: int) -> np.ndarray:
    """Sorted keys that many documents of a sample have; the sample bounds their number."""
    parts = max(1, -(-n_bytes // SAMPLE_BYTES))
    sample = texts.where(F.pmod(F.xxhash64(F.lit("sample"), "id", "tie"), F.lit(parts)) == 0)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(keys) for _, _, (keys, *_) in per_document(batch.column(0).cast(pa.binary()).to_pylist())]
        keys, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["key", "n"])

    least = F.greatest(F.lit(OFTEN), F.ceil(sample.count() * F.lit(SHARE)))
    keys = map_batches(sample, ["text"], run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return np.sort(keys.select("key").toPandas()["key"].to_numpy(np.int64)).astype(np.uint64)


def among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of every value, byte by byte: like bytes lie together and compress."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def shared_stretches(texts: DataFrame, n_bytes: int, frequent) -> DataFrame:
    """(tie, places): the stretches of a text, by number, whose key a text with another ``tie`` has.

    Keys are compared by as many bits as make chance matches rare. They travel to buckets as sorted blocks, one for each
    bucket that a batch has keys for; frequent keys do not travel.
    """
    n_buckets = max(1, -(-n_bytes // (12 * BUCKET_STRETCHES)))
    bits = min(KEY_BITS, max(32, n_bytes.bit_length() + 10))
    width = -(-bits // 8)
    bounds = np.array([-(-(b << bits) // n_buckets) for b in range(n_buckets)], np.uint64)

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, rows, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for row, _, (found, *_) in per_document(batch.column(1).cast(pa.binary()).to_pylist()):
            kept = np.flatnonzero(~among(found, frequent.value))
            keys.append(found[kept] >> np.uint64(KEY_BITS - bits))
            rows.append(np.full(len(kept), row))
            places.append(kept)
        key, row, place = map(np.concatenate, (keys, rows, places))
        order = np.argsort(key, kind="stable")
        key, row, place = key[order], row[order], place[order]
        cuts = np.append(np.searchsorted(key, bounds), len(key)).tolist()
        ties, out = batch.column(0).to_numpy(), []
        for bucket, (a, z) in enumerate(zip(cuts, cuts[1:])):
            if z > a:
                used, local = np.unique(row[a:z], return_inverse=True)
                out.append((bucket, ties[used].tobytes(), planes(key[a:z], width), planes(local, 2), planes(place[a:z], 4)))
        columns = list(zip(*out)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
            names=["bucket", "ties", "keys", "rows", "places"],
        )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        blocks = [
            np.frombuffer(ties, np.int64)[from_planes(rows, 2).astype(np.int64)] for ties, rows in zip(group["ties"], group["rows"])
        ]
        ties = np.concatenate(blocks)
        keys = np.concatenate([from_planes(x, width) for x in group["keys"]])
        places = np.concatenate([from_planes(x, 4).astype(np.int32) for x in group["places"]])
        order = np.argsort(keys, kind="stable")
        keys, ties, places = keys[order], ties[order], places[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        several = np.minimum.reduceat(ties, starts) != np.maximum.reduceat(ties, starts)
        several = np.repeat(several, np.diff(np.append(starts, len(keys))))
        return pd.DataFrame({"tie": ties[several], "place": places[several]})

    blocks = map_batches(texts, ["tie", "text"], spread, "bucket int, ties binary, keys binary, rows binary, places binary", rows=256)
    found = blocks.groupBy("bucket").applyInPandas(compare, "tie long, place int")
    return found.groupBy("tie").agg(F.collect_list("place").alias("places"))


def contexts(texts: DataFrame, shared: DataFrame, equal: DataFrame, frequent) -> DataFrame:
    """(key, often, hash, id, tie, start, place, body): a row for each shared stretch, with the bytes of its strings and where in
    them those of the key are; ``often`` marks frequent keys. Of the texts that ``equal`` (tie, digest, least) names, those of the smallest id have rows.

    Key and hash stand for the bytes; only the first row of a batch that has them carries them.
    """
    none = F.lit(None)
    known = shared.select("tie", "places", none.cast("struct<digest: binary, least: bigint>").alias("same")).unionByName(
        equal.select("tie", none.cast("array<int>").alias("places"), F.struct("digest", "least").alias("same"))
    ).groupBy("tie").agg(F.max("places").alias("places"), F.collect_list("same").alias("same"))
    copy = F.exists("same", lambda e: (F.col("id") > e["least"]) & (e["digest"] == F.unhex(F.md5("text"))))
    joined = texts.join(known, "tie", "left").where(~F.coalesce((F.size("same") > 0) & copy, F.lit(False)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        parts: list[list] = [[np.zeros(0, np.int64)] for _ in range(6)]
        bodies: list[bytes] = []
        for row, data, (keys, starts, n, places) in per_document(batch.column(2).cast(pa.binary()).to_pylist()):
            often = among(keys, frequent.value)
            wanted = often.copy()
            listed = batch.column(3)[row]
            if listed.is_valid:
                chosen = listed.values.to_numpy()
                wanted[chosen[chosen < len(keys)]] = True
            starts, ends = starts[wanted], (starts + n)[wanted] + LENGTH - 1
            bodies += [data[a:z] for a, z in zip(starts.tolist(), ends.tolist())]
            for part, values in zip(parts, (
                keys[wanted].astype(np.int64), np.full(len(starts), ids[row]), np.full(len(starts), ties[row]), starts, places[wanted] - starts,
                often[wanted],
            )):
                part.append(values)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, bodies), np.uint64, len(bodies)).view(np.int64)
        first = np.ones(len(bodies), bool)
        first[np.unique(hashes, return_index=True)[1]] = False  # the mask of what is left out
        key, id_, tie, start, place, often = map(np.concatenate, parts)
        columns = [key, often.astype(bool), hashes, id_, tie, start.astype(np.int32), place.astype(np.int32)]
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, columns), pa.array(bodies, pa.binary(), mask=first) if bodies else pa.array([], pa.binary())],
            names=["key", "often", "hash", "id", "tie", "start", "place", "body"],
        )

    return map_batches(joined, ["id", "tie", "text", "places"], run,
                       "key long, often boolean, hash long, id long, tie long, start int, place int, body binary", rows=256)


def first_owners(bodies: list[bytes], lows: np.ndarray) -> np.ndarray:
    """For every string of LENGTH bytes of the contexts, context after context, the smallest id that has it.

    The shard's suffixes are sorted; neighbours that share LENGTH bytes within their contexts are equal strings.
    """
    lengths = np.array([len(b) for b in bodies], np.int64)
    joined = np.frombuffer(b"\0".join(bodies) + b"\0\0", np.uint8)
    ends = np.cumsum(lengths + 1) - 1
    symbols = joined.astype(np.int64) + 2
    symbols[ends], symbols[-1] = 1, 0
    sa = suffix_array(symbols, 258)
    prefixes = permuted_prefixes(joined, sa, LENGTH)
    owner = np.append(np.repeat(np.arange(len(bodies)), lengths + 1), 0)
    rest = ends[owner] - np.arange(len(joined))
    whole = rest >= LENGTH
    whole[-1] = False
    at = sa[whole[sa]]
    # Strings that are equal lie side by side in the whole array, so nothing between them was left out.
    fresh = np.append(True, prefixes[at[1:]] < LENGTH)
    starts = np.flatnonzero(fresh)
    least = np.repeat(np.minimum.reduceat(lows[owner[at]], starts), np.diff(np.append(starts, len(at))))
    out = np.full(len(joined), LAST_ID, np.int64)
    out[at] = least
    return out[whole]


def alike(bodies: list[bytes], places: list[int]) -> list[int]:
    """Numbers of the contexts of one key that another one may share a string with.

    A string holds the key's bytes and at least half of its other bytes on one side of them, so contexts that share a string agree
    on one of these. Where the key's bytes are in a context twice, strings may be shared out of step; it always stays.
    """
    if len(bodies) == 1:
        return []
    half = (LENGTH - GRAM) // 2
    sides: list[dict[bytes, list[int]]] = [{}, {}]
    stay = set()
    for i, (body, at) in enumerate(zip(bodies, places)):
        own = body[at : at + GRAM]
        if body.find(own) < at or body.find(own, at + 1) >= 0:
            stay.add(i)
        if at >= half:
            sides[0].setdefault(body[at - half : at + GRAM], []).append(i)
        if at + GRAM + half <= len(body):
            sides[1].setdefault(body[at : at + GRAM + half], []).append(i)
    for side in sides:
        for some in side.values():
            if len(some) > 1:
                stay.update(some)
    return sorted(stay) if len(stay) > 1 else []


def solved(dealt: DataFrame) -> DataFrame:
    """(key, hash, parts): the stretches of each context's strings that some document of it may lose.

    ``dealt`` has (key, hash, body, place, low, high), the bytes and the smallest and largest id of each context. A part
    is (at, n, low): ``n`` strings from number ``at`` on, and the smallest id that has them. All contexts of a key
    are in one shard, ordered by key.
    """
    reach_package(dealt.sparkSession)

    def judge(rows: pa.Table) -> pa.RecordBatch:
        keys, hashes, sizes, lows, highs = (rows.column(c).to_numpy() for c in ("key", "hash", "size", "low", "high"))
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        counts = np.diff(np.append(heads, len(keys)))
        # Bytes of contexts that are alone in their key are not looked at.
        crowd = np.flatnonzero(np.repeat(counts, counts) > 1)
        bodies, places = (rows.column(c).take(pa.array(crowd)).to_pylist() for c in ("body", "place"))
        edges = np.append(0, np.cumsum(counts[counts > 1])).tolist()
        chosen = np.array([a + i for a, z in zip(edges, edges[1:]) for i in alike(bodies[a:z], places[a:z])], np.int64)
        compared = crowd[chosen]
        low, high, n = lows, highs, sizes.astype(np.int64) - LENGTH + 1
        whole = np.setdiff1d(np.arange(len(keys)), compared)
        context, at, size, owner = whole, np.zeros(len(whole), np.int64), n[whole], low[whole]
        if len(compared):
            own = first_owners([bodies[i] for i in chosen.tolist()], low[compared])
            number = np.repeat(np.arange(len(compared)), n[compared])
            starts = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (number[1:] != number[:-1])))
            begin = np.cumsum(n[compared]) - n[compared]
            context = np.append(context, compared[number[starts]])
            at = np.append(at, starts - begin[number[starts]])
            size = np.append(size, np.diff(np.append(starts, len(own))))
            owner = np.append(owner, own[starts])
        kept = np.flatnonzero(owner < high[context])
        kept = kept[np.argsort(context[kept], kind="stable")]
        context, at, size, owner = context[kept], at[kept], size[kept], owner[kept]
        heads = np.flatnonzero(np.append(True, context[1:] != context[:-1])[: len(context)])
        parts = pa.StructArray.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(owner)], names=["at", "n", "low"]
        )
        lists = pa.ListArray.from_arrays(pa.array(np.append(heads, len(context)).astype(np.int32)), parts)
        chosen = context[heads]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[chosen]), pa.array(hashes[chosen]), lists], names=["key", "hash", "parts"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            bytes_ = np.append(0, np.cumsum(batch.column(2).to_numpy() + 1))
            low = 0
            # Places where another key starts: a shard that is large enough ends at the next one.
            for at in np.flatnonzero(np.append(keys[0] != last, keys[1:] != keys[:-1])).tolist():
                if size + bytes_[at] - bytes_[low] >= SHARD_BYTES:
                    yield judge(pa.Table.from_batches([*held, batch.slice(low, at - low)]).combine_chunks())
                    held, size, low = [], 0, at
            held.append(batch.slice(low))
            size, last = size + bytes_[-1] - bytes_[low], keys[-1]
        if held:
            yield judge(pa.Table.from_batches(held).combine_chunks())

    columns = ["key", "hash", F.octet_length("body").cast("long").alias("size"), "body", "place", "low", "high"]
    return dealt.sortWithinPartitions("key", "hash").select(*columns).mapInArrow(
        run, "key long, hash long, parts array<struct<at: int, n: int, low: bigint>>"
    )


def distinct_contexts(pieces: DataFrame, low: str = "id", high: str = "id") -> DataFrame:
    """(key, hash, low, high, body): the contexts with the smallest and largest id that has them."""
    return pieces.groupBy("key", "hash").agg(
        F.min(low).alias("low"), F.max(high).alias("high"), F.max("body").alias("body"), F.max("place").alias("place")
    )


def single_strings(distinct: DataFrame) -> DataFrame:
    """(key, hash, low, high, body, old_key, old_hash, at): every string of the contexts as a context with its own key."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for key, hash_, body, low, high in zip(*(batch.column(i).to_pylist() for i in range(5))):
            for at in range(len(body) - LENGTH + 1):
                own = body[at : at + LENGTH]
                h = xxhash.xxh3_128_intdigest(own)
                new = [x - (1 << 64) if x >> 63 else x for x in (h & (1 << 64) - 1, h >> 64)]
                out.append((*new, low, high, own, 0, key, hash_, at))
        columns = list(zip(*out)) or [()] * 9
        kinds = [pa.int64()] * 4 + [pa.binary(), pa.int32()] + [pa.int64()] * 2 + [pa.int32()]
        names = ["key", "hash", "low", "high", "body", "place", "old_key", "old_hash", "at"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return map_batches(distinct, ["key", "hash", "body", "low", "high"], run,
                       "key long, hash long, low long, high long, body binary, place int, old_key long, old_hash long, at int")


def dealt_contexts(pieces: DataFrame, n_shards: int) -> DataFrame:
    """``distinct_contexts`` dealt by key, for keys that are not frequent: a task has hardly two equal contexts of these, so they
    move once and combine where they are compared."""
    return distinct_contexts(pieces.repartition(n_shards, "key"))


def crowded(pieces: DataFrame, n_groups: int) -> DataFrame:
    """Keys with too many contexts. Counting groups of keys first leaves few keys, or none, to be counted themselves."""
    group = F.pmod(F.col("key"), F.lit(n_groups))
    large = pieces.groupBy(group.alias("part")).agg(F.count("body").alias("n")).where(F.col("n") > CROWD).select("part")
    some = pieces.withColumn("part", group).join(F.broadcast(large), "part", "left_semi")
    return some.groupBy("key").agg(F.count("body").alias("n")).where(F.col("n") > CROWD).select("key")


def owners(pieces: DataFrame, n_shards: int, n_often: int = 1) -> DataFrame:
    """(key, hash, parts) of all contexts; keys with too many contexts are replaced by keys of single strings.

    Contexts of frequent keys combine before they are dealt to ``n_often`` shards, the others are dealt to ``n_shards``.
    """

    def dealt(some: DataFrame) -> DataFrame:
        often = distinct_contexts(some.where("often")).repartition(n_often, "key")
        return solved(dealt_contexts(some.where("NOT often"), n_shards)).unionByName(solved(often))

    crowds = keep(crowded(pieces, 16 * (n_shards + n_often)), "crowded_keys")
    if crowds.isEmpty():
        return dealt(pieces)
    plain = dealt(pieces.join(crowds, "key", "left_anti"))
    strings = keep(single_strings(distinct_contexts(pieces.join(crowds, "key", "left_semi"))), "single_strings")
    found = solved(distinct_contexts(strings, "low", "high").repartition(n_shards + n_often, "key")).select("key", "hash", F.col("parts")[0]["low"].alias("low"))
    part = F.struct("at", F.lit(1).alias("n"), "low")
    split = strings.drop("low", "high", "body", "place").join(found, ["key", "hash"]).groupBy("old_key", "old_hash").agg(F.collect_list(part).alias("parts"))
    return plain.unionByName(split.select(F.col("old_key").alias("key"), F.col("old_hash").alias("hash"), "parts"))


def covered(starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal stretches of bytes that strings cover which start at ``start`` to ``start + n - 1``."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], (starts + n + LENGTH - 1)[order]
    reach = np.maximum.accumulate(ends)
    fresh = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return starts[fresh], reach[np.append(fresh[1:], len(starts)) - 1]


def remove_shared(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, kept, removed), one row per row of ``docs``; other columns are left out.

    A text is its UTF-8 bytes, NULL none. Every byte goes that is covered by a string of LENGTH bytes which a document of a
    smaller id has anywhere; strings are judged as the texts came in. ``kept`` is what stays, binary, since a cut may
    fall inside a character; ``removed`` lists start and end of the maximal stretches that went. Rows that repeat an
    id do not take from each other; rows without id come after all others and do not take from each other either. Texts
    shorter than LENGTH stay whole. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), id_key(doc_id).alias("id"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    marked = rows.withColumn("tie", F.xxhash64("text"))
    # Equal texts are looked at once: all but that of the smallest id lose everything if they are long enough.
    texts = marked.where(F.octet_length("text") >= LENGTH).select("id", "tie", "text")
    named = keep(texts.select("id", "tie", F.unhex(F.md5("text")).alias("digest")), "names")
    equal = keep(
        named.groupBy("tie", "digest").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n"), "equal_texts"
    )
    copies = keep(named.join(equal, ["tie", "digest"]).where(F.col("id") > F.col("least")).select("id", "tie").distinct(), "copies")
    frequent = spark.sparkContext.broadcast(frequent_keys(texts, size))
    shared = keep(shared_stretches(texts, size, frequent), "shared_stretches")
    pieces = keep(contexts(texts, shared, equal, frequent), "contexts")
    discard(named, equal, shared)
    bodies = dict(map(tuple, pieces.groupBy("often").agg(F.sum(F.octet_length("body").cast("long"))).collect()))
    found = keep(owners(pieces, *(max(1, -(-(bodies.get(often) or 0) // (16 * SHARD_BYTES))) for often in (False, True))), "owners")
    lost = F.transform(
        F.filter("parts", lambda p: p["low"] < F.col("id")), lambda p: F.struct((F.col("start") + p["at"]).alias("start"), p["n"].alias("n"))
    )
    ranges = keep(
        pieces.drop("often", "body", "place").join(found, ["key", "hash"]).select("id", "tie", lost.alias("lost")).where(F.size("lost") > 0)
        .groupBy("id", "tie").agg(F.flatten(F.collect_list("lost")).alias("lost")), "lost",
    )
    discard(pieces, found)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept, removed = [], []
        copies, lists = batch.column(2).to_pylist(), batch.column(3)
        for row, data in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
            data = data or b""
            if copies[row]:
                spans, data = [(0, len(data))], b""
            elif lists[row].is_valid:
                found = lists[row].values
                low, high = covered(*(np.asarray(found.field(i), np.int64) for i in (0, 1)))
                spans = list(zip(low.tolist(), high.tolist()))
                edges = [0, *(x for span in spans for x in span), len(data)]
                data = b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2]))
            else:
                spans = []
            kept.append(data)
            removed.append([{"start": a, "end": z} for a, z in spans])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(4), pa.array(kept, pa.binary()), pa.array(removed, span)],
            names=["doc_id", "n_bytes", "kept", "removed"],
        )

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    gone = ranges.withColumn("copy", F.lit(False)).unionByName(copies.select("id", "tie", F.lit(None).alias("lost"), F.lit(True).alias("copy")))
    whole = marked.join(gone, ["id", "tie"], "left").withColumns({"n_bytes": n_bytes, "copy": F.coalesce("copy", F.lit(False))})
    return map_batches(whole, ["doc_id", "text", "copy", "lost", "n_bytes"], run,
                       "doc_id long, n_bytes long, kept binary, removed array<struct<start: bigint, end: bigint>>")


def removal_report(docs: DataFrame) -> DataFrame:
    """One row per document: its bytes, how many went in how many stretches, SHA-256 of the rest."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return remove_shared(docs.select("doc_id", "text")).select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
