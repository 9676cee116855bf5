"""Token counts by overlap resynchronisation: huge texts are counted in overlapping chunks.

Each chunk but the first starts somewhere in the middle of a word, so its first tokens mean nothing.
The splitter before the merges looks only ahead and only a few characters, so once two chunks agree
on a place where a slice starts, everything after it is the same in both. Chunks are spliced at such
places; where an overlap has none, it is widened.
"""

from __future__ import annotations

import functools
import importlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gradeline.llm.frames import map_batches
from gradeline.sources.tables import keep

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Texts of more code points than this are counted in chunks.
CHUNK = 1 << 15
OVERLAP = 256
#: The splitter never looks further ahead than this, added tokens aside.
LOOK_AHEAD = 2


@functools.cache
def load(path: str) -> tuple[Tokenizer, np.ndarray, int]:
    """(tokenizer, bytes of each id, margin): a slice that ends a margin before a cut is not touched by it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    size = max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1
    lengths = np.zeros(size, np.int64)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        lengths[i] = len(token)  # the byte-level alphabet has one character for each byte
    added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    for i, content in added.items():
        lengths[i] = len(content.encode())
    return tokenizer, lengths, LOOK_AHEAD + max(map(len, added.values()), default=0)


def count(texts: list[str], path: str) -> list[int]:
    tokenizer = load(path)[0]
    return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def slice_starts(text: str, path: str) -> tuple[int, np.ndarray, np.ndarray]:
    """(tokens, code points where slices start, tokens before each of them) of a text encoded alone."""
    tokenizer, lengths, _ = load(path)
    encoding = tokenizer.encode(text, add_special_tokens=False)
    ids = np.array(encoding.ids, np.int64)
    slices = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
    ends = np.cumsum(lengths[ids])
    raw = np.frombuffer(text.encode(), np.uint8)
    if len(raw) != (ends[-1] if len(ends) else 0):
        raise ValueError("the tokenizer changes texts before it splits them; chunks can't be aligned")
    first = np.flatnonzero(np.append(True, slices[1:] != slices[:-1])) if len(ids) else np.zeros(0, np.int64)
    byte = (ends - lengths[ids])[first]
    starts_before = np.append(0, np.cumsum((raw & 0xC0) != 0x80))  # code points before each byte
    return len(ids), starts_before[byte], first


def chunk_edges(text: str, start: int, overlap: int, is_first: bool, is_last: bool, path: str) -> tuple:
    """(tokens, places near the head, tokens before them, places near the tail, tokens before them).

    Places count from the start of the whole text. Only places are given whose slices no cut can
    change: a margin from the end of the chunk unless the text ends there.
    """
    margin = load(path)[2]
    tokens, places, before = slice_starts(text, path)
    end = len(text)
    sure = places <= (end if is_last else end - margin)
    head = sure & (places < overlap) & (not is_first)
    tail = sure & (places >= end - overlap) & (not is_last)
    return tokens, places[head] + start, before[head], places[tail] + start, before[tail]


EDGES = "head array<long>, head_tokens array<long>, tail array<long>, tail_tokens array<long>"


def count_chunks(chunks: DataFrame, path: str) -> DataFrame:
    """(_id, _text, part, start, tokens, head, head_tokens, tail, tail_tokens) for each chunk."""
    columns = ["_id", "_text", "part", "start", "overlap", "is_last", "piece"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.to_pylist()
        found = [
            chunk_edges(r["piece"], r["start"], r["overlap"], r["part"] == 0, r["is_last"], path) for r in rows
        ]
        lists = [pa.array([f[k].tolist() for f in found], pa.list_(pa.int64())) for k in range(1, 5)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in range(4)), pa.array([f[0] for f in found], pa.int64()), *lists],
            names=["_id", "_text", "part", "start", "tokens", "head", "head_tokens", "tail", "tail_tokens"],
        )

    return map_batches(chunks, columns, run, f"_id long, _text long, part int, start long, tokens long, {EDGES}", 1)


def cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """The chunks of (_id, _text, whole): ``chunk`` code points each and ``overlap`` more, equal texts once.

    The last chunk is the first that reaches the end. Chunks are dealt out by number, so those of one
    text are counted by many tasks.
    """
    columns = ["_id", "_text", "part", "start", "overlap", "is_last", "piece"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for r in batch.to_pylist():
            text = r["whole"]
            parts = max(1, -(-(len(text) - overlap) // chunk))
            rows += [
                (r["_id"], r["_text"], k, k * chunk, overlap, k == parts - 1, text[k * chunk : (k + 1) * chunk + overlap])
                for k in range(parts)
            ]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)], names=columns
        )

    ddl = "_id long, _text long, part int, start long, overlap long, is_last boolean, piece string"
    return map_batches(texts, ["_id", "_text", "whole"], run, ddl, 1).dropDuplicates(["_id", "_text", "part"])


def spliced(counted: DataFrame) -> DataFrame:
    """(_id, _text, n_tokens): NULL where two neighbours have no common place.

    Up to a common place the left chunk counts, after it the right one: the last chunk counts whole,
    and each seam adds what the left chunk has before the place and takes off what the right one has.
    Overlaps are no wider than chunks, so places follow each other and each chunk is in step before
    the place at which it hands over.
    """
    chain = counted.select(
        "_id", "_text", "tokens", "head", "head_tokens", "tail", "tail_tokens", "part",
        F.explode(F.array("part", F.col("part") + 1)).alias("seam"),
    ).where("seam > 0")
    # A seam has the chunk before it and the chunk after it.
    side = F.col("part") < F.col("seam")
    seams = chain.groupBy("_id", "_text", "seam").agg(
        F.max(F.when(side, F.struct("tail", "tail_tokens"))).alias("l"),
        F.max(F.when(~side, F.struct("head", "head_tokens"))).alias("r"),
    ).where("r is not null")
    common = F.array_min(F.array_intersect("l.tail", "r.head"))
    at = seams.where("l is not null").withColumn("place", common)
    left = F.get(F.col("l.tail_tokens"), (F.array_position("l.tail", F.col("place")) - 1).cast("int"))
    right = F.get(F.col("r.head_tokens"), (F.array_position("r.head", F.col("place")) - 1).cast("int"))
    seam_rows = at.select(
        "_id", "_text", (left - right).alias("shift"), F.col("place").isNull().alias("failed"),
        (F.col("seam") - 1).alias("part"),
    )
    joined = counted.select("_id", "_text", "part", "tokens").join(seam_rows, ["_id", "_text", "part"], "left")
    return joined.groupBy("_id", "_text").agg(
        F.max(F.coalesce("failed", F.lit(False))).alias("failed"),
        F.sum(F.when(F.col("failed").isNull(), F.col("tokens")).otherwise(F.col("shift"))).alias("n_tokens"),
    ).select("_id", "_text", F.when(~F.col("failed"), F.col("n_tokens")).alias("n_tokens"))


def count_tokens(
    docs: DataFrame, path: str | None = None, text: str = "text", doc_id: str = "doc_id",
    chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    Counts are those of the tokenizer file with nothing added, its special strings inside texts
    taken as it takes them by default, and nothing truncated. Texts of up to ``chunk`` code points
    are counted at once. Longer ones are cut into chunks that are dealt to all tasks; a text whose
    chunks can't be aligned is cut again with overlaps eight times as wide until it can, at the
    latest when one chunk holds it.

    NULL and empty texts have no bytes and no tokens. Repeated rows and rows without id each get
    their row; extra columns are left out. The executors read the tokenizer file at ``path``.
    """
    where = path or importlib.import_module("public_tokenizers").path(VOCABULARY)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole.alias("whole"))
    is_long = F.char_length("whole") > chunk

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = count(batch.column(2).to_pylist(), where)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
        )

    sized = rows.withColumn("n_bytes", F.octet_length("whole").cast("long"))
    short = map_batches(
        sized.where(~is_long), ["doc_id", "n_bytes", "whole"], run, "doc_id long, n_bytes long, n_tokens long"
    )
    # Equal long texts are counted once; the hash of the text stands for it.
    marked = sized.where(is_long).withColumns({
        "_id": F.xxhash64("whole"), "_text": F.xxhash64(F.lit(1), "whole"),
    })
    texts = marked.select("_id", "_text", "whole")
    width, size = overlap, max(chunk, overlap)
    counts = keep(spliced(keep(count_chunks(cut(texts, size, width), where), "chunks")), "counts")
    done = counts.where("n_tokens is not null")
    while not (left := counts.where("n_tokens is null")).isEmpty():
        width *= 8
        size = max(chunk, width)
        again = texts.join(left.select("_id", "_text"), ["_id", "_text"], "left_semi")
        counts = keep(spliced(keep(count_chunks(cut(again, size, width), where), "chunks")), "counts")
        done = done.unionByName(counts.where("n_tokens is not null"))
    long = marked.select("doc_id", "n_bytes", "_id", "_text").join(done, ["_id", "_text"])
    both = short.unionByName(long.select("doc_id", "n_bytes", "n_tokens"))
    return both.withColumn("over_limit", F.col("n_tokens") > limit)
