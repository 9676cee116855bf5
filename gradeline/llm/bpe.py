"""Byte-level BPE: encoding by the ranks of a given vocabulary, and decoding.

Texts of a batch become one array of code-point classes. What a character does to the splitter is a
transition function on a few states; the functions are composed block by block, which is
associative, so all boundaries come out of vector operations and no regular expression runs. Each
slice between boundaries is merged by rank, once per distinct slice and worker.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import importlib
import itertools

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.llm.frames import map_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Slices remembered per worker; the memory is emptied when it is full, which changes no result.
REMEMBERED = 1_000_000
#: Places in a row of the scan.
BLOCK = 64

# Classes of code points: letter, number, white space, anything else, end of a text.
LETTER, NUMBER, SPACE, OTHER, END = range(5)

# What the splitter sees at a character. INNER: white space followed by white space or the end;
# LEAD: a blank that joins the run after it; ALONE: other white space before a run; CLIP1, CLIP2:
# an apostrophe that takes one or two letters with it unless a blank leads it.
(S_LETTER, S_NUMBER, S_OTHER, S_INNER, S_LEAD, S_ALONE, S_CLIP1, S_CLIP2, S_END) = range(9)

# What is open after a character.
(NONE, LETTERS, NUMBERS, OTHERS, INNERS, LED, TAKE1, TAKE2) = range(8)


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a slice starts here) by symbol and state."""
    step = np.zeros((9, 8), np.uint8)
    start = np.ones((9, 8), bool)
    for symbol, run in ((S_LETTER, LETTERS), (S_NUMBER, NUMBERS), (S_OTHER, OTHERS), (S_INNER, INNERS)):
        step[symbol] = run
        start[symbol, run] = False
    for symbol, run in ((S_LETTER, LETTERS), (S_NUMBER, NUMBERS), (S_OTHER, OTHERS)):
        start[symbol, LED] = False
    # An apostrophe takes letters only where it opens a slice.
    for symbol, take in ((S_CLIP1, TAKE1), (S_CLIP2, TAKE2)):
        step[symbol] = take
        step[symbol, [OTHERS, LED]] = OTHERS
        start[symbol, [OTHERS, LED]] = False
    # The letters that an apostrophe takes; after the last of them nothing is open.
    step[S_LETTER, TAKE2], step[S_LETTER, TAKE1] = TAKE1, NONE
    start[S_LETTER, [TAKE1, TAKE2]] = False
    step[S_LEAD] = LED
    step[S_ALONE] = NONE
    step[S_END] = NONE
    start[S_END] = False
    return step, start


STEP, START = _transitions()


@functools.cache
def class_table() -> np.ndarray:
    """The class of each code point, in the Unicode version of the library whose ids are to be met.

    The library is asked once per worker: it leaves out what a pattern does not match, so encoding
    and decoding all code points gives those of one class.
    """
    everything = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        library = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        members = bytes(library.encode_ordinary(everything)).decode("utf-8")
        table[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    return table


def symbols(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The symbol at each place of a batch; ``ends`` are the places that follow each text."""
    classes = class_table()[codes]
    classes[ends] = END
    after = np.append(classes[1:], END)
    out = np.array([S_LETTER, S_NUMBER, S_INNER, S_OTHER, S_END], np.uint8)[classes]
    last = (classes == SPACE) & (after != SPACE) & (after != END)
    out[last] = S_ALONE
    out[last & (codes == 0x20)] = S_LEAD
    quotes = np.flatnonzero((codes == 0x27) & (classes == OTHER) & (after == LETTER))
    if len(quotes):
        padded = np.append(codes, np.zeros(2, codes.dtype))
        one, two = padded[quotes + 1], padded[quotes + 2]
        out[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = S_CLIP1
        pair = one.astype(np.int64) << 32 | two
        out[quotes[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]] = S_CLIP2
    return out


def slice_starts(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a slice starts at each place: the scan of the transition functions.

    Places are laid out in rows of BLOCK. All rows advance together from every state, which composes
    the functions of each row; composing rows gives the state each row begins in; a second pass
    from those states gives the starts.
    """
    n = len(codes)
    seen = np.full(-(-n // BLOCK) * BLOCK, S_END, np.uint8)
    seen[:n] = symbols(codes, ends)
    seen = np.ascontiguousarray(seen.reshape(-1, BLOCK).T)
    states = len(STEP[0])
    flat = STEP.reshape(-1)
    reached = np.tile(np.arange(states, dtype=np.uint8)[:, None], (1, seen.shape[1]))
    for column in seen:
        reached = flat[column.astype(np.intp) * states + reached]
    entry = np.empty(seen.shape[1], np.uint8)
    state = NONE
    for k, row in enumerate(np.ascontiguousarray(reached.T).tolist()):
        entry[k] = state
        state = row[state]
    starts = np.empty(seen.shape, bool)
    opens = START.reshape(-1)
    for k, column in enumerate(seen):
        at = column.astype(np.intp) * states + entry
        starts[k] = opens[at]
        entry = flat[at]
    return np.ascontiguousarray(starts.T).reshape(-1)[:n]


def split_texts(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(all bytes with a zero byte after each text, byte places where slices start, those zero bytes)."""
    joined = b"\0".join([*texts, b""])
    codes = np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), np.uint32)
    width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    place = np.cumsum(width) - width
    stops = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    starts = slice_starts(codes, np.searchsorted(place, stops))
    return joined, place[starts], stops


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.cache
def byte_table(path: str) -> list[bytes]:
    """The bytes of each id; ids without an entry have none."""
    ranks = load_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The ids of one slice: the pair of lowest rank is merged first, the leftmost among equals."""
    if piece in ranks:
        return (ranks[piece],)
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts here
    left = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if middle <= i or middle >= n or end[middle] != stop:  # one of the two has been merged since
            continue
        end[i], end[middle] = stop, -1
        if stop < n:
            left[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (before := left[i]) >= 0 and (r := ranks.get(piece[before:stop])) is not None:
            heapq.heappush(heap, (r, before, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return tuple(out)


_remembered: dict[str, dict[bytes, tuple[int, ...]]] = {}


def encode_batch(texts: list[bytes], path: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its ids and, for each slice, the byte offset after it."""
    ranks = load_ranks(path)
    known = _remembered.setdefault(path, {})
    if len(known) > REMEMBERED:
        known.clear()
    joined, starts, stops = split_texts(texts)
    first = np.searchsorted(starts, np.append(0, stops[:-1] + 1)).tolist()
    until = np.searchsorted(starts, stops).tolist()
    out, begin = [], 0
    for low, high, stop in zip(first, until, stops.tolist()):
        cuts = np.append(starts[low:high], stop)
        bounds = cuts.tolist()
        pieces = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        for piece in set(pieces).difference(known):
            known[piece] = merge(piece, ranks)
        ids = np.fromiter(itertools.chain.from_iterable([known[piece] for piece in pieces]), np.int32)
        out.append((ids, (cuts[1:] - begin).astype(np.int32)))
        begin = stop + 1
    return out


def tokenizer_path(name: str = VOCABULARY) -> str:
    return importlib.import_module("public_tokenizers").path(name)


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def encode(docs: DataFrame, path: str | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids, offsets): the token ids of each text, and the byte offset after each slice.

    Ids are those of the given rank file with every match of the published pattern encoded by
    itself and special tokens treated as text. NULL and empty texts have no ids. One row per row of
    ``docs``, repeated rows and rows without id included; other columns are left out. ``path`` is
    read by the executors, which need the file at the same place. A worker holds a few texts.
    """
    where = path or tokenizer_path()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = encode_batch(_bytes(batch.column(1)), where)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                _lists([ids for ids, _ in found]),
                _lists([cuts for _, cuts in found]),
            ],
            names=["doc_id", "ids", "offsets"],
        )

    return map_batches(docs, [doc_id, text], run, "doc_id long, ids array<int>, offsets array<int>")


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded): the bytes that the ids stand for.

    The digest is over the ids as little-endian unsigned 32-bit integers. NULL ids decode to no bytes.
    """
    where = path or tokenizer_path()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = byte_table(where)
        lists = [np.zeros(0, np.int32) if x is None else x for x in _arrays(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                pa.array([len(x) for x in lists], pa.int64()),
                pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in lists], pa.string()),
                pa.array([b"".join([table[i] for i in x.tolist()]) for x in lists], pa.binary()),
            ],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded"],
        )

    return map_batches(encoded, [doc_id, ids], run, "doc_id long, n_tokens long, ids_sha256 string, decoded binary")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    bounds = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(bounds, np.concatenate([np.zeros(0, np.int32), *arrays]))


def _arrays(column: pa.ListArray) -> list[np.ndarray | None]:
    values = np.asarray(column.values)
    bounds = np.asarray(column.offsets)
    missing = column.is_null().to_pylist()
    return [None if gone else values[a:b] for gone, a, b in zip(missing, bounds[:-1], bounds[1:])]


def token_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: token count, digest of its ids, digest of the bytes they decode to."""
    return decode(encode(docs, path), path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
