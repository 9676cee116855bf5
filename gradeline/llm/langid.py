"""Language identification by interpolated Kneser-Ney character models, one per language.

The n-grams of the highest order are counted over all training texts; lower orders count in how many
ways a gram is continued to the left. The model is tables of (gram hash,
language, probability) of any size, read block by block into sorted arrays. A text goes to the language with the lowest cross-entropy
per character, unless even that is higher than held-back texts of the language ever show.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeline.llm.bpe import LETTER, class_table
from gradeline.llm.frames import held_out, map_batches
from gradeline.session import reach_package
from gradeline.sources.tables import keep

ORDER = 4
#: Bytes of the model that are sent to all tasks in one pass over the texts; a larger model takes more passes.
BLOCK_BYTES = 64 << 20
#: Bytes of a row of the model: hash, language and value, and the hash's place.
ROW_BYTES = 32
#: Distinct grams of a batch whose probabilities in all languages are looked up at a time.
STEP = 1 << 15
#: Labelled texts that are kept out of the counts and set the rejection limits.
CALIBRATION_ROWS = 2_000
REJECT_SHARE = 0.001
UNKNOWN = "und"
#: Distinct grams a worker gathers before it hands them on.
GATHERED = 1_000_000


def normalised(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, the text of each): lower case, one blank for what lies between letters.

    ``order - 1`` blanks precede each text, so no gram reaches from one text into another's letters.
    """
    pad = " " * (order - 1)
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(pad + t + " " for t in lowered).encode("utf-32-le", "replace"), np.uint32)
    lengths = np.fromiter((len(t) + order for t in lowered), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    letter = class_table()[codes] == LETTER
    begins = np.cumsum(lengths) - lengths
    lead = np.zeros(len(codes), bool)
    for k in range(order - 1):
        lead[begins + k] = True
    before = np.append(False, letter[:-1])
    stay = letter | lead | before
    return np.where(letter, codes, 0x20)[stay].astype(np.int64), owner[stay]


def grams(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct windows as rows of code points, the row of each window); windows end at places order - 1 on."""
    alphabet, letters = _distinct(codes)
    index, rows = letters, alphabet[:, None]
    for k in range(1, order):
        wide = index[: len(letters) - k] * len(alphabet) + letters[k:]
        found, index = _distinct(wide)
        rows = np.column_stack([rows[found // len(alphabet)], alphabet[found % len(alphabet)]])
    return rows, index


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with inverse; small values are marked in a table instead of being sorted."""
    top = int(values.max(initial=0)) + 1
    if top > 8 * len(values) + (1 << 21):
        return np.unique(values, return_inverse=True)
    seen = np.zeros(top, bool)
    seen[values] = True
    place = np.cumsum(seen, dtype=np.int32) - 1
    return np.flatnonzero(seen), place[values].astype(np.int64)


def hashes(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of code points."""
    h = np.full(len(rows), 0x9E3779B97F4A7C15, np.uint64)
    for column in rows.T:
        h = (h ^ column.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


def count_grams(texts: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) over the columns (lang, text): all grams of the highest order."""
    reach_package(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counter)), pa.array(list(counter)), pa.array(list(counter.values()), pa.int64())],
                    names=["lang", "gram", "n"],
                )
            held.clear()

        for whole in batches:
            for low in range(0, whole.num_rows, 64):
                batch = whole.slice(low, 64)
                by_lang: dict[str, list[str]] = {}
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    by_lang.setdefault(lang, []).append(text)
                for lang, group in by_lang.items():
                    codes, _ = normalised(group, order)
                    rows, index = grams(codes, order)
                    flat = rows.astype("<u4").tobytes().decode("utf-32-le")
                    names = [flat[i : i + order] for i in range(0, len(flat), order)]
                    held.setdefault(lang, Counter()).update(dict(zip(names, np.bincount(index).tolist())))
                if sum(map(len, held.values())) > GATHERED:
                    yield from flush()
        yield from flush()

    counted = texts.select("lang", "text").mapInArrow(run, "lang string, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Sparse:
    """Ascending hashes, each with the languages that have a value for it and the values."""

    keys: np.ndarray
    starts: np.ndarray
    langs: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, hashed: np.ndarray, langs: np.ndarray, values: np.ndarray) -> Sparse:
        order = np.argsort(hashed, kind="stable")
        keys, starts = np.unique(hashed[order], return_index=True)
        return cls(keys, np.append(starts, len(order)), langs[order].astype(np.int32), values[order])

    def look_up(self, wanted: np.ndarray, languages: int, missing: float) -> np.ndarray:
        """A row of one value per language for each wanted hash."""
        out = np.full((len(wanted), languages), missing)
        if not len(self.keys):
            return out
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        rows = np.flatnonzero(self.keys[at] == wanted)
        first, count = self.starts[at[rows]], self.starts[at[rows] + 1] - self.starts[at[rows]]
        which = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        out[np.repeat(rows, count), self.langs[which]] = self.values[which]
        return out


@dataclass
class Block:
    """The part of a model for windows of one group of middles: per order, the discounted probabilities of
    grams and the weights of the next lower order of contexts (1 where unseen)."""

    number: int
    of: int
    order: int
    languages: int
    levels: list[tuple[Sparse, Sparse]]
    floor: float

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """ln p(last character | the ones before) per row and language."""
        p = np.full((len(rows), self.languages), self.floor)
        for k, (grams_of, contexts_of) in enumerate(self.levels, 1):
            gram, context = rows[:, self.order - k :], rows[:, self.order - k : self.order - 1]
            share = grams_of.look_up(hashes(gram), self.languages, 0.0)
            p = share + contexts_of.look_up(hashes(context), self.languages, 1.0) * p
        return np.log(p)

    def mine(self, rows: np.ndarray) -> np.ndarray:
        """Whether the block is the one for a window, by the two characters before the last."""
        return hashes(rows[:, max(0, self.order - 3) : self.order - 1]) % np.uint64(self.of) == self.number

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sums of ln p over the block's windows, by text and language; all windows of each text, 0 without letters)."""
        out = np.zeros((len(texts), self.languages))
        codes, owner = normalised(texts, self.order)
        lettered = np.bincount(owner, weights=codes != 0x20, minlength=len(texts)) > 0
        if len(codes) < self.order:
            return out, np.zeros(len(texts), np.int64)
        rows, index = grams(codes, self.order)
        mine = owner[self.order - 1 :]
        # Windows that end in the blanks before a text say nothing about it.
        inside = owner[: len(index)] == mine
        mine, index = mine[inside], index[inside]
        n = np.where(lettered, np.bincount(mine, minlength=len(texts)), 0)
        asked = np.flatnonzero(self.mine(rows)) if self.of > 1 else np.arange(len(rows))
        place = np.full(len(rows), -1)
        place[asked] = np.arange(len(asked))
        mine, index = mine[place[index] >= 0], place[index[place[index] >= 0]]
        for low in range(0, self.languages and len(asked), STEP):
            logs = self.log_probabilities(rows[asked[low : low + STEP]])
            now = (index >= low) & (index < low + STEP)
            for k in range(self.languages):
                out[:, k] += np.bincount(mine[now], weights=logs[index[now] - low, k], minlength=len(texts))
        return out, n


@dataclass
class Model:
    """The tables of a model, of any size: per order (gram, lang, value) and (context, lang, value) by middle."""

    order: int
    languages: list[str]
    tables: list[tuple[DataFrame, DataFrame]]
    blocks: int
    floor: float = 1e-6
    sharpness: float = 20.0
    limits: list[float] = field(default_factory=list)
    read: dict[int, Block] = field(default_factory=dict)

    def block(self, number: int) -> Block:
        """A block of about BLOCK_BYTES, read to the driver; only the one last asked for is held."""
        if number not in self.read:
            self.read.clear()
            place = {name: i for i, name in enumerate(self.languages)}
            levels = []
            for pair in self.tables:
                level = []
                for table in pair:
                    part = table.where(F.col("part").isNull() | (F.col("part") == number)).toPandas()
                    level.append(Sparse.of(
                        part["h"].to_numpy(np.int64).view(np.uint64), part["lang"].map(place).to_numpy(np.int64),
                        part["value"].to_numpy(np.float64),
                    ))
                levels.append(tuple(level))
            self.read[number] = Block(number, self.blocks, self.order, len(self.languages), levels, self.floor)
        return self.read[number]

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        """ln p(last character | the ones before) per row and language."""
        out = np.zeros((len(rows), len(self.languages)))
        for number in range(self.blocks):
            block = self.block(number)
            mine = block.mine(rows)
            out[mine] = block.log_probabilities(rows[mine])
        return out


def _hashed(table: DataFrame, order: int, k: int, blocks: int) -> DataFrame:
    """(h, lang, value, part) of (name, lang, value): hashes of strings, and the block of the two characters
    before the last of a window; part is NULL where a string of order ``k`` is too short to tell."""
    middle = min(2, order - 1)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.column(0).to_pylist()
        size = len(names[0]) if names else 0
        rows = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32).reshape(len(names), size).astype(np.int64)
        context = rows[:, : k - 1]
        known = k - 1 >= middle
        parts = (hashes(context[:, k - 1 - middle :]) % np.uint64(blocks)).astype(np.int64) if known else [None] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(hashes(rows).view(np.int64)), batch.column(1), batch.column(2), pa.array(parts, pa.int64())],
            names=["h", "lang", "value", "part"],
        )

    return map_batches(table, ["name", "lang", "value"], run, "h long, lang string, value double, part long", rows=4096)


def train(texts: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> Model | None:
    """A model of (lang, text), all rows, grams and languages counted; None where no row has both and a letter."""
    usable = texts.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = [keep(count_grams(usable, order), "grams")]
    for k in range(order - 1, 0, -1):
        shorter = counts[-1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n"))
        counts.append(keep(shorter, "grams"))
    counts.reverse()
    languages = sorted(row["lang"] for row in counts[0].select("lang").distinct().collect())
    if not languages:
        return None
    rows = sum(counted.count() for counted in counts)
    blocks = max(1, -(-rows * ROW_BYTES // block_bytes))
    tables = []
    for k, counted in enumerate(counts, 1):
        once, twice = (F.sum((F.col("n") == x).cast("long")) for x in (1, 2))
        share = F.least(F.lit(0.9), F.greatest(F.lit(0.1), once / F.greatest(once + 2 * twice, F.lit(1))))
        discounts = counted.groupBy("lang").agg(share.alias("discount"))
        split = counted.withColumn("context", F.substring("gram", 1, k - 1))
        contexts = keep(
            split.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).join(discounts, "lang"),
            "contexts",
        )
        value = (F.col("n") - F.least("discount", "n")) / F.col("total")
        probabilities = split.join(contexts, ["lang", "context"]).select(F.col("gram").alias("name"), "lang", value.alias("value"))
        rest = contexts.select(
            F.col("context").alias("name"), "lang", (F.col("discount") * F.col("kinds") / F.col("total")).alias("value")
        )
        tables.append(tuple(keep(_hashed(t, order, k, blocks), "model") for t in (probabilities, rest)))
    letters = counts[0].select("gram").distinct().count()
    return Model(order, languages, tables, blocks, floor=1 / (1 + letters))


def calibrate(model: Model, sample: DataFrame) -> Model:
    """Set the sharpness of scores and the rejection limits from a bounded sample of (lang, text)."""
    marked = cross_entropy_rows(sample.where(F.col("lang").isin(model.languages)), model, ["lang"]).toPandas()
    marked = marked[np.isfinite([x[0] for x in marked["entropies"]])] if len(marked) else marked
    model.limits = [float("inf")] * len(model.languages)
    if not len(marked):
        return model
    entropies = np.array(marked["entropies"].tolist())
    truth = marked["lang"].map({name: i for i, name in enumerate(model.languages)}).to_numpy(np.int64)
    grid = np.array([1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0])
    losses = [-np.mean(np.log(_softmax(-s * entropies)[np.arange(len(truth)), truth] + 1e-12)) for s in grid]
    model.sharpness = float(grid[int(np.argmin(losses))])
    for k in range(len(model.languages)):
        own = entropies[truth == k, k]
        if len(own):
            model.limits[k] = float(np.quantile(own, 1 - REJECT_SHARE)) * 1.25
    return model


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def cross_entropy_rows(texts: DataFrame, model: Model, carried: list[str]) -> DataFrame:
    """(*carried, entropies) of a frame with the columns ``carried`` and text: nats per character in each language;
    infinite for texts without letters.

    Of a model of several blocks each is sent to all tasks in turn, and the sums of a text are added up.
    """
    kinds = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in carried)
    if model.blocks == 1:
        return map_batches(texts, [*carried, "text"], _scorer(texts, model, 0, len(carried), True), f"{kinds}, entropies array<double>")
    keyed = texts.withColumn("_key", F.md5(F.coalesce("text", F.lit(""))))
    parts = None
    for number in range(model.blocks):
        sums = map_batches(keyed, ["_key", "text"], _scorer(texts, model, number, 1, False), "_key string, sums array<double>, n long")
        # Equal texts have equal sums; any of them will do. Written now, while this block is the one at hand.
        part = keep(sums.groupBy("_key").agg(F.max(F.struct("n", "sums")).alias("s")).select("_key", "s.*"), "sums")
        parts = part if parts is None else parts.unionByName(part)
    places = F.posexplode("sums").alias("k", "x")
    added = parts.select("_key", "n", places).groupBy("_key", "k").agg(F.sum("x").alias("x"), F.max("n").alias("n"))
    mean = F.when(F.col("n") > 0, -F.col("x") / F.col("n")).otherwise(F.lit(float("inf")))
    listed = added.select("_key", F.struct("k", mean.alias("e")).alias("p")).groupBy("_key").agg(
        F.transform(F.array_sort(F.collect_list("p")), lambda p: p["e"]).alias("entropies")
    )
    return keyed.join(listed, "_key").select(*[F.col(f"`{c}`") for c in carried], "entropies")


def _scorer(texts: DataFrame, model: Model, number: int, carried: int, whole: bool) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    shared = texts.sparkSession.sparkContext.broadcast(model.block(number))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums, n = shared.value.sums([t or "" for t in batch.column(carried).to_pylist()])
        names, first = batch.schema.names[:carried], [batch.column(k) for k in range(carried)]
        if whole:
            found = np.where(n[:, None] > 0, -sums / np.maximum(n, 1)[:, None], np.inf)
            return pa.RecordBatch.from_arrays([*first, pa.array(found.tolist(), pa.list_(pa.float64()))], names=[*names, "entropies"])
        lists = pa.array(sums.tolist(), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*first, lists, pa.array(n, pa.int64())], names=[*names, "sums", "n"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected), one row per row of ``docs`` (doc_id, text).

    lang_pred is the learned language of lowest cross-entropy, the first in the alphabet among
    equals; ``und`` with score 0 where the text is NULL or has no letter, or nothing was learned.
    score is the language's posterior under equal priors. rejected tells texts whose cross-entropy is
    beyond the calibrated limit of their language, and all ``und``. Whole texts are read; repeated
    rows and rows without id each get their row.
    """
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    if model is None:
        nothing = {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "rejected": F.lit(True)}
        return asked.drop("text").withColumns(nothing)
    scored = cross_entropy_rows(asked, model, ["doc_id", "held_out"])
    languages, sharpness = model.languages, model.sharpness
    limits = np.array(model.limits or [np.inf] * len(languages))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        entropies = np.array(batch.column(2).to_pylist())
        known = np.isfinite(entropies[:, 0])
        best = np.argmin(entropies, 1)
        posterior = _softmax(-sharpness * np.where(known[:, None], entropies, 0.0))
        rows = np.arange(len(best))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1),
                pa.array([languages[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                pa.array(np.where(known, posterior[rows, best], 0.0)),
                pa.array(~known | (entropies[rows, best] > limits[best])),
            ],
            names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
        )

    ddl = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    return map_batches(scored, ["doc_id", "held_out", "entropies"], run, ddl)


def calibration_rows(learnable: DataFrame, limit: int) -> DataFrame:
    """(lang, doc_id) of at most ``limit`` ids by hash, of no language more than a tenth of its ids."""
    ids = keep(learnable.where(F.col("lang").isNotNull()).select("lang", "doc_id").distinct(), "ids")
    sizes = ids.groupBy("lang").agg(F.count("*").alias("size"))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    first = ids.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= limit)
    tenth = first.join(sizes, "lang").where(F.col("place") * 10 <= F.col("size"))
    chosen = tenth.orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(limit)
    return keep(chosen.select("lang", "doc_id"), "calibration")


def language_report(docs: DataFrame) -> DataFrame:
    """Languages of all rows of ``documents``, learned from the rows that are not held out.

    Up to CALIBRATION_ROWS ids, at most a tenth of any language's, calibrate the model; all other rows are counted.
    """
    learnable = docs.where(~held_out() & F.col("doc_id").isNotNull()).select("doc_id", "lang", "text")
    chosen = F.broadcast(calibration_rows(learnable, CALIBRATION_ROWS))
    model = train(learnable.join(chosen, ["lang", "doc_id"], "left_anti"))
    if model is not None:
        calibrate(model, learnable.join(chosen, ["lang", "doc_id"], "left_semi"))
    return predict(docs, model)
