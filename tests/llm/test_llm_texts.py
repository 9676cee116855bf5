"""Line dedup, quality rules, sharding, byte-level BPE and token counts against plain Python."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from gradeline.llm import bpe, lines, rules, shards, token_counts
from gradeline.llm.frames import table

SF = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, n_lines string, part int, score int, ids string"
ODD = [
    (5, None), (6, ""), (7, " \t\n"), (None, "no id, but a line of some length"), (8, "one\n\none"), (8, "one\n\none"),
    (9, "Same Line Of Text\n  same line of text \nRest é"), (3, "x\nsame line of text"), (2, "\x0bsame line of text\r"),
    (10, "a b c d e f g h " * 9), (11, "word " * 30000), (12, "ÉÉÉÉÉÉÉÉÉÉ\nééééééééééé"), (13, "ÉÉÉÉÉÉÉÉÉÉ"),
    (14, "don't we'll  \n\n 's ''s <|endoftext|> 　中文 \U0001F600 " * 40), (15, "k" * 3000),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in ODD], DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def corpus(spark):
    return table(spark, SF, "documents")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


WHITE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_lines(rows):
    last = 2**63 - 1
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(WHITE))
            if len(key) >= 10:
                holders.setdefault(key, set()).add(last if i is None else i)
    out = []
    for i, text in rows:
        parts = (text or "").split("\n")
        stay = [p for p in parts if min(holders.get(lower(p.strip(WHITE)), {-1}) | {last if i is None else i}) in
                ({last if i is None else i} if lower(p.strip(WHITE)) in holders else {-1, last if i is None else i})]
        out.append((i, len(parts), len(parts) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def test_lines(odd, empty, corpus):
    for docs in (odd, corpus):
        assert found(lines.line_report(docs)) == plain_lines(pairs(docs))
    assert lines.line_report(empty).count() == 0
    whole = lines.dedup_lines(odd)
    assert whole.count() == len(ODD) and set(odd.columns) <= set(whole.columns)
    texts = {r["doc_id"]: r["text"] for r in whole.collect()}
    assert texts[5] is None and texts[9].split("\n")[-1] == "Rest é" and texts[3] == "x"


def test_a_line_with_most_rows_is_found(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('a very common line', char(10), 'own line ', id) AS text")
    report = lines.line_report(docs)
    assert report.where("n_dropped = 1").count() == 2999
    assert report.where("n_dropped = 0").collect()[0]["doc_id"] == 0


def plain_measures(i, text):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = {}
    for k in range(len(tokens) - 7):
        seen.setdefault(tuple(tokens[k : k + 8]), []).append(k)
    under = {k + j for places in seen.values() if len(places) > 1 for k in places for j in range(8)}
    worded = [p for p in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", p)]
    failed = len(tokens) < 20 or 100 * len(under) > 30 * len(tokens)
    return (i, len(tokens), sum(map(len, tokens)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(worded) - len(set(worded)), len(under), failed)


def test_rules(odd, empty, corpus):
    for docs in (odd, corpus):
        expected = sorted((plain_measures(i, t) for i, t in pairs(docs)), key=str)
        assert found(rules.rule_report(docs).drop("kept")) == expected
    assert rules.rule_report(empty).count() == 0
    assert rules.rule_report(corpus).where("base_failed AND kept").count() == 0
    judged = rules.judge(odd)
    assert judged.count() == len(ODD) and set(odd.columns) <= set(judged.columns)
    plan = rules.rule_report(corpus)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Exchange", plan)


def test_rules_reject_junk_and_keep_prose(spark, corpus):
    judged = rules.judge(corpus.select("doc_id", "text")).join(table(spark, SF, "labels"), "doc_id")
    assert judged.where("quality = 1 AND NOT base_failed AND NOT kept").count() == 0
    assert judged.where("quality = 0 AND kept").count() <= 0.1 * judged.where("quality = 0").count()
    prose = "The cat sat on the mat and the dog lay in the sun of a long day as it was by then late in the year. "
    junk = "".join(f"w{i}*** " for i in range(60))
    rows = spark.createDataFrame([(1, prose), (2, junk)], "doc_id long, text string")
    assert dict(rules.judge(rows).select("doc_id", "kept").collect()) == {1: True, 2: False}


def plain_shards(rows, n):
    key = lambda r: 2**63 - 1 if r[0] is None else r[0]
    sized = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in sorted(rows, key=key)]
    total, at, slots, out = sum(s for _, s, _ in sized), 0, {}, []
    for i, size, crc in sized:
        shard = min(n - 1, (2 * at + size) * n // (2 * total))
        at += size
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i, size, crc, "bytes", shard, slots[shard], None))
    return sorted(out, key=str)


def test_shards(odd, empty, corpus, spark, tmp_path):
    assert found(shards.assign_shards(corpus)) == plain_shards(pairs(corpus), 16)
    assert found(shards.assign_shards(odd, 3)) == plain_shards(pairs(odd), 3)
    assert shards.assign_shards(empty).count() == 0
    same = spark.range(1000).selectExpr("7L AS doc_id", "'same' AS text")
    rows = shards.assign_shards(same).groupBy("shard").count().collect()
    assert len(rows) == 16 and {r["count"] for r in rows} <= {62, 63}
    shards.write_shards(corpus, str(tmp_path / "out"))
    written = spark.read.parquet(str(tmp_path / "out"))
    assert found(written.select("doc_id", "text")) == sorted(pairs(corpus), key=str)


def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY)),
    )


def test_bpe(odd, empty, corpus):
    encoding = library()
    for docs in (odd, corpus):
        expected = []
        for i, text in pairs(docs):
            ids = encoding.encode_ordinary(text or "")
            packed = b"".join(k.to_bytes(4, "little") for k in ids)
            digest = hashlib.sha256((text or "").encode()).hexdigest()
            expected.append((i, len(ids), hashlib.sha256(packed).hexdigest(), digest))
        assert found(bpe.token_report(docs)) == sorted(expected, key=str)
    assert bpe.token_report(empty).count() == 0
    for row in bpe.encode(odd).collect():
        assert (row["offsets"] or [0]) == sorted(set(row["offsets"] or [0]))


def test_bpe_splits_like_the_pattern():
    encoding, path = library(), public_tokenizers.path(bpe.VOCABULARY)
    rng = random.Random(4)
    alphabet = [*" '\t\n　\xa0stmdrevl'SaZé0٣!?", "'re", "'ll", "中", "\U00014252", "\U0001F600", "  "]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(150))) for _ in range(2000)]
    for text, (ids, offsets) in zip(texts, bpe.encode_batch([t.encode() for t in texts], path)):
        assert ids.tolist() == encoding.encode_ordinary(text)
        assert not len(offsets) or offsets[-1] == len(text.encode())


def test_counts(odd, empty, corpus, spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))

    def expected(docs):
        out = []
        for i, text in pairs(docs):
            n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
            out.append((i, len((text or "").encode()), n, n > 1024))
        return sorted(out, key=str)

    assert found(token_counts.count_tokens(corpus, chunk=2000)) == expected(corpus)
    rng = random.Random(6)
    texts = ["".join(rng.choices([*"ab '\n\té中1,.<|>", "<|endoftext|>", "zzzzzzzzzzzz"], k=900)) for _ in range(40)]
    mixed = spark.createDataFrame([*ODD, *enumerate(texts, 100)], "doc_id long, text string")
    # Small chunks make overlaps without a common place, which have to be widened.
    for chunk, overlap in ((64, 24), (500, 40)):
        assert found(token_counts.count_tokens(mixed, chunk=chunk, overlap=overlap)) == expected(mixed)
    assert token_counts.count_tokens(empty).count() == 0
