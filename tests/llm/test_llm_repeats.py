"""Periodic runs, shared byte strings and the Merkle manifest against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeline.llm import merkle, periodic, shared_strings, suffixes
from gradeline.llm.frames import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    return table(spark, SF, "documents")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def plain_runs(words, exponent=4, length=6):
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i - start + q
            if size >= max(length, exponent * q):
                span = words[start : start + size]
                if not any(all(span[k] == span[k + p] for k in range(size - p)) for p in range(1, q)):
                    out.append((start, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def ascii_words(text):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def plain_report(doc_id, text):
    words = ascii_words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)), sha(kept))


def test_runs_of_random_sequences(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(periodic, "BLOCK", 3)  # blocks of ordered sets are cut and searched
    for trial in range(400):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            letters = "ab"[: rng.randrange(1, 3)] + "c" * rng.randrange(2)
            text = [rng.choice(letters) for _ in range(rng.randrange(30))]
            for _ in range(rng.randrange(4)):
                text += [rng.choice(letters) for _ in range(rng.randrange(1, 5))] * rng.randrange(1, 9)
            texts.append([w.encode() for w in text])
        exponent, length = rng.choice([(4, 6), (2, 2), (3, 10), (2, 5)])
        symbols, starts = periodic.numbered(texts)
        found = periodic.found_runs(symbols, exponent, length)
        expected = [(int(s) + a, n, q) for s, t in zip(starts, texts) for a, n, q in plain_runs(t, exponent, length)]
        assert [tuple(r) for r in found.tolist()] == expected, (texts, exponent, length)


def test_runs_of_one_word_are_quick():
    words = [[b"a"] * 60_000, [b"a", b"b"] * 20_000, [b"x%d" % (i % 1000) for i in range(40_000)]]
    symbols, starts = periodic.numbered(words)
    expected = [(0, 60_000, 1), (int(starts[1]), 40_000, 2), (int(starts[2]), 40_000, 1000)]
    assert [tuple(r) for r in periodic.found_runs(symbols).tolist()] == expected


def test_runs_report(spark, corpus):
    repeat = "la " * 9 + "one two " * 5 + "one"
    rows = [(None, repeat), (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, repeat), (5, repeat), (6, "Ä ä Ä ä Ä ä Ä ä"), (7, "x y " * 6)]
    rows += [(i, " ".join(f"w{k % 7}" for k in range(40))) for i in range(10, 60)] + [(1000 + i, "") for i in range(30)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, runs int, collapsed string")
    for frame in (docs, corpus):
        got = sorted((tuple(r) for r in periodic.run_report(frame).collect()), key=str)
        assert got == sorted((plain_report(*r) for r in pairs(frame)), key=str)
    found = {r["doc_id"]: r for r in periodic.find_runs(docs).collect()}
    assert [tuple(r) for r in found[5]["runs"]] == [(0, 9, 1), (9, 11, 2)] and found[5]["collapsed"] == "la one two"
    assert periodic.run_report(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(docs, exponent=1)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves, width=8):
    """(last node, path of every leaf): runs of ``width`` become parents until one node is left."""
    paths, places, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for path, at in zip(paths, places):
            low = at - at % width
            path.append(("".join(nodes[low:at]), "".join(nodes[at + 1 : low + width])))
        nodes = [sha("".join(nodes[i : i + width])) for i in range(0, len(nodes), width)]
        places = [at // width for at in places]
    return nodes[0], paths


def plain_manifest(rows):
    """Rows of the report for (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        doc_id, *_, text = row
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None
        other = (*row[:-1], "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if tampered else text)
        leaf, folded = (sha("".join(map(encoded, r))) for r in (row, other))
        trees.setdefault("" if row[2] is None else "=" + row[2], []).append((doc_id is not None, doc_id or 0, leaf, folded, doc_id))
    names = sorted(trees, key=str.encode)
    built = {}
    for name in names:
        trees[name].sort()
        built[name] = plain_tree([leaf for _, _, leaf, _, _ in trees[name]])
    root, upper = plain_tree([built[name][0] for name in names])
    out = []
    for name, above in zip(names, upper):
        for (_, _, leaf, folded, doc_id), path in zip(trees[name], built[name][1]):
            proof = "".join(left + right for left, right in path + above)
            for left, right in path + above:
                folded = sha(left + folded + right)
            out.append((doc_id, leaf, built[name][0], root, sha(proof), folded, folded == root))
    return sorted(out, key=str)


def test_manifest(spark, corpus):
    ddl = "doc_id long, source string, lang string, n_chars long, text string, tree int, idx int, digest string"
    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), rng.choice(["en", "en", "de"]), i, f"Text {i}") for i in range(150)]
    rows += [(200 + i, None, None, None, None) for i in range(9)] + [(300, "a", "", 1, ""), (301, "a", "Ä", 1, "ÄB"), (302, "a", "~", 1, "-")]
    rows += [(7, "a", "en", 7, "again"), (7, "a", "en", 7, "again"), (None, "a", "en", 1, "No id"), (None, None, None, None, None)]
    for some in (rows, rows[:1], rows[150:159], rows[:64], [r for r in rows if r[2] == "en"][:65]):
        docs = spark.createDataFrame([(*r, 1, 2, "x") for r in some], ddl)
        assert sorted((tuple(r) for r in merkle.manifest_report(docs).collect()), key=str) == plain_manifest(some)
    assert merkle.manifest_report(docs.limit(0)).count() == 0
    whole = [tuple(r) for r in corpus.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted((tuple(r) for r in merkle.manifest_report(corpus).collect()), key=str)
    assert got == plain_manifest(whole) and {r[-1] for r in got} == {True, False}


def test_manifest_of_pairs_names_every_altered_column(spark):
    docs = spark.range(37).select("id", (F.col("id") % 3).alias("part"), F.concat(F.lit("v"), "id").alias("value"))
    same = merkle.manifest(docs, ["id", "part", "value"], "part", "id", width=2).collect()
    assert all(r["folded"] == r["root"].hex() for r in same) and {r["size"] for r in same} == {13, 12}
    other = merkle.manifest(docs, ["id", "part", "value"], "part", "id", {"value": F.lit("v5")}, width=2).collect()
    assert [r["key"] for r in other if r["folded"] == r["root"].hex()] == [5]


def test_suffix_arrays_and_prefixes(monkeypatch):
    rng = random.Random(3)
    for trial in range(600):
        size = rng.choice([1, 2, 3, 20])
        text = [rng.randrange(1, size + 1) for _ in range(rng.randrange(1, 60))] * rng.randrange(1, 4) + [0]
        expected = sorted(range(len(text)), key=lambda i: text[i:])
        for dense in (0, 10**9):  # all scans by whole arrays, then all by symbols
            monkeypatch.setattr(suffixes, "DENSE", dense)
            assert suffixes.suffix_array(np.array(text), size + 1).tolist() == expected
        prefixes = suffixes.permuted_prefixes(np.array(text, np.uint8), np.array(expected), 11)
        for before, here in zip(expected, expected[1:]):
            same = 0
            while same < 11 and max(before, here) + same < len(text) and text[before + same] == text[here + same]:
                same += 1
            assert prefixes[here] == same


def test_equal_strings_have_equal_keys():
    rng = random.Random(4)
    passage = bytes(rng.randrange(97, 123) for _ in range(300))
    owner = {}
    for text in (b"x" * 40 + passage, passage + b"end", b"a" * 500, b"ab" * 300, b"s" * 49, b"t" * 50):
        keys, starts, n, places = shared_strings.stretches(text)
        assert all(s + m - 1 <= p <= s + 26 for s, m, p in zip(starts, n, places))
        assert n.sum() == max(0, len(text) - 49) and starts.tolist() == (np.cumsum(n) - n).tolist()
        for key, start, count in zip(keys.tolist(), starts.tolist(), n.tolist()):
            for i in range(start, start + count):
                assert owner.setdefault(text[i : i + 50], key) == key
    assert len(shared_strings.stretches(b"a" * 500)[0]) < 60


def plain_removal(rows):
    """Rows of the report for (doc_id, text)."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49):
            key = data[i : i + 50]
            first[key] = min(first.get(key, 2**63 - 1), 2**63 - 1 if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data) + 1)
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < (2**63 - 1 if doc_id is None else doc_id):
                gone[i : i + 50] = b"\1" * 50
        spans = sum(gone[i] and not gone[i - 1] for i in range(len(data)))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted(seed):
    rng = random.Random(seed)
    prose = lambda n: " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 8))) for _ in range(n))
    passages = [prose(rng.choice([8, 12, 30, 60])) for _ in range(5)] + ["\u00e4\u00f6\u20ac\U0001f600" * 20, "-" * 200, "ab" * 60]
    rows = []
    for i in range(90):
        parts = [prose(rng.randrange(20))]
        for _ in range(rng.randrange(4)):
            passage = rng.choice(passages)
            low = rng.randrange(len(passage) // 3)
            parts += [passage[low : rng.randrange(low + 1, len(passage) + 1)], prose(rng.randrange(10))]
        rows.append((i * 3 % 91, rng.choice([" ", "", "\n"]).join(parts)))
    rows += [(100 + i, rows[i % 4][1]) for i in range(12)] + [(200, None), (201, ""), (202, "short"), (203, "x" * 49), (204, "x" * 50), (205, "x" * 500)]
    return rows


def test_shared_strings_go(spark, corpus, monkeypatch):
    rows = planted(7)
    odd = [(None, rows[0][1]), (None, rows[0][1]), (None, "lone row " * 20), (5, rows[1][1]), (5, "again " * 30), (5, "again " * 30), (6, "again " * 30)]
    ddl = "doc_id long, text string, id int, tie string, copy int"
    for some in (rows, rows + odd):
        docs = spark.createDataFrame([(*r, 1, "x", 2) for r in some], ddl)
        got = sorted((tuple(r) for r in shared_strings.removal_report(docs).collect()), key=str)
        assert got == plain_removal(some)
    assert sum(r[2] > 0 for r in got) > 40
    assert shared_strings.removal_report(docs.limit(0)).count() == 0
    found = {r["doc_id"]: r for r in shared_strings.remove_shared(docs).collect()}
    texts = dict(rows)
    whole = texts[205].encode()
    assert [tuple(s) for s in found[205]["removed"]] == [(0, 500)] and found[205]["kept"] == b"" and whole == b"x" * 500
    got = sorted((tuple(r) for r in shared_strings.removal_report(corpus).collect()), key=str)
    assert got == plain_removal(pairs(corpus))


def test_shared_strings_of_crowded_and_frequent_keys(spark, monkeypatch):
    rows = planted(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain_removal(rows)
    # Keys of four contexts are replaced, shards are small, most shared keys are frequent, buckets are many.
    for name, value in (("CROWD", 3), ("SHARD_BYTES", 500), ("OFTEN", 2), ("BUCKET_STRETCHES", 100)):
        monkeypatch.setattr(shared_strings, name, value)
        assert sorted((tuple(r) for r in shared_strings.removal_report(docs).collect()), key=str) == expected


def test_contexts_of_rare_keys_move_once(spark, rows):
    ddl = "key long, often boolean, hash long, id long, tie long, start int, place int, body binary"
    body = [b"a" * 60, b"b" * 70]
    pieces = rows(ddl, *[(k, k == 2, h, 10 * k + h + n, n, 0, 3, body[h] if n else None) for k in range(3) for h in range(2) for n in range(2)])
    dealt = shared_strings.dealt_contexts(pieces.where("NOT often"), 3)
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    found = sorted((r["key"], r["hash"], r["low"], r["high"], bytes(r["body"])) for r in dealt.collect())
    assert found == [(k, h, 10 * k + h, 10 * k + h + 1, body[h]) for k in range(2) for h in range(2)]
    parts = {(r["key"], r["hash"]): [tuple(p) for p in r["parts"]] for r in shared_strings.owners(pieces, 3).collect()}
    assert parts == {(k, h): [(0, 11 + 10 * h, 10 * k + h)] for k in range(3) for h in range(2)}
    assert shared_strings.crowded(pieces, 2).isEmpty()


def test_crowded_keys_are_found_in_groups(spark, monkeypatch):
    monkeypatch.setattr(shared_strings, "CROWD", 3)
    pieces = spark.range(40).select(F.expr("if(id < 5, 7L, id - 12)").alias("key"), F.encode(F.lit("x"), "UTF-8").alias("body"))
    assert [r["key"] for r in shared_strings.crowded(pieces, 4).collect()] == [7]
