"""SimHash, decontamination, language id, quality, WARC and the pipeline against brute force and held-out rows."""

import hashlib
import random
import re
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gradeline.llm import bpe, components, decontaminate, langid, lines, quality, rules, simhash, warc
from gradeline.llm.frames import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark):
    return table(spark, SF, "documents")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def plain_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            root[find(i)] = find(j)
    smallest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc), doc)
    return sorted(((doc, f"{p:016x}", smallest.get(find(i))) for i, ((doc, _), p) in enumerate(zip(rows, prints))), key=str)


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    out = []
    for i in range(n):
        words = list(base)
        words[rng.randrange(300)] = f"new{i}"
        out.append(" ".join(words))
    return out


def test_simhash(spark, corpus, monkeypatch):
    found = sorted((tuple(r) for r in simhash.near_duplicates(corpus).collect()), key=str)
    assert found == plain_components(pairs(corpus))
    rows = [(i + 10, t) for i, t in enumerate(near_copies(120, 1))]
    rows += [(1, None), (2, ""), (3, "One two"), (4, "one TWO"), (5, "é É"), (None, rows[0][1]), (6, "same"), (6, "same"), (None, "lone row")]
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, fp string, key int")
    # Small limits send the crowded keys through the chunks.
    monkeypatch.setattr(simhash, "CROWD", 8)
    monkeypatch.setattr(simhash, "CHUNK", 16)
    for blocks in (None, 5):
        got = sorted((tuple(r) for r in simhash.near_duplicates(docs, blocks=blocks).collect()), key=str)
        assert got == plain_components(rows)
    kept = simhash.first_of_each(docs)
    firsts = {c for _, _, c in plain_components(rows)} - {None}
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(firsts)
    assert [r["text"] for r in kept.where("doc_id IS NULL").collect()] == ["lone row"] and kept.columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(1, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000 + i, 5000 + (i + 1) % 50) for i in range(50)]
    rng.shuffle(links)
    roots = {}
    for r in components.components(spark.createDataFrame(links + links[:20], "a long, b long")).collect():
        roots.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, roots.values())) == [50, 200, 300]
    assert components.components(spark.createDataFrame([(1, 1)], "a long, b long")) is None


def plain_tiles(item, doc, least):
    marked_item, marked_doc, total = [False] * len(item), [False] * len(doc), 0
    while True:
        best = 0, 0, 0
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while (i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k]
                       and not marked_item[i + k] and not marked_doc[j + k]):
                    k += 1
                if k > best[0]:
                    best = k, i, j
        k, i, j = best
        if not k or k < least:
            return total
        marked_item[i : i + k], marked_doc[j : j + k] = [True] * k, [True] * k
        total += k


def test_tiles():
    rng = random.Random(3)
    for _ in range(150):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 20))]
        doc = [rng.randrange(4) for _ in range(rng.randrange(1, 50))]
        least = rng.randrange(1, 6)
        hashed = [decontaminate.tokens(" ".join(map(str, side))) for side in (item, doc)]
        got = decontaminate.tile(*hashed, least)
        assert sum(n for n, _, _ in got) == plain_tiles(item, doc, least)


def test_contamination(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(3, 40)))) for i in range(12)] + [(50, None), (51, ""), (52, "?!")]
    docs = []
    for d in range(60):
        text = rng.choices(words, k=rng.randrange(60))
        for _ in range(rng.randrange(3)):
            item = (items[rng.randrange(12)][1]).split()
            cut = rng.randrange(len(item) + 1)
            parts = [item[cut:], rng.choices(words, k=rng.randrange(8)), item[:cut]]  # reordered
            text[rng.randrange(len(text) + 1) :] = [w for p in parts for w in p]
        docs.append((d, ", ".join(text).upper()))
    docs += [(100, None), (101, ""), (None, items[0][1]), (7, items[1][1]), (7, items[1][1])]
    frame = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([*items, items[3]], "item_id long, text string")
    expected = []
    for d, text in docs:
        for i, item in items:
            ours, theirs = re.findall(r"\w+", (item or "").lower()), re.findall(r"\w+", (text or "").lower())
            covered = plain_tiles(ours, theirs, min(5, len(ours))) if ours else 0
            if ours and covered >= 0.5 * len(ours):
                expected.append((d, i, len(ours), covered))
    for limit in (1 << 20, 300):  # one block of items, and many
        found = decontaminate.contaminated(frame, benchmark, block_bytes=limit)
        got = [tuple(r) for r in found.select("doc_id", "item_id", "item_tokens", "covered_tokens").collect()]
        assert sorted(got, key=str) == sorted(expected, key=str) and len(got) > 40
    assert decontaminate.contaminated(frame.limit(0), benchmark).count() == 0
    assert decontaminate.contaminated(frame, benchmark.limit(0)).count() == 0
    clean = decontaminate.clean_documents(frame, found)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - ({e[0] for e in expected} - {None})


def test_planted_passages_are_found_and_clean_documents_left(spark, corpus):
    items = {i: t for i, t in ((r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect())}
    found = decontaminate.contaminated(corpus, table(spark, SF, "benchmark"))
    holding = {d for d, text in pairs(corpus) if any(t in (text or "") for t in items.values())}
    assert holding <= {r["doc_id"] for r in found.collect()}
    assert found.where("coverage < 0.9").count() == 0


def test_languages(spark, corpus):
    report = langid.language_report(corpus)
    judged = report.join(corpus.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in judged) >= 0.97 * len(judged)
    assert report.count() == corpus.count() and report.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    odd = [(i, t, None, "x", 1) for i, t in enumerate([None, "", "  12 34 !", "\U0001F600", "the house of the", "É" * 70])]
    extra = spark.createDataFrame(odd + odd[:1], "doc_id long, text string, lang string, rejected string, score int")
    model = langid.train(corpus.select("lang", "text"))
    got = {r["doc_id"]: r for r in langid.predict(extra, model).collect()}
    assert [got[i]["lang_pred"] == "und" for i in range(6)] == [True] * 4 + [False] * 2 and got[0]["score"] == 0
    nothing = langid.language_report(extra)
    assert nothing.count() == 7 and nothing.where("lang_pred <> 'und'").count() == 0
    assert langid.language_report(corpus.limit(0)).count() == 0


def test_language_model_is_a_distribution(spark):
    texts = spark.createDataFrame([("a", "abab abba baba"), ("a", "bb aa"), ("b", "xyx zyx"), (None, "q"), ("c", None)], "lang string, text string")
    model = langid.train(texts, order=3)
    alphabet = sorted({ord(c) for c in "abxyz "})
    for context in ("ab", " a", "yx", "zz"):
        rows = np.array([[*map(ord, context), c] for c in alphabet])
        total = np.exp(model.log_probabilities(rows)).sum(0)
        assert model.languages == ["a", "b"] and (total < 1 + 1e-9).all() and (total > 0.8).all()


def test_quality(spark, corpus):
    labels = table(spark, SF, "labels")
    report = quality.quality_report(corpus, labels)
    judged = report.join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in judged)
    assert right >= 0.85 * len(judged) and report.count() == corpus.count()
    odd = spark.createDataFrame([(1, None, 3), (2, "", 3), (None, "x", 3), (1, "y" * 100000, 3)], "doc_id long, text string, score int")
    for judge in (labels, labels.limit(0), labels.withColumn("quality", F.lit(None).cast("int"))):
        got = quality.quality_report(odd, judge)
        assert got.count() == 4 and got.where("score BETWEEN 0 AND 1 AND predicted = CAST(score >= 0.5 AS INT)").count() == 4
    assert quality.quality_report(corpus.limit(0), labels).count() == 0


def record(body):
    return f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}\r\n\r\n"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_warc_payloads_with_magic(spark, small_splits, tmp_path):
    rng = random.Random(5)
    bits = ["\r\n", "\r\n\r\n", "WARC/1.0\r\n", "\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n", record("x"), "é", "\r", "\n",
            record("abc" * 30), "hello world ", "WARC/1.", record("") + record(record("deep"))]
    rows = [(i, f"http://a/WARC/1.0?{i}\r\nWARC/1.1", None if i == 3 else "".join(rng.choices(bits, k=rng.choice([0, 1, 3, 30]))), "x") for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(2)
    path = f"{tmp_path}/plain"
    warc.write_archive(pages, path, compression="none", least=10**9)
    assert spark.read.option("lineSep", warc.SEPARATOR).text(path).rdd.getNumPartitions() > 5
    read = warc.read_archive(spark, path).withColumn("id", warc.header_field("WARC-Record-ID", r"<urn:page:(-?\d+)>"))
    got = {int(r["id"]): bytes(r["payload"]) for r in read.collect()}
    assert got == {i: (html or "").encode() for i, _, html, _ in rows}


def test_warc_report(spark):
    big = "p" * 100
    rows = [(5, "u", big), (3, "u", big), (9, None, big), (3, "u", big), (7, "u", "p" * 99), (8, "u", "p" * 99), (1, "u", None), (2, "u", ""),
            (None, "u", big), (None, "u", "lone" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in warc.archive_report(pages).collect()), key=str)
    expected = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == big and i != 3
        expected.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(expected, key=str)
    assert warc.archive_report(pages.limit(0)).count() == 0


def test_warc_cut_off(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes((record("first") + record("second" * 10)).encode()[:-30])
    (tmp_path / "b.warc").write_bytes(b"not an archive " + record("x").encode())
    rows = warc.read_archive(spark, str(tmp_path)).orderBy("at").collect()
    assert [(r["body"], r["payload"] and bytes(r["payload"])) for r in rows] == [(5, b"first"), (60, None)]


@pytest.mark.parametrize("length", [61, 5_000_000_000, 10**16, 10**18 - 1])
def test_warc_damaged_length(spark, tmp_path, length):
    last = record("second" * 10).replace("Content-Length: 60", f"Content-Length: {length}")
    (tmp_path / "a.warc").write_bytes((record("first") + last).encode().rstrip(b"\r\n"))
    rows = warc.read_archive(spark, str(tmp_path)).orderBy("at").collect()
    assert [(r["body"], r["payload"] and bytes(r["payload"])) for r in rows] == [(5, b"first"), (length, None)]


def test_pipeline(spark, corpus):
    kept = rules.judge(corpus).where("kept").select(*corpus_pipeline.COLUMNS)
    reduced = pairs(lines.dedup_lines(kept))
    first = {c for _, _, c in plain_components(reduced)}
    unique = [(i, t) for i, t in reduced if i in first]
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    seen = spark.createDataFrame(unique, "doc_id long, text string")
    leaking = {r["doc_id"] for r in decontaminate.contaminated(seen, table(spark, SF, "benchmark")).collect()}
    assert {i for i, t in unique if any(x in t for x in items)} <= leaking
    clean = [(i, t) for i, t in unique if i not in leaking]
    expected = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in clean}
    got = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"]: r["decoded_sha256"] for r in got.collect()} == expected
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and bpe.token_report(seen).columns == got.columns


def test_fingerprints_of_one_key_leave_a_forest():
    rng = random.Random(6)
    for n, flips in ((2, 1), (60, 2), (500, 3), (300, 12)):
        centre = rng.getrandbits(64)
        values = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(flips + 1))) for _ in range(n)}
        values = np.array([*values, *[rng.getrandbits(64) for _ in range(20)]], np.uint64)
        links = simhash.forest(values, 4)
        assert len(links) < len(values)

        def joined(pairs):
            root = list(range(len(values)))
            for a, b in pairs:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
            groups = {}
            for i, r in enumerate(root):
                groups.setdefault(r, []).append(i)
            return sorted(groups.values())

        near = [(a, b) for a, b in combinations(range(len(values)), 2) if int(values[a] ^ values[b]).bit_count() <= 4]
        assert joined(links.tolist()) == joined(near)


def test_long_keys_have_few_fingerprints_and_few_copies():
    assert [len(simhash.block_masks(4, simhash.blocks_for(n))) for n in (1, 10**6, 10**10)] == [5, 15, 35]
    for mask in simhash.block_masks(4, 5):
        longer = simhash.longer_masks(mask, 4)
        assert len(longer) == 5 and all(m & mask == mask for m in longer)
        extra = [m % 2**64 & ~mask for m in longer]
        assert sum(extra) == ~mask % 2**64 and sum(e.bit_count() for e in extra) == 64 - (mask % 2**64).bit_count()


def test_near_dedup_stage_keeps_each_text_once_whatever_its_id(spark):
    long = [" ".join(f"t{k}w{i}" for i in range(30)) for k in range(5)]
    rows = [(1, long[0]), (2, long[0]), (2, long[1]), (3, long[2]), (3, long[3]), (None, long[4]), (None, long[4]), (None, long[0])]
    docs = spark.createDataFrame([(*r, "en", "s", i) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, SF)
    got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in kept.collect()), key=str)
    expected = [(1, long[0], 0), (2, long[1], 2), (3, long[2], 3), (3, long[3], 4), (None, long[4], 5)]
    assert got == sorted(expected, key=str) and kept.columns == docs.columns


def test_decontamination_stage_judges_rows_whatever_their_ids(spark):
    item = next(r["text"] for r in table(spark, SF, "benchmark").collect() if len((r["text"] or "").split()) > 8)
    rows = [(None, item), (None, "clean text"), (None, None), (1, item), (1, "another clean text"), (2, "clean text"), (2, "clean text")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    clean = corpus_pipeline.decontamination(spark, docs, SF)
    got = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert sorted(got, key=str) == sorted((r for r in rows if r[1] != item), key=str) and clean.columns == docs.columns


def test_language_model_is_whole_and_the_same_in_blocks(spark, corpus):
    """No gram and no language is left out, and a model of many blocks scores like one of a single block."""
    rng = random.Random(8)
    many = [(f"l{k:03}", " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(6))) for k in range(70)]
    texts = spark.createDataFrame(many, "lang string, text string")
    model = langid.train(texts)
    assert model.languages == sorted(k for k, _ in many)
    own = {}
    for lang, text in many:
        padded = "   " + text + " "
        own[lang] = {padded[i : i + 4] for i in range(len(padded) - 3)}
    assert model.tables[-1][0].count() == sum(map(len, own.values()))
    docs = spark.createDataFrame([*((i, x) for i, (_, x) in enumerate(many)), (500, None), (501, "12"), (0, many[0][1])], "doc_id long, text string")
    parted = langid.train(texts, block_bytes=model.tables[-1][0].count() * 10)
    assert parted.blocks > 3
    one, more = (sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in langid.predict(docs, m).collect()) for m in (model, parted))
    assert one == more and len(one) == 73
    assert [lang for i, lang, _ in one if i < 70] == ["l000", *(k for k, _ in many)]


def test_language_rows_beyond_the_calibration_are_counted(spark, monkeypatch):
    ids = [r["id"] for r in spark.range(20_000).where("pmod(xxhash64(id), 10) = 0 AND crc32(CAST(id AS STRING)) % 3 <> 1").limit(12).collect()]
    rows = [(i, "rare", f"zxq qzx xqz {'z' * (k + 1)}") for k, i in enumerate(ids)]
    rows += [(100_000 + i, "common", f"the house of the {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    counted, whole = [], langid.train
    monkeypatch.setattr(langid, "train", lambda texts: counted.append(texts.count()) or whole(texts))
    monkeypatch.setattr(langid, "CALIBRATION_ROWS", 5)
    report = {r["doc_id"]: r["lang_pred"] for r in langid.language_report(docs).collect()}
    usable = docs.where("crc32(CAST(doc_id AS STRING)) % 3 <> 1").count()
    assert counted == [usable - 5] and all(report[i] == "rare" for i in ids)

