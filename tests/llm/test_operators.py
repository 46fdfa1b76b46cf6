"""Every operator against brute force, and on nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import bpe, decontam, langid, line_dedup, quality_model, quality_rules, simhash, substring_dedup, suffix_dedup, toxicity
from ledgerlake.llm.components import components
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, a bigint, fp string, words string, lo int, score double, root string, chunks string"
DATA = "/root/testdata/sf0.01"


def table(spark, texts, ids=None):
    ids = ids or range(len(texts))
    rows = [(i, t, "en", "s", None if t is None else len(t), 7, "x", "y", 1, 0.5, "r", "c") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng, n, vocab=40):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd_texts():
    """Null, empty, blank, one word, repeated, near-repeated, many-lined and long texts."""
    rng = random.Random(5)
    base = [". ".join(prose(rng, 9) for _ in range(12)) for _ in range(4)]
    shared = prose(rng, 60)
    lines = "\n".join(prose(rng, 8) for _ in range(20))
    return [None, "", " \n\t ", "Word", base[0], base[0], base[0] + " tail", base[1] + " " + shared, shared + " " + base[2], lines, "head\n" + lines, lines + "\nend", base[3] * 40, "é " * 300, "a" * 3000]


def test_decontamination(spark, odd_texts, monkeypatch):
    bench = [(1, odd_texts[4][:150]), (2, odd_texts[4][:150]), (3, "Word"), (4, None), (5, "..."), (None, "é é é"), (10, odd_texts[9][20:90])]
    items = spark.createDataFrame([(i, t, 3) for i, t in bench], "item_id bigint, text string, doc_id int")
    docs = table(spark, odd_texts)
    pairs = [("" if i is None else str(i), t.encode()) for i, t in bench if t is not None]
    want = {}
    for d, t in enumerate(odd_texts):
        n, hit, names = brute.contamination((t or "").encode(), pairs)
        want[d] = (n, len(hit), len(names), brute.sha(",".join(sorted(names)).encode()), bool(hit))
    got = {r[0]: tuple(r[1:]) for r in decontam.report(decontam.find(docs, items)).collect()}
    assert got == want
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 60)
    assert {r[0]: tuple(r[1:]) for r in decontam.report(decontam.find(docs, items)).collect()} == want
    cleaned = {r.doc_id: r for r in decontam.clean(docs, items).collect()}
    assert cleaned[0].text is None and cleaned[7].text == odd_texts[7] and 3 not in cleaned
    assert all(brute.contamination((r.text or "").encode(), pairs)[1] == set() for r in cleaned.values())
    assert decontam.clean(docs, items.limit(0)).count() == len(odd_texts)
    assert decontam.find(docs.limit(0), items).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    words = [f"v{i}" for i in range(60)]
    part = lambda a, b: " ".join(words[a:b])
    items = spark.createDataFrame([(k, part(a, b)) for k, (a, b) in enumerate([(0, 12), (8, 20), (15, 25), (30, 40), (45, 55)])], "item_id bigint, text string")
    fill = lambda n: " ".join(f"x{i}" for i in range(n))
    texts = [part(0, 25), fill(30) + " " + part(0, 25), f"{part(0, 12)} {fill(6)} {part(30, 40)}", f"{fill(20)} {part(45, 50)} {part(30, 40)} {part(50, 55)} {fill(5)}", fill(9), "", None]
    docs = table(spark, texts * 2, [*range(len(texts))] * 2).unionByName(table(spark, [texts[1]], [None]))
    found = lambda: sorted(map(repr, decontam.report(decontam.find(docs, items)).collect()))
    left = lambda: sorted(map(repr, decontam.clean(docs, items).collect()))
    want = found(), left()
    assert len(want[0]) == 2 * len(texts) + 1
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 60)
    assert (found(), left()) == want


def test_quality_rules(spark, odd_texts):
    docs = table(spark, odd_texts).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("lang")))
    got = quality_rules.judge(docs.unionByName(docs))
    rows = got.collect()
    assert len(rows) == 2 * len(odd_texts)
    for r in rows:
        n, chars, symbols, dup, rep = brute.base_counts(odd_texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep)
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)
        assert not (r.kept and r.base_failed)
    assert quality_rules.judge(docs.limit(0)).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_rules_verdict(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    by = {r.quality: r.kept for r in quality_rules.judge(docs).filter("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert by[1] > 0.995 and by[0] < 0.2


def test_line_dedup(spark, odd_texts):
    docs = table(spark, odd_texts)
    rows = [(d, (t or "").encode()) for d, t in enumerate(odd_texts)]
    for size in (line_dedup.MIN_BYTES, 100):
        cut = brute.cut_lines(rows, size)
        assert cut
        got = {r.doc_id: r for r in line_dedup.report(docs, size).collect()}
        for d, t in rows:
            left, n, gone = brute.without_lines(t, cut[d])
            assert (got[d].n_lines, got[d].n_removed, got[d].kept_sha256) == (n, gone, brute.sha(left)), d
    kept = line_dedup.dedup(docs.unionByName(docs))
    assert kept.columns == docs.columns and kept.filter("doc_id = 0 and text is null").count() == 2
    assert line_dedup.dedup(docs.limit(0)).count() == 0


def test_chunks_against_brute_force():
    rng = random.Random(3)
    texts = [b"", b" ", b"\n", b"one", b"ab\n" * 3000, b"ab\n" * 2000, b" " * 500, b"\t\n" * 40, prose(rng, 4000, 3000).encode()]
    texts += ["".join(rng.choice(["a", "bc", "def", " ", "  ", "\n", "\t", "é", ". "]) for _ in range(rng.randrange(200))).encode() for _ in range(200)]
    for size in (1, 30, 90):
        whole = line_dedup.Lines.of(texts)
        lines = [(int(t), int(a - whole.begin[t]), int(b - whole.begin[t])) for t, a, b in zip(whole.text, whole.start, whole.stop, strict=True)]
        assert lines == [(k, a, b) for k, t in enumerate(texts) for a, b in brute.lines_of(t)]
        found = [lines[a][:2] + (lines[b - 1][2], b - a) for a, b in whole.chunks(size).tolist()]
        assert found == [(k, c[0][0], c[-1][1], len(c)) for k, t in enumerate(texts) for c in brute.line_chunks(t, size)]
        for t in texts:
            cs = brute.line_chunks(t, size)
            gone = [c for c in cs if rng.random() < 0.5]
            assert line_dedup.without(t, [(c[0][0], c[-1][1]) for c in gone]) == brute.without_lines(t, gone)[0]
    sizes = [len(c) for c in brute.line_chunks(texts[8], 30)]
    assert len(sizes) > 200 and min(sizes) >= 3 and max(sizes[:-1]) <= 16
    shared = set(texts[4][a:b] for a, b in line_dedup.chunks(texts[4])) & set(texts[5][a:b] for a, b in line_dedup.chunks(texts[5]))
    assert shared  # equal lines make chunks of bounded length


def test_chunks_shift_with_their_lines():
    rng = random.Random(1)
    lines = [prose(rng, 6, 5000).encode() for _ in range(200)]
    parts = lambda ls: {t[a:b] for t in [b"\n".join(ls)] for a, b in line_dedup.chunks(t)}
    assert len(parts([b"new", *lines[:100], b"new", *lines[100:]]) - parts(lines)) <= 6


@pytest.mark.parametrize(("lines", "words", "recall"), [(1, 100, 0.8), (4, 50, 0.9), (12, 25, 0.92)])
def test_line_dedup_of_planted_passages(spark, lines, words, recall):
    rng = random.Random(9)
    ls = lambda k: [prose(rng, words, 5000) for _ in range(k)]
    parts = [ls(lines) for _ in range(6)]
    rest = [ls(3) + ls(rng.randrange(4)) for _ in range(24)]
    texts = ["\n".join(r[:3] + parts[i % 6] + r[3:]) for i, r in enumerate(rest)]
    got = line_dedup.dedup(table(spark, texts)).select("doc_id", F.size(F.split("text", r"\s+")).alias("n")).collect()
    gone = {r.doc_id: len(texts[r.doc_id].split()) - r.n for r in got}
    assert sum(gone[i] for i in range(6)) == 0 and all(gone[i] <= lines * words for i in range(24))
    assert sum(gone.values()) >= recall * 18 * lines * words


def test_quality_model(spark, odd_texts):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_model.classify(docs, labels.unionByName(labels)).join(labels, "doc_id").filter("held_out")
    right, n = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 50 and right > 0.95
    odd = table(spark, odd_texts)
    rows = quality_model.classify(odd, labels.limit(0)).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.score <= 1 for r in rows)
    forest = quality_model.train(docs, labels)
    assert quality_model.score(odd, forest).count() == len(odd_texts)
    assert quality_model.score(odd.limit(0), forest).count() == 0


def test_toxicity(spark, odd_texts):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    learn = labels.filter("doc_id % 5 <> 0")
    chain = toxicity.train(docs, learn)
    got = toxicity.score(docs, chain).withColumnRenamed("toxic", "said").join(labels.filter("doc_id % 5 = 0"), "doc_id")
    right = {(r.toxic, r.said): r["count"] for r in got.groupBy("toxic", "said").count().collect()}
    hit, missed, wrong, clean = (right.get(k, 0) for k in ((1, True), (1, False), (0, True), (0, False)))
    assert hit / (hit + missed) > 0.85 and wrong / (wrong + clean) < 0.02
    rows = toxicity.score(table(spark, odd_texts), chain).collect()
    assert len(rows) == len(odd_texts) and all(0 <= r.p_toxic <= 1 for r in rows) and not rows[0].toxic
    assert toxicity.classify(table(spark, odd_texts), labels.limit(0)).count() == len(odd_texts)


def test_language(spark, odd_texts):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = langid.identify(docs.unionByName(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    texts = langid.train(docs)
    odd = langid.predict(table(spark, [*odd_texts, "1234 !?", "Ω"]), texts).collect()
    said = {r.doc_id: r for r in odd}
    assert [said[d].lang_pred for d in (0, 1, 2, 15)] == ["und"] * 4 and said[0].score == 0
    assert said[16].lang_pred != "und" and all(0 <= r.score <= 1 for r in odd)
    assert {r.lang_pred for r in langid.identify(table(spark, odd_texts).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = langid.keep_identified(table(spark, odd_texts))
    assert kept.columns == SCHEMA.replace(",", "").split()[::2] and kept.count() == len(odd_texts) - 3


@pytest.mark.parametrize(("stretch", "join", "longest"), [(1024, 256, 200), (1024, 256, 5000), (64, 8, 500), (5, 2, 300), (64, 0, 300)])
def test_cross_parsing_counts_phrases(monkeypatch, stretch, join, longest):
    """Against a parse that searches the training text anew for each phrase."""
    monkeypatch.setattr(langid, "STRETCH", stretch)
    monkeypatch.setattr(langid, "JOIN", join)
    rng = random.Random(2)
    texts = tuple((k, "".join(rng.choice(c) for _ in range(300)).encode()) for k, c in (("x", "abcd "), ("y", "cdef ")))
    m = langid.Model(texts)
    for _ in range(30):
        t = "".join(rng.choice("abcdefg ") for _ in range(rng.randrange(longest // 2, longest))).encode()
        s = bytes(m.symbols(t).tolist())
        for k, (_, train) in enumerate(texts):
            hay, at, phrases = bytes(m.symbols(train).tolist()), 0, 0
            while at < len(s):
                n = 1
                while at + n < len(s) and s[at : at + n + 1] in hay:
                    n += 1
                if s[at : at + 1] not in hay:
                    n = 1
                at, phrases = at + n, phrases + 1
            got = m.rates([b"", b"ab", t])[2, k] * len(s) / m.bits[k]
            assert abs(got - phrases) < 1e-6, (t, got, phrases)


def test_language_with_odd_rows(spark):
    """Rows without id, ties, long texts, many copies, more rows than are learned from."""
    rng = random.Random(21)
    speak = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))
    rows = [(i, speak("aeiou", 80), "x") for i in range(90)] + [(100 + i, speak("bcdfg", 80), "y") for i in range(90)]
    rows += [(None, speak("aeiou", 9), "y"), (300, speak("hjklm", 4000), "z"), (301, speak("hjklm", 5000), "z"), (302, None, "z")] + [(303, speak("bcdfg", 3), "y")] * 50
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    texts = dict(langid.train(docs))
    assert set(texts) == {"x", "y", "z"} and texts["z"].decode() in rows[181][1] and len(texts["z"]) == langid.LONG_TEXT
    assert all(len(t) < langid.TRAIN_SYMBOLS + langid.LONG_TEXT for k, t in texts.items() if k != "z")
    whole = {r[1] for r in rows if r[1]}
    assert all(t.decode() in whole or len(t) > 1000 for t in texts.values())
    got = langid.predict(spark.createDataFrame([(1, speak("aeiou", 9000)), (2, speak("bcdfg", 5)), (None, speak("hjklm", 50)), (4, "aeiou uoiea aeoui"), (4, "aeiou uoiea aeoui")], "doc_id bigint, text string"), langid.train(docs)).collect()
    assert sorted(r.lang_pred for r in got) == ["x", "x", "x", "y", "z"]
    same = (("p", b"abc"), ("q", b"abc"))
    tie = langid.predict(spark.createDataFrame([(1, "abcabc")], "doc_id bigint, text string"), same).first()
    assert tie.lang_pred == "p" and tie.score == 0
    assert langid.train(docs.limit(0)) == () and langid.identify(docs.limit(0)).count() == 0


@pytest.mark.parametrize("group", [8000, 1])
def test_suffix_dedup(spark, group):
    rng = random.Random(11)
    part = "".join(rng.choice("ab") for _ in range(700))
    texts = [None, "", "short", part, "x" + part[:500] + "y", part[100:600], "z" * 900, "é" * 300, "q" + "é" * 250, "".join(rng.choice("ab") for _ in range(900)), part, part[:300] + "mid" + part[300:]]
    want = brute.repeated_bytes([(t or "").encode() for t in texts], 150)
    docs = table(spark, texts)
    for r in suffix_dedup.dedup(docs, 150, group).collect():
        b, mark = (texts[r.doc_id] or "").encode(), want[r.doc_id]
        spans = sum(m and not (i and mark[i - 1]) for i, m in enumerate(mark))
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(b), len(b) - len(kept), spans, kept), r.doc_id
    assert suffix_dedup.dedup(docs.limit(0)).count() == 0
    null_ids = docs.withColumn("doc_id", F.lit(None).cast("bigint"))
    assert suffix_dedup.dedup(null_ids, 150, group).count() == len(texts)


def test_suffix_dedup_of_whole_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in docs.collect())
    marks = dict(zip([d for d, _ in rows], brute.repeated_bytes([t for _, t in rows], suffix_dedup.WINDOW), strict=True))
    got = {r.doc_id: r for r in suffix_dedup.dedup(docs).collect()}
    for d, t in rows:
        kept = bytes(x for x, m in zip(t, marks[d], strict=True) if not m)
        assert (got[d].n_bytes, bytes(got[d].kept)) == (len(t), kept), d
    assert any(r.n_removed for r in got.values())


def test_repeated_rows_and_null_ids_are_copies(spark):
    rng = random.Random(14)
    part = "".join(rng.choice("abcd") for _ in range(500))
    texts = [part + "x" * 9, "y" + part, "alone " + prose(rng, 120, 900), None]
    for rows, ids in ((texts, [1, 1, 2, 2]), (texts, [None] * 4), (texts + texts, list(range(4)) * 2), (texts + texts, [None] * 8)):
        want = brute.repeated_bytes([(t or "").encode() for t in rows], 400)
        kept = sorted(bytes(x for x, m in zip((t or "").encode(), mark, strict=True) if not m) for t, mark in zip(rows, want, strict=True))
        assert sorted(bytes(r.kept) for r in suffix_dedup.dedup(table(spark, rows, ids)).collect()) == kept


@pytest.mark.parametrize(("repeats", "split", "letters"), [(suffix_dedup.refine, list, b"ab"), (substring_dedup.repeats, bytes.split, b"a b c ")])
def test_buckets_are_the_equal_windows(repeats, split, letters):
    rng = random.Random(15)
    for size in (8, 13, 16, 20, 37):
        base = bytes(rng.choice(letters) for _ in range(400))
        contents = [base[(a := rng.randrange(200)) : a + rng.randrange(200)] + bytes(rng.choice(letters) for _ in range(30)) for _ in range(9)] + [b""]
        want, got = {}, {}
        for r, c in enumerate(contents):
            s = split(c)
            for i in range(len(s) - size + 1):
                want.setdefault(tuple(s[i : i + size]), set()).add((r, i))
        for r, i, b in zip(*(x.tolist() for x in repeats(contents, size)), strict=True):
            got.setdefault(b, set()).add((r, i))
        assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)
    assert len(repeats([], 8)[0]) == 0


def test_nodes_of_a_subtree():
    rng = random.Random(16)
    words = [b"w%d" % rng.randrange(4) for _ in range(150)]
    contents = [b" ".join(words[(a := rng.randrange(90)) : a + rng.randrange(60)]) for _ in range(9)]
    row, place, begin, depth = substring_dedup.subtree(contents, 9)
    assert len(begin) > 3
    for a, z, d in zip(begin, [*begin[1:], len(row)], depth, strict=True):
        below = [contents[r].split()[p:] for r, p in zip(row[a:z], place[a:z], strict=True)]
        assert below == sorted(below, key=lambda x: [contents_order(contents).index(w) for w in x]) and len(below) > 1
        assert all(x[:d] == below[0][:d] for x in below) and len({tuple(x[: d + 1]) for x in below}) > 1


def contents_order(contents):
    return list(dict.fromkeys(w for c in contents for w in c.split()))


@pytest.mark.parametrize("group", [50_000, 1])
def test_substring_dedup(spark, group):
    rng = random.Random(12)
    part = prose(rng, 80, 5)
    texts = [None, "", "one two", part, "x " + part, prose(rng, 300, 2), part[:200], "same " * 100, "same " * 50, prose(rng, 50), part + " " + part]
    want = brute.later_words([(t or "").encode() for t in texts], 10)
    docs = table(spark, texts)
    for r in substring_dedup.dedup(docs, 10, group).collect():
        ws, mark = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept) == (len(ws), sum(mark), b" ".join(w for w, m in zip(ws, mark, strict=True) if not m).decode()), r.doc_id
    assert substring_dedup.dedup(docs.limit(0)).count() == 0
    assert substring_dedup.dedup(docs.unionByName(docs), 10, group).count() == 2 * len(texts)


@pytest.mark.parametrize("group", [50_000, 1])
def test_substring_dedup_of_repeated_rows(spark, group):
    rng = random.Random(13)
    part = prose(rng, 60, 500)
    texts = ["a b " + part + " c", "d " + part, part + " " + prose(rng, 30, 500), prose(rng, 40, 500)]
    docs = table(spark, texts)
    want = sorted([b" ".join(w for w, m in zip(ws, mark, strict=True) if not m).decode() for ws, mark in brute.later_words([t.encode() for t in texts], 10)] * 2)
    assert sorted(r.kept for r in substring_dedup.dedup(docs.unionByName(docs), 10, group).collect()) == want
    same = docs.withColumn("doc_id", F.lit(None).cast("bigint")).filter(F.col("text").isin(texts[0], texts[1]))
    kept = [r.kept for r in substring_dedup.dedup(same.unionByName(same), 10, group).collect()]
    assert sum(part in k for k in kept) == 2 and sum(k in ("a b c", "d") for k in kept) == 2


def test_bpe_equals_the_library(spark, odd_texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    hard = ["  two  spaces ", "it's he'll 'sa", "x\n y\n\n  z\t", "<|endoftext|>a <|endoftext|>", "é  b　c", "\x00\x1c\x1f", "日本語 テスト 123abc", "a" * 500 + " b", " lead", "trail ", "\U0001f600 ok", "naïve—“quote”…", "a\u2003 b\u00a0 \u00a0c \u3000 d\u2028  e", "“x” – y’s\u202f z\x85 q"]
    texts = [*odd_texts, *hard]
    docs = table(spark, texts)
    got = bpe.encode_decode(docs.unionByName(docs.filter("doc_id = 4")), path).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.token_ids == ids and r.decoded == lib.decode(ids, skip_special_tokens=False), texts[r.doc_id]
    assert bpe.encode_decode(docs.limit(0), path).count() == 0


def test_bpe_remembers_little(monkeypatch):
    """Many long texts, with and without places to cut, under a small bound."""
    monkeypatch.setattr(bpe, "CACHE", 500)
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder, lib, rng = bpe.ByteBPE(path), Tokenizer.from_file(path), random.Random(8)
    letter = lambda: rng.choice("abcdefghijklmnop“”’…é日")
    for k in range(100):
        texts = ["“" + "".join(letter() for _ in range(rng.randrange(300))) + "” \u00a0 " + prose(rng, 30, 9000) + "<|endoftext|>" * (k % 3) for _ in range(20)]
        assert coder.encode_all([t.encode() for t in texts[:1]])[0] == bytes().join(i.to_bytes(4, "little") for i in lib.encode(texts[0], add_special_tokens=False).ids)
        coder.encode_all([t.encode() for t in texts])
        assert len(coder.known) < 500 + 2000 and max(map(len, coder.known)) <= bpe.KNOWN


@pytest.mark.parametrize("group", [4096, 5])
def test_simhash(spark, odd_texts, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)
    rng = random.Random(4)
    near = [prose(rng, 400, 5000) for _ in range(6)]
    texts = [*odd_texts, *near, *[t + " more" for t in near], *["more " + t for t in near], near[0]]
    want = [(d, brute.fingerprint((t or "").encode())) for d, t in enumerate(texts)]
    comp = brute.components(want)
    docs = table(spark, texts)
    got = {r.doc_id: r for r in simhash.report(simhash.near_duplicates(docs)).collect()}
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{fp:016x}", c) for (d, fp), c in zip(want, comp, strict=True)}
    kept = simhash.keep_one(docs.unionByName(docs))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(comp))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_every_close_pair_shares_a_key():
    rng = random.Random(9)
    masks = simhash._ring_masks()
    for _ in range(3000):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(4)):
            b ^= 1 << bit
        assert any((a ^ b) & m == 0 for m in masks)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)] + [(200, 200)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_null_ids_and_repeated_rows_everywhere(spark, odd_texts):
    """Every operator returns a row for each row, whatever the ids; equal texts get equal results."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*odd_texts, "plain words " * 30]
    docs = table(spark, texts * 2, [None] * len(texts) + [3] * len(texts))
    labels = spark.createDataFrame([(None, 1, 1, "x"), (3, 0, 1, "y"), (3, 1, 0, "y")], "doc_id bigint, quality int, toxic int, text string")
    items = spark.createDataFrame([(1, texts[4][:90])], "item_id bigint, text string")
    results = {
        "decontaminate": decontam.report(decontam.find(docs, items)).select("doc_id", "n_words", "n_hit"),
        "rules": quality_rules.judge(docs).select("doc_id", "n_words", "kept"),
        "lines": line_dedup.report(docs).select("doc_id", "n_lines", "n_removed"),
        "quality": quality_model.classify(docs, labels).select("doc_id", "score", "predicted"),
        "toxicity": toxicity.classify(docs, labels).select("doc_id", "p_toxic", "toxic"),
        "language": langid.identify(docs).select("doc_id", "lang_pred", "score"),
        "bpe": bpe.digests(bpe.encode_decode(docs, path)).select("doc_id", "n_tokens", "ids_sha256"),
        "simhash": simhash.report(simhash.near_duplicates(docs)).select("doc_id", "fingerprint", "component_id"),
    }
    for name, df in results.items():
        rows = [tuple(r) for r in df.collect()]
        assert len(rows) == 2 * len(texts), name
        assert sum(r[0] is None for r in rows) == len(texts), name
        if name not in ("lines",):
            assert sorted(map(repr, (r[1:] for r in rows if r[0] is None))) == sorted(map(repr, (r[1:] for r in rows if r[0] == 3))), name


def test_quality_rules_with_long_texts_and_ties(spark):
    """Words that are equally common share the last places among the commonest without changing from run to run."""
    rng = random.Random(31)
    words = [f"w{i:02d}" for i in range(60)]  # all equally common
    texts = [" ".join(rng.sample(words, 60) * 2) for _ in range(30)] + [" ".join(rng.choice(words) for _ in range(40000))]
    one, two = (sorted(map(repr, quality_rules.judge(table(spark, texts)).repartition(n).collect())) for n in (1, 3))
    assert one == two and len(one) == len(texts)


def test_labels_that_disagree_or_clash(spark):
    docs = table(spark, [prose(random.Random(i), 80) for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0 and 1 or 0, "t", "en") for i in range(40)] + [(1, 0, 1, "t", "en"), (1, 1, 0, "u", None)], "doc_id bigint, quality int, toxic int, text string, lang string")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == 40 and {r.doc_id: r.p_toxic for r in toxicity.classify(docs, labels.orderBy("text", "toxic")).collect()} == {r.doc_id: r.p_toxic for r in got}
    assert quality_model.classify(docs, labels).count() == 40


def test_a_chain_is_its_links_in_turn():
    """Against sums written out, one row and one feature at a time."""
    import math

    import numpy as np

    rng = np.random.default_rng(5)
    links = [toxicity.Linear(rng.normal(size=k + 6), float(rng.normal())) for k in range(3)]
    chain = toxicity.Chain([bytes([97 + i]) for i in range(6)], links)
    places = [sorted({int(c) for c in rng.integers(0, 6, n)}) for n in (0, 1, 3, 6)]
    for row, got in zip(places, chain.predict(places), strict=True):
        earlier = []
        for link in links:
            z = link.bias + sum(link.weight[j] * p for j, p in enumerate(earlier)) + sum(link.weight[len(earlier) + c] for c in row)
            earlier.append(1 / (1 + math.exp(-z)))
        assert np.allclose(got, earlier)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert components(spark.createDataFrame([(1, 1)], "a bigint, b bigint")).count() == 0
