"""Ranked lexical search, run detection and exact vector search against brute force, and on odd inputs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import common, lexical_search, run_detection, threshold_search
from tests.llm import brute
from tests.llm.test_operators import DATA, odd_texts, prose, table  # noqa: F401

# Ranked lexical search


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id bigint, text string, doc_id int, score string")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sizes", [(4096, 64), (7, 2), (50, 4)])
def test_lexical_search(spark, odd_texts, monkeypatch, sizes):  # noqa: F811
    monkeypatch.setattr(lexical_search, "SHARD", sizes[0])
    monkeypatch.setattr(lexical_search, "BLOCK", sizes[1])
    rng = random.Random(4)
    texts = odd_texts + [prose(rng, rng.randrange(1, 60), 150) for _ in range(150)]
    texts += texts[20:40]  # ties
    ids = [*rng.sample(range(1000), len(texts) - 1), None]
    items = [(k, prose(rng, rng.randrange(1, 25), 150)) for k in range(12)] + [(20, "W1 w1, w2"), (20, "other w3"), (21, None), (22, ""), (23, "nowhere"), (None, "é é w5"), (20, "W1 w1, w2")]
    got = lexical_search.search(table(spark, texts, ids).repartition(3), items_of(spark, items))
    assert rows_of(got) == sorted(brute.ranked(list(zip(ids, texts, strict=True)), items), key=repr)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_lexical_search_in_parts_and_on_nothing(spark, odd_texts, monkeypatch):  # noqa: F811
    docs, items = table(spark, odd_texts), items_of(spark, [(k, t[:80]) for k, t in enumerate(odd_texts[4:9])])
    want = rows_of(lexical_search.search(docs, items))
    assert len(want) > 10
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", 100)
    assert rows_of(lexical_search.search(docs, items)) == want
    assert lexical_search.search(docs.limit(0), items).count() == lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(table(spark, [None, "", " . "]), items).count() == 0


def test_lexical_search_reads_few_blocks():
    """Block maxima and bounds leave most blocks of a common term compressed, and change no result."""
    rng = random.Random(2)
    n = 4000
    docs = np.arange(n, dtype=np.uint16)
    rare = np.array(sorted(rng.sample(range(n), 30)), np.uint16)
    tf = np.array([rng.randrange(1, 3) for _ in range(n)] + [5] * 30, np.int32)
    row = {"ids": list(range(n)), "lengths": np.full(n, 100, np.int64).tobytes(), "terms": [0, 1], "dfs": [n, 30], "docs": np.r_[docs, rare].tobytes(), "tfs": tf.tobytes()}
    shard = index_row(row, n, 100 * n)
    best = threshold_search.Best(10)
    best.add(np.full(10, 40_000_000), np.arange(10_000, 10_010), np.zeros(10, bool))
    blocks = len(shard.first)
    shard.search([(0, 1), (1, 60)], best)
    assert shard.read < blocks / 2
    every = threshold_search.Best(10)
    whole = index_row(row, n, 100 * n)
    whole.search([(0, 1), (1, 60)], every)
    assert whole.read == blocks
    assert best.score.tolist() == every.score.tolist() and best.id.tolist() == every.id.tolist()


def index_row(row, texts, length):
    import pyarrow as pa

    class Posted:
        """Runs the function that index() hands to Spark on one row."""

        def select(self, *names):
            return self

        def mapInArrow(self, work, schema):
            types = [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            return list(work(iter([pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))])))

    out = lexical_search.index(Posted(), texts, length, 64)[0]
    return lexical_search.Shard(64, out.column(0).flatten(), *(out.column(c)[0].as_py() for c in range(1, 6)))


def test_lexical_search_of_whole_tables(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute.ranked([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows_of(lexical_search.search(docs, items)) == sorted(want, key=repr)


# Run detection


def runs_of(texts):
    """The runs of some lists of numbers, searched for together."""
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    begin = np.cumsum([0, *map(len, texts)])
    out = [[] for _ in texts]
    for s, e, q in run_detection.runs(np.array([x for t in texts for x in t], np.int64), of):
        out[of[s]].append((s - int(begin[of[s]]), e - s, q))
    return out


def periodic(rng):
    """Words with runs of all kinds: nested, overlapping, at the edges, broken by other words."""
    kinds = rng.choice([1, 2, 3, 8, 50])
    some = lambda n: [rng.randrange(kinds) for _ in range(n)]
    out = some(rng.randrange(30))
    for _ in range(rng.randrange(4)):
        u = some(rng.randrange(1, 15))
        if rng.random() < 0.3:
            u = u * 8 + some(2)
        out += (u * rng.randrange(2, 12))[: rng.randrange(10, 200)] + some(rng.randrange(6))
    return out


@pytest.mark.parametrize("patience", [8, 0])
def test_runs_of_random_words(monkeypatch, patience):
    monkeypatch.setattr(run_detection, "PATIENCE", patience)
    rng = random.Random(patience)
    texts = [periodic(rng) for _ in range(400)]
    assert sum(bool(r) for r in map(brute.word_runs, texts)) > 200
    assert runs_of(texts) == [brute.word_runs(t) for t in texts]


def test_runs_of_regular_words():
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    thue = [bin(i).count("1") % 2 for i in range(512)]
    texts = [fib[-1], thue, [0] * 300, [0] * 23, [0] * 24, [0, 1] * 11 + [0], [0, 1] * 12, list(range(100)) * 3, list(range(100)) * 2, list(range(9)) * 3, list(range(8)) * 3, ([0] * 20 + [1]) * 6, [], [5]]
    texts += [list(range(50)) + [9] * 30 + list(range(50)) + [9] * 30]
    assert runs_of(texts) == [brute.word_runs(t) for t in texts]


def test_a_grammar_derives_its_text():
    rng = random.Random(3)
    texts = [periodic(rng) for _ in range(60)]
    ends = np.cumsum([len(t) for t in texts])
    ids = np.array([k * 1000 + x for k, t in enumerate(texts) for x in t], np.int64)
    rules, left = run_detection.repair(ids, ends)
    assert len(left) < len(ids) / 2
    for x, y, places in rules:
        words = {tuple(ids[p : p + x + y].tolist()) for p in places.tolist()}
        assert len(words) == 1 and len(places) > 1
        assert all(np.searchsorted(ends, p, side="right") == np.searchsorted(ends, p + x + y - 1, side="right") for p in places.tolist())


def test_run_detection_of_documents(spark, odd_texts):  # noqa: F811
    rng = random.Random(8)
    texts = odd_texts + [" ".join(f"w{x}" for x in periodic(rng)) for _ in range(120)] + ["z " * 5000, "x\ty " * 40 + "\x0bend"]
    ids = [*range(len(texts) - 1), None]
    docs = table(spark, texts, ids)
    got = {r.doc_id: r for r in run_detection.detect(docs.unionByName(docs), plant=True).collect()}
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    for d, t in zip(ids, texts, strict=True):
        assert tuple(got[d][n] for n in names) == brute.run_row(d, t), d
        assert brute.sha(got[d].collapsed.encode()) == got[d].collapsed_sha256
        assert len(got[d].runs) == got[d].n_runs
    assert run_detection.detect(docs, plant=True, texts=False).columns == ["doc_id", *names]
    assert run_detection.detect(docs).count() == len(texts) and run_detection.detect(docs.limit(0)).count() == 0


def test_run_detection_of_whole_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: tuple(r[1:]) for r in run_detection.detect(docs, plant=True, texts=False).collect()}
    short = [r for r in docs.collect() if len(r.text or "") < 30_000]
    assert len(short) > 900
    assert all(got[r.doc_id] == brute.run_row(r.doc_id, r.text) for r in short)


# Exact vector search


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 3, 0) for i, v in rows], "vec_id bigint, embedding array<double>, label int, score int")


@pytest.mark.parametrize("sizes", [(4096, 2048), (16, 3), (5, 1)])
def test_vector_search(spark, monkeypatch, sizes):
    monkeypatch.setattr(threshold_search, "SHARD", sizes[0])
    monkeypatch.setattr(threshold_search, "BLOCK", sizes[1])
    rng = np.random.default_rng(1)
    rows = [(i * 20, rng.normal(size=6).round(3).tolist()) for i in range(90)]
    rows += [(i, rows[3][1]) for i in range(900, 930)]  # ties
    rows += [(0, rows[1][1]), (0, rows[0][1]), (None, rows[2][1]), (None, [1.0] * 6), (100, None), (200, [1.0, None]), (300, [float("nan")] * 6), (400, [float("inf")] + [0.0] * 5), (500, []), (600, [0.0] * 6), (700, [0.5, -2.0]), (800, [1.0] * 9)]
    got = threshold_search.search(vectors(spark, rows).repartition(2), F.col("vec_id") % 100 == 0)
    assert rows_of(got) == sorted(brute.nearest(rows), key=repr)
    assert threshold_search.search(vectors(spark, rows).limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert threshold_search.search(vectors(spark, rows[:4]), F.col("vec_id") < 0).count() == 0


def test_vector_search_beyond_doubles(spark):
    rng = random.Random(7)
    rows = [(i * 50, [float(rng.randrange(-(2**20), 2**20)) for _ in range(3)]) for i in range(40)]
    got = [r for r in rows_of(threshold_search.search(vectors(spark, rows), F.col("vec_id") % 100 == 0)) if abs(r[3]) < 2**63 - 1]
    assert got and set(got) <= set(brute.nearest(rows))
    assert threshold_search.search(vectors(spark, [(0, [1e300, 1.0]), (1, [1e300, -1e300])]), F.col("vec_id") == 0).first().score == 2**63 - 1


def test_vector_search_stops_early():
    """Where few vectors are near, most are never scored."""
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(4000, 4)) * 10).astype(np.int64)
    x[:20] *= 100
    lists = np.argsort(x.T, axis=1, kind="stable").astype(np.int32)
    best = [threshold_search.Best(3)]
    scored = threshold_search.walk(x[:1], np.array([0]), x, lists, np.arange(4000), np.zeros(4000, bool), best)
    want = sorted(((-int(s), i) for i, s in enumerate(x @ x[0]) if i), key=lambda p: p)[:3]
    assert list(zip((-best[0].score).tolist(), best[0].id.tolist(), strict=True)) == want
    assert scored < 1500


def test_vector_search_of_whole_tables(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet")
    want = brute.nearest([(r.vec_id, r.embedding) for r in rows.collect()])
    assert rows_of(threshold_search.search(rows, F.col("vec_id") % 100 == 0)) == sorted(want, key=repr)


def test_slices_are_bounded_in_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(common, "SLICE_BYTES", 1000)
    batch = pa.RecordBatch.from_arrays([pa.array([b"x" * n for n in (10, 400, 400, 400, 5000, 1, 1)])], ["t"])
    sizes = [[len(x) for x in s.column(0).to_pylist()] for s in common.slices(batch)]
    assert sum(sizes, []) == [10, 400, 400, 400, 5000, 1, 1]
    assert all(len(s) == 1 or sum(s) <= 1000 for s in sizes)
    assert [s.num_rows for s in common.slices(batch, 3)][0] <= 3
