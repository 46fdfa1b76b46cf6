"""The pipeline against brute force over the smallest tables, and the numbered queries' columns."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerlake.llm import langid, line_dedup
from ledgerlake.llm.queries import queries
from tests.llm import brute

DATA = "/root/testdata/sf0.001"
COLUMNS = {
    1: {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    2: {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    3: {"doc_id", "n_lines", "n_removed", "kept_sha256"},
    4: {"doc_id", "held_out", "score", "predicted"},
    5: {"doc_id", "p_low_quality", "p_toxic", "toxic"},
    6: {"doc_id", "held_out", "lang_pred", "score"},
    7: {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    8: {"doc_id", "n_words", "n_removed", "kept_sha256"},
    9: {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    10: {"doc_id", "fingerprint", "component_id"},
    11: {"item_id", "rank", "doc_id", "score"},
    12: {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
    13: {"query_id", "rank", "vec_id", "score"},
}


def test_queries_return_a_row_for_each_document(spark):
    for name, f in queries().items():
        df = f(spark, DATA)
        assert set(df.columns) == COLUMNS[int(name[2:].split("_")[0])], name
        assert df.count() == 200 or name.startswith(("op11", "op13")), name
    assert len(queries()) == 13


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [(str(r.item_id), r.text.encode()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    rows = sorted((r.doc_id, r.text) for r in langid.keep_identified(docs).select("doc_id", "text").collect())
    assert rows == sorted((r.doc_id, r.text) for r in docs.collect() if r.text and any(c.isalpha() for c in r.text))
    cut = brute.cut_lines([(d, t.encode()) for d, t in rows], line_dedup.MIN_BYTES)
    left = []
    for d, t in rows:
        text = brute.without_lines(t.encode(), cut[d])[0].decode()
        if not cut[d] or text.strip():
            left.append((d, text))
    comp = brute.components([(d, brute.fingerprint(t.encode())) for d, t in left])
    left = [(d, t) for (d, t), c in zip(left, comp, strict=True) if d == c]
    lib, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, DATA).collect()}
    for d, t in left:
        n, hit, _ = brute.contamination(t.encode(), items)
        if 2 * len(hit) <= n:
            t = brute.without_words(t.encode(), hit).decode()
            ids = lib.encode(t, add_special_tokens=False).ids
            want[d] = (ids, len(ids), brute.sha(t.encode()))
    assert {d: (r.token_ids, r.n_tokens, r.decoded_sha256) for d, r in got.items()} == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, DATA).columns == docs.columns


def test_stages_on_odd_rows(spark):
    """Null ids and texts, repeated rows, ids with several texts, and columns named as those that stages use."""
    text = "one two three. four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, text), (1, text), (1, "another text of the same id, which is quite short"), (None, text + " end"), (None, None), (2, None), (3, ""), (4, " \n"), (5, "long " * 50_000), (6, text)]
    docs = spark.createDataFrame([(i, t, "en", "s", None, "x", "y", 7, "z") for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, h string, tid string, lo int, spans string")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, DATA)
            table = spark.createDataFrame(out.collect(), out.schema)
        assert {"doc_id", "token_ids"} <= set(table.columns)
    done = corpus_pipeline.language(spark, docs, DATA)
    assert done.columns == docs.columns and done.count() == 6
    kept = {(r.doc_id, r.text): r.n_chars for r in corpus_pipeline.lines(spark, docs, DATA).collect()}
    assert (2, None) in kept and (3, "") in kept and kept[1, text] is None and (6, text) not in kept
    assert {r.n_chars for r in corpus_pipeline.decontaminate(spark, docs, DATA).collect()} == {None}
