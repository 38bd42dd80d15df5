"""The pipeline against brute-force versions of its stages."""

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayside.llm import rules
from test_decontaminate import brute as leaks_of
from test_jaccard_join import brute as components_of
from test_recipes import LOWER

FOLDER = "/root/testdata/sf0.001"


def test_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    model = rules.train(docs, labels, corpus_pipeline.QUALITY_FOLD)
    good = {r.doc_id for r in rules.score(docs, model, corpus_pipeline.QUALITY_FOLD).collect() if r.predicted}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    last = {}
    for i, t in rows:
        last[(t or "").translate(LOWER)] = max(i, last.get((t or "").translate(LOWER), i))
    rows = [(i, t) for i, t in rows if last[(t or "").translate(LOWER)] == i]
    first = {i for i, _, c in components_of(rows) if i == c}
    rows = [(i, t) for i, t in rows if i in first]
    leaked = {x[0] for x in leaks_of(rows, items)}
    rows = [(i, t) for i, t in rows if i not in leaked]
    assert leaked and len(rows) < len(good)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, FOLDER).collect()]
    assert sorted(got) == sorted(want)


def test_stages_keep_the_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, "en", "a", 0), (1, None, "en", "a", 0), (None, "x y", None, None, None), (2, "", "en", "b", 0)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        now = some
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, FOLDER)
            assert now.columns == docs.columns
            now.count()
        assert corpus_pipeline.STAGES[-1][1](spark, now, FOLDER).count() == now.count()


@pytest.mark.parametrize("stage", [corpus_pipeline.near_dedup, corpus_pipeline.bpe_encoding])
def test_whole_texts_go_to_python_in_small_batches(spark, stage):
    """A worker holds a batch of texts three times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.unset(key)
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert stage(spark, docs, FOLDER).count() == 1
    assert int(spark.conf.get(key)) <= 500
