"""The rule ensemble: compiled expression, held-out accuracy, odd rows."""

import numpy as np

from quayside.llm import rules

FOLD = (3, 1)


def table(spark, name, sf="0.01"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")


def test_held_out_accuracy_and_compiled_rules(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = rules.train(docs, labels, FOLD)
    assert 0 < len(model.rules) < 100
    got = {r.doc_id: r for r in rules.score(docs, model, FOLD).collect()}
    assert len(got) == docs.count()
    stats = rules.with_statistics(docs).toPandas()
    by_hand = model.predict(stats[rules.NAMES].to_numpy(float))
    for i, p in zip(stats.doc_id, by_hand):
        assert abs(got[i].score - p) < 1e-9 and got[i].predicted == int(got[i].score >= 0.5)
    y = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert np.mean([a == b for a, b in y]) > 0.97
    kept = rules.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.predicted)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (None, "x", "c"), (3, "word " * 100000, "d"), (3, "word " * 100000, "d"), (4, "\n\n \n", "e")],
        "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, None), (9, 0), (None, 1)], "doc_id long, quality int")
    model = rules.train(docs, labels, FOLD)
    assert model.rules == ()
    got = rules.score(docs, model, FOLD).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    empty = rules.train(docs, labels.limit(0), FOLD)
    assert {r.score for r in rules.score(docs, empty, FOLD).collect()} == {0.5}
    assert rules.score(docs.limit(0), model, FOLD).count() == 0
    assert rules.keep_good(docs, empty).columns == docs.columns
