"""Quality by boosted trees: counts against plain loops, directions, flat nodes, held-out labels."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quayside.llm.boosted_quality import MONOTONIC, NAMES, fit, flat, judge, measure, train
from quayside.llm.queries import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)]


def test_counts():
    rng = random.Random(4)
    odd = ["", " \n\t", "a", "ä b c d", "one\x0btwo\x0cthree\x1cfour\x85five", "x " * 9, "a b c d e f g h " * 3, "l\nl\n l\nl \n\n",
           "#*$%&|<> 你好 😀 " * 5, " ".join(map(str, range(30000))), "long word " * 20000]
    for _ in range(300):
        odd.append("".join(rng.choice("ab \n#ü") for _ in range(rng.randrange(200))))
    for t in odd:
        counts, stats = measure(t.encode())
        assert counts == brute(t), t[:60]
        assert len(stats) == len(NAMES) and np.isfinite(stats).all()


def sample(n=1500, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(NAMES)))
    at = NAMES.index
    y = (x[:, at("symbols")] + 0.3 * np.sin(9 * x[:, at("symbols")]) + x[:, at("stops")] * x[:, at("commas")] + rng.normal(0, 0.2, n) < 0.9)
    return x, y.astype(int)


def test_monotonic_statistics_never_raise_a_score():
    x, y = sample()
    model = fit(x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.85
    other, _ = sample(400, 7)
    for k, sign in enumerate(MONOTONIC.values()):
        steps = []
        for value in np.linspace(-0.1, 1.1, 40):
            moved = other.copy()
            moved[:, k] = value
            steps.append(model.score(moved))
        if sign:
            assert (np.diff(np.stack(steps), axis=0) * sign >= -1e-12).all()


def test_flat_nodes_equal_a_walk():
    x, y = sample(600, 3)
    model = fit(x, y)

    def walk(row):
        total = model.start
        for node in model.roots:
            while model.low[node] != node:
                node = model.low[node] if row[model.feature[node]] <= model.edge[node] else model.high[node]
            total += model.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(x[:50]), [walk(r) for r in x[:50]])
    assert flat(0.0, [], []).score(x[:2]).tolist() == [0.5, 0.5]
    assert fit(x[:5], np.ones(5, int)).score(x[:1])[0] > 0.5


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, 9), (1, text, 9), (2, None, 9), (3, "", 9), (None, "short one", 9), (4, text * 400, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = train(docs, labels)
    got = sorted(judge(docs, model).collect(), key=repr)
    assert sorted([[r[0], *r[1:6]] for r in got], key=repr) == sorted([[i, *brute(t)] for i, t, _ in rows], key=repr)
    assert [r.kept for r in got if r.doc_id == 1] == [True, True] and not any(r.kept for r in got if r.n_words < 20)
    assert judge(docs.limit(0), model).count() == 0


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = train(docs, labels, (3, 1))
    out = labels.where((F.crc32(F.col("doc_id").cast("string")) % 3 == 1) & F.col("quality").isNotNull())
    got = judge(docs, model).join(out, "doc_id").select("score", "quality").toPandas()
    right = (got["score"] >= 0.5) == (got["quality"] == 1)
    assert len(got) > 1000 and right.mean() > 0.97
    assert right[got["quality"] == 1].mean() > 0.99


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = LLM_QUERIES["op13_boosted_quality"](spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    assert list(got.columns[:8]) == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = {i: brute(t) for i, t in zip(docs["doc_id"], docs["text"])}
    assert len(got) == len(docs)
    for r in got.itertuples():
        base = list(r[2:7])
        assert base == want[r.doc_id]
        assert r.base_failed == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert r.kept == (not r.base_failed and r.score >= 0.5)
