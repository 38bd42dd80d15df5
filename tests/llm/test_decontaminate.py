"""Decontamination against all windows of all documents."""

import random
import re
from collections import Counter

from quayside.llm.decontaminate import drop_leaks, leaks


def tokens(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def shingles(w, k):
    return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()


def brute(docs, items):
    out = set()
    for i, t in docs:
        w = tokens(t)
        for j, b in items:
            own = tokens(b)
            n, k = len(own), min(5, len(own))
            if not n or not w:
                continue
            want, best = shingles(own, k), None
            if not want.keys() & shingles(w, k).keys():
                continue
            for s in range(max(1, len(w) - n + 1)):
                have = shingles(w[s:s + n], k)
                sim = sum((want & have).values()) / sum((want | have).values())
                if sim >= 0.75 and (best is None or sim > best[0]):
                    best = sim, s
            if best:
                out.add((i, j, best[1], n, round(best[0], 9)))
    return out


def made(seed, n_items=12, n_docs=120):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(text(rng.choice([1, 3, 5, 8, 15, 30, 45, 57])))) for k in range(n_items)]
    items += [(100, "echo " * 30), (101, None), (102, ""), (103, items[5][1]), (103, items[5][1])]
    docs = []
    for d in range(n_docs):
        w = text(rng.randint(0, 80))
        own = items[rng.randrange(n_items)][1].split()
        for _ in range(rng.randint(0, 3)):  # words changed, added or left out
            at = rng.randrange(len(own) + 1)
            own[at:at + rng.randint(0, 1)] = rng.choice([[], ["x"], ["y"]])
        at = rng.randint(0, len(w))
        docs.append((d, ", ".join(w[:at] + own + w[at:]).upper()))
    docs += [(500, "echo " * 200), (501, None), (502, ""), (503, "word " * 20000 + items[4][1]), (500, "echo " * 200)]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, words int"),
            spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, start int"))


def test_equals_all_windows(spark):
    docs, items = made(1)
    d, b = frames(spark, docs, items)
    got = {(r.doc_id, r.item_id, r.start, r.words, round(r.similarity, 9)) for r in leaks(d, b).collect()}
    want = brute(docs, items)
    assert got == want and len(want) > 30
    kept = drop_leaks(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in {x[0] for x in want})


def test_empty_tables(spark):
    docs, items = made(2, 8, 5)
    d, b = frames(spark, docs, items)
    assert leaks(d.limit(0), b).count() == 0
    assert leaks(d, b.limit(0)).count() == 0
    assert drop_leaks(d, b.limit(0)).count() == d.count()


def test_whole_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    b = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = {(r.doc_id, r.item_id, r.start, r.words, round(r.similarity, 9)) for r in leaks(d, b).collect()}
    assert got == brute([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in b.collect()])
