"""The n-gram Jaccard join against all pairs."""

import random

import numpy as np

from quayside.llm import jaccard_join
from quayside.llm.components import components
from quayside.llm.jaccard_join import drop_near, near_groups, parity
from quayside.session import materialise


def words(t):
    return (t or "").encode().lower().split()


def shingles(t):
    w = words(t)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    where = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, s in enumerate(sets):
        shared = {}
        for x in s:
            for b in where[x]:
                if b > a:
                    shared[b] = shared.get(b, 0) + 1
        for b, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[b]) - n):
                up[find(a)] = find(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(r[0], least.get(find(k), r[0]))
    return sorted([(r[0], len(sets[k]), least.get(find(k)) if sets[k] else r[0]) for k, r in enumerate(rows)], key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, key string, n string")


def got_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def made(seed, clusters=12, copies=14, edits=7):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(3000)]
    passage = [rng.choice(vocab) for _ in range(55)]
    rows, i = [], 0
    for c in range(clusters):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 5, 9, 40, 120, 300]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(w) + 1)
                w[at:at + rng.randint(0, 1)] = rng.choice([[], [rng.choice(vocab)]])
            if c % 3 == 0:
                w = w + passage
            rows.append((i, "  ".join(w), "x", "y"))
            i += 1
    for _ in range(60):  # a common passage in unlike texts
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 120))]
        rows.append((i, " ".join(w + passage), "x", "y"))
        i += 1
    rng.shuffle(rows)
    odd = [(9000, None), (9001, ""), (9002, " \n"), (9003, "one two"), (9004, "ONE\tTwo"), (9005, "one two three"), (None, "one two"),
           (None, "alone here"), (9006, "long word " * 40000), (9007, "long word " * 40000 + "end"), (9008, "é É é É é É"),
           (9009, "é é é é é é"), (9003, "one two"), (9010, rows[0][1]), (-5, rows[1][1])]
    return rows + [(a, b, "x", "y") for a, b in odd]


def test_equals_all_pairs(spark):
    for seed in (1, 2):
        rows = made(seed)
        assert got_of(near_groups(frame(spark, rows).repartition(6))) == brute(rows)


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(2000)]
    base = [rng.choice(vocab) for _ in range(140)]
    rows = []
    for i in range(700):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w), "x", "y"))
    rows += [(1000 + i, " ".join(base), "x", "y") for i in range(700)]
    assert got_of(near_groups(frame(spark, rows).repartition(8))) == brute(rows)


def unlinked_copies(n, seed=11):
    """Near copies of one text, most of them too unlike each other to link."""
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(4000)]
    base = [rng.choice(vocab) for _ in range(160)]
    rows = []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(len(w)), rng.randint(4, 8)):
            w[at] = rng.choice(vocab)
        rows.append((i, " ".join(w), "x", "y"))
    return rows


def test_compared_pairs_grow_with_the_group_not_its_square(spark, monkeypatch):
    compared, exact = [], jaccard_join.linked

    def counted(pairs, sets):
        pairs = materialise(pairs, "counted")
        compared[-1] += pairs.count()
        return exact(pairs, sets)

    monkeypatch.setattr(jaccard_join, "linked", counted)
    for n in (600, 1200):
        compared.append(0)
        rows = unlinked_copies(n)
        assert got_of(near_groups(frame(spark, rows).repartition(6))) == brute(rows)
    assert compared[1] < 2.7 * compared[0], compared


def test_overlaps_of_parts_and_lots(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "UNION_PART", 7)
    monkeypatch.setattr(jaccard_join, "CHUNK", 3)
    rng = random.Random(8)
    tokens = {k: rng.sample(range(200), rng.randint(0, 30)) for k in range(40)}
    union = {g: set(rng.sample(range(200), rng.choice([1, 20, 90]))) for g in range(100, 106)}
    asked = [(k, g) for k in tokens for g in union if g == 100 or rng.random() < 0.3]
    got = jaccard_join.overlaps(
        spark.createDataFrame(asked + asked[:5], "node long, other long"),
        spark.createDataFrame(list(tokens.items()), "node long, tokens array<long>"),
        spark.createDataFrame([(g, t) for g, own in union.items() for t in own], "other long, token long"))
    want = {(k, g): len(union[g] & set(tokens[k])) for k, g in asked}
    assert {(r.node, r.other): r.both for r in got.collect()} == {k: n for k, n in want.items() if n}


def test_unlike_bits_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for n in (1, 5, 200, 3000):
        a, b = (np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for _ in range(2))
        b = np.unique(np.concatenate([a[: n // 2], b[n // 2:]]))
        bits = sum(((x ^ y) & 0xFFFFFFFFFFFFFFFF).bit_count() for x, y in zip(parity(a).tolist(), parity(b).tolist()))
        assert bits <= len(np.setxor1d(a, b))
    assert not parity(np.zeros(0, np.uint64)).any()


def test_drop_and_empty(spark):
    rows = made(3, clusters=4, copies=6)
    docs = frame(spark, rows)
    kept = drop_near(docs)
    assert kept.columns == docs.columns
    want = {i for i, _, c in brute(rows) if i == c}
    assert {r.doc_id for r in kept.collect()} == want
    assert near_groups(docs.limit(0)).count() == 0 and drop_near(docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1400)] + [(7000, 7000), (5000, 4000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: 0 for i in range(201)} | {k: 1000 for k in range(1000, 1400)} | {5000: 4000, 4000: 4000}
    assert got == want


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got_of(near_groups(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_components_of_stars_write_one_table(spark, monkeypatch):
    """Each written step is an exchange; links that already go to their roots need no round, a chain of four one round."""
    import quayside.llm.components as module
    written, write = [], module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, name: written.append(name) or write(df, name))
    for links, most in (([(k, 1) for k in range(2, 90)] + [(3, 1), (5, 5)], 1), ([(2, 1), (3, 2), (4, 3)], 7)):
        written.clear()
        got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == {n: 1 for link in links for n in link if link != (5, 5)} and len(written) <= most, written
