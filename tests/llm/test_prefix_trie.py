"""The prefix trie against a dictionary of all prefixes, over one part and over many."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quayside.llm import prefix_trie
from quayside.llm.prefix_trie import least, minima, prefix_trie as trie, reach_left, reach_right

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mark(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, mark(role or "", text or ""), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + v[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in m if len(built[c]) == len(node))
        out.append((m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(kids[node]), leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, key string")


def got(spark, rows):
    return sorted([tuple(r) for r in trie(frame(spark, rows)).collect()], key=repr)


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(n * 2), n):
        for turn in range(rng.choice([1, 1, 2, 3, 6, 12])):
            rows.append((c, turn, rng.choice("ua"), rng.choice(["a b", "a", "c d e f"]) if turn < 4 else f"own {rng.random()}"))
    rng.shuffle(rows)
    return rows


ODD = [
    (1, 0, "user", "hi there"), (1, 0, "user", "hi there"), (1, None, None, None), (2, 0, "user", ""), (3, 0, "user", "a\tb c"),
    (None, 1, "user", "lost"), (40, 0, "user", "only"), (45, 0, "user", "only"), (45, 1, "user", "Zwei Wörter " * 20000),
    (-5, 0, "u", "below"), (0, 0, "u", "below"), (10**15, 2, "u", "late"), (10**15, 1, "u", "early"),
]


@pytest.mark.parametrize("size", [16_000, 7, 1])
def test_equals_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(prefix_trie, "PART_TURNS", size)
    monkeypatch.setattr(prefix_trie, "MAX_PARTS", 40)
    for rows in (ODD, random_rows(120, 5)):
        want = brute([r for r in rows if r[0] != -5])
        assert got(spark, [r for r in rows if r[0] != -5]) == want
    assert got(spark, []) == []


def test_negative_ids_borrow_towards_zero(spark):
    (root,) = [r for r in got(spark, [(-5, 0, "u", "below"), (0, 0, "u", "top")]) if r[1] == 0]
    assert root[:5] == (-5, 0, None, 2, 1) if zlib.crc32(b"-5") % 4 else 2


def test_hot_conversation_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART_TURNS", 50)
    monkeypatch.setattr(prefix_trie, "SLICE", 64)
    rows = [(c, t, "u", f"same {t}" if c % 3 else f"own {c} {t}") for c in range(400) for t in range(4)]
    rows += [(1000, t, "u", f"same {t}") for t in range(300)]
    assert got(spark, rows) == brute(rows)


def test_searches_equal_scans():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 17, 64):
        values = rng.integers(-1, 4, n)
        values[0] = -1
        table = minima(values)
        at, depth = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(4)))
        left, right = reach_left(table, at, depth), reach_right(table, at, depth)
        for a, d, l, r in zip(at, depth, left, right):
            while a and values[a] >= d:
                a -= 1
            b = a
            while b + 1 < n and values[b + 1] >= d:
                b += 1
            assert (l, r) == (a, b)
        assert (least(table, left, right) == [values[a:b + 1].min() for a, b in zip(left, right)]).all()
