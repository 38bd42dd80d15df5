"""Chunk recipes against a dictionary of normalised texts."""

import hashlib
import string

from quayside.llm.recipes import copies, drop_copies

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    out = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known, default=None)
        stays = False
        for i in sorted(ids, key=lambda x: (x is None, x)):
            kept = not stays and i == keep
            stays |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


LONG = " ".join(f"word{i} name" for i in range(9000))
ROWS = [
    (1, "Same text", "a"), (2, "same TEXT", "b"), (2, "same TEXT", "b"), (3, "ÄHNLICH", "c"), (4, "ähnlich", "d"),
    (5, None, "e"), (6, "", "f"), (None, "", "g"), (None, "only null", "h"), (None, "only null", "h"),
    (7, LONG, "i"), (8, LONG.upper(), "j"), (9, LONG[:-1] + "X", "k"), (10, LONG + " ", "l"), (11, "x" * 40000, "m"),
    (12, "x" * 40000, "n"), (13, "x" * 39999, "o"), (14, " ", "p"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, keep_id string")


def test_groups(spark):
    got = sorted([tuple(r) for r in copies(frame(spark)).collect()], key=repr)
    assert got == brute(ROWS)
    assert copies(frame(spark).limit(0)).count() == 0


def test_drop(spark):
    got = drop_copies(frame(spark))
    assert got.columns == ["doc_id", "text", "keep_id"]
    rows = sorted([r.doc_id for r in got.collect()], key=repr)
    want = sorted([i for i, _, _, kept, _ in brute(ROWS) if kept], key=repr)
    assert rows == want
    assert drop_copies(frame(spark).limit(0)).count() == 0


def test_hot_group(spark):
    rows = [(i, "copy " * 500 if i % 3 else f"own text {i}", "") for i in range(3000)]
    got = sorted([tuple(r) for r in copies(frame(spark, rows).repartition(16)).collect()], key=repr)
    assert got == brute(rows)
