"""Toxicity by a support vector machine over a gapped subsequence kernel with Nyström landmarks.

A text is a row of character windows, its sentences in the sense of the kernel.
The kernel of two strings adds up their common subsequences of four
characters, each weighed down by the length it spans, so an insult with gaps or
inserted characters still shares most of its weight. Landmarks are strings that
tell labelled texts apart; the machine is fitted on windows seen from the
landmarks. A decision is linear in the subsequences, so it is folded into one
table of weights by subsequence and a whole text is scored in one pass.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.rules import labelled
from quayside.llm.text import hash_sample, remainder
from quayside.session import materialise

#: About so many documents of each label, and characters in them, at most are fitted; chosen by hash.
SAMPLE_DOCS, SAMPLE_CHARS = 1500, 8_000_000
#: Landmarks of toxic texts and of others.
TELLING, PLAIN = 64, 32
#: Window length, longest span of a subsequence, weight of each spanned character.
WINDOW, SPAN, DECAY = 14, 6, 0.6
#: Rounds in which the telling windows are chosen anew.
MINED = 4
#: Share of toxic texts whose window is left out of a round, as a label may rest on something else.
UNSEEN = 0.15
SIGNS = 64
#: Entries of the table of weights; subsequences are placed in it by a hash.
TABLE = 1 << 20

#: Digits written for letters.
LIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
#: Character codes: a-z, a code for digits, other letters folded into the rest; 0 for white space, DROPPED for other signs.
DROPPED = 255
_CODE = np.full(0x250, DROPPED, np.uint8)
for _c in range(0x250):
    _s = LIKE.get(chr(_c), chr(_c))
    if _s.isalpha():
        _CODE[_c] = ord(_s) - 96 if "a" <= _s <= "z" else 28 + _c % (SIGNS - 28)
    elif _s.isdigit():
        _CODE[_c] = 27
    elif _s.isspace():
        _CODE[_c] = 0
#: The places before the last character that the other three of a subsequence take, and its weight.
_TAKEN = [(a, b, c, DECAY ** (a + 1)) for c, b, a in combinations(range(1, SPAN), 3)]


def _entry(w, x, y, z):
    """Place of a subsequence in the table."""
    return ((((w * SIGNS + x) * SIGNS + y) * SIGNS + z) * 0x9E3779B1 >> 7) & (TABLE - 1)


def codes(text: str | None) -> np.ndarray:
    """Character codes of the whole text, and some blanks behind it.

    Signs are left out and a repeated character counts once, so that what is
    strewn into a word leaves few gaps for the kernel to bridge; single letters
    parted by blanks are read as one word. Letters
    beyond the table take one of the codes of other letters by a hash; what
    repeats is told by the character, not by its code.
    """
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer((text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    far = 28 + (points.astype(np.uint64) * 0x9E3779B1 >> 12) % (SIGNS - 28)
    c = np.where(points < 0x250, _CODE[np.minimum(points, 0x24F)], far).astype(np.int64)
    points, c = points[c != DROPPED], c[c != DROPPED]
    new = c[1:] != c[:-1]
    new |= (points[1:] != points[:-1]) & (points[1:] >= 0x250)
    c = c[np.r_[True, new]]
    edge = np.r_[True, c == 0, True]
    single = ~edge[1:-1] & edge[:-2] & edge[2:]
    # a blank between two single letters goes; letters that come together by that count once if equal
    gone = np.zeros(len(c), bool)
    gone[1:-1] = (c[1:-1] == 0) & single[:-2] & single[2:]
    if gone.any():
        at = np.flatnonzero(~gone)
        again = (np.diff(at) > 1) & (c[at[1:]] == c[at[:-1]])
        c = c[at[np.r_[True, ~again]]]
    return np.r_[c, np.zeros(SPAN - 2, c.dtype)].astype(np.int64)


def gains(c: np.ndarray, table: np.ndarray) -> np.ndarray:
    """What the subsequences that end at each character add, by the table of weights."""
    n, c = len(c), c.astype(np.int64)
    padded = np.concatenate([np.zeros(SPAN - 1, np.int64), c])
    shifted = [padded[SPAN - 1 - k:SPAN - 1 - k + n] for k in range(SPAN)]  # the character k places before
    out = np.zeros(n, np.float32)
    for x, y, z, weight in _TAKEN:
        out += np.float32(weight) * table[_entry(shifted[x], shifted[y], shifted[z], c)]
    return out


def window_sums(g: np.ndarray) -> np.ndarray:
    """Sums over the windows that end at each character."""
    total = np.cumsum(g, dtype=np.float64)
    total[WINDOW:] -= total[:-WINDOW].copy()
    return total


def features(string: str) -> dict[int, float]:
    """Weight of each subsequence of a string, by its place in the table; one holds three letters at least."""
    c = [int(x) for x in codes(string)]
    out: dict[int, float] = defaultdict(float)
    for i in range(len(c)):
        for x, y, z, weight in _TAKEN:
            if i >= x:
                own = (c[i - x], c[i - y], c[i - z], c[i])
                if own.count(0) < 2:
                    out[_entry(*own)] += weight
    return out


@dataclass(frozen=True)
class KernelModel:
    """Weights by subsequence, and the logistic curve from the largest window to the score."""

    table: np.ndarray
    slope: float
    shift: float

    def score(self, text: str | None) -> float:
        c = codes(text)
        most = float(window_sums(gains(c, self.table)).max()) if len(c) else 0.0
        return float(1 / (1 + np.exp(-np.clip(self.slope * most + self.shift, -30, 30))))


def choose_landmarks(texts: list[str], y: np.ndarray) -> tuple[list[str], list[str]]:
    """Strings that tell texts with label 1, each for texts no earlier one covers, and frequent words of the others."""
    def names(text: str) -> set[str]:
        letters = {"".join(ch for ch in w if ch.isalpha()) for w in set(text.lower().split())}
        out = set()
        for w in letters:
            if len(w) >= 3 or len(w) == 2 and min(w) >= "\u0250":
                name = f" {w} "  # a longer one in strings of the window's length, each half a window on, and the last
                out.update(name[a:a + WINDOW] for a in range(0, max(len(name) - WINDOW, 0), WINDOW // 2))
                out.add(name[-WINDOW:])
        return out

    often = Counter()
    for text in texts:
        often.update(names(text))
    often = {w for w, n in often.items() if n >= 3}
    holders: dict[str, set[int]] = defaultdict(set)
    for k, text in enumerate(texts):
        for w in names(text) & often:
            holders[w].add(k)
    ones = set(np.flatnonzero(y).tolist())
    p, n = len(ones), len(y) - len(ones)
    rated = []
    for s, own in holders.items():
        a = len(own & ones)
        b = len(own) - a
        if a >= 3 and a / p > 4 * (b + 1) / (n + 1):
            share = len(own) / len(y)
            rated.append(((a / p - b / n) / np.sqrt(share * (1 - share) * (1 / p + 1 / n) + 1e-9), s))
    rated.sort(key=lambda r: (-r[0], -len(r[1]), r[1]))
    telling, covered = [], Counter()
    for _, s in rated:
        new = [k for k in holders[s] & ones if covered[k] < 2]
        if len(new) >= 2:
            telling.append(s)
            covered.update(new)
        if len(telling) == TELLING:
            break
    plain = sorted(((-len(own - ones), s) for s, own in holders.items() if not own & ones or len(own & ones) * n < 2 * p * len(own - ones)))
    return telling, [s for _, s in plain[:PLAIN]]


def svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-5) -> np.ndarray:
    """Weights and, last, shift of a linear machine with squared hinge loss, both labels in equal weight, by Newton steps."""
    z = np.c_[x, np.ones(len(x))]
    s = np.where(y == 1, 1.0, -1.0)
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    ridge = penalty * np.diag(np.r_[np.ones(x.shape[1]), 1e-3])
    w = np.zeros(z.shape[1])
    for turn in range(30):
        inside = s * (z @ w) < 1
        new = np.linalg.solve((z * (weight * inside)[:, None]).T @ z + ridge, z.T @ (weight * inside * s))
        if np.abs(new - w).max() < 1e-8:
            break
        w = 0.5 * (w + new) if turn > 15 else new
    return w


def logistic(x: np.ndarray, y: np.ndarray, odds: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with both labels smoothed; a row of label 1 stands for `odds` rows."""
    p1, p0 = (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2)
    goal = np.where(y == 1, p1, p0)
    scale = x.std() + 1e-9
    z = np.c_[(x - x.mean()) / scale, np.ones(len(x))]
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        weight = np.where(y == 1, odds, 1.0)
        h = (z * (weight * p * (1 - p) + 1e-6)[:, None]).T @ z + 1e-6 * np.eye(2)
        w -= np.linalg.solve(h, z.T @ (weight * (p - goal)))
    return float(w[0] / scale), float(w[1] - w[0] * x.mean() / scale)


def fit(texts: list[str], y: np.ndarray, odds: float = 1.0) -> KernelModel:
    """Landmarks, telling windows, machine, curve. Without texts of both labels the score is the smoothed share.

    `odds`: how many labelled texts a text of label 1 stands for, against one of label 0.
    """
    share = (odds * y.sum() + 1) / (odds * y.sum() + (1 - y).sum() + 2)
    flat = KernelModel(np.zeros(TABLE, np.float32), 0.0, float(np.log(share / (1 - share))))
    if len(set(y.tolist())) < 2:
        return flat
    telling, plain = choose_landmarks(texts, y)
    marks = [features(s) for s in [*telling, *plain]]
    marks = [m for m in marks if m]
    if not telling or not marks:
        return flat
    norm = [np.sqrt(sum(v * v for v in m.values())) for m in marks]
    places = [np.array(list(m)) for m in marks]
    weights = [np.array(list(m.values())) / n for m, n in zip(marks, norm)]

    def folded(share: np.ndarray) -> np.ndarray:
        """The table of a sum of landmarks, each with its share."""
        out = np.zeros(TABLE)
        for a, at, w in zip(share, places, weights):
            out[at] += a * w
        return out.astype(np.float32)

    kernel = np.array([[sum(v * b.get(u, 0) for u, v in a.items()) / norm[i] / norm[j] for j, b in enumerate(marks)] for i, a in enumerate(marks)])
    values, vectors = np.linalg.eigh(kernel + 1e-6 * np.eye(len(marks)))
    whiten = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-4))) @ vectors.T
    rng = np.random.default_rng(5)
    rows = [codes(t).astype(np.uint8) for t in texts]
    unit = np.eye(len(marks))
    table = folded(unit[:len(telling)].sum(0))
    others: list[np.ndarray] = []
    for _ in range(MINED):
        found: list[tuple[float, np.ndarray]] = []
        for c, label in zip(rows, y):
            if not len(c):
                continue
            sums = window_sums(gains(c, table))
            # of a toxic text its most telling window; of others, over the rounds, what looks most telling and some at random
            ends = [int(sums.argmax())] if label else [int(sums[k:k + 500].argmax()) + k for k in range(0, len(c), max(500, len(c) // 4))]
            ends += [] if label else [int(rng.integers(0, len(c)))]
            for e in ends:
                spot = c[max(0, e - WINDOW + 1 - (SPAN - 1)):e + 1]
                if label:
                    found.append((float(sums[e]), spot))
                else:
                    others.append(spot)
        found.sort(key=lambda f: -f[0])
        ones = [spot for _, spot in found[:max(1, int(len(found) * (1 - UNSEEN)))]]
        spots, labels = [*ones, *others], [1] * len(ones) + [0] * len(others)
        seen = np.zeros((len(spots), len(marks)))
        flat_rows = np.concatenate([np.r_[np.zeros(SPAN - 1, np.int64), s] for s in spots])
        ends = np.cumsum([len(s) + SPAN - 1 for s in spots])
        for k in range(len(marks)):
            total = np.r_[0, np.cumsum(gains(flat_rows, folded(unit[k])), dtype=np.float64)]
            seen[:, k] = total[ends] - total[np.maximum(ends - WINDOW, 0)]
        labels = np.array(labels)
        w = svm(seen @ whiten, labels)[:-1]
        table = folded(whiten @ w)
    most = np.array([window_sums(gains(c, table)).max() if len(c) else 0.0 for c in rows])
    slope, shift = logistic(most, y, odds)
    return KernelModel(table, max(slope, 0.0), shift)


def train(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int], name: str = "toxic") -> KernelModel:
    """Fit on a bounded number of labelled documents, whole texts, which come to the driver."""
    known = labelled(labels, name, held_out)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    length = texts.agg(F.avg(F.char_length("text")).alias("a")).first()["a"] or 1.0
    size = max(1, min(SAMPLE_DOCS, int(SAMPLE_CHARS / max(length, 1))))
    ones, zeros = known.where("y = 1"), known.where("y = 0")
    sample = materialise(hash_sample(ones, "doc_id", size).unionByName(hash_sample(zeros, "doc_id", size)), "sample")
    got = texts.join(F.broadcast(sample), "doc_id").orderBy("doc_id", "text").toPandas()  # about 2 * SAMPLE_DOCS rows at most
    taken = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    stand = {k: df.count() / max(taken.get(k, 0), 1) for k, df in ((1, ones), (0, zeros))}
    return fit([t or "" for t in got["text"]], got["y"].to_numpy(int), stand[1] / stand[0] if min(stand.values()) > 0 else 1.0)


def score(docs: DataFrame, model: KernelModel, held_out: tuple[int, int]) -> DataFrame:
    """One row per document row: doc_id, held_out, score (0 to 1), predicted (1 from 0.5).

    Null and empty texts have no window and the score of a window without
    weight. A null id counts as the empty text in the fold. Repeated rows each
    come back; further columns are ignored; an empty table gives no rows.
    """
    parts, out = held_out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [model.score(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": scores})

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return own.mapInPandas(run, "doc_id long, score double").select(
        "doc_id", (remainder(F.col("doc_id"), parts) == out).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
