"""Quality rules: fixed counts of a text, and boosted trees over its statistics.

Trees are grown on histograms of the statistics of a bounded labelled sample.
Chosen statistics are monotonic: more symbols, copied lines or repeated words
never raise a score. The fitted trees are flattened into arrays of nodes, and a
batch of texts walks all trees at once, one level a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.rules import labelled
from quayside.llm.text import hash_sample, texts

#: Signs counted as symbols, words of a window, fewest words, share of repeated words in percent.
SYMBOLS = b"#*$%&|<>"
WINDOW, FEWEST, MOST_REPEATED = 8, 20, 30
SPACES = b" \t\n\r\x0b\x0c"

#: About so many labelled rows at most are fitted, chosen by hash of their id.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, LEAST_LEAF, RIDGE = 60, 4, 48, 0.2, 10, 1.0

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics of the trees; -1 marks those that may only lower a score as they grow.
MONOTONIC = {
    "words_log": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeated": -1, "marks": -1, "stops": 0, "commas": 0,
    "digits": 0, "capitals": 0, "blanks": 0, "line_words": 0, "unlike_words": 0, "frequent_word": 0, "entropy": 0,
}
NAMES = list(MONOTONIC)


def repeated_words(ids: np.ndarray) -> int:
    """Words inside windows of eight that are found twice or more.

    Windows are compared by a 64-bit sum first; only where two sums agree are
    they named exactly, by doubling the names of windows of 1, 2 and 4 words.
    """
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            total = total * np.uint64(0x9E3779B97F4A7C15) + (ids[k:k + n].astype(np.uint64) + np.uint64(1))
    total.sort()
    if not (total[1:] == total[:-1]).any():
        return 0
    names, size = ids.astype(np.int64), 1
    while size < WINDOW:
        pairs = names[:-size] * (int(names.max()) + 1) + names[size:]
        names, size = np.unique(pairs, return_inverse=True)[1], size * 2
    found = np.flatnonzero(np.bincount(names)[names] > 1)
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, found, 1)
    np.add.at(edges, found + WINDOW, -1)
    return int((edges.cumsum() > 0).sum())


def _among(signs: bytes) -> np.ndarray:
    return np.frombuffer(signs, np.uint8).astype(int)


_SPACES, _SYMBOLS = _among(SPACES), _among(SYMBOLS)


def measure(text: bytes) -> tuple[list[int], list[float]]:
    """The five counts of a UTF-8 text and the statistics of the trees; all 0 for a text without words."""
    words = text.split()  # of bytes: at the six ASCII spaces, nothing else
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    signs = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    n, points = len(words), int(len(text) - signs[0x80:0xC0].sum())
    word_chars, symbols = points - int(signs[_SPACES].sum()), int(signs[_SYMBOLS].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines, repeated = len(lines) - len(set(lines)), repeated_words(ids)
    counts = [n, word_chars, symbols, dup_lines, repeated]
    if not n:
        return counts, [0.0] * len(NAMES)
    share = signs[signs > 0] / len(text)
    return counts, [
        float(np.log1p(n)), min(word_chars / n, 100.0), symbols / points, dup_lines / len(lines), repeated / n,
        int(signs[33] + signs[63]) / n, int(signs[46]) / n, int(signs[44]) / n, int(signs[48:58].sum()) / points,
        int(signs[65:91].sum()) / points, int(signs[32]) / points, min(n / len(lines), 1000.0), len(seen) / n,
        int(np.bincount(ids).max()) / n, float(-(share * np.log2(share)).sum()),
    ]


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays of nodes; a leaf is its own child on both sides."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    edge: np.ndarray
    low: np.ndarray
    high: np.ndarray
    value: np.ndarray

    def total(self, x: np.ndarray) -> np.ndarray:
        """Sum of all trees for each row: they step down together."""
        if not len(self.roots) or not len(x):
            return np.full(len(x), self.start)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = np.where(x[rows, self.feature[at]] <= self.edge[at], self.low[at], self.high[at])
        return self.start + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1 for each row."""
        return 1 / (1 + np.exp(-np.clip(self.total(x), -30, 30)))


def weight(grad: float, hess: float, least: float, most: float) -> float:
    return float(np.clip(-grad / (hess + RIDGE), least, most))


def best_split(binned, grad, hess, cuts, least, most):
    """(gain, statistic, bin, weight of the low side, of the high side), or None; splits against the direction don't count."""
    g, h, best = grad.sum(), hess.sum(), None
    own = weight(g, h, least, most)
    before = g * own + 0.5 * (h + RIDGE) * own**2
    for at, (name, sign) in enumerate(MONOTONIC.items()):
        if not len(cuts[at]):
            continue
        size = len(cuts[at]) + 1
        n = np.bincount(binned[:, at], minlength=size).cumsum()[:-1]
        gl = np.bincount(binned[:, at], grad, size).cumsum()[:-1]
        hl = np.bincount(binned[:, at], hess, size).cumsum()[:-1]
        wl = np.clip(-gl / (hl + RIDGE), least, most)
        wr = np.clip(-(g - gl) / (h - hl + RIDGE), least, most)
        loss = gl * wl + 0.5 * (hl + RIDGE) * wl**2 + (g - gl) * wr + 0.5 * (h - hl + RIDGE) * wr**2
        gain = before - loss
        gain[(n < LEAST_LEAF) | (len(grad) - n < LEAST_LEAF) | ((wr - wl) * sign < 0)] = -1
        k = int(gain.argmax())
        if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
            best = gain[k], at, k, float(wl[k]), float(wr[k])
    return best


def grow(nodes: list, binned, grad, hess, cuts, rows, depth, least, most) -> int:
    """Append the tree over `rows` to `nodes` and return its root's number.

    The weights of a node stay within [least, most]. Below a split on a
    monotonic statistic both sides keep to their side of the middle between
    their weights, so deeper splits can't turn the direction.
    """
    here = len(nodes)
    nodes.append((0, 0.0, here, here, RATE * weight(grad[rows].sum(), hess[rows].sum(), least, most)))
    split = best_split(binned[rows], grad[rows], hess[rows], cuts, least, most) if depth else None
    if split:
        _, at, k, wl, wr = split
        sign, middle = MONOTONIC[NAMES[at]], (wl + wr) / 2
        bounds = ((least, most), (least, most)) if not sign else ((least, middle), (middle, most)) if sign > 0 else ((middle, most), (least, middle))
        low = binned[rows, at] <= k
        sides = [grow(nodes, binned, grad, hess, cuts, r, depth - 1, *b) for r, b in zip((rows[low], rows[~low]), bounds)]
        nodes[here] = (at, float(cuts[at][k]), *sides, 0.0)
    return here


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees with logistic loss. Without rows of both labels the score is the smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    start, nodes, roots = float(np.log(share / (1 - share))), [], []
    if len(set(y.tolist())) == 2:
        cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], 1)
        f = np.full(len(y), start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree: list = []
            grow(tree, binned, p - y, p * (1 - p), cuts, np.arange(len(y)), DEPTH, -np.inf, np.inf)
            offset = len(nodes)
            roots.append(offset)
            nodes += [(a, e, lo + offset, hi + offset, v) for a, e, lo, hi, v in tree]
            f += flat(0.0, tree, [0]).total(x)
    return flat(start, nodes, roots)


def flat(start: float, nodes: list, roots: list) -> Forest:
    feature, edge, low, high, value = (np.array(c) for c in zip(*nodes)) if nodes else (np.zeros(0, int),) * 5
    return Forest(start, np.array(roots, int), feature, edge, low, high, value)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for b in batches:
        rows = [measure(t) for t in b.column("text").cast(pa.binary()).to_pylist()]
        if rows:
            yield b.column("doc_id"), np.array([c for c, _ in rows], np.int64), np.array([s for _, s in rows], float)


def _narrow(docs: DataFrame) -> DataFrame:
    own = texts(docs)
    return own.select(own["doc_id"].cast("long").alias("doc_id"), own["text"].cast("string").alias("text"))


def train(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (1, 1), name: str = "quality") -> Forest:
    """Fit on about SAMPLE labelled documents at most; only their statistics come to the driver.

    `held_out` names a fold (modulus, remainder of the id's crc32) that is not
    learned from; by default there is none.
    """
    sample = hash_sample(labelled(labels, name, held_out), "doc_id", SAMPLE)

    def run(batches):
        for ids, _, stats in _measured(batches):
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(stats[:, k]) for k in range(len(NAMES)))], ["doc_id", *NAMES])

    own = _narrow(docs)
    # at most about SAMPLE rows of two numbers, so the documents need not move
    rows = own.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi").mapInArrow(
        run, "doc_id long, " + ", ".join(f"{n} double" for n in NAMES))
    got = rows.join(F.broadcast(sample), "doc_id").orderBy("doc_id", *NAMES).toPandas()
    return fit(got[NAMES].to_numpy(float), got["y"].to_numpy(int))


def judge(docs: DataFrame, model: Forest) -> DataFrame:
    """One row per document row: doc_id, the five counts, base_failed, kept, score.

    kept is false where the counts fail (fewer than 20 words, or over 30 % of
    the words inside repeated windows), else whether the score is at least 0.5.
    Null and empty texts have no words, so they fail; null ids and repeated
    rows come back as they are; further columns are ignored; an empty table
    gives no rows.
    """

    def run(batches):
        for ids, counts, stats in _measured(batches):
            failed = (counts[:, 0] < FEWEST) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
            score = model.score(stats)
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(counts[:, k]) for k in range(len(BASE))), pa.array(failed), pa.array(~failed & (score >= 0.5)), pa.array(score)],
                ["doc_id", *BASE, "base_failed", "kept", "score"])

    return _narrow(docs).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{n} long" for n in BASE) + ", base_failed boolean, kept boolean, score double")
