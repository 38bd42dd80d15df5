"""Language-model scores of whole documents by a gated recurrent network.

Word counts come from all training documents. The network knows the most
frequent words, in classes of about equal weight; its softmax is factored into
class and word within class. Every other word is the class of rare words, whose
share is spread by the smoothed counts. The weights are fitted on all training
documents: they are dealt to tasks by hash, each task goes through its share,
and the tasks' weights are averaged at its end. The state is carried from
window to window, so a score is the log-probability of the complete text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.text import remainder
from quayside.session import materialise

#: Words the network knows, its classes and the size of its state.
VOCABULARY, CLASSES, HIDDEN = 1024, 32, 16
#: Lanes and steps of a window; passes over all training documents; the rate at the start.
LANES, WINDOW, PASSES, RATE = 128, 32, 1, 0.025
#: Training tokens that a task goes through in a pass, about; steps of all lanes that it holds at a time.
SHARD_TOKENS, HELD_STEPS = 2_000_000, 32 * WINDOW
#: Steps of a window when scoring.
SPAN = 4 * WINDOW
#: Weights in one row of those that tasks hand on to be averaged.
SLICE = 1024
#: Most frequent words whose counts every executor holds; the counts of all others are joined.
HELD = 100_000
#: Words that a task counts before it hands the counts on.
COUNTED = 500_000
ADDED = 0.1
#: The end of a text, counted as a token. It can't be a word, as it holds a blank.
END = " "
_END = END.encode()


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words, without the end."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_counts(docs: DataFrame, held_out: tuple[int, int]) -> DataFrame:
    """word, c over all training documents, ends included; written. Tasks add up their words before they leave them."""
    parts, out = held_out
    train = docs.where(remainder(docs["doc_id"].cast("long"), parts) != out)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed() -> pa.RecordBatch:
            words = pa.array(list(own), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(own.values()), pa.int64())], ["word", "c"])

        own: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own.update(words_of(text))
                own[_END] += 1
                if len(own) > COUNTED:
                    yield handed()
                    own.clear()
        yield handed()

    counted = train.select(train["text"].cast("string").alias("text")).mapInArrow(count, "word string, c long")
    return materialise(counted.groupBy("word").agg(F.sum("c").alias("c")), "counts")


@dataclass
class Gru:
    """Weights in float32. Word k of the vocabulary has class of[k] and place at[k] in it; the last word is the rare one.

    The words of a class lie together in `to_word` and `word_bias`, from first[c] on.
    """

    embed: np.ndarray
    inner: np.ndarray
    bias: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray
    word_bias: np.ndarray
    of: np.ndarray
    at: np.ndarray
    last: np.ndarray  # last[c]: number of words in class c
    first: np.ndarray

    def table(self) -> np.ndarray:
        """What each word adds to the gates."""
        return self.embed + self.bias

    def words(self, c: int) -> slice:
        """Where the words of a class lie."""
        return slice(self.first[c], self.first[c] + self.last[c])


#: The weights that are fitted, in the order in which they are laid end to end.
FITTED = ("embed", "inner", "bias", "to_class", "class_bias", "to_word", "word_bias")


def laid_out(m: Gru) -> np.ndarray:
    return np.concatenate([getattr(m, n).reshape(-1) for n in FITTED])


def with_weights(m: Gru, values: np.ndarray) -> Gru:
    """The same words and classes with other weights, which are views of `values`."""
    ends = np.cumsum([getattr(m, n).size for n in FITTED])
    parts = np.split(values, ends[:-1])
    return replace(m, **{n: part.reshape(getattr(m, n).shape) for n, part in zip(FITTED, parts)})


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place, by the hyperbolic tangent, which can't overflow."""
    half = x.dtype.type(0.5)
    x *= half
    np.tanh(x, out=x)
    x *= half
    x += half
    return x


def start_weights(counts: np.ndarray, rng: np.random.Generator) -> Gru:
    """Classes of about equal weight, biases at the log shares, small random weights."""
    share = (counts + 0.5) / (counts + 0.5).sum()
    order = np.argsort(-share, kind="stable")
    of, at = np.zeros(len(share), np.int32), np.zeros(len(share), np.int32)
    of[order] = np.minimum((np.cumsum(share[order]) - share[order] / 2) * CLASSES, CLASSES - 1).astype(np.int32)
    of = np.unique(of, return_inverse=True)[1].astype(np.int32)
    classes = int(of.max()) + 1
    size = np.bincount(of, minlength=classes)
    for c in range(classes):
        at[of == c] = np.arange(size[c])
    mass = np.bincount(of, share, classes)
    first = np.r_[0, np.cumsum(size)[:-1]]
    place = np.argsort(first[of] + at)
    word_bias = np.log(share / mass[of]).astype(np.float32)[place]
    draw = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
    h = HIDDEN
    embed, inner, to_class = draw(len(share), 3 * h, by=0.3), draw(h, 3 * h, by=0.2), draw(h, classes, by=0.05)
    to_word = draw(classes, h, int(size.max()), by=0.05)[of[place], :, at[place]]
    return Gru(embed, inner, np.zeros(3 * h, np.float32), to_class, np.log(mass).astype(np.float32), to_word, word_bias, of, at, size, first)


def step(m: Gru, x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The new state of all lanes, from what the word adds to the gates and the state."""
    k = HIDDEN
    a = h @ m.inner
    zr = sigmoid(x[:, :2 * k] + a[:, :2 * k])
    n = zr[:, k:] * a[:, 2 * k:]
    n += x[:, 2 * k:]
    np.tanh(n, out=n)
    return n + zr[:, :k] * (h - n)


def shares(x: np.ndarray) -> np.ndarray:
    """The softmax of each row, in place. The logits of states within -1 and 1 stay far below what exp can take; the limit is for safety."""
    np.minimum(x, 60, out=x)
    np.exp(x, out=x)
    x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
    return x


def _tiny(p: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(p, 1e-30))


def log_probabilities(m: Gru, state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Natural log-probability of each word after each state, class by class."""
    of = m.of[word]
    out = _tiny(shares(state @ m.to_class + m.class_bias)[np.arange(len(word)), of])
    order = np.argsort(of, kind="stable")
    ends = np.cumsum(np.bincount(of, minlength=len(m.last)))
    for c, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends)):
        rows = order[a:b]
        if len(rows) and m.last[c] > 1:
            own = shares(state[rows] @ m.to_word[m.words(c)].T + m.word_bias[m.words(c)])
            out[rows] += _tiny(own[np.arange(len(rows)), m.at[word[rows]]])
    return out


def gradients(m: Gru, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """Loss, gradients and last state of one window (steps x lanes), truncated at its start."""
    steps, lanes = inputs.shape
    k, kind = HIDDEN, h.dtype
    # within a step the lanes come last, so that each gate is one block of memory
    x = np.ascontiguousarray(m.table()[inputs].transpose(0, 2, 1))
    a, zr, n = (np.empty((steps, size, lanes), kind) for size in (3 * k, 2 * k, k))
    states = np.empty((steps + 1, k, lanes), kind)
    states[0] = h.T
    across = np.ascontiguousarray(m.inner.T)
    for t in range(steps):
        now, gate, new, after = a[t], zr[t], n[t], states[t + 1]
        np.matmul(across, states[t], out=now)
        sigmoid(np.add(x[t, :2 * k], now[:2 * k], out=gate))
        np.multiply(gate[k:], now[2 * k:], out=new)
        new += x[t, 2 * k:]
        np.tanh(new, out=new)
        np.subtract(states[t], new, out=after)
        after *= gate[:k]
        after += new
    w, rows_of = targets.reshape(-1), np.ascontiguousarray(states.transpose(0, 2, 1))
    by_class = np.argsort(m.of[w].astype(np.uint16), kind="stable")  # rows of a class lie together; short keys are sorted by radix
    s, w = rows_of[1:].reshape(-1, k)[by_class], w[by_class]
    of, rows, ones = m.of[w], np.arange(len(w)), np.ones(len(w), kind)
    g = {name: np.zeros_like(getattr(m, name)) for name in FITTED}
    d = shares(s @ m.to_class + m.class_bias)
    loss = -_tiny(d[rows, of]).sum()
    d[rows, of] -= 1
    g["to_class"], g["class_bias"], ds = s.T @ d, ones @ d, d @ m.to_class.T
    ends = np.cumsum(np.bincount(of, minlength=len(m.last)))
    for c, (start, end) in enumerate(zip(np.r_[0, ends[:-1]], ends)):
        if start == end or m.last[c] == 1:  # a single word of its class is certain
            continue
        own, mine = m.words(c), s[start:end]
        weights = m.to_word[own]
        e, places = shares(mine @ weights.T + m.word_bias[own]), (rows[:end - start], m.at[w[start:end]])
        loss -= _tiny(e[places]).sum()
        e[places] -= 1
        g["to_word"][own], g["word_bias"][own] = e.T @ mine, ones[:end - start] @ e
        ds[start:end] += e @ weights
    outer = np.empty_like(ds)
    outer[by_class] = ds
    ds, before = np.ascontiguousarray(outer.reshape(steps, lanes, k).transpose(0, 2, 1)), states[:-1]
    z, r = zr[:, :k], zr[:, k:]
    to_n, to_z, to_r = (1 - z) * (1 - n * n), (before - n) * z * (1 - z), a[:, 2 * k:] * r * (1 - r)
    da, dn, back = np.empty((steps, 3 * k, lanes), kind), np.empty((steps, k, lanes), kind), np.zeros((k, lanes), kind)
    for t in reversed(range(steps)):
        back += ds[t]
        of_n, of_all = dn[t], da[t]
        np.multiply(back, to_n[t], out=of_n)
        np.multiply(back, to_z[t], out=of_all[:k])
        np.multiply(of_n, to_r[t], out=of_all[k:2 * k])
        np.multiply(of_n, r[t], out=of_all[2 * k:])
        back *= z[t]
        back += m.inner @ of_all
    added = da.transpose(0, 2, 1).reshape(-1, 3 * k)
    g["inner"] = rows_of[:-1].reshape(-1, k).T @ added
    added[:, 2 * k:] = dn.transpose(0, 2, 1).reshape(-1, k)  # what the words add isn't weighed by the gate
    g["bias"] = ones @ added
    order = np.argsort(inputs.astype(np.uint16), axis=None, kind="stable")
    given, starts = np.unique(inputs.reshape(-1)[order], return_index=True)
    g["embed"][given] = np.add.reduceat(added[order], starts)
    return float(loss), {name: v / len(w) for name, v in g.items()}, rows_of[-1].copy()


class Fitting:
    """Truncated backpropagation through time over a stream of tokens, with Adam; the state goes on from window to window.

    `turn`: the pass, from 0; `expected`: about how many tokens it has, by which the rate falls.
    """

    def __init__(self, start: Gru, turn: int, expected: float):
        self.weights = laid_out(start).astype(np.float32)
        self.model = with_weights(start, self.weights)
        self.first, self.second = np.zeros_like(self.weights), np.zeros_like(self.weights)
        self.turn, self.expected = turn, max(expected, 1.0)
        self.updates, self.learned = 0, 0
        self.before = 0  # word 0 is the end, which also stands before the first word
        self.waiting: list[np.ndarray] = []
        self.length = 0

    def take(self, text: np.ndarray) -> None:
        """The next text; tokens wait until all lanes are full."""
        self.waiting.append(text)
        self.length += len(text)
        full = LANES * HELD_STEPS
        if self.length >= full:
            stream = np.concatenate(self.waiting)
            for a in range(0, len(stream) - full + 1, full):
                self.learn(stream[a:a + full])
            rest = stream[len(stream) // full * full:].copy()
            self.waiting, self.length = [rest], len(rest)

    def finish(self) -> None:
        """Learn what still waits, the last few tokens in a lane of their own."""
        stream = np.concatenate([np.zeros(0, np.int32), *self.waiting])
        cut = len(stream) // LANES * LANES
        self.learn(stream[:cut])
        self.learn(stream[cut:], 1)
        self.waiting, self.length = [], 0

    def learn(self, stream: np.ndarray, lanes: int = LANES) -> None:
        if not len(stream):
            return
        grid = stream.reshape(lanes, -1).T
        given = np.r_[np.int32(self.before), stream[:-1]].reshape(lanes, -1).T
        self.before = int(stream[-1])
        h = np.zeros((lanes, HIDDEN), np.float32)
        for a in range(0, len(grid), WINDOW):
            words = grid[a:a + WINDOW]
            _, g, h = gradients(self.model, given[a:a + WINDOW], words, h)
            h = np.where((words[-1] == 0)[:, None], 0, h).astype(np.float32)
            self.learned += words.size
            self.update(np.concatenate([g[n].reshape(-1) for n in FITTED], dtype=np.float32), lanes / LANES)

    def update(self, g: np.ndarray, share: float) -> None:
        self.updates += 1
        done = (self.turn + min(1.0, self.learned / self.expected)) / PASSES
        rate = RATE * (1 - 0.9 * done) * share
        self.first += np.float32(0.1) * (g - self.first)
        self.second += np.float32(0.001) * (g * g - self.second)
        root = np.sqrt(self.second * np.float32(1 / (1 - 0.999**self.updates))) + np.float32(1e-8)
        self.weights -= np.float32(rate / (1 - 0.9**self.updates)) * self.first / root


def fit(encoded: DataFrame, start: Gru, n: int) -> tuple[Gru, int]:
    """Weights fitted on all rows of `encoded` (doc_id, ids), which hold `n` tokens; and how many were learned in the last pass.

    In each pass every task starts from the same weights and goes through the
    texts that a hash deals to it, in the order of the hash; the mean of the
    tasks' weights, each counted by its tokens, ends the pass. There is
    a task for about `SHARD_TOKENS` tokens. Only the means come to the driver.
    """
    tasks, model, learned = max(1, -(-n // SHARD_TOKENS)), start, 0
    shards = encoded.select(F.xxhash64(F.lit(17), "doc_id", "ids").alias("place"), "ids")

    for turn in range(PASSES):
        def learn(batches: Iterator[pd.DataFrame], model: Gru = model, turn: int = turn) -> Iterator[pd.DataFrame]:
            own = Fitting(model, turn, n / tasks)
            for batch in batches:
                for ids in batch["ids"]:
                    own.take(np.frombuffer(ids, "<u2").astype(np.int32))
            own.finish()
            if own.learned:
                parts = [own.weights[a:a + SLICE].tobytes() for a in range(0, len(own.weights), SLICE)]
                yield pd.DataFrame({"slice": range(len(parts)), "task": TaskContext.get().partitionId(), "tokens": own.learned, "part": parts})

        def mean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: dict[int, np.ndarray] = {}
            tokens: dict[int, int] = {}
            for batch in batches:
                for k, size, part in zip(batch["slice"], batch["tokens"], batch["part"]):
                    total[k] = total.get(k, 0) + size * np.frombuffer(part, np.float32).astype(np.float64)
                    tokens[k] = tokens.get(k, 0) + size
            yield pd.DataFrame({
                "slice": list(total), "tokens": list(tokens.values()),
                "part": [(v / tokens[k]).astype(np.float32).tobytes() for k, v in total.items()]})

        made = shards.repartition(tasks, "place").sortWithinPartitions("place", "ids").mapInPandas(
            learn, "slice int, task int, tokens long, part binary")
        got = made.repartition("slice").sortWithinPartitions("slice", "task").mapInPandas(mean, "slice int, tokens long, part binary").collect()
        if got:  # the weights once, whatever the number of tasks
            got.sort(key=lambda r: r["slice"])
            learned = got[0]["tokens"]
            model = with_weights(start, np.frombuffer(b"".join(bytes(r["part"]) for r in got), np.float32).copy())
    return model, learned


def score_texts(m: Gru, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each text. Texts are laid end to end in lanes, the state is 0 at each start."""
    total = np.zeros(len(texts))
    if not texts:
        return total
    lanes = min(256, len(texts))
    load, mine = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
    for k in sorted(range(len(texts)), key=lambda k: -len(texts[k])):  # the longest first, each to the emptiest lane
        lane = int(load.argmin())
        mine[lane].append(k)
        load[lane] += len(texts[k])
    order = np.argsort(-load, kind="stable")
    mine, load = [mine[k] for k in order], load[order]
    words = [np.concatenate([texts[k] for k in lane]) for lane in mine]
    owner = [np.repeat(np.array(lane, np.int64), [len(texts[k]) for k in lane]) for lane in mine]
    table, state = m.table(), np.zeros((lanes, HIDDEN), np.float32)
    for a in range(0, int(load[0]), SPAN):
        live = int((load > a).sum())  # lanes are in order of their length, so those still running come first
        span = min(SPAN, int(load[0]) - a)
        w, own = np.zeros((span, live), np.int32), np.full((span, live), -1, np.int64)
        before = np.zeros((span, live), np.int32)
        for j in range(live):
            part = words[j][a:a + span]
            w[:len(part), j], own[:len(part), j] = part, owner[j][a:a + span]
            earlier = words[j][max(a - 1, 0):a + span - 1] if a else np.r_[0, words[j][:span - 1]]
            before[:len(earlier), j] = earlier[:span]
        states, h = np.zeros((span, live, HIDDEN), np.float32), state[:live]
        for t in range(span):
            h = h * (before[t] != 0).astype(np.float32)[:, None]  # after an end a text starts
            h = states[t] = step(m, table[before[t]], h)
        state = h
        valid = own.reshape(-1) >= 0
        lp = log_probabilities(m, states.reshape(-1, HIDDEN)[valid], w.reshape(-1)[valid])
        total += np.bincount(own.reshape(-1)[valid], lp, len(texts))
    return total


def score(docs: DataFrame, held_out: tuple[int, int]) -> DataFrame:
    """One row per document row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null texts count as empty and have one token, the end. A null id counts as
    the empty text in the fold. Repeated rows each come back; further columns
    are ignored; an empty table gives no rows. Without training documents all
    words are unknown and the base spreads its mass over one unknown word.
    """
    parts, out = held_out
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    counts = word_counts(own, held_out)
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(sums["n"] or 0), int(sums["v"])
    below = n + ADDED * (v + 1)
    # the largest counts that HELD words have at most; a row per distinct count tells which
    least, room = float("inf"), HELD
    for r in counts.groupBy("c").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("c")).limit(HELD).collect():
        room -= r["k"]
        if room < 0:
            break
        least = r["c"]
    held = [] if least == float("inf") else counts.where(F.col("c") >= int(least)).collect()  # HELD words at most
    held = {r["word"]: r["c"] for r in sorted(held, key=lambda r: (-r["c"], r["word"]))}
    if end := counts.where(F.col("word") == END).first():  # each text has it, so it is held however many words are as frequent
        held[END] = end["c"]
    known = [END, *[w for w in held if w != END][:VOCABULARY - 2]]
    inside = np.array([held.get(w, 0) for w in known], float)
    # what the rare words share: their counts, their part of the added mass and that of the unknown word
    rare_mass = (n - inside.sum()) + ADDED * (v + 1 - sum(w in held for w in known))
    rare = len(known)
    start = start_weights(np.r_[inside, max(n - inside.sum(), 0)], np.random.default_rng(7))
    # number of each held word, the end first; behind the last number stands what holds for all other words
    index = {w.encode("utf-8"): k for k, w in enumerate([END, *[w for w in held if w != END]])}
    c_of = np.array([held.get(END, 0), *[c for w, c in held.items() if w != END]], float)
    place = np.full(len(index) + 1, rare, "<u2")
    place[:len(known)] = range(len(known))
    base_of, within = np.append(np.log10((c_of + ADDED) / below), 0.0), np.zeros(len(index) + 1)
    within[len(known):-1] = np.log10((c_of[len(known):] + ADDED) / rare_mass) if len(known) < len(index) else 0.0
    counted = np.append(c_of > 0, False)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, left, figures = [], [], []
            for text in batch.column("text").to_pylist():
                words = [*words_of(text), _END]
                at = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
                ids.append(place[at].tobytes())
                other = Counter(words[k] for k in np.flatnonzero(at < 0))
                left.append([{"word": w.decode("utf-8"), "k": k} for w, k in other.items()])
                figures.append((len(words), int(counted[at].sum()), float(base_of[at].sum()), float(within[at].sum())))
            n_tokens, n_known, base, spread = zip(*figures) if figures else ((),) * 4
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
                pa.array(base, pa.float64()), pa.array(spread, pa.float64()), pa.array(ids, pa.binary()),
                pa.array(left, pa.list_(pa.struct([("word", pa.string()), ("k", pa.int64())])))],
                ["row", "doc_id", "n_tokens", "n_known", "base", "spread", "ids", "left"])

    numbered = own.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    made = materialise(numbered.mapInArrow(
        encode, "row long, doc_id long, n_tokens long, n_known long, base double, spread double, ids binary, "
        "left array<struct<word:string,k:bigint>>"), "encoded")
    model, _ = fit(made.where(remainder(F.col("doc_id"), parts) != out), start, n)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = score_texts(model, [np.frombuffer(ids, "<u2").astype(np.int32) for ids in batch["ids"]]) / math.log(10)
            yield batch.drop(columns=["spread", "ids"]).assign(doc_id=batch["doc_id"].astype("Int64"), model=got + batch["spread"])

    scored = made.drop("left").mapInPandas(run, "row long, doc_id long, n_tokens long, n_known long, base double, model double")
    words = made.select("row", F.inline("left"))
    # a word in no training text isn't in the counts; such words and those below the held ones are rare, so no key is hot
    got = words.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    share = F.log10(F.col("c") + ADDED) * F.col("k")
    sums_left = got.groupBy("row").agg(
        F.sum(share).alias("logs"), F.sum("k").alias("k"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return scored.join(sums_left, "row", "left").select(
        "doc_id", (remainder(F.col("doc_id"), parts) == out).alias("held_out"), "n_tokens",
        (F.col("n_known") + zero("known")).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("logs") - zero("k") * math.log10(below)).alias("base_score"),
        (F.col("model") + zero("logs") - zero("k") * math.log10(rare_mass if rare_mass > 0 else 1.0)).alias("score"))
