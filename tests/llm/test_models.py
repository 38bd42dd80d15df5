"""Toxicity, language-model scores and page text: held-out quality, exact base figures, odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from quayside.llm import gru, pages, toxicity


def table(spark, name, sf="0.01"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")


def held(i, parts, out):
    return zlib.crc32(("" if i is None else str(i)).encode()) % parts == out


# toxicity

def test_toxicity_on_planted_words(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    bad = ["vilkop", "grubhed", "snivlex"]
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice(words) for _ in range(rng.randint(5, 80))]
        y = int(i % 3 == 0)
        if y:
            w.insert(rng.randint(0, len(w)), rng.choice(bad))
        rows.append((i, " ".join(w), 7))
        labels.append((i, y))
    odd = [(5000, None, 1), (5001, "", 1), (None, "x", 1), (5002, "calm " * 50000 + "snivlex", 1), (5002, "calm " * 50000 + "snivlex", 1),
           (5003, "you are a vil.kop here", 1), (5004, "a ssnivvlex there", 1)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, score int")
    model = toxicity.train(docs, spark.createDataFrame(labels + [(1, None)], "doc_id long, toxic int"), (5, 0))
    got = toxicity.score(docs, model, (5, 0)).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == held(r.doc_id, 5, 0) for r in got)
    by, y = {r.doc_id: r for r in got}, dict(labels)
    out = [i for i in y if held(i, 5, 0)]
    assert np.mean([by[i].predicted == y[i] for i in out]) > 0.97
    assert by[5002].predicted == by[5003].predicted == by[5004].predicted == 1 and by[5000].predicted == by[5001].predicted == 0
    assert toxicity.score(docs.limit(0), model, (5, 0)).count() == 0


def test_toxicity_of_long_words_and_other_scripts():
    """Words longer than a window, and words of letters beyond the table, are learned like others."""
    rng = random.Random(8)
    plain = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    plain += ["".join(rng.choice("абвгдежзиклмнопрст") for _ in range(rng.randint(3, 8))) for _ in range(300)]
    for bad in ("donaudampfschiffdummkopfgesicht", "хлурфыщ", "ψφξωζθχ"):
        texts, y = [], []
        for i in range(400):
            w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
            if i % 2:
                w.insert(rng.randint(0, len(w)), bad)
            texts.append(" ".join(w))
            y.append(i % 2)
        model = toxicity.fit(texts[:300], np.array(y[:300]))
        assert np.mean([(model.score(t) >= 0.5) == k for t, k in zip(texts[300:], y[300:])]) > 0.95
    assert len(set(toxicity.codes("хлурфыщ")[:7].tolist())) > 3
    assert len(toxicity.codes("ффф")) == len(toxicity.codes("ф"))


def test_single_letters_are_one_word():
    def plain(text):
        return toxicity.codes(text)[:-toxicity.SPAN + 2].tolist()

    assert plain("an i d i o t here") == plain("an idiot here")
    assert plain("a-b o o k") == plain("ab ok")
    assert plain("I am") != plain("Iam") and len(plain("a")) == 2
    rng = np.random.default_rng(3)
    vocab = ["".join(rng.choice(list("abcdefghijklmnoprstu"), rng.integers(3, 9))) for _ in range(400)]
    bad = ["vilkop", "grunzer", "stinkdorn"]

    def text(word=None):
        words = rng.choice(vocab, 40).tolist()
        return " ".join([*words[:20], *([word] if word else []), *words[20:]])

    y = np.array([1, 0, 0] * 80)
    model = toxicity.fit([text(bad[i // 3 % 3] if one else None) for i, one in enumerate(y)], y)
    assert np.mean([model.score(text(" ".join(bad[k % 3]))) >= 0.5 for k in range(60)]) >= 0.9
    assert np.mean([model.score(text()) >= 0.5 for _ in range(100)]) <= 0.02


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"), (5, 0))
    assert {r.score for r in toxicity.score(docs, model, (5, 0)).collect()} == {0.5}


def test_kernel_table_is_the_kernel():
    """The folded table gives the same sum as common subsequences counted one by one."""
    marks = toxicity.features(" abcde ")
    t = np.zeros(toxicity.TABLE, np.float32)
    for k, v in marks.items():
        t[k] = v
    c = toxicity.codes("xx abxcde yy")
    want = sum(w * t[toxicity._entry(*(int(c[i - k]) if i >= k else 0 for k in (x, y, z)), int(c[i]))]
               for i in range(len(c)) for x, y, z, w in toxicity._TAKEN)
    assert abs(toxicity.gains(c, t).sum() - want) < 1e-5 and want > 0


# language-model scores

def words(t):
    return [*(w.decode() for w in (t or "").encode().lower().split()), None]


def test_scores(spark):
    docs = table(spark, "documents").select("doc_id", "text").unionByName(spark.createDataFrame(
        [(-1, None), (-1, None), (None, ""), (-2, "never seen words here zzzz"), (-3, "long text " * 30000)], "doc_id long, text string"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    c = Counter()
    for i, t in rows:
        if not held(i, 10, 0):
            c.update(words(t))
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), held(i, 10, 0), len(words(t)), sum(c[w] > 0 for w in words(t)), n,
                   round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)), 4)) for i, t in rows)
    out = gru.score(docs, (10, 0)).collect()
    got = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(a[5] - b[5]) < 1e-3 for a, b in zip(got, want))
    own = [r for r in out if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in own) > sum(r.base_score for r in own)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert gru.score(docs.limit(0), (10, 0)).count() == 0


def small_model(seed=0):
    return gru.start_weights(np.array([50.0, 30, 20, 10, 5, 5, 3, 2, 1, 1]), np.random.default_rng(seed))


def test_probabilities_sum_to_one():
    m = small_model()
    state = np.random.default_rng(1).normal(size=(3, gru.HIDDEN)).astype(np.float32)
    total = sum(np.exp(gru.log_probabilities(m, state, np.full(3, w))) for w in range(10))
    assert np.allclose(total, 1, atol=1e-5)


def test_weights_hold_no_padding():
    """Each word has a row of its own and nothing beside it, so that an update costs what the words need."""
    m = gru.start_weights(1e6 / np.arange(1, 301) ** 1.2, np.random.default_rng(3))
    assert len(set(m.last)) > 3 and m.last.sum() == 300
    assert m.to_word.size == 300 * gru.HIDDEN and m.word_bias.size == 300
    assert sorted(m.first[m.of] + m.at) == list(range(300))
    total = sum(np.exp(gru.log_probabilities(m, np.ones((1, gru.HIDDEN), np.float32), np.array([w]))[0]) for w in range(300))
    assert abs(total - 1) < 1e-4


def test_state_is_carried_through_the_whole_text():
    """Texts scored together in lanes, over many windows, equal each text scored step by step."""
    m, rng = small_model(2), np.random.default_rng(3)
    texts = [np.r_[rng.integers(1, 10, n), 0].astype(np.int32) for n in (0, 1, 5, 31, 32, 33, 200, 3, 97)]
    got = gru.score_texts(m, texts)
    for text, score in zip(texts, got):
        h, before, total = np.zeros((1, gru.HIDDEN), np.float32), 0, 0.0
        for w in text:
            h = gru.step(m, m.table()[[before]], h)
            total += gru.log_probabilities(m, h, np.array([w]))[0]
            before = w
        assert abs(total - score) < 1e-3


def test_gradients():
    m, rng = small_model(4), np.random.default_rng(5)
    for name in ("embed", "inner", "bias", "to_class", "class_bias", "to_word", "word_bias"):
        setattr(m, name, getattr(m, name).astype(np.float64))
    x, y, h = rng.integers(0, 10, (6, 3)), rng.integers(0, 10, (6, 3)), rng.normal(size=(3, gru.HIDDEN))
    _, g, _ = gru.gradients(m, x, y, h)
    for name in g:
        w = getattr(m, name)
        at = np.unravel_index(np.abs(g[name]).argmax(), w.shape)
        keep, step = w[at], 1e-5
        w[at] = keep + step
        up = gru.gradients(m, x, y, h)[0]
        w[at] = keep - step
        down = gru.gradients(m, x, y, h)[0]
        w[at] = keep
        assert abs((up - down) / (2 * step) / y.size - g[name][at]) < 1e-5


def test_every_training_token_is_learned(spark, monkeypatch):
    """Texts behind a very long one with a low id teach as well, and each pass takes every token once, in several tasks."""
    rng = random.Random(6)
    ring = "alpha beta gamma delta epsilon zeta eta theta".split()
    long = " ".join(rng.choice("abcdefghijklmnopqrst") for _ in range(450_000))
    first = next(i for i in range(100) if not held(i, 10, 0))
    rows = [(first, long), *[(i, " ".join(ring * 25)) for i in range(1000, 1500)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = [r for r in gru.score(docs, (10, 0)).collect() if r.held_out]
    assert len(out) > 20 and all(r.score > 0.8 * r.base_score for r in out)

    monkeypatch.setattr(gru, "SHARD_TOKENS", 1500)
    texts = [np.r_[np.arange(1 + i % 7, 9 + i % 60), 0].astype("<u2") for i in range(300)]
    n = sum(map(len, texts))
    ids = spark.createDataFrame([(i, t.tobytes()) for i, t in enumerate(texts)], "doc_id long, ids binary")
    start = gru.start_weights(np.bincount(np.concatenate(texts)).astype(float), np.random.default_rng(7))
    model, learned = gru.fit(ids, start, n)
    assert learned == n and n > 5 * gru.SHARD_TOKENS
    plain = [t.astype(np.int32) for t in texts]
    assert gru.score_texts(model, plain).sum() > gru.score_texts(start, plain).sum()
    again, _ = gru.fit(ids.repartition(3, "ids"), start, n)
    assert all((getattr(again, name) == getattr(model, name)).all() for name in gru.FITTED)
    assert gru.fit(ids.limit(0), start, 0) == (start, 0)


def test_end_is_held_below_the_threshold(spark, monkeypatch):
    """With few held words, or more words at the top count than are held, the end keeps its own count."""
    rows = [(i, " ".join(["aa bb cc dd ee ff"] * 5 + [f"w{i}"])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    c = Counter()
    for i, t in rows:
        if not held(i, 10, 0):
            c.update(words(t))
    n, v = sum(c.values()), len(c)
    scores = []
    for size in (3, 6, 100_000):
        monkeypatch.setattr(gru, "HELD", size)
        got = {r.doc_id: r for r in gru.score(docs, (10, 0)).collect()}
        for i, t in rows:
            want = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t))
            assert got[i].n_known == sum(c[w] > 0 for w in words(t)) and abs(got[i].base_score - want) < 1e-6
        scores.append(sum(r.score for r in got.values()))
    assert all(math.isfinite(x) for x in scores)


# pages

def test_marginals_equal_enumeration():
    rng = np.random.default_rng(6)
    parents, n = [-1, 0, 0, 1, 1, 2], 6
    unary, edges = rng.normal(size=n), rng.normal(size=(n, 2, 2))
    mass, total = np.zeros(n), 0.0
    for bits in range(2**n):
        y = [(bits >> k) & 1 for k in range(n)]
        w = math.exp(sum(unary[k] * y[k] for k in range(n)) + sum(edges[k, y[parents[k]], y[k]] for k in range(1, n)))
        total += w
        mass += w * np.array(y)
    got, _, norm = pages.marginals(parents, unary, edges)
    assert np.allclose(got, mass / total) and abs(norm - math.log(total)) < 1e-9


def test_pages(spark):
    docs = table(spark, "pages")
    model = pages.train(docs)
    got = {r.page_id: r for r in pages.main_text(docs, model).collect()}
    good = 0
    import html
    for r in docs.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        good += got[r.page_id].text == "\n".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    assert good >= 0.99 * len(got)
    names = sorted({w for r in got.values() for w in r.text.split()[:20]})
    rng, exact = random.Random(77), 0
    for _ in range(100):
        page = pages.laid_out(names, rng)
        nodes = pages.parse(page)
        want = "\n".join(t for _, t in sorted((p, t) for x in nodes if x.mark == "1" for p, t in zip(x.places, x.own)))
        exact += model.text(re.sub(' y="[01]"', "", page)) == want
    assert exact >= 90
    odd = spark.createDataFrame(
        [(1, "u", None, 1), (1, "u", None, 1), (None, None, "", 2), (2, "v", "no tags &amp; one\n line", 3), (3, "w", "<p" * 20000, 4),
         (4, "x", "<div>" * 3000 + "deep" + "</div>" * 3000, 5), (5, "y", "<article><h1>A</h1><p>" + "word, word. " * 50000 + "</article>", 6)],
        "page_id long, url string, html string, n_chars int")
    out = pages.main_text(odd, model).collect()
    assert len(out) == 7
    by = {r.page_id: r for r in out}
    assert by[1].text == "" and by[None].text == "" and by[5].n_chars > 500000
    assert pages.main_text(odd.limit(0), model).count() == 0


def test_parse():
    nodes = pages.parse("<article><p><b>one\n two<br><p>three &lt;x&gt; <script>var t='</p>';</script>four<!-- <p>no --></article>")
    assert [t for n in nodes for t in n.own] == ["one two", "three <x> four"]
    nodes = pages.parse("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e</table>tail")
    assert [t for _, t in sorted((p, t) for n in nodes for p, t in zip(n.places, n.own))] == ["a", "b", "c", "d", "e", "tail"]


def test_formulas_objects_and_hidden_text_stay(spark):
    """What an article holds is its text, whatever its markup; a drawing without an end takes nothing along."""
    table_ = table(spark, "pages")
    model = pages.train(table_)
    article = lambda inner: f"<html><body><nav><ul><li><a href='#'>Home page</a></li></ul></nav><article><h1>Some heading here</h1><p>First words of the text, as they are.</p>{inner}<p>Last words of the text, as they are.</p></article><footer>Imprint</footer></body></html>"
    cases = {
        "<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be given, as said.</p>": "Let x=2 be given, as said.",
        "<p>See <object data='a.bin'>the fallback text</object> here, please.</p>": "See the fallback text here, please.",
        "<p>A drawing <svg><path d='M0'/><text>no</text></svg> closed, as it should.</p>": "A drawing closed, as it should.",
        "<p>A drawing <svg><path d='M0'/> open</p><p>It goes on from there, as it should.</p>": "A drawing\nIt goes on from there, as it should.",
        "<p>Some <canvas>no</p><p>More words follow, as they should.</p>": "Some\nMore words follow, as they should.",
        "<p hidden>Hidden words are words, as all others.</p>": "Hidden words are words, as all others.",
        "<p aria-hidden='true'>Hidden words are words, as all others.</p>": "Hidden words are words, as all others.",
        "<div style='display: none'><p>Hidden words are words, as all others.</p></div>": "Hidden words are words, as all others.",
    }
    for inner, text in cases.items():
        assert model.text(article(inner)) == f"Some heading here\nFirst words of the text, as they are.\n{text}\nLast words of the text, as they are.", inner
