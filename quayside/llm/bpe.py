"""BPE encoding and decoding with a word-end vocabulary file.

`encode_decode` runs in batches on the executors. Each worker reads the
vocabulary file once and keeps what it learnt of words in a bounded table, so
a frequent word is merged once per worker and a text costs one lookup a word.
Letters are those of this Python's Unicode tables; a letter added to Unicode
later is not lower-cased.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import DataFrame

from quayside.llm.text import texts

#: What the vocabulary's own definition calls white space, and its word pattern.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = re.compile(f"[{SPACES}]+")
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+")
#: Words kept per worker; the table is emptied when full, which costs time and changes nothing else.
KEPT_WORDS = 300_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else 256 and up in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Merge neighbours by lowest rank, leftmost first among equals.

    The symbols form a doubly linked list; the queue holds (rank, left place,
    left, right) and an entry is stale when either symbol has changed since.
    """
    if len(symbols) < 2:
        return symbols
    live: list[str | None] = list(symbols)
    end = len(live)
    before, after = list(range(-1, end - 1)), list(range(1, end + 1))
    queue = []
    for i in range(end - 1):
        rank = ranks.get((live[i], live[i + 1]))
        if rank is not None:
            queue.append((rank, i, live[i], live[i + 1]))
    heapify(queue)
    while queue:
        _, i, left, right = heappop(queue)
        j = after[i]
        if live[i] != left or j >= end or live[j] != right:
            continue
        live[i], live[j] = left + right, None
        after[i] = after[j]
        if after[j] < end:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < end:
                rank = ranks.get((live[a], live[b]))
                if rank is not None:
                    heappush(queue, (rank, a, live[a], live[b]))
    return [s for s in live if s is not None]


class WordBpe:
    """A vocabulary with merges and a word-end mark, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.letters = byte_letters()
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.numbers = {i: str(i) for i in self.tokens}
        self.written: dict[str, tuple[int, ...]] = {}

    def word(self, word: str) -> list[int]:
        """Ids of one word; symbols without an id are left out, as the vocabulary has no unknown token."""
        symbols = [self.letters[b] for b in word.encode("utf-8")]
        symbols[-1] += self.end
        return [self.ids[s] for s in merge(symbols, self.ranks) if s in self.ids]

    def pieces(self, text: str) -> Iterator[tuple[str, bool]]:
        """Words of the text in order and the special tokens written in it, which are marked True."""
        parts = self.split_special.split(text) if self.split_special else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield part, True
            elif part:
                # The lower case of a single letter never depends on its neighbours, so a capital sigma is set first.
                plain = BLANK.sub(" ", unicodedata.normalize("NFC", part)).replace("Σ", "σ").lower()
                for w in PIECE.findall(plain):
                    yield w, False

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for w, special in self.pieces(text):
            out += [self.special[w]] if special else self.word(w)
        return out

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings of the ids, joined by one space."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)

    def row(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, the ids joined by one space, the decoded text."""
        ids: list[int] = []
        written = self.written
        for w, special in self.pieces(text):
            got = written.get(w) if not special else (self.special[w],)
            if got is None:
                if len(written) >= KEPT_WORDS:
                    written.clear()
                # the numbers are those of the vocabulary, so an entry holds no strings of its own but the word
                got = written[w] = tuple(self.word(w))
            ids += got
        return len(ids), " ".join(map(self.numbers.__getitem__, ids)), self.decode(ids)


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode_decode(docs: DataFrame, path: str, with_text: bool = False) -> DataFrame:
    """Encode every whole text and decode it again.

    One row per document: doc_id, n_tokens, ids_sha256 (of the decimal ids
    joined by one space), decoded_sha256; with `with_text` also token_ids
    (array<int>) and decoded. Null and empty texts have no tokens and the hash
    of the empty string; repeated rows and null ids are kept as they are. The
    vocabulary file must be readable on every executor under `path`.
    """
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_text:
        fields += ", token_ids array<int>, decoded string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = loaded(path)
        for batch in batches:
            rows = []
            for t in batch["text"]:
                n, ids, decoded = bpe.row(t)
                row = (n, _sha256(ids), _sha256(decoded))
                rows.append((*row, [int(x) for x in ids.split()], decoded) if with_text else row)
            out = pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")[1:]])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out

    own = texts(docs)
    return own.withColumn("doc_id", own["doc_id"].cast("long")).mapInPandas(run, fields)
