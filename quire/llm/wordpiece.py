"""Greedy longest-match token counts by a linear automaton.

The vocabulary is a trie. Every node has a failure link and the number
of tokens that following it pops; a word is read once, character by
character, and its pieces are counted without being built.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import runs, text_buffers

GROUP_BYTES = 2 << 20
KEPT_WORDS = 300_000       # counts of words kept by a task before it starts anew


class Automaton:
    """``first`` pieces begin a word, ``rest`` continue it. A word that
    cannot be covered is one unknown token."""

    def __init__(self, first: list[str], rest: list[str], mark: str = "▁"):
        self.mark = mark
        self.next: list[dict[str, int]] = [{}]
        ends, name = {}, [""]
        for piece in [*(mark + p for p in first), *rest]:
            at = 0
            for c in piece:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    name.append(name[at] + c)
                at = self.next[at][c]
            ends[at] = True
        n = len(self.next)
        self.fail: list[int] = [-1] * n          # -1: the word cannot be covered
        self.pops: list[int] = [0] * n
        layer = [0]
        while layer:                             # by depth: links point to nodes of smaller depth
            below = []
            for u in layer:
                for c, v in self.next[u].items():
                    below.append(v)
                    if v in ends:
                        self.fail[v], self.pops[v] = 0, 1
                        continue
                    z, pops = self.fail[u], self.pops[u]
                    while z >= 0 and c not in self.next[z]:
                        pops += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.next[z][c], pops
            layer = below

    def count(self, word: str) -> int:
        """Tokens of a word; 0 of the empty word, -1 if it is unknown
        (one that holds the mark is)."""
        if not word:
            return 0
        if self.mark in word:
            return -1
        nxt, fail, pops = self.next, self.fail, self.pops
        u = tokens = 0
        for c in self.mark + word:
            while (v := nxt[u].get(c)) is None:
                if fail[u] < 0:
                    return -1
                tokens += pops[u]
                u = fail[u]
            u = v
        while u:
            if fail[u] < 0:
                return -1
            tokens += pops[u]
            u = fail[u]
        return tokens


_BUILT: dict[str, Automaton] = {}


def from_pieces(path: str) -> Automaton:
    """The automaton of a piece model's vocabulary: pieces with the
    white-space mark begin words, the others continue them."""
    if path not in _BUILT:
        from quire.llm.pieces import NORMAL, WS, PieceModel
        m = PieceModel(path)
        some = [p for p, k in zip(m.pieces, m.kinds) if k == NORMAL]
        _BUILT[path] = Automaton([p[1:] for p in some if p[0] == WS and WS not in p[1:]],
                                 [p for p in some if WS not in p])
    return _BUILT[path]


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, known = from_pieces(path), {}
        for batch in batches:
            _, off = text_buffers(batch.column(1))
            for i, j in runs(off, GROUP_BYTES):
                if len(known) > KEPT_WORDS:
                    known = {}
                words, ends = [], []
                for t in batch.column(1)[i:j]:
                    words += (t.as_py() or "").replace(auto.mark, " ").split()
                    ends.append(len(words))
                got = list(map(known.get, words))
                for w in {words[x] for x, n in enumerate(got) if n is None}:
                    known[w] = auto.count(w)
                n = np.fromiter(map(known.get, words, repeat(0)), np.int64, len(words))
                at = np.concatenate(([0], ends)).astype(np.int64)

                def per_text(x: np.ndarray) -> pa.Array:
                    return pa.array(np.diff(np.concatenate(([0], np.cumsum(x)))[at]))

                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array(np.diff(at)), per_text(np.abs(n)), per_text((n < 0).astype(np.int64))],
                    names=["doc_id", "n_words", "n_tokens", "n_unknown"])
    return run


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words (split at white space and at its mark), n_tokens (an unknown word
    is one token) and n_unknown for every row. Null and blank texts have
    zeros; repeated rows and null ids are counted like others; other
    columns are not read. The file must be readable on every executor."""
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return src.mapInArrow(_run(model_file), "doc_id long, n_words long, n_tokens long, n_unknown long")
