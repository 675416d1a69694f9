"""SentencePiece encoding and decoding with byte offsets.

A text is normalised by the longest prefix found in the model's compiled
character map; every normalised byte keeps the source byte it came from.
The normalised text is cut where no piece of the vocabulary can reach
across, each part is segmented by highest-score merges (parts are kept
by their string, so a frequent word is merged once per task), and every
piece is projected back to the byte span of the original text.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import runs, text_buffers

WS = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6   # piece types of the model file
GROUP_BYTES = 1 << 19      # text encoded at once
KEPT_PARTS = 300_000       # parts kept by a task before it starts anew
SHORT = 64                 # symbols up to which parts are merged side by side; a longer one keeps a heap
NONE = 1 << 24             # rank of a pair that is no piece


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a serialised protocol-buffer message."""
    i = 0

    def varint() -> int:
        nonlocal i
        r = s = 0
        while True:
            c = b[i]
            i += 1
            r |= (c & 127) << s
            s += 7
            if c < 128:
                return r

    while i < len(b):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {2: varint, 5: lambda: 4, 1: lambda: 8}[key & 7]()
            yield key >> 3, b[i:i + n]
            i += n


class CharMap:
    """The compiled character map: a double-array trie over UTF-8 bytes
    whose values point at NUL-terminated replacements."""

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        if blob:
            n = struct.unpack_from("<I", blob)[0]
            self.units = struct.unpack_from(f"<{n // 4}I", blob, 4)
            self.texts = blob[4 + n:]

    def longest(self, b: bytes, at: int) -> tuple[int, bytes | None]:
        """(bytes consumed, replacement) of the longest key at ``at``."""
        units, found = self.units, (0, None)
        if not units:
            return found
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        for i in range(at, len(b)):
            node ^= b[i]
            if node >= len(units) or (u := units[node]) & 0x800000FF != b[i]:
                break
            node ^= (u >> 10) << ((u & 512) >> 6)
            if u >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.texts[start:self.texts.index(0, start)]
        return found


class PieceModel:
    """A BPE piece model with byte fallback, read from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            blob = f.read()
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        trainer: dict = {}
        norm: dict = {}
        for k, v in _fields(blob):
            if k == 1:
                p = dict(_fields(v))
                self.pieces.append(p[1].decode())
                scores.append(struct.unpack("<f", p[2])[0] if 2 in p else 0.0)
                self.kinds.append(p.get(3, NORMAL))
            elif k == 2:
                trainer = dict(_fields(v))
            elif k == 3:
                norm = dict(_fields(v))
        if trainer.get(3, 1) != 2:
            raise ValueError("a BPE model is needed")
        if trainer.get(24, 0) or USER in self.kinds:
            raise ValueError("white space as suffix and user-defined pieces are not supported")
        self.map = CharMap(norm.get(2, b""))
        self.prefix = bool(norm.get(3, 1))
        self.squeeze = bool(norm.get(4, 1))
        if not norm.get(5, 1):
            raise ValueError("white space must be escaped")
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown = self.kinds.index(UNKNOWN)
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, UNUSED)}
        self.score = {p: scores[i] for p, i in self.ids.items()}
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.id_byte = {i: b for b, i in self.byte_id.items()}
        self._tables()
        # cuts: before a run of white space, if no piece has one inside, and
        # around line ends, if no longer piece has one
        many = [p for p in self.ids if len(p) > 1]
        inner = any(re.search(f"[^{WS}]{WS}", p) for p in many)
        lines = any("\n" in p for p in many)
        cut = "" if lines else r"\n"
        self.parts = None if inner else re.compile(
            rf"{cut}|{WS}+[^{WS}{cut}]*|[^{WS}{cut}]+" if cut else rf"{WS}+[^{WS}]*|[^{WS}]+")

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its bytes and its end, the
        byte of the source it came from."""
        if not self.map.units and not self.squeeze:
            if not text:
                return "", np.zeros(1, np.int64)
            out = (WS if self.prefix else "") + text.replace(" ", WS)
            raw = np.frombuffer(text.encode(), np.uint8)
            width = np.where(raw == 32, 3, 1)
            at = np.concatenate((np.zeros(3 * self.prefix, np.int64), np.repeat(np.arange(len(raw)), width), [len(raw)]))
            return out, at
        b, i, parts = text.encode(), 0, []      # (replacement, from, to)
        while i < len(b):
            n, new = self.map.longest(b, i)
            if new is None:
                n = 1 if b[i] < 128 else 2 if b[i] < 224 else 3 if b[i] < 240 else 4
                new = b[i:i + n]
            parts.append((new, i, i + n))
            i += n
        out, src = bytearray(), []
        start, end = 0, len(parts)
        if self.squeeze:                        # leading, trailing and repeated spaces go
            while start < end and parts[start][0] == b" ":
                start += 1
            while start < end and parts[end - 1][0] == b" ":
                end -= 1
        if start == end:
            return "", np.full(1, len(b), np.int64)
        ws = WS.encode()
        if self.prefix:
            out += ws
            src += [parts[start][1]] * 3
        space = self.squeeze
        for new, lo, _ in parts[start:end]:
            for c in new.decode():
                if c == " ":
                    if space and self.squeeze:
                        continue
                    out += ws
                    src += [lo] * 3
                else:
                    raw = c.encode()
                    out += raw
                    src += [lo] * len(raw)
                space = c == " "
        while self.squeeze and out.endswith(ws):
            del out[-3:], src[-3:]
        return out.decode(), np.array([*src, parts[end - 1][2]], np.int64)

    def segment(self, part: str) -> list[str]:
        """Pieces of a part: the best-scored adjacent pair is merged, the
        leftmost of equals, until no pair is a piece."""
        score = self.score
        sym = list(part)
        nxt = list(range(1, len(sym) + 1))
        prv = list(range(-1, len(sym) - 1))
        heap = [(-s, i, a + b) for i, (a, b) in enumerate(pairwise(sym)) if (s := score.get(a + b)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, text = heapq.heappop(heap)
            j = nxt[i] if sym[i] else len(sym)
            if j >= len(sym) or sym[i] + sym[j] != text:
                continue
            sym[i], sym[j] = text, ""
            nxt[i] = nxt[j]
            if nxt[j] < len(sym):
                prv[nxt[j]] = i
                if (s := score.get(both := text + sym[nxt[j]])) is not None:
                    heapq.heappush(heap, (-s, i, both))
            if prv[i] >= 0 and (s := score.get(both := sym[prv[i]] + text)) is not None:
                heapq.heappush(heap, (-s, prv[i], both))
        return [s for s in sym if s]

    def encode_part(self, part: str) -> tuple[list[int], list[int]]:
        """Ids of a part and the normalised bytes that each covers. Of the
        byte pieces of an unknown character the last covers it."""
        ids, width = [], []
        for p in self.segment(part):
            raw = p.encode()
            if (i := self.ids.get(p)) is not None:
                ids.append(i), width.append(len(raw))
            elif self.byte_fallback:
                ids += [self.byte_id[b] for b in raw]
                width += [0] * (len(raw) - 1) + [len(raw)]
            else:
                ids.append(self.unknown), width.append(len(raw))
        return ids, width

    def _tables(self) -> None:
        """Flat tables of the vocabulary: symbol numbers (a piece's id; a
        character that is no piece but occurs in one follows), the pairs
        that merge as an open-addressed hash table, and the pieces' bytes."""
        sym = dict(self.ids)
        for p in self.ids:
            for c in p:
                sym.setdefault(c, len(self.pieces) + len(sym))
        order = {p: r for r, p in enumerate(sorted(self.ids, key=lambda p: (-self.score[p], self.ids[p])))}
        rank, last = {}, None
        for p, r in order.items():           # pieces of equal score share a rank
            last = r if last is None or self.score[p] != last_score else last
            rank[p], last_score = last, self.score[p]
        pairs = [(sym[p[:i]], sym[p[i:]], self.ids[p], rank[p]) for p in self.ids for i in range(1, len(p))
                 if p[:i] in sym and p[i:] in sym]
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot_key = np.full(1 << bits, -1, np.int64)
        self.slot_id, self.slot_rank = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        for left, right, i, r in pairs:
            key = left << 24 | right
            h = int(self._hash(np.array([key]))[0])
            while self.slot_key[h] >= 0:
                h = (h + 1) & ((1 << bits) - 1)
            self.slot_key[h], self.slot_id[h], self.slot_rank[h] = key, i, r
        self.char_sym = np.full(0x110000, -1, np.int32)
        for p, i in sym.items():
            if len(p) == 1:
                self.char_sym[ord(p)] = i
        shown = [(bytes([self.id_byte[i]]) if i in self.id_byte else " ⁇ ".encode() if k == UNKNOWN
                  else b"" if k == CONTROL else p.replace(WS, " ").encode())
                 for i, (p, k) in enumerate(zip(self.pieces, self.kinds))]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_len = np.array([len(x) for x in shown], np.int64)
        self.shown_at = np.cumsum(self.shown_len) - self.shown_len
        self.piece_width = np.array([len(p.encode()) for p in self.pieces], np.int64)

    def _hash(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, merged id) of symbol pairs; rank NONE if they do not merge."""
        key = left.astype(np.int64) << 24 | right
        key[(left < 0) | (right < 0)] = -2
        h = self._hash(key)
        rank, to = np.full(len(key), NONE, np.int64), np.zeros(len(key), np.int32)
        todo = np.arange(len(key))
        while len(todo):
            there = self.slot_key[h[todo]]
            hit = there == key[todo]
            at = todo[hit]
            rank[at], to[at] = self.slot_rank[h[at]], self.slot_id[h[at]]
            todo = todo[~hit & (there >= 0)]
            h[todo] = (h[todo] + 1) & (len(self.slot_key) - 1)
        return rank, to

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and widths (flat) and their number for each part. All parts
        are merged side by side: one merge in each part a round."""
        size = np.array([len(p) for p in parts], np.int64)
        code = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        sym = self.char_sym[code].copy()
        own = np.repeat(np.arange(len(parts)), size)
        start = np.cumsum(size) - size
        at = np.arange(len(sym)) - start[own]                      # place in the part, kept by merges
        done_sym, done_own, done_at = [], [], []
        rank, to = self._ranks(sym, own)
        while len(sym):
            head = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            order = (rank << 31) | at
            best = np.minimum.reduceat(order, head)
            best = np.repeat(best, np.diff(np.append(head, len(sym))))
            live = best < (NONE << 31)
            done_sym.append(sym[~live]), done_own.append(own[~live]), done_at.append(at[~live])
            hit = live & (order == best)
            where = np.flatnonzero(hit)
            sym[where] = to[where]
            keep = live.copy()
            keep[where + 1] = False
            moved = np.zeros(len(sym), bool)
            moved[where] = True
            sym, own, at, rank, to, moved = (x[keep] for x in (sym, own, at, rank, to, moved))
            m = np.flatnonzero(moved)
            moved[m[m > 0] - 1] = True
            near = np.flatnonzero(moved)
            near_next = near[near + 1 < len(sym)]
            rank[near] = NONE
            same = near_next[own[near_next] == own[near_next + 1]]
            rank[same], to[same] = self._pairs(sym[same], sym[same + 1])
        sym, own, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_sym, done_own, done_at))
        order = np.argsort(own * (1 << 31) + at, kind="stable")
        sym, own, at = sym[order], own[order], at[order]
        known = (sym >= 0) & (sym < len(self.pieces))
        char = code[start[own] + at].astype(np.int64) if len(sym) else np.zeros(0, np.int64)
        width = np.where(known, self.piece_width[np.where(known, sym, 0)],
                         1 + (char > 0x7F) + (char > 0x7FF) + (char > 0xFFFF))
        if self.byte_fallback:
            many = np.where(known, 1, width)
        else:
            many, sym = np.ones(len(sym), np.int64), np.where(known, sym, self.unknown)
            known = np.ones(len(sym), bool)
        first = np.cumsum(many) - many
        ids, wide = np.zeros(int(many.sum()), np.int32), np.zeros(int(many.sum()), np.int32)
        ids[first[known]] = sym[known]
        wide[first + many - 1] = width                             # of byte pieces the last covers the character
        for k in np.flatnonzero(~known).tolist():
            for d, byte in enumerate(chr(char[k]).encode()):
                ids[first[k] + d] = self.byte_id[byte]
        return ids, wide, np.bincount(own, many, len(parts)).astype(np.int64)

    def _ranks(self, sym: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, to = np.full(len(sym), NONE, np.int64), np.zeros(len(sym), np.int32)
        at = np.flatnonzero(own[1:] == own[:-1])
        rank[at], to[at] = self._pairs(sym[at], sym[at + 1])
        return rank, to

    def decode_flat(self, ids: np.ndarray, stop: np.ndarray) -> pa.Array:
        """The decoded text of each run of ids (ends ``stop``): the pieces'
        bytes are gathered; the dummy prefix of the first piece goes."""
        size = self.shown_len[ids]
        total = np.concatenate(([0], np.cumsum(size)))
        pick = np.arange(total[-1]) + np.repeat(self.shown_at[ids] - total[:-1], size)
        raw = self.shown[pick] if len(pick) else np.zeros(0, np.uint8)
        ends = total[stop]
        begins = np.concatenate(([0], ends[:-1]))
        if self.prefix or self.squeeze:
            some = np.flatnonzero(ends > begins)
            keep = np.ones(len(raw), bool)
            keep[begins[some[raw[begins[some]] == 32]]] = False
            ends = np.concatenate(([0], np.cumsum(keep)))[ends]
            raw = raw[keep]
        off = np.concatenate(([0], ends)).astype(np.int32)
        return pa.StringArray.from_buffers(len(stop), pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(raw)))

    def decode(self, ids: list[int]) -> str:
        """The text of ids that begin anywhere in a text (the dummy prefix
        is not removed)."""
        out = bytearray()
        for i in ids:
            if (b := self.id_byte.get(i)) is not None:
                out.append(b)
            elif self.kinds[i] == UNKNOWN:
                out += " ⁇ ".encode()
            elif self.kinds[i] != CONTROL:
                out += self.pieces[i].replace(WS, " ").encode()
        return out.decode("utf-8", "replace")


class _Parts(dict):
    """Parts met by a task: string -> number; their ids and widths lie in
    flat arrays."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.ids, self.width, self.first, self.count = array("i"), array("i"), array("q"), array("i")

    def numbers(self, parts: list[str]) -> np.ndarray:
        """The number of each part; parts not met before are encoded."""
        at = np.fromiter(map(self.get, parts, repeat(-1)), np.int64, len(parts))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            self._learn(list({parts[i] for i in new}))
            at[new] = [self[parts[i]] for i in new]
        return at

    def _learn(self, new: list[str]) -> None:
        short = [p for p in new if len(p) <= SHORT]
        if short:
            self._add(short, *self.model.encode_parts(short))
        for p in new:
            if len(p) > SHORT:
                ids, width = self.model.encode_part(p)
                self._add([p], np.array(ids, np.int32), np.array(width, np.int32), np.array([len(ids)]))

    def _add(self, parts: list[str], ids: np.ndarray, width: np.ndarray, count: np.ndarray) -> None:
        first = len(self.ids) + np.cumsum(count) - count
        self.update(zip(parts, range(len(self.first), len(self.first) + len(parts))))
        self.first.frombytes(first.astype(np.int64).tobytes())
        self.count.frombytes(count.astype(np.int32).tobytes())
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.width.frombytes(width.astype(np.int32).tobytes())


_MODELS: dict[str, PieceModel] = {}


def load(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)),
                                    pa.array(values.astype(np.int32)))


def encode_group(model: PieceModel, parts: _Parts, texts: list[str | None]):
    """Ids, starts and ends (flat) with the end of each text's run, and
    an array of the decoded texts."""
    seg: list[str] = []
    ends, sources = [], []
    for text in texts:
        norm, src = model.normalize(text or "")
        if norm:
            seg.extend(model.parts.findall(norm) if model.parts else [norm])
        ends.append(len(seg))
        sources.append(src)
    at = parts.numbers(seg)
    first, count = (np.frombuffer(x, t)[at] if len(at) else np.zeros(0, np.int64)
                    for x, t in ((parts.first, np.int64), (parts.count, np.int32)))
    count = count.astype(np.int64)
    total = np.concatenate(([0], np.cumsum(count)))
    pick = np.arange(total[-1]) + np.repeat(first - total[:-1], count)
    ids = np.frombuffer(parts.ids, np.int32)[pick] if len(pick) else np.zeros(0, np.int32)
    width = np.frombuffer(parts.width, np.int32)[pick].astype(np.int64) if len(pick) else np.zeros(0, np.int64)
    stop = total[np.array(ends, np.int64)]
    past = np.cumsum(width)
    starts, finish = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
    lo = 0
    for hi, src in zip(stop.tolist(), sources):
        if hi > lo:
            base = past[lo] - width[lo]
            finish[lo:hi] = src[past[lo:hi] - base]
            starts[lo:hi] = src[past[lo:hi] - width[lo:hi] - base]
        lo = hi
    return ids, starts, finish, stop, model.decode_flat(ids, stop)


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        parts = _Parts(model)
        for batch in batches:
            _, off = text_buffers(batch.column(1))
            for i, j in runs(off, GROUP_BYTES):
                if len(parts) > KEPT_PARTS:
                    parts = _Parts(model)
                ids, starts, ends, stop, decoded = encode_group(model, parts, batch.column(1)[i:j].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], _lists(ids, stop), _lists(starts, stop), _lists(ends, stop),
                     decoded], names=["doc_id", "ids", "starts", "ends", "decoded"])
    return run


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every whole text: doc_id, ids, starts, ends (byte spans
    in the original text, one for each id) and decoded.

    A null text is an empty one; an empty text has no ids and decodes to
    the empty text. Rows keep their number (repeated rows and null ids
    too); other columns are not read. ``model_file`` must be readable on
    every executor. A text must stay under 2 GB.
    """
    src = docs.select(docs[id_col].cast("long").alias("doc_id"),
                      F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return src.mapInArrow(_run(model_file),
                          "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string")


def digest(encoded: DataFrame) -> DataFrame:
    """n_tokens and SHA-256 digests of the ids and of the decoded text."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
