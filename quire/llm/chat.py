"""Roles of transcript lines by a hidden Markov model, canonical turns.

A conversation is a sequence of lines. What is seen of a line (its
speaker marker, its length, whether it asks, where it stands) is a
symbol; the hidden state is the role that speaks. Start, transition and
emission weights are counted over the lines whose speaker is known.
Viterbi runs in blocks: each block gives a matrix of best weights between
its first and last state, the matrices are chained, and each block is
traced back on its own, so a conversation of any length is split.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import cells_of, table

ROLES = ("system", "user", "assistant")
BLOCK = 256                # turns of a block
NONE = "none"

# Speaker markers at the start of a line.
MARKERS = {"system": "system", "instruction": "system", "instructions": "system", "context": "system",
           "user": "user", "human": "user", "customer": "user", "question": "user", "q": "user", "me": "user",
           "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant",
           "agent": "assistant", "answer": "assistant", "a": "assistant"}
_MARK = re.compile(r"^\s*(?:[#>*\[<|(-]*\s*)(" + "|".join(sorted(MARKERS, key=len, reverse=True)) +
                   r")\s*(?:[\])>*|]*)\s*[:：]\s*", re.I)


WEAK = "weak "             # before the marker of a line inside a row whose role is known
KNOWN = "known "           # before the marker of the first line of such a row
NEVER = -1e12              # the weight of any other role there


def lines(text: str | None, speaker: str | None) -> list[tuple[str, str]]:
    """(marker, text) of the lines of one row. The row's speaker, if it
    is known, is the role of the first line. In a row without a known speaker a line's own marker
    goes before it and is cut off; in a row with one it is weak evidence
    and the line stays as it is."""
    out = []
    own = MARKERS.get((speaker or "").strip().lower(), NONE)
    for n, line in enumerate((text or "").split("\n")):
        m = _MARK.match(line)
        if m and own == NONE:
            out.append((MARKERS[m[1].lower()], line[m.end():]))
        elif m and n > 0:
            out.append((WEAK + MARKERS[m[1].lower()], line))
        else:
            out.append((own if n == 0 and own == NONE else KNOWN + own if n == 0 else "same", line))
    return out


def cut(marker: str, line: str, role: str, last: str | None) -> str:
    """The line without its weak marker where the recovered role changes
    to the marker's role, else the line."""
    if marker == WEAK + role and last is not None and last != role:
        return line[_MARK.match(line).end():]
    return line


def symbol(marker: str, text: str, first: bool) -> str:
    size = min(6, int(math.log2(len(text) + 1)) // 2 * 2)
    shape = "ask" if text.rstrip().endswith("?") else "list" if re.match(r"\s*(?:[-*•]|\d+[.)])\s", text) else "text"
    return f"{marker}|{size}|{shape}|{'first' if first else 'next'}"


class Model:
    """Log weights: start[role], step[from, to], seen[symbol part][role].
    The parts of a symbol are taken as independent given the role."""

    def __init__(self, counts: dict[tuple[str, str], float], steps: np.ndarray, starts: np.ndarray, inner: np.ndarray | None = None):
        k = len(ROLES)
        inner = np.zeros((k, k)) if inner is None else inner
        weak = np.log((inner + 0.5) / (inner + 0.5).sum(1, keepdims=True))     # [role of the row, role of a marker inside it]
        self.weak = {WEAK + r: weak[:, i] for i, r in enumerate(ROLES)}
        self.start = np.log((starts + 1) / (starts + 1).sum())
        self.step = np.log((steps + 1) / (steps + 1).sum(1, keepdims=True))
        total = starts + steps.sum(0)
        self.seen = {}
        for part in {p for p, _ in counts}:
            n = np.array([counts.get((part, r), 0.0) for r in ROLES])
            self.seen[part] = np.log((n + 0.5) / (total + 8))
        self.other = np.zeros(k)
        for r in range(k):                     # a marker names its role, but not surely
            mark = np.full(k, 0.01)
            mark[r] = 0.98
            self.seen[f"mark={ROLES[r]}"] = np.log(mark)

    def emission(self, marker: str, text: str, first: bool) -> np.ndarray:
        e = self.other.copy()
        if marker == "same":                   # an unmarked line after the first of a row tells nothing
            return e
        if marker.startswith(KNOWN):           # nothing that is learned outweighs a given role
            e = np.full(len(ROLES), NEVER)
            e[ROLES.index(marker.removeprefix(KNOWN))] = 0.0
            return e
        if marker in self.weak:
            return self.weak[marker]
        if marker in ROLES:
            e = e + self.seen[f"mark={marker}"]
        for part in symbol(marker, text, first).split("|")[1:]:
            e = e + self.seen.get(part, self.other)
        return e

    def stay(self) -> np.ndarray:
        """Steps to an unmarked line of the same row: the speaker mostly stays."""
        s = np.full((len(ROLES),) * 2, math.log(0.001))
        np.fill_diagonal(s, math.log(0.998))
        return s


def learn(spark: SparkSession, turns: DataFrame) -> Model:
    """Counts over the turns whose role is known; a bounded number of
    them (roles x symbol parts) reaches the driver."""
    known = turns.where(F.col("role").isin(*ROLES)).select(
        "conv", "turn", "role", F.least(F.lit(6), F.floor(F.log2(F.length(F.substring_index("text", "\n", 1)) + 1) / 2) * 2)
        .cast("int").cast("string").alias("size"),
        F.when(F.substring_index("text", "\n", 1).rlike(r"\?\s*$"), "ask")
        .when(F.col("text").rlike(r"^\s*(?:[-*•]|\d+[.)])\s"), "list").otherwise("text").alias("shape"),
        F.when(F.col("turn") == 0, "first").otherwise("next").alias("place"))
    counts: dict[tuple[str, str], float] = {}
    for r in known.select("role", F.explode(F.array("size", "shape", "place")).alias("part")).groupBy("role", "part").count().collect():
        counts[r[1], r[0]] = float(r[2])
    # the turn before, by equal keys, not by a window over a whole conversation
    before = known.groupBy("conv", "turn").agg(F.max("role").alias("last")).select(
        F.col("conv").alias("c"), (F.col("turn") + 1).alias("t"), "last")
    steps, starts = np.zeros((3, 3)), np.zeros(3)
    pair = known.join(before, F.col("conv").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")), "left")
    for last, role, n in pair.groupBy("last", "role").count().collect():
        if last is None:
            starts[ROLES.index(role)] += n
        else:
            steps[ROLES.index(last), ROLES.index(role)] += n
    # markers at the start of later lines of these rows
    later = turns.where(F.col("role").isin(*ROLES) & F.contains("text", F.lit("\n"))).select(
        "role", F.split("text", "\\n").alias("lines")).select("role", F.explode(F.slice("lines", 2, F.size("lines"))).alias("line"))
    inner = np.zeros((3, 3))
    word = F.lower(F.regexp_extract("line", "(?i)" + _MARK.pattern, 1)).alias("word")
    for role, w, n in later.select("role", word).where("word <> ''").groupBy("role", "word").count().collect():
        inner[ROLES.index(role), ROLES.index(MARKERS[w])] += n
    return Model(counts, steps, starts, inner)


def _block_lines(part: list[tuple]) -> list[tuple]:
    """(row, marker, text, first) of all lines of a block, rows in order."""
    out = []
    for i, row in enumerate(part):
        for n, (marker, text) in enumerate(lines(row[5], row[4])):
            out.append((i, marker, text, row[2] == 0 and i == 0 and n == 0))
    return out


def _steps(model: Model, found: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    stay, start = model.stay(), np.tile(model.start, (len(ROLES), 1))
    for _, marker, text, first in found:
        yield start if first else stay if marker == "same" or marker in model.weak else model.step, model.emission(marker, text, first)


def _matrices(model: Model):
    """The best weight of a block for each state before it and each state
    of its last line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cells_of(batches, 2):
            best = None
            for step, seen in _steps(model, _block_lines(part)):
                best = (step if best is None else (best[:, :, None] + step[None, :, :]).max(1)) + seen[None, :]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part[0][0]], pa.int64()), pa.array([part[0][1]], pa.int64()),
                 pa.array([best.ravel().tolist()], pa.list_(pa.float64()))], names=["conv", "block", "best"])
    return run


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states before and at the end of each block on the best path:
    forward over the block matrices of a conversation, then back."""
    k = len(ROLES)
    for part in cells_of(batches, 1):
        at, back, out = np.zeros(k), [], []
        for row in part:
            w = at[:, None] + np.array(row[2]).reshape(k, k)
            back.append(w.argmax(0))
            at = w.max(0)
        end = int(at.argmax())
        for row, b in zip(reversed(part), reversed(back)):
            out.append((row[0], row[1], int(b[end]), end))
            end = int(b[end])
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(
            (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["conv", "block", "before", "at_end"])


def _traced(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in cells_of(batches, 2):
            found = _block_lines(part)
            w, back = None, []
            for step, seen in _steps(model, found):
                move = step[part[0][6]][None, :] if w is None else w[:, None] + step
                back.append(move.argmax(0))
                w = move.max(0) + seen
            path, state = [], part[0][7]
            for b in reversed(back):
                path.append(state)
                state = int(b[state])
            path.reverse()
            out: list[list] = []               # [row, state, lines]
            for (i, marker, text, _), state in zip(found, path):
                inside = out and out[-1][0] == i
                if inside and out[-1][1] == state and (marker == "same" or marker in model.weak):
                    out[-1][2].append(text)
                else:
                    out.append([i, state, [cut(marker, text, ROLES[state], ROLES[out[-1][1]] if inside else None)]])
            place, last, cols = 0, None, []
            for i, state, body in out:
                place = place + 1 if i == last else 0
                last = i
                text = "\n".join(body).strip()
                cols.append((part[i][0], part[i][2], place, ROLES[state], text, render(ROLES[state], text)))
            yield pa.RecordBatch.from_arrays([pa.array([c[n] for c in cols], t) for n, t in enumerate(
                (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()))],
                names=["conv_id", "turn", "part", "role", "text", "rendered"])
    return run


def render(role: str, text: str) -> str:
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def format_turns(spark: SparkSession, turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """Canonical turns: conv_id, turn, part (number of the turn within
    its row, from 0), role, text and rendered.

    A row's known role is the role of its first line, whatever the model
    holds of such conversations. Where it is null or unknown, roles are
    recovered, and a line's own marker ("Human: ...") is strong evidence;
    in a row with a known role a marker inside is weak evidence, weighed
    as often as rows of each role hold it, and stays in the text unless
    the recovered role changes to the marker's role there.
    Consecutive lines of a row with one recovered role are one turn. Rows
    are ordered by turn, then by role and text (ties and repeated rows
    stay); null turns come first; null conversations are one. Null and
    empty texts are turns without text. Other columns are not read.
    """
    src = turns.select(turns[conv_col].cast("long").alias("conv"), turns[turn_col].cast("long").alias("turn"),
                       turns[role_col].cast("string").alias("role"), F.coalesce(turns[text_col], F.lit("")).alias("text"))
    model = model or learn(spark, src)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = src.select("conv", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 40))).alias("block"), "turn",
                      F.lit(0).alias("tie"), "role", "text")
    order = ["conv", "block", "turn", "role", "text"]
    best = table(spark, rows.repartition(n, "conv", "block").sortWithinPartitions(*order)
                 .mapInArrow(_matrices(model), "conv long, block long, best array<double>"))
    ends = table(spark, best.repartition(n, "conv").sortWithinPartitions("conv", "block")
                 .mapInArrow(_chained, "conv long, block long, before int, at_end int"))
    ends = ends.select(F.col("conv").alias("c"), F.col("block").alias("b"), "before", "at_end")
    known = rows.join(ends, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")
    return (known.repartition(n, "conv", "block").sortWithinPartitions(*order)
            .mapInArrow(_traced(model), "conv_id long, turn long, part int, role string, text string, rendered string"))
