"""Toxicity scores: boosted trees over dense text features.

Each whole text is read once into a few numbers (densities of a fixed and
of a learned insult lexicon, insults near a second person, capitals,
punctuation, words hidden by look-alike characters). The learned lexicon
holds the words and word beginnings that mark toxic texts of the training
fold in any language. Gradient-boosted trees are fitted on the labelled
rows of that fold and calibrated by isotonic regression on a part of it
that the trees have not seen.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quire.llm.common import table

TRAIN_ROWS = 200_000       # bound of the labelled sample that the model is fitted on
LEXICON_ROWS = 12_000      # bound of the labelled sample that the lexicon is learned from
LEXICON_SIZE = 2_000       # bound of the learned lexicon
LEXICON_TEXTS = 5          # different toxic texts that a learned entry is found in, at least
THRESHOLD = 0.7

# Insults by strength, and second-person words (en, de, fr, es).
STRONG = frozenset("""
idiot idiots moron morons imbecile stupid dumbass asshole bastard bitch scum trash vermin loser losers pathetic
worthless disgusting clown retard scumbag dickhead filth parasite degenerate subhuman cretin dumb fool jerk garbage
arschloch idioten trottel abschaum dummkopf vollidiot connard imbécile salaud ordure imbécil estúpido basura escoria
""".split())
MILD = frozenset("""
hate kill die ugly shut crap damn hell stink liar coward freak creep sick gross nasty lame useless hateful despise
hasse dumm hässlich déteste moche odio feo inútil
""".split())
SECOND = frozenset("you your yours yourself youre u ur du dich dir dein deine euch ihr tu toi te ton ta vous votre tú usted vosotros".split())

FEATURES = ("strong_rate", "strong_log", "strong_kinds", "learned_rate", "learned_log", "learned_kinds", "mild_rate", "near_second", "second_rate", "hidden_log",
            "hidden_rate", "capitals", "shouted", "punctuation", "exclaims", "words_log", "word_length")

_WORD = re.compile(r"[^\W\d_]+")
_LOOKALIKE = bytes.maketrans(b"013457@$!|", b"oieastasil")
_INSIDE = b"*_-.~^'"
_SIGNS = re.compile(r"[0-9@$!|*_\-.~^][^\W\d_]|[0-9@$|*~^]")
_NOT_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_NOT_PUNCT = bytes(c for c in range(256) if not (33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126))


def stems(word: str) -> tuple[str, ...]:
    """What a word may be known by: itself (marked) and its beginnings."""
    return "=" + word, word[:4], word[:5], word[:6]


def features(text: str | None, learned: frozenset[str] = frozenset(),
             begins: frozenset[str] = frozenset()) -> list[float]:
    """The numbers of one whole text; a text without words gives zeros.
    ``begins`` are the first four letters of the learned entries."""
    text = text or ""
    raw = text.encode()
    words = _WORD.findall(text.lower())
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    strong = mild = second = hidden = 0
    known: list[str] = []
    at: list[int] = []
    if not STRONG.isdisjoint(words):
        at = [i for i, w in enumerate(words) if w in STRONG]
        strong = len(at)
    kinds = len({words[i] for i in at})
    if learned:
        for i in [i for i, w in enumerate(words) if w[:4] in begins]:
            if len(words[i]) >= 4 and not learned.isdisjoint(stems(words[i])):
                known.append(words[i])
                at.append(i)
    if not SECOND.isdisjoint(words):
        second = sum(w in SECOND for w in words)
    near = sum(not SECOND.isdisjoint(words[max(0, i - 5):i + 6]) for i in at) if second else 0
    if not MILD.isdisjoint(words):
        mild = sum(w in MILD for w in words)
    if _SIGNS.search(text):
        plain = raw.lower().translate(_LOOKALIKE, _INSIDE).decode("utf-8", "ignore")
        hidden = max(0, sum(w in STRONG for w in _WORD.findall(plain)) - strong)
    upper = len(raw.translate(None, _NOT_UPPER))
    marks = len(raw.translate(None, _NOT_PUNCT))
    letters = sum(map(len, words))
    return [100 * strong / n, math.log1p(strong), float(kinds), 100 * len(known) / n, math.log1p(len(known)),
            float(len(set(known))), 100 * mild / n, 100 * near / n, 100 * second / n,
            math.log1p(hidden), 100 * hidden / n, upper / len(raw), float(upper > 0.6 * letters), marks / len(raw),
            100 * raw.count(b"!") / n, math.log1p(n), letters / n]


def _measure(learned: frozenset[str]):
    begins = frozenset(x.removeprefix("=")[:4] for x in learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py(), learned, begins) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], *(pa.array([r[i] for r in rows], pa.float64()) for i in range(len(FEATURES)))],
                names=["doc_id", *batch.schema.names[2:], *FEATURES])
    return run


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, print (near copies mostly share it) and the text's stems."""
    for batch in batches:
        prints, found = [], []
        for t in batch.column(1):
            words = _WORD.findall((t.as_py() or "").lower())
            prints.append(min((zlib.crc32(" ".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2))), default=0))
            found.append(list({x for w in set(words) if len(w) >= 4 for x in stems(w)}))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints, pa.int64()), pa.array(found, pa.list_(pa.string()))],
            names=["label", "print", "stems"])


def marks_of(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(of, label) of the training fold: several labels of an id count by
    majority; rows without an id or a label teach nothing."""
    return (labels.select(labels[id_col].cast("long").alias("of"), labels[label_col].cast("double").alias("mark"))
            .where(F.col("of").isNotNull() & F.col("mark").isNotNull() & training_fold(F.col("of")))
            .groupBy("of").agg((F.avg("mark") >= 0.5).cast("double").alias("label")))


def learn_lexicon(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str) -> frozenset[str]:
    """Words and beginnings that mark toxic texts. Of near copies (equal
    prints) one text counts. The sample has about LEXICON_ROWS rows, taken
    by a hash of the id; LEXICON_SIZE entries reach the driver at most."""
    n = marks.count()
    if not n:
        return frozenset()
    part = F.pmod(F.xxhash64("of", F.lit("words")), F.lit(1 << 20)) < int((1 << 20) * min(1.0, LEXICON_ROWS / n))
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    sample = texts.join(F.broadcast(marks.where(part)), F.col("doc_id") == F.col("of")).select("label", "text")
    spelt = sample.mapInArrow(_spell, "label double, print long, stems array<string>")
    spelt = spelt.groupBy("print", "label").agg(F.any_value("stems").alias("stems"))
    counts = (spelt.select("label", F.explode("stems").alias("stem")).groupBy("stem")
              .agg(F.sum("label").alias("toxic"), F.count("*").alias("all")))
    good = counts.where((F.col("toxic") >= LEXICON_TEXTS) & ((F.col("toxic") - 1) / F.col("all") >= 0.8))
    return frozenset(r[0] for r in good.orderBy(F.desc("toxic"), "stem").limit(LEXICON_SIZE).collect())


def extract(docs: DataFrame, learned: frozenset[str] = frozenset(), id_col: str = "doc_id",
            text_col: str = "text", whole: bool = False) -> DataFrame:
    """doc_id and one column for each name of FEATURES, one row per row;
    ``whole`` adds ``own``, the row itself."""
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"),
                      *([F.struct(*(docs[c] for c in docs.columns)).alias("own")] if whole else []))
    kept = StructType([f for f in src.schema if f.name != "text"] + [StructField(f, DoubleType()) for f in FEATURES])
    return src.mapInArrow(_measure(learned), kept)


class Toxicity:
    """A fitted scorer. ``score`` adds nothing but the text's own numbers:
    labels, languages, sources and ids are no inputs."""

    def __init__(self, trees, curve, base: float):
        self.trees, self.curve, self.base = trees, curve, base

    def score(self, found: DataFrame) -> DataFrame:
        """``extract``'s rows -> the same without the numbers, score (0 to 1)."""
        own = [c for c in found.columns if c not in FEATURES]
        if self.trees is None:
            return found.select(*own, F.lit(self.base).alias("score"))
        p = self.trees.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(found))
        p = p.select(*own, vector_to_array("probability")[1].alias("raw"))
        if self.curve is None:
            return p.select(*own, F.col("raw").alias("score"))
        return self.curve.transform(p).select(*own, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))


def training_fold(doc_id: Column) -> Column:
    """Rows that may teach: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1


def fit(found: DataFrame, marks: DataFrame, rows: int = TRAIN_ROWS, trees: int = 20, depth: int = 4) -> Toxicity:
    """Fit on ``marks`` (of, label), at most about ``rows`` of them, chosen
    by a hash of the id. Without both classes the score is the share of
    toxic labels (0 if there is none)."""
    side = F.pmod(F.xxhash64("of", F.lit("part")), F.lit(1 << 20))
    known = found.join(marks, found.doc_id == marks.of).withColumn("side", side)
    known = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(known).select("x", "label", "side").persist()
    try:
        n, toxic = known.agg(F.count("*"), F.sum("label")).first()
        toxic = toxic or 0.0
        if not n or toxic in (0, n):
            return Toxicity(None, None, toxic / n if n else 0.0)
        if n > rows:
            known = known.where(F.col("side") < int((1 << 20) * rows / n))
        fit_part, check_part = known.where("side % 4 <> 0"), known.where("side % 4 = 0")
        if fit_part.agg(F.min("label"), F.max("label")).first()[:] != (0.0, 1.0):
            fit_part = known
        model = GBTClassifier(featuresCol="x", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3,
                              maxBins=32, seed=7).fit(fit_part)
        held = model.transform(check_part).select(vector_to_array("probability")[1].alias("raw"), "label")
        curve = None
        if held.agg(F.min("label"), F.max("label")).first()[:] == (0.0, 1.0):
            curve = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(held)
        return Toxicity(model, curve, toxic / n)
    finally:
        known.unpersist()


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD, label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``.

    Null and blank texts are scored as texts without words. Rows with a
    null id are scored and held out of nothing (held_out is null).
    Repeated rows give repeated scores; other columns are not read.
    """
    marks = marks_of(labels, id_col, label_col)
    found = table(spark, extract(docs, learn_lexicon(docs, marks, id_col, text_col), id_col, text_col))
    model = fit(found, marks)
    return model.score(found).select(
        "doc_id", (~training_fold(F.col("doc_id"))).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", threshold: float = THRESHOLD, label_col: str = "toxic") -> DataFrame:
    """``docs`` without the rows that ``score`` predicts toxic. Every row
    is judged by its own text, whatever other rows share its id: the rows
    are carried beside their numbers, not joined again. The numbers of the
    training fold are written for the fit; those of the rows are taken while
    the rows pass, so no table holds a second copy of the texts."""
    marks = marks_of(labels, id_col, label_col)
    learned = learn_lexicon(docs, marks, id_col, text_col)
    fold = docs.where(training_fold(docs[id_col].cast("long")))
    model = fit(table(spark, extract(fold, learned, id_col, text_col)), marks)
    scored = model.score(extract(docs, learned, id_col, text_col, whole=True))
    return scored.where(F.col("score") < threshold).select("own.*")
