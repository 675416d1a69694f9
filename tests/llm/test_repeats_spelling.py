"""Repeated passages and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import repeats, spelling
from quire.llm.queries import op12_repeats, op13_spelling

DOCS = "doc_id long, text string, text_key string, copies int, first string, word string, n int, form string"


def plain_repeats(texts, length):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    places = Counter(tuple(w[i:i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        gone = {j for i in range(len(w) - length + 1) if places[tuple(w[i:i + length])] > 1 for j in range(i, i + length)}
        out.append((len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def texts_of(seed, many):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    words = lambda n: [word() for _ in range(n)]
    common = [words(rng.choice([34, 35, 36, 60, 120])) for _ in range(6)]
    line = words(40)
    texts = [None, None, "", " \n\t", "a " * 300, "a " * 34, "a " * 35, "x y " * 40, " ".join(words(50)), " ".join(words(30_000))]
    for _ in range(many):
        t = words(rng.randint(0, 120))
        if rng.random() < 0.6:
            t[len(t) // 2:len(t) // 2] = rng.choice(common)
        if rng.random() < 0.5:
            t[3:3] = line
        if rng.random() < 0.1:
            t = [x.upper() for x in t]
        texts.append(rng.choice([" ", "\n", "  "]).join(t))
        if rng.random() < 0.2:
            texts.append(texts[-1] if rng.random() < 0.5 else " ".join([*texts[-1].split(), "end"]))
    return texts


@pytest.mark.parametrize("hot, shard", [(1000, 50_000), (3, 50), (0, 1)])
def test_repeats(spark, tmp_path, monkeypatch, hot, shard):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = texts_of(hot, 150)
    spark.createDataFrame([(i if i % 9 else None, t, "k", 1, "f", "w", 2, "g") for i, t in enumerate(texts)], DOCS).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op12_repeats(spark, str(tmp_path)).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted(((i if i % 9 else None, n, gone, sha(kept)) for i, (n, gone, kept) in enumerate(plain_repeats(texts, 35))), key=str)
    # other lengths, by the automata alone and with small shards
    monkeypatch.setattr(repeats, "SHARD_WORDS", shard)
    for length in (1, 5, 9):
        df = spark.createDataFrame([(t,) for t in texts[:60]], "text string")
        rows = repeats.cleaned(spark, df, length).collect()
        want = {tuple(x) for x, t in zip(plain_repeats(texts[:60], length), texts) if t is not None}
        assert {(r.n_words, r.n_removed, r.kept) for r in rows} == want
        assert all(sum(s.stop - s.start for s in r.spans) == r.n_removed for r in rows)
    assert repeats.cleaned(spark, df.limit(0)).count() == 0


def test_automaton():
    rng = random.Random(4)
    for _ in range(40):
        texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 25))] for _ in range(4)]
        auto = repeats.Automaton()
        for t in texts:
            auto.add(t)
        auto.count()
        for length in (1, 2, 5):
            places = Counter(tuple(t[i:i + length]) for t in texts for i in range(len(t) - length + 1))
            other = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(30)]
            for t in [*texts, other]:
                assert auto.repeated(t, length) == [i for i in range(len(t) - length + 1) if places[tuple(t[i:i + length])] > 1]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def test_variants(spark, tmp_path):
    rng = random.Random(6)
    base = ["".join(rng.choice("abÀàn×ß") for _ in range(rng.randint(4, 7))) for _ in range(60)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "banana", "Banana", "BANANÀ"]
    rows = [(None, None), (1, ""), (2, "1 2 3 !"), (None, "short word"), (3, "verylongword" * 5000)]
    for i in range(300):
        words = []
        for _ in range(60):
            w = base[min(int(rng.expovariate(0.05)), len(base) - 1)]
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "a", "b", w[k] + "n"]) + w[k + 1:]
            words.append(w)
        rows.append((i if i % 7 else None, rng.choice([" ", "-", "1"]).join(words)))
    rows += rows[-30:]
    spark.createDataFrame([(*r, "k", 1, "f", "w", 2, "g") for r in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_spelling(spark, str(tmp_path))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_variants(rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spark, empty).count() == 0


def test_pivots():
    rng = random.Random(2)
    for _ in range(200):
        grams = [(r, at, rng.randint(1, 9)) for r, at in enumerate(rng.sample(range(8), 3))]
        cost = {at: c for _, at, c in grams}
        pairs = [(p, q) for p in cost for q in cost if q - p >= 2]
        assert sum(cost[p] for p in spelling.pivots(grams)) == min(cost[p] + cost[q] for p, q in pairs)
        p, q = spelling.pivots(grams)
        assert q - p >= 2
