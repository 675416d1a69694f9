"""Embedding near-duplicates, nearest neighbours, pages and transcripts
against brute force, and their edge cases."""

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import chat, hilbert, itq, pages

NAN, INF = float("nan"), float("inf")


def vectors(seed=1, n=900, d=16):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, d))
    for i in range(0, n - 1, 3):                            # groups of near copies
        v[i + 1] = v[i] + 0.12 * rng.standard_normal(d)
    v[300:420] = v[300] + 0.1 * rng.standard_normal((120, d))
    return v.astype(np.float32).astype(np.float64)


def frame(spark, v, labels):
    rows = [(int(i) * 5, [float(x) for x in row], int(l), "x", 1) for i, (row, l) in enumerate(zip(v, labels))]
    d = v.shape[1]
    rows += [(100001, None, 1, "x", 1), (100002, [0.0] * d, 1, "x", 1), (100003, [NAN] * d, 1, "x", 1), (100004, [INF] + [0.0] * (d - 1), 1, "x", 1),
             (100005, [None] + [1.0] * (d - 1), 1, "x", 1), (None, [float(x) for x in v[0]], int(labels[0]), "x", 1), (100006, [1.0, 2.0], 1, "x", 1),
             (100007, [2.0, 4.0], 1, "x", 1), (100008, [float(x) for x in v[0]], None, "x", 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, n long")


def test_embedding_near_duplicates(spark):
    v = vectors()
    labels = np.arange(len(v)) // 3 % 2
    df = frame(spark, v, labels)
    got = {r.vec_id: r for r in itq.near_duplicates(spark, df).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    links = sum(got[i * 5].n_links for i in range(len(v)))
    assert links >= 0.98 * near.sum()
    assert all(got[i * 5].n_links <= near[i].sum() for i in range(len(v)))
    root = np.arange(len(v))
    for _ in range(len(v)):
        new = np.array([min(root[i], *(root[near[i]] if near[i].any() else [root[i]])) for i in range(len(v))])
        if (new == root).all():
            break
        root = new
    same = np.mean([got[i * 5].component_id == 5 * root[i] for i in range(len(v))])
    assert same > 0.97
    for i in (100001, 100002, 100003, 100004, 100005, 100008, None):
        assert got[i].n_links == 0 and got[i].component_id == i and got[i].kept
    assert got[100006].n_links == got[100007].n_links == 1 and got[100007].component_id == 100006
    assert itq.near_duplicates(spark, df.limit(0)).count() == 0
    twice = itq.near_duplicates(spark, df.union(df)).where("vec_id = 0").collect()
    assert len(twice) == 2 and {r.n_links for r in twice} == {got[0].n_links}


def test_rows_of_one_id_and_equal_vectors(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [0.0, 1.0], 1), (2, [-0.0, 1.0], 1), (3, [0.0, 1.0], 2), (4, [0.0, 2.0], 1), (4, [0.0, 2.0], 1)]
    got = itq.near_duplicates(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [
        (1, 0, 1, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True), (4, 2, 1, False), (4, 2, 1, False)]


def test_a_third_of_equal_vectors(spark):
    rng = np.random.default_rng(7)
    v = rng.standard_normal((3000, 16))
    v[:1000] = v[0]
    v[1000:1010] = v[0] * 2
    df = spark.createDataFrame([(i, [float(x) for x in r], 1) for i, r in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in itq.near_duplicates(spark, df).collect()}
    assert {(got[i].n_links, got[i].component_id) for i in range(1010)} == {(1009, 0)}


def test_hot_bucket_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(itq, "BLOCK", 16)
    v = np.ones((100, 8)) + 1e-3 * np.random.default_rng(0).standard_normal((100, 8))
    df = spark.createDataFrame([(i, [float(x) for x in r], 1) for i, r in enumerate(v)], "vec_id long, embedding array<double>, label int")
    got = itq.near_duplicates(spark, df).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(99, 0)}


def test_hilbert_is_a_curve():
    g = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = hilbert.hilbert(g, 3)
    assert sorted(key) == list(range(512))
    path = g[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_nearest_is_exact(spark):
    v = vectors(3, 700)
    df = frame(spark, v, np.zeros(len(v)))
    got = hilbert.nearest(spark, df, lambda c: c % 20 == 0, k=20).collect()
    ids = np.append(np.arange(len(v)) * 5, 100008)
    every = np.vstack((v, v[0]))
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(by) == {i for i in ids.tolist() if i % 20 == 0}
    for q, found in by.items():
        s = (every * every[ids.tolist().index(q)]).sum(1)
        want = sorted((-s[j], int(ids[j])) for j in range(len(ids)) if ids[j] != q)[:20]
        assert [x for x, _ in found] == [i for _, i in want]
        assert np.allclose([x for _, x in found], [-s for s, _ in want], rtol=1e-12)
    small = hilbert.nearest(spark, df.where("vec_id <= 20"), lambda c: c % 20 == 0).collect()
    assert sorted((r.query_id, r.rank) for r in small) == [(q, k) for q in (0, 20) for k in (1, 2, 3, 4)]
    assert hilbert.nearest(spark, df.limit(0), lambda c: c % 20 == 0).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<nav><a>menu</a></nav><header>top</header><div class="cookie-notice">cookies</div><!-- <p>no</p> --><article class="post"><header><h1>Head  &amp; one</h1></header>
<p title="a > b">First <b>para</b>graph<p>Second&nbsp;&eacute;<br>line<div class="share">tweet</div><form><p>mail</form><aside>see</aside>
<ul><li>x<li>y</ul><div id="comments"><p>reader</div></article><footer>&copy; f</footer>"""


def test_page_blocks():
    main = " ".join(t for k, t in pages.blocks(PAGE) if k == pages.MAIN)
    assert main == "Head & one First paragraph Second é line x y"
    assert pages.blocks(None) == pages.blocks("") == []
    assert [t for _, t in pages.blocks("a < b <p>c</p> <<p>d <i")] == ["a < b", "c", "<", "d <i"]


def test_pages(spark):
    line = " ".join(f"w{i}" for i in range(12))
    plain = [f"<body><p>{line}</p><p>own text number {i} stays here</p></body>" for i in range(3)]
    rows = [(1, "http://a.com/1", PAGE), (2, None, None), (3, "http://a.com/2", ""), *((10 + i, "http://b.com/x", p) for i, p in enumerate(plain)),
            (20, "http://c.com/", plain[0]), (20, "http://d.com/", plain[0]), (None, "x", "<p>" + "long " * 40000 + "</p>")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, main string")
    got = pages.extract(spark, df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[2] == by[3] == "" and by[11] == "own text number 1 stays here" and by[20] == f"{line} own text number 0 stays here"
    assert by[None] == " ".join(["long"] * 40000)
    assert pages.extract(spark, df.limit(0)).count() == 0


def _viterbi(model, rows):
    w, back, found = None, [], []
    for i, r in enumerate(rows):
        for n, (m, t) in enumerate(chat.lines(r[3], r[2])):
            found.append((m, t, r[1] == 0 and i == 0 and n == 0))
    for m, t, first in found:
        step = np.tile(model.start, (3, 1)) if first else model.stay() if m == "same" else model.step
        move = step + (np.zeros(3) if w is None else w)[:, None]
        back.append(move.argmax(0))
        w = move.max(0) + model.emission(m, t, first)
    path, s = [], int(w.argmax())
    for b in reversed(back):
        path.append(s)
        s = int(b[s])
    return path[::-1]


def test_chat_blocks_equal_one_pass(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 8)
    rng = random.Random(5)
    rows = []
    for c in range(30):
        for t in range(rng.randint(1, 60)):
            role = ("user", "assistant")[t % 2]
            text = "why is it?" if role == "user" else "because " * rng.randint(5, 60)
            rows.append((c, t, role if rng.random() < 0.6 else None, text))
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, block string")
    model = chat.learn(spark, df.withColumnRenamed("conv_id", "conv"))
    got = chat.format_turns(spark, df, model=model).orderBy("conv_id", "turn").collect()
    assert len(got) == len(rows)
    for c in range(30):
        own = [r for r in rows if r[0] == c]
        assert [r.role for r in got if r.conv_id == c] == [chat.ROLES[s] for s in _viterbi(model, own)]
    right = sum(g.role == ("user", "assistant")[g.turn % 2] for g in got) / len(got)
    assert right > 0.9


def test_chat_transcript_and_edges(spark):
    df = spark.createDataFrame([(1, 0, None, "System: be brief\nHuman: hi\nmore\nAI: hello\n"), (2, 0, "user", None), (2, 1, "assistant", ""),
                                (2, 1, "assistant", ""), (None, None, "user", "x"), (3, 5, "??", "y")],
                               "conv_id long, turn long, role string, text string")
    got = chat.format_turns(spark, df).collect()
    one = sorted((r.part, r.role, r.text) for r in got if r.conv_id == 1)
    assert one == [(0, "system", "be brief"), (1, "user", "hi\nmore"), (2, "assistant", "hello")]
    assert len(got) == 3 + 5 and all(r.rendered == f"<|im_start|>{r.role}\n{r.text}<|im_end|>\n" for r in got)
    assert chat.format_turns(spark, df.limit(0)).count() == 0
