"""The pipeline against its stages recomputed in plain Python."""

import hashlib
import random
import re

import pytest

pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

import public_tokenizers

import corpus_pipeline
from tests.llm.test_texts import MODEL, classes


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7)))
    token = lambda: hashlib.sha1(str(rng.random()).encode()).hexdigest()
    rows, labels = [], []
    for i in range(400):
        words = [word() for _ in range(rng.randint(20, 80))]
        toxic = i % 6 == 0
        if toxic:
            words[3:3] = ["idiot", "scum", "moron"]
        if i % 6 == 1:
            words.insert(5, f'token = "{token()}"')
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
        if i % 6 == 2:
            rows.append((1000 + i, " ".join(words) + " end"))
            rows.append((2000 + i, rows[-1][1].upper()))
    rows += [(5000, None), (5001, ""), (5002, "x")]
    d = tmp_path_factory.mktemp("sf")
    data = [(i, t, "en", f"s{i % 5}", len(t or "")) for i, t in rows]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return f"{d}", rows


def test_stages(spark, sf):
    path, rows = sf
    names = spark.read.parquet(f"{path}/documents.parquet").columns
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path).cache()
        seen.append((name, docs, docs.collect()))
    assert [n for n, *_ in seen] == ["toxicity", "minhash", "secrets", "mixing", "sentencepiece"]
    assert all(d.columns == names for _, d, _ in seen[:-1])
    toxic = {i for i, t in rows if t and "scum" in t}
    first = {r.doc_id: r.text for r in seen[0][2]}
    assert set(first) == {i for i, _ in rows} - toxic
    want = classes([(i, t, "s") for i, t in first.items()], 5)
    assert sorted(r.doc_id for r in seen[1][2]) == sorted(d for d, _, c in want if d == c)
    third = {r.doc_id: r for r in seen[2][2]}
    for i, r in third.items():
        clean = re.sub(r"(?<=token = \")[0-9a-f]{40}", "[SECRET]", first[i]) if first[i] else first[i]
        assert r.text == clean and r.n_chars == len(clean or "")
    mixed = [r.doc_id for r in seen[3][2]]
    assert set(mixed) <= set(third) and max(map(mixed.count, set(mixed))) <= 3
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    by = {r.doc_id: r for r in seen[4][2]}
    assert len(seen[4][2]) == len(mixed)
    for i in set(mixed):
        ids = sp.encode(third[i].text or "")
        assert by[i].n_tokens == len(ids) and by[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_run_repeats(spark, sf):
    one, two = (sorted(map(tuple, corpus_pipeline.run(spark, sf[0]).collect())) for _ in range(2))
    assert one == two and one
