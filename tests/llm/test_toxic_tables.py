"""The toxicity stage writes numbers, not a second copy of the texts."""

import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import toxicity


def test_texts_are_not_written(spark, monkeypatch):
    rows = [(i, f"you idiot number {i} stupid moron" if i % 2 else f"a calm text of the day {i}", f"s{i}") for i in range(60)] + [(None, None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    written, table = [], toxicity.table
    monkeypatch.setattr(toxicity, "table", lambda s, d: written.append(d.columns) or table(s, d))
    left = toxicity.drop_toxic(spark, df, labels)
    toxic = {r.doc_id for r in toxicity.score(spark, df, labels).where("predicted = 1").collect()}
    assert written and not any("own" in c or "text" in c for c in written)
    assert toxic and sorted(map(tuple, left.collect()), key=str) == sorted((r for r in rows if r[0] not in toxic), key=str)
    assert left.columns == df.columns
