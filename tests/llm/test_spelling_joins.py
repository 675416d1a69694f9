"""Joins of the spelling variants: no table that grows with the vocabulary is broadcast."""

import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import spelling


def test_no_table_is_broadcast(spark, monkeypatch):
    plans, table = [], spelling.table

    def planned(session, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return table(session, df)

    monkeypatch.setattr(spelling, "table", planned)
    words = {"banana": 40, "bananna": 8, "banan": 5, "orange": 30, "orangge": 6, "lemon": 20}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    df = spelling.variants(spark, spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string"))
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    found = {r.word: r for r in df.collect()}
    assert found["bananna"].form == "banana" and found["orange"].n_near == 1 and found["lemon"].form is None
    joined = [p for p in plans if "Join" in p]
    assert len(joined) >= 3                                   # candidates, rounds of roots, result
    assert not any("Broadcast" in p for p in joined)
