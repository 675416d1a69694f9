"""Shingle sets, the widest rows of the near-duplicate search, are never written as a table."""

import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import minhash


def test_sets_are_not_written(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[:50 + i % 8] + [f"own{i}"])) for i in range(16)] + [(90, "some other text of one row"), (91, None)]
    written, table = [], minhash.table
    monkeypatch.setattr(minhash, "table", lambda s, df: written.append(df.columns) or table(s, df))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert written and not any("items" in c for c in written)
    sets = {i: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows if t}
    want = {i: i for i, _ in rows}
    for _ in rows:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    want[a] = want[b] = min(want[a], want[b])
    assert got == want
