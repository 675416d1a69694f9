"""Equal rows draw one by one; the engine equals its SQL on them."""

from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")
duckdb = pytest.importorskip("duckdb")

from quire.llm import mixing
from quire.llm.sql import SQL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, own string, u long, rid long, at int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "x", 1, 2, 3) for i, t, lang, s in rows], DOCS)


def _taken(rows):
    out = {}
    for r in rows:
        taken, target, size = out.get(r.source, (0, 0, 0))
        out[r.source] = taken + r.size * r.copies, r.target, r.source_size
    return out


def _rows():
    # one source of equal rows without an id, one with a hot group beside others, and sources of its own
    return ([(None, "one two three", "en", "a")] * 400 + [(7, "w " * 9, "de" if i % 2 else "en", "b") for i in range(700)]
            + [(i, f"text {i} of c " * (i % 5 + 1), "en", "c") for i in range(300)] + [(7, "w " * 9, "en", None), (8, None, "en", "b"), (8, None, "en", "b")])


def test_equal_rows_meet_the_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 64)                # the groups take several chunks
    rows = _rows()
    got = mixing.mix(spark, _docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((i, s) for i, _, _, s in rows)
    for source, (taken, target, size) in _taken(got).items():
        assert abs(taken - target) <= 20 and taken <= 3 * size, source
    assert len({r.copies for r in got if r.source == "a"}) == 2
    back = mixing.mix(spark, _docs(spark, rows[::-1])).collect()
    assert Counter(map(tuple, back)) == Counter(map(tuple, got))


def test_emitted_rows_are_the_mix(spark):
    rows = _rows()
    first, again = (mixing.emit(spark, _docs(spark, r)).collect() for r in (rows, rows[::-1]))
    mix = mixing.mix(spark, _docs(spark, rows)).collect()
    want = Counter()
    for r in mix:
        want[r.doc_id, r.source] += r.copies
    assert Counter((r.doc_id, r.source) for r in first) == +want
    assert Counter(map(tuple, first)) == Counter(map(tuple, again))       # whatever the order of the rows
    assert first[0].__fields__ == [c.split()[0] for c in DOCS.split(", ")]


def test_sql_on_equal_rows(spark, tmp_path):
    df = _docs(spark, _rows() + [(None, None, "en", None), (None, "", "en", None)])
    df.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    want = Counter((i, z, n, round(t, 6), k) for i, z, n, t, k in con.execute(SQL["op9_mixing"]).fetchall())
    got = Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.size * r.copies) for r in mixing.mix(spark, df).collect())
    assert got == want
