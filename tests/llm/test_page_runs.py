"""Repeated runs on every page of a host, with an article or without one."""

import random
from collections import Counter

import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import pages


def extracted(spark, rows, **more):
    got = pages.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string"), **more).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    return {r.page_id: r.text for r in got}


def test_pages_with_an_article_take_part(spark):
    line, own = (" ".join(f"{c}{i}" for i in range(12)) for c in "lo")
    rows = [(i, "http://a.com/", f"<article><p>{own} {own} {i}</p></article><div>{line}</div><div>tail {i}</div>") for i in range(4)]
    rows += [(10 + i, "http://b.com/", f"<article><p>{line}</p><p>{own} b{i}</p></article>") for i in range(3)]
    rows += [(13, "http://b.com/", f"<div>{line}</div><div>{own[:5]} b13</div>")]
    rows += [(20 + i, "http://c.com/", f"<article><p>{own} c{i}</p></article>") for i in range(6)]
    rows += [(30 + i, "http://c.com/", f"<div>{line}</div><div>last words c{i}</div>") for i in range(3)]
    by = extracted(spark, rows)
    assert [by[i] for i in range(4)] == [f"{own} {own} {i} tail {i}" for i in range(4)]     # the site's line goes, the tail stays
    assert [by[10 + i] for i in range(3)] == [f"{line} {own} b{i}" for i in range(3)]        # an article's own text stays
    assert by[13] == f"{own[:5]} b13"                                                       # articles that hold the line count
    assert [by[30 + i] for i in range(3)] == [f"{line} last words c{i}" for i in range(3)]   # on 3 of 9 pages


def brute(texts, repeat):
    """What stays of the distinct pages of a host, a page being a tuple of (in an article, words) blocks."""
    least = max(pages.PAGES, -(-len(set(texts)) // 2))
    runs = lambda b: {b[i:i + repeat] if len(b) >= repeat else ("whole", b) for i in range(max(1, len(b) - repeat + 1))}
    on = Counter(run for t in set(texts) for run in set().union(*(runs(b) for _, b in t)))
    out = []
    for t in texts:
        left = []
        for own, b in t:
            gone = set()
            for i in range(max(1, len(b) - repeat + 1)):
                if not own and on[b[i:i + repeat] if len(b) >= repeat else ("whole", b)] >= least:
                    gone |= set(range(i, i + repeat))
            left.append([w for i, w in enumerate(b) if i not in gone])
        whole = sum(map(len, left)) < pages.LEFT * sum(len(b) for _, b in t)
        out.append(" ".join(" ".join(b) for b in ([b for _, b in t] if whole else left) if b))
    return out


@pytest.mark.parametrize("sent", [pages.SENT, 0])
def test_articles_and_copies_by_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(pages, "SENT", sent)
    rng, rows, want = random.Random(3), [], {}
    for host, many in enumerate((3, 4, 9)):
        line, texts = tuple(rng.choices("abcdefgh", k=14)), []
        for _ in range(many):
            words = lambda k: tuple(rng.choices("abc", k=rng.randrange(1, k)))
            texts.append(((rng.random() < 0.5, words(20)), (rng.random() < 0.5, line[rng.randrange(6):]), (False, ("about", "us")),
                          (False, words(3) + line[3:13] + words(9)), (True, words(12))))
        texts += texts[:1] * 5                                                              # copies count once
        for i, (t, left) in enumerate(zip(texts, brute(texts, 5))):
            page = "".join(f"<article>{' '.join(b)}</article>" if own else f"<div>{' '.join(b)}</div>" for own, b in t)
            rows.append((100 * host + i, f"http://{host}.com/", page))
            want[100 * host + i] = left
    assert extracted(spark, rows, repeat=5) == want
    assert any(len(want[i]) < len(" ".join(x)) for i, _, page in rows for x in [[t for _, t in pages.blocks(page)]])


def test_counts_by_parts_hide_no_frequent_item(monkeypatch):
    monkeypatch.setattr(pages, "COUNTED", 40)
    rng = random.Random(9)
    rows = [(rng.choice("xyyy"), [" ".join(rng.choices("abcdefghijklmnop", [9, 5, *[1] * 14], k=rng.randrange(1, 12))) for _ in range(2)])
            for _ in range(300)]
    batches = [pa.RecordBatch.from_arrays([pa.array([h for h, _ in rows[i:i + 50]]), pa.array([r for _, r in rows[i:i + 50]])], names=["host", "rest"])
               for i in range(0, 300, 50)]
    found, parts = Counter(), 0
    for out in pages._counts(3)(iter(batches)):
        parts += 1
        for host, item, n in zip(*(c.to_pylist() for c in out.columns)):
            found[host, item] += n
    assert parts > 10
    for host in "xy":
        own = [{x for b in r for x in (b.split() if len(b.split()) >= 3 else [" " + b])} for h, r in rows if h == host]
        on = Counter(x for items in own for x in items)
        assert all(found[host, x] + found[host, None] >= n for x, n in on.items())
        assert found[host, None] < pages.SHARE * len(own)
