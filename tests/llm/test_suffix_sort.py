"""Boilerplate of a host by sorted suffixes, against brute force."""

import random

import pytest

pytest.importorskip("public_tokenizers")

from quire.llm import pages

SYMBOLS = "rid long, host long, least long, pos int, size int, word string"


def brute(texts, repeat):
    """What stays of the distinct pages of one host, a page being a list of blocks of words."""
    least = max(pages.PAGES, -(-len(texts) // 2))
    runs = lambda b: {(b[i:i + repeat] if len(b) >= repeat else ("whole", b)) for i in range(max(1, len(b) - repeat + 1))}
    on = [set().union(*map(runs, t)) for t in texts]
    out = []
    for t in texts:
        left = []
        for b in t:
            gone = set()
            for i in range(max(1, len(b) - repeat + 1)):
                run = b[i:i + repeat] if len(b) >= repeat else ("whole", b)
                if sum(run in o for o in on) >= least:
                    gone |= set(range(i, i + repeat))
            left.append([w for i, w in enumerate(b) if i not in gone])
        whole = sum(map(len, left)) < pages.LEFT * sum(map(len, t))
        out.append(" ".join(" ".join(b) for b in (t if whole else left) if b))
    return out


@pytest.mark.parametrize("repeat", [8, 5])
def test_hosts_by_brute_force(spark, repeat):
    rng, rows, want = random.Random(repeat), [], {}
    for host, many in enumerate((2, 3, 7)):
        line = tuple(rng.choices("abcdefgh", k=19))
        texts = []
        for _ in range(many):
            cut = rng.randrange(0, 8)
            own = tuple(rng.choices("abc", k=rng.randrange(1, 30)))
            texts.append([own, line[cut:], ("about", "us"), own[:4] + line[3:14] + own[4:], tuple("a" * rng.randrange(1, 15))])
        for i, (t, left) in enumerate(zip(texts, brute(texts, repeat))):
            rows.append((10 * host + i, f"http://{host}.com/", "".join(f"<p>{' '.join(b)}</p>" for b in t)))
            want[10 * host + i] = left
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in pages.extract(spark, df, repeat=repeat).collect()} == want
    assert any(len(want[r[0]]) < len(r[2].replace("<p>", "").replace("</p>", " ").strip()) for r in rows)


def test_ranks_are_the_order_of_the_suffixes(spark):
    line = [f"w{i % 5}{i}" for i in range(21)]
    texts = {i: [f"own{i}", *line, f"end{i}"] for i in range(4)}
    symbols = spark.createDataFrame([(i, 1, 3, p, 0, w) for i, t in texts.items() for p, w in enumerate(t)], SYMBOLS)
    found = {n: rows.collect() for n, rows in pages.suffixes(spark, symbols, 8)}
    assert list(found) == [1, 2, 4, 8, 16]                                    # up to the longest run of 21 tokens
    for n, rows in found.items():
        assert sorted((r.rid, r.pos) for r in rows) == [(i, p) for i in texts for p in range(1, 23 - n)]
        first = {r.rank: tuple(texts[r.rid][r.pos:r.pos + n]) for r in rows}
        assert len(first) == 22 - n and [first[k] for k in sorted(first)] == sorted(first.values())
