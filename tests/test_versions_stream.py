"""Versioned snapshots, the leveled streaming catalog, winners of heavy
rows, upload order and configurations in the service's shape."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quire.operators.dedupe import latest_rows
from quire.plans import publish, targets, versions
from quire.sources import folders
from quire.streaming import leveled_catalog


@pytest.mark.parametrize("buckets", [1, 7, 300])
def test_versions(spark, tmp_path, buckets, monkeypatch):
    monkeypatch.setattr(versions, "FAN", 4)
    rng, folder = random.Random(buckets), f"{tmp_path}/v"
    rows = {i: rng.choice(["a", "b", None]) for i in range(200)}
    seen = {}
    for step in range(4):
        monkeypatch.setattr(versions, "LITERALS", 1000 if step % 2 else 2)
        df = spark.createDataFrame([(k, v, step) for k, v in rows.items()], "k long, v string, more int")
        got = versions.publish(df, folder, ["k"], ["v"], buckets)
        want = {k: "insert" if k not in seen else "same" if seen[k] == v else "update" for k, v in rows.items()}
        want |= {k: "delete" for k in seen if k not in rows}
        assert {r.k: r.action for r in got.collect()} == want
        assert {r.k: r.v for r in versions.read(spark, folder).collect()} == rows
        seen = dict(rows)
        for _ in range(3 if step < 2 else 0):     # the last step publishes equal rows
            rows.pop(rng.choice(list(rows)))
            rows[rng.randrange(1000)] = "new"
    names = folders.names(spark, f"{folder}/versions")
    assert len(names) == 4
    tree = spark.read.parquet(f"{folder}/versions/{names[0]}/tree")
    assert tree.where(F.col("level") == tree.agg(F.max("level")).first()[0]).count() == 1


def test_few_buckets_differ(spark, tmp_path):
    folder = f"{tmp_path}/v"
    df = spark.range(2000).withColumn("v", F.lit("x"))
    a = versions.write(df, folder, ["id"], ["v"], 128)
    b = versions.write(df.withColumn("v", F.when(F.col("id") == 77, "y").otherwise(F.col("v"))), folder, ["id"], ["v"], 128)
    assert versions.differing(spark, folder, a, b).count() == 1 and versions.differing(spark, folder, a, a).count() == 0
    plan = versions.diff(spark, folder, a, b, ["id"])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(_bucket), EqualTo(_bucket" in plan or "In(_bucket" in plan


def test_a_run_that_ends_early_leaves_the_old_version(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/v"
    old = spark.createDataFrame([(1, "a")], "k long, v string")
    versions.publish(old, folder, ["k"], ["v"], 4)
    name = versions.current(spark, folder)

    def fails(*_):
        raise RuntimeError("ended")
    monkeypatch.setattr(versions, "make_current", fails)
    with pytest.raises(RuntimeError):
        versions.publish(spark.createDataFrame([(2, "b")], old.schema), folder, ["k"], ["v"], 4)
    assert versions.current(spark, folder) == name and [r.v for r in versions.read(spark, folder).collect()] == ["a"]
    assert [n for n in os.listdir(folder) if not n.startswith(".")] == ["CURRENT", "versions"] or set(os.listdir(folder)) >= {"CURRENT", "versions"}


def test_levels_stay_bounded_and_replays_change_nothing(spark, tmp_path):
    rng, out = random.Random(5), f"{tmp_path}/catalog"
    want, batches = {}, []
    for n in range(22):
        batch = [(rng.randrange(30), rng.randrange(10_000), f"v{n}", rng.random() < 0.2) for _ in range(8)]
        batches.append(spark.createDataFrame(batch, "k long, seq long, v string, _deleted boolean"))
        for k, seq, v, gone in batch:
            want[k] = max(want.get(k, (-1, "", False)), (seq, v, gone))
        leveled_catalog.write_batch(spark, batches[-1], n, out, ["k"], ["seq", "v"])
        if n in (3, 9, 15, 21):
            for again in (n, n - 1):
                leveled_catalog.write_batch(spark, batches[again], again, out, ["k"], ["seq", "v"])
            got = {r.k: (r.seq, r.v) for r in leveled_catalog.current(spark, out, ["k"], ["seq", "v"]).collect()}
            assert got == {k: x[:2] for k, x in want.items() if not x[2]}
        assert len(leveled_catalog.live_runs(spark, out)) <= 3 * 3
    assert leveled_catalog.live_runs(spark, out) == [(2, 0), (1, 16), (0, 20), (0, 21)]
    files = sum(f.endswith(".parquet") for _, _, fs in os.walk(out) for f in fs)
    assert files <= 4 + 2 * 3          # replayed runs that a merged one covers may be left


def test_stream(spark, tmp_path):
    rows = [(i % 7, i, "gone" if i % 5 == 0 else f"v{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "k long, seq long, v string")
    for part in range(6):
        df.where(F.col("seq") % 6 == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/landed")
    for _ in range(2):                  # the second start finds nothing new
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/landed")
        leveled_catalog.start(stream, f"{tmp_path}/out", f"{tmp_path}/progress", ["k"], ["seq"], F.col("v") == "gone").awaitTermination()
    last = {k: max(r for r in rows if r[0] == k) for k in range(7)}
    got = {r.k: r.v for r in leveled_catalog.current(spark, f"{tmp_path}/out", ["k"], ["seq"]).collect()}
    assert got == {k: r[2] for k, r in last.items() if r[2] != "gone"}


def test_latest_rows(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("a", 2, "z"), ("b", None, "n"), (None, 1, "q"), (None, 1, None), ("c", 1, None)]
    df = spark.createDataFrame(rows, "k string, o int, body string")
    got = sorted(((r.k, r.body) for r in latest_rows(df, ["k"], ["o"], "body").collect()), key=str)
    assert len(got) == 4 and {k for k, _ in got} == {"a", "b", "c", None} and dict(got)["b"] == "n" and dict(got)["a"] in ("y", "z")
    assert latest_rows(df.limit(0), ["k"], ["o"], "body").count() == 0


def test_destinations(spark):
    conf = {"g": {"uploadDestination": "gcp"}, "h": {"uploadDestination": "gcp"}, "d": {"uploadDestination": "dify"}, "e": {"uploadDestination": "dify"},
            "n": {"uploadDestination": "other"}}
    rec = lambda f, t: (f, (t,), (f"gs://b/{f}",))
    rows = [(t, rec("2.html", "two"), 5) for t in conf] + [(t, rec("1.html", "one"), 7) for t in conf] + [("d", rec("2.html", "two again"), 9)]
    meta = spark.createDataFrame(rows, "crawl_target string, metadata struct<id:string,structData:struct<title:string>,content:struct<uri:string>>, run_ord int")
    bodies = spark.createDataFrame([(t, "2.html") for t in conf] + [("g", "0.html")], "crawl_target string, filename string")
    stores = spark.createDataFrame([("g", "sg"), ("d", "sd"), ("n", "sn")], "target string, store_id string")
    got = sorted(tuple(r) for r in publish.destination_manifest(meta, bodies, targets.destinations_frame(spark, conf), stores).fillna("-").collect())
    assert got == [("d", "dify", "sd", 1, "2.html", "two", "ready"), ("d", "dify", "sd", 2, "1.html", "one", "missing_body"),
                   ("d", "dify", "sd", 3, "2.html", "two again", "ready"), ("g", "gcp", "sg", 1, "0.html", "-", "ready"),
                   ("g", "gcp", "sg", 2, "2.html", "-", "ready"), ("h", "gcp", "-", 1, "2.html", "-", "ready")]


def test_settings_shape():
    config = {"t": {"uploadDestination": "dify", "targets": [
        {"source": "confluence-cloud", "settings": {"type": "pages", "items": ["1"], "options": {"includeChildPages": True}}},
        {"source": "jira-cloud", "settings": {"type": "jql", "items": ["project = P"], "options": {"includeComments": True}}},
        {"source": "jira-cloud", "settings": {"type": "epic-issue-summary-P9"}}, {"source": "web", "settings": {"type": "url", "items": ["http://h"]}},
        {"source": "ftp", "settings": {"type": "url"}}, {"source": "web", "settings": {"type": "feed"}}]}, "u": {"uploadDestination": "gcp"}}
    got = targets.from_settings(config, {"project = P": "project_key = 'P'"})
    assert got["u"] == {"uploadDestination": "gcp", "sources": []} and got["t"]["uploadDestination"] == "dify"
    assert [(s["source"], s["type"], s["items"]) for s in got["t"]["sources"]] == [
        ("confluence", "pages", ["1"]), ("jira", "query", ["project_key = 'P'"]), ("jira", "epic-issue-summary", ["P9"]), ("web", "url", ["http://h"])]
    assert got["t"]["sources"][0]["options"] == {"includeChildPages": True}
    with pytest.raises(ValueError, match="project = P"):
        targets.from_settings(config)
