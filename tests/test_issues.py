from pyspark.sql import functions as F

from quire.operators import issues as iss


def _body(spark, rows):
    schema = ("key string, t string, title string, proj string, labels array<string>, created string, "
              "updated string, epic string, points double, descr string")
    df = spark.createDataFrame(rows, schema)
    b = iss.issue_body(F.col("key"), F.col("t"), F.col("title"), F.col("proj"), F.col("labels"), F.col("created"),
                       F.col("updated"), [("Epic", F.col("epic"), False), ("Story Points", F.col("points"), True)],
                       F.col("descr"))
    return [r[0] for r in df.select(b).collect()]


def test_issue_body_sections(spark):
    rows = [("K-1", "Story", "T", "P", [], "c", "u", None, 0.0, ""),
            ("K-2", "Bug", "T", "P", None, "c", "u", "E-1", 3.0, "<p>d</p>"),
            ("K-3", "Task", "T", "P", ["a", "b"], "c", "u", "", 2.5, None)]
    got = _body(spark, rows)
    head = "Issue Key: {}\n\nIssue Type: {}\n\nTitle: T\n\nProject Name: P\n\n"
    assert got[0] == head.format("K-1", "Story") + "Created Time: c\n\nUpdated Time: u"
    assert got[1] == (head.format("K-2", "Bug") + "Created Time: c\n\nUpdated Time: u\n\nEpic: E-1\n\n"
                      "Story Points: 3\n\nDescription: \n<p>d</p>")
    assert got[2] == head.format("K-3", "Task") + "Labels: a, b\n\nCreated Time: c\n\nUpdated Time: u\n\nStory Points: 2.5"


def test_steps_block_order_ties_and_missing_parts(spark):
    rows = [("I", 2, "s2", "d2", "r2", 1), ("I", 1, "s1", None, "r1", 2), ("I", 1, "s0", "d0", "", 1),
            ("J", 5, None, None, None, 1)]
    df = spark.createDataFrame(rows, "k string, o long, step string, data string, result string, seq long")
    got = {r.k: r.steps_block for r in
           iss.steps_block(df, "k", [("o", True), ("seq", True)], "step", "data", "result").collect()}
    e1 = "Test Number: 1\n\nTest Step: \ns0\n\nTest Data: \nd0\n\n"
    e2 = "Test Number: 2\n\nTest Step: \ns1\n\n\n\nTest Result: \nr1"
    e3 = "Test Number: 3\n\nTest Step: \ns2\n\nTest Data: \nd2\n\nTest Result: \nr2"
    assert got["I"] == "\n\nZephyr Tests Scenarios:\n=====\n" + "\n===\n".join([e1, e2, e3]) + "\n=====\n"
    assert got["J"] == "\n\nZephyr Tests Scenarios:\n=====\nTest Number: 1\n\n\n\n\n\n\n=====\n"


def test_comments_block_and_issues_without_comments(spark):
    issues = spark.createDataFrame([("A",), ("B",), ("C",)], "key string")
    comments = spark.createDataFrame([("A", 1, None, "u1", "hi"), ("A", 0, "ann", "u0", "first"), ("B", 0, "bo", "u", "x")],
                                     "issue string, seq long, author string, updated string, body string")
    blocks = iss.comments_block(comments, "issue", [("seq", True)], "author", "updated", "body")
    got = {r.key: r.comments_block for r in iss.attach_blocks(issues, "key", (blocks, "comments_block")).collect()}
    a1 = "Comment Number: 1\n\nComment Author: ann\n\nComment Updated Time: u0\n\nComment Body: \nfirst"
    a2 = "Comment Number: 2\n\nComment Author: \n\nComment Updated Time: u1\n\nComment Body: \nhi"
    assert got["A"] == "\n\nComments:\n=====\n" + a1 + "\n=====\n" + a2 + "\n=====\n"
    assert got["C"] == ""


def test_epic_summary_drops_empty_epics_and_breaks_ties(spark):
    epics = spark.createDataFrame([("E1", "One"), ("E2", "Two")], "key string, title string")
    stories = spark.createDataFrame([("E1", "S2", "b", "2024-01-02", 2), ("E1", "S1", "a", "2024-01-02", 1),
                                     ("E1", "S3", "c", "2024-01-03", 3)],
                                    "epic string, skey string, stitle string, upd string, seq long")
    out = iss.epic_summaries(epics, stories, "key", "title", "epic", "skey", "stitle", "upd",
                             [("upd", False), ("skey", True)]).collect()
    assert [r.key for r in out] == ["E1"]
    assert out[0].body == ("Epic ID: E1\nEpic Title: One\n=====\nListing of User Stories:\n\n"
                           "S3: c [Last Updated On: 2024-01-03]\nS1: a [Last Updated On: 2024-01-02]\n"
                           "S2: b [Last Updated On: 2024-01-02]\n")


def test_epic_summary_parts_rejoin(spark):
    epics = spark.createDataFrame([("E1", "One"), ("E2", "Two"), ("E3", "none")], "key string, title string")
    stories = spark.createDataFrame([(f"E{1 + i % 2}", f"S{i:03d}", f"t{i}", f"2024-01-{1 + i % 28:02d}", i)
                                     for i in range(300)],
                                    "epic string, skey string, stitle string, upd string, seq long")
    order = [("upd", False), ("skey", True)]
    whole = {r.key: r.body for r in iss.epic_summaries(epics, stories, "key", "title", "epic", "skey", "stitle",
                                                         "upd", order).collect()}
    parts = iss.epic_summary_parts(epics, stories, "key", "title", "epic", "skey", "stitle", "upd", order).collect()
    joined = {}
    for r in sorted(parts, key=lambda r: (r.key, r.part)):
        joined[r.key] = joined.get(r.key, "") + r.text
    assert joined == whole and set(whole) == {"E1", "E2"}


def test_text_zero_is_a_value_and_number_zero_is_not(spark):
    df = spark.createDataFrame([("0", 0.0, "0"), ("", 12000000.0, None), (None, None, "")],
                               "epic string, points double, d string")
    none = F.lit(None).cast("array<string>")
    body = iss.issue_body(F.lit("k"), F.lit("t"), F.lit("s"), F.lit("p"), none, F.lit("c"), F.lit("u"),
                          [("Epic", F.col("epic"), False), ("Story Points", F.col("points"), True)], F.col("d"))
    tails = [r[0].split("Updated Time: u")[1] for r in df.select(body).collect()]
    assert tails == ["\n\nEpic: 0\n\nDescription: \n0", "\n\nStory Points: 12000000", ""]


def test_a_target_without_sources_is_rejected(spark):
    import pytest

    from quire.plans.corpus import run_targets
    with pytest.raises(ValueError, match="expected"):
        run_targets(spark, {"t": {"uploadDestination": "gcp", "targets": []}}, {}, base_url="b", bucket="b")
