"""Issue documents (L2): body rendering (P22, C11), comment and test-step
blocks (A1, A2 with J3, J4), epic summaries (A3, J5, C10), custom
fields and attachment lists (P5-P7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import file_name, js_number
from quire.operators.ordering import PART_BYTES, Order, ordered_concat, ordered_parts

# File-name prefix, custom fields (display name -> field key)
# and the texts of the rendered issue documents, in document order.
SOURCE_PREFIX = "jira-cloud"
CUSTOM_FIELDS = [("Epic", "customfield_10014"), ("Story Points", "customfield_10036")]
SECTION_SEP = "\n\n"
ISSUE_KEY = "Issue Key: "
ISSUE_TYPE = "Issue Type: "
TITLE = "Title: "
PROJECT_NAME = "Project Name: "
LABELS = "Labels: "
LABEL_SEP = ", "
CREATED = "Created Time: "
UPDATED = "Updated Time: "
DESCRIPTION = "Description: \n"
STEPS_HEAD = "\n\nZephyr Tests Scenarios:\n=====\n"
TEST_NUMBER = "Test Number: "
TEST_STEP = "Test Step: \n"
TEST_DATA = "Test Data: \n"
TEST_RESULT = "Test Result: \n"
STEP_SEP = "\n===\n"
COMMENTS_HEAD = "\n\nComments:\n=====\n"
COMMENT_NUMBER = "Comment Number: "
COMMENT_AUTHOR = "Comment Author: "
COMMENT_UPDATED = "Comment Updated Time: "
COMMENT_BODY = "Comment Body: \n"
COMMENT_SEP = "\n=====\n"
BLOCK_TAIL = "\n=====\n"
EPIC_ID = "Epic ID: "
EPIC_TITLE = "\nEpic Title: "
EPIC_LISTING = "\n=====\nListing of User Stories:\n\n"
STORY_UPDATED = " [Last Updated On: "
STORY_END = "]\n"
EPIC_MARK = "Epic: "


def _s(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _truthy(c: Column, numeric: bool) -> Column:
    """JavaScript truthiness of a field value: NULL, '' and the number 0
    are false; the string '0' is true."""
    return F.coalesce(c != F.lit(0) if numeric else c.cast("string") != "", F.lit(False))


def pick_custom(custom: Column, field_key: str) -> Column:
    """P5: a custom field value from the issue's field map."""
    return F.element_at(custom, F.lit(field_key))


def attachment_list(attachments: Column) -> Column:
    """Reshape the nested attachment list; absent -> empty list."""
    empty = F.array().cast("array<struct<mimeType:string,filename:string,created:string,content:string>>")
    return F.transform(F.coalesce(attachments, empty), lambda a: F.struct(
        a["mimeType"].alias("mimeType"), a["filename"].alias("filename"),
        a["created"].alias("createdAt"), a["content"].alias("contentRestLink")))


def count_or_zero(arr: Column) -> Column:
    """Array length, absent -> 0."""
    return F.coalesce(F.size(arr), F.lit(0)).cast("int")


def issue_body(key: Column, issue_type: Column, title: Column, project: Column, labels: Column,
               created: Column, updated: Column, custom: Sequence[tuple[str, Column, bool]],
               description: Column) -> Column:
    """P22 + C11: the ordered sections of an issue document joined by a
    blank line; optional sections (labels, truthy custom fields, truthy
    description) are left out. ``custom`` holds (display name, value,
    numeric); numeric values print like JavaScript numbers."""
    lab = F.when(F.coalesce(F.size(labels), F.lit(0)) > 0,
                 F.concat(F.lit(LABELS), F.array_join(labels, LABEL_SEP, "")))
    parts = [F.concat(F.lit(ISSUE_KEY), _s(key)), F.concat(F.lit(ISSUE_TYPE), _s(issue_type)),
             F.concat(F.lit(TITLE), _s(title)), F.concat(F.lit(PROJECT_NAME), _s(project)), lab,
             F.concat(F.lit(CREATED), _s(created)), F.concat(F.lit(UPDATED), _s(updated))]
    for name, value, numeric in custom:
        shown = js_number(value) if numeric else value.cast("string")
        parts.append(F.when(_truthy(value, numeric), F.concat(F.lit(f"{name}: "), shown)))
    parts.append(F.when(description.isNotNull() & (description != ""), F.concat(F.lit(DESCRIPTION), description)))
    return F.concat_ws(SECTION_SEP, *parts)


def comment_element(n: Column, author: Column, updated: Column, body: Column) -> Column:
    return F.concat_ws(SECTION_SEP, F.concat(F.lit(COMMENT_NUMBER), n.cast("string")),
                       F.concat(F.lit(COMMENT_AUTHOR), _s(author)), F.concat(F.lit(COMMENT_UPDATED), _s(updated)),
                       F.concat(F.lit(COMMENT_BODY), _s(body)))


def step_element(n: Column, step: Column, data: Column, result: Column) -> Column:
    """One test step; a missing part leaves an empty element (so the
    blank-line separators stay)."""
    def part(label, c):
        return F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(label), c)).otherwise(F.lit(""))
    return F.concat_ws(SECTION_SEP, F.concat(F.lit(TEST_NUMBER), n.cast("string")),
                       part(TEST_STEP, step), part(TEST_DATA, data), part(TEST_RESULT, result))


def comments_block(comments: DataFrame, issue: str, order: Order, author: str, updated: str,
                   body: str, out: str = "comments_block") -> DataFrame:
    """A1 + O3: one row per issue with its numbered comments block."""
    joined = ordered_concat(
        comments, [issue], order,
        lambda n, g: comment_element(n, g(author), g(updated), g(body)),
        COMMENT_SEP, "_joined", numbered=True, fields=[author, updated, body])
    return joined.select(issue, F.concat(F.lit(COMMENTS_HEAD), F.col("_joined"), F.lit(BLOCK_TAIL)).alias(out))


def steps_block(steps: DataFrame, issue: str, order: Order, step: str, data: str, result: str,
                out: str = "steps_block") -> DataFrame:
    """A2 + O1: one row per issue with its numbered test-step block,
    ordered by orderId (ties broken by the remaining columns)."""
    joined = ordered_concat(
        steps, [issue], order,
        lambda n, g: step_element(n, g(step), g(data), g(result)),
        STEP_SEP, "_joined", numbered=True, fields=[step, data, result])
    return joined.select(issue, F.concat(F.lit(STEPS_HEAD), F.col("_joined"), F.lit(BLOCK_TAIL)).alias(out))


def attach_blocks(issues: DataFrame, key: str, *blocks: tuple[DataFrame, str]) -> DataFrame:
    """J3 + J4: left-join optional blocks (already one row per issue);
    an issue without one gets ''."""
    out = issues
    for df, col in blocks:
        b = df.withColumnRenamed(df.columns[0], "_q_key")
        out = out.join(b, out[key] == b["_q_key"], "left").drop("_q_key").withColumn(
            col, F.coalesce(F.col(col), F.lit("")))
    return out


def epic_summaries(epics: DataFrame, stories: DataFrame, epic_key: str, epic_title: str,
                   story_epic: str, story_key: str, story_title: str, story_updated: str,
                   order: Order, out: str = "body") -> DataFrame:
    """A3 + J5 + C10: an epic document listing its done stories, newest
    update first; epics without stories are dropped (inner join)."""
    listing = ordered_concat(stories, [story_epic], order, _story_line(story_key, story_title, story_updated),
                             "", "_listing")
    e = epics.join(listing, epics[epic_key] == listing[story_epic], "inner")
    head = F.concat(F.lit(EPIC_ID), _s(F.col(epic_key)), F.lit(EPIC_TITLE), _s(F.col(epic_title)),
                    F.lit(EPIC_LISTING))
    return e.withColumn(out, F.concat(head, F.col("_listing"))).drop("_listing", story_epic)


def _story_line(story_key: str, story_title: str, story_updated: str):
    return lambda n, g: F.concat(_s(g(story_key)), F.lit(": "), _s(g(story_title)),
                                 F.lit(STORY_UPDATED), _s(g(story_updated)), F.lit(STORY_END))


def epic_summary_parts(epics: DataFrame, stories: DataFrame, epic_key: str, epic_title: str,
                       story_epic: str, story_key: str, story_title: str, story_updated: str,
                       order: Order, part_bytes: int = PART_BYTES) -> DataFrame:
    """A3 for epics whose listing may outgrow one string value: rows
    (epic key, part, text); part 0 is the header, the others the listing in
    order, of ``part_bytes`` each (see :func:`ordered_parts`). Joined in
    part order they equal :func:`epic_summaries`."""
    own = stories.join(epics.select(F.col(epic_key).alias("_q_epic")), F.col(story_epic) == F.col("_q_epic"), "left_semi")
    listing = ordered_parts(own, [story_epic], order, _story_line(story_key, story_title, story_updated),
                            "", "text", part_bytes=part_bytes)
    with_stories = epics.join(own.select(F.col(story_epic).alias("_q_epic")).distinct(), F.col(epic_key) == F.col("_q_epic"), "left_semi")
    head = with_stories.select(F.col(epic_key), F.lit(0).alias("part"), F.concat(
        F.lit(EPIC_ID), _s(F.col(epic_key)), F.lit(EPIC_TITLE), _s(F.col(epic_title)), F.lit(EPIC_LISTING)).alias("text"))
    body = listing.select(F.col(story_epic).alias(epic_key), "part", "text")
    return head.unionByName(body)


def issue_title(key: Column, title: Column) -> Column:
    """``[KEY] title``."""
    return F.concat(F.lit("["), key, F.lit("] "), _s(title))


def epic_title(key: Column, title: Column) -> Column:
    """``[KEY] Epic: title``."""
    return F.concat(F.lit("["), key, F.lit("] " + EPIC_MARK), _s(title))


def issue_file_name(key: Column) -> Column:
    """P12 for issues: ``jira-cloud <KEY>.html``."""
    return file_name(F.concat_ws(" ", F.lit(SOURCE_PREFIX), key), "html")
