"""quire: corpus preparation for search / RAG on Spark.

Landed snapshots of wiki spaces and pages, issue-tracker records with
comments and test steps, and raw web pages are turned into one document
plus one metadata record each, then published as NDJSON / Parquet
snapshots with an insert / update / delete diff against the previous run.

Every operator is a ``DataFrame -> DataFrame`` function (usable through
``DataFrame.transform``) built from Spark SQL expressions, so Catalyst
plans, prunes and pushes down the whole job.

Main entry points::

    from quire import run_targets, publish_snapshot          # whole runs
    from quire import wiki_corpus, issue_corpus, epic_summary_corpus, web_corpus
    from quire import closure, bounded_crawl                 # graph loops
    from quire import number_rows, ordered_concat, latest_by, first_by
"""

__version__ = "0.1.0"

_EXPORTS = {
    "run_targets": "quire.plans.corpus", "wiki_corpus": "quire.plans.corpus",
    "issue_corpus": "quire.plans.corpus", "epic_summary_corpus": "quire.plans.corpus",
    "web_corpus": "quire.plans.corpus", "publish_snapshot": "quire.plans.publish",
    "snapshot_diff": "quire.plans.publish", "closure": "quire.plans.graph", "bounded_crawl": "quire.plans.graph",
    "number_rows": "quire.operators.ordering", "ordered_concat": "quire.operators.ordering",
    "latest_by": "quire.operators.dedupe", "first_by": "quire.operators.dedupe",
}


def __getattr__(name):  # lazy, so importing quire does not import pyspark modules eagerly
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
