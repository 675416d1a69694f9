"""Main text of web pages.

A page is read into blocks; blocks in menus, headers, footers, sidebars,
notices, adverts, forms and comments are marked by their containers, and
blocks inside an article or main element are the main text. The blocks of
every page, in an article or not, are searched for repeated runs: equal
pages of a host count once, the suffixes of their blocks are sorted by
prefix doubling, and runs that sorted suffixes on a share of the host's
distinct pages begin with are boilerplate. It goes outside articles; an
article's own text and the other tokens stay.

A run consists of words that each are on that share of the pages, so the
frequent words of each host are counted first and suffixes of others are
not sorted. Texts stay in the one table they are written to, unless what
they meet is too large to be sent to every executor.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table

REPEAT = 8                 # tokens of a repeated run, at least
MAIN, OPEN, CHROME, SOFT = 2, 1, 0, -1     # SOFT: chrome that an article or main element inside it ends
SHARE, PAGES = 0.5, 3      # boilerplate of a host is on this share of its distinct pages, and on so many
LEFT = 0.1                 # a page that would keep less than this share of its tokens stays whole
COUNTED = 1 << 19          # counters that a task holds at once
SENT = 100_000             # a table of more values is not sent to every executor

# Elements without text, those of page chrome, and blocks.
_SILENT = frozenset("script style noscript template svg math iframe object canvas head title textarea select".split())
_CHROME = frozenset("nav header footer aside form menu dialog button".split())
_MAIN = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""p div section article main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th thead tbody tfoot caption
blockquote pre figure figcaption br hr body html nav header footer aside form address details summary fieldset""".split())
_CHROME_NAME = frozenset("""nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side widget notice
cookie cookies consent banner alert popup modal ad ads advert adverts advertisement advertising sponsor sponsored promo promotion
comment comments disqus replies respond share sharing social related recommended newsletter subscribe signup login search
pagination skip cookie-notice cookie-banner cookie-consent site-header site-footer page-header page-footer site-navigation
main-navigation main-menu nav-menu share-buttons social-share related-posts comments-area comment-list skip-link""".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_MARK = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(?=/?[a-zA-Z])")
_CLOSED = {"<!--": "-->", "<![CDATA[": "]]>"}
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""")
_NAMED = re.compile(r"""(?i)(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def _named_chrome(attrs: str) -> bool:
    """A whole class token or id names page chrome."""
    return any(name.lower() in ("class", "id") and not _CHROME_NAME.isdisjoint("".join(value).lower().replace("_", "-").split())
               for name, *value in _NAMED.findall(attrs or ""))


def _chrome(tag: str, attrs: str) -> int | None:
    """CHROME for containers that hold no text of the page, SOFT for
    those known by a class, an id or a form, else None."""
    soft = tag == "form"
    if tag in _CHROME and not soft:
        return CHROME
    if attrs and tag not in _MAIN and tag not in ("body", "html"):
        for name, *value in _NAMED.findall(attrs):
            v, name = "".join(value).lower(), name.lower()
            if name == "role" and v in _ROLES or name == "hidden" or name == "aria-hidden" and v == "true":
                return SOFT if name == "role" and v in ("form", "search") else CHROME
        soft = soft or _named_chrome(attrs)
    return SOFT if soft else None


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the blocks of a page in order: MAIN inside an
    article or main element, CHROME in a container that is none of the
    page's text, OPEN elsewhere. Character references are decoded, white
    space inside a block is one space."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    stack: list[tuple[str, int, int]] = []     # (tag, kind, silent)
    opened: Counter[str] = Counter()           # tags on the stack
    kind = silent = at = 0
    kind = OPEN

    def flush() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            if words:
                out.append((max(kind, CHROME), " ".join(words)))
            text.clear()

    page = page or ""
    size, form = len(page), _TAG
    while at < size:
        mark = _MARK.search(page, at)
        start = mark.start() if mark else size
        if not silent and start > at:
            text.append(page[at:start])
        if mark is None:
            break
        if mark[0] != "<":
            end = page.find(_CLOSED.get(mark[0], ">"), mark.end())
            at = size if end < 0 else end + len(_CLOSED.get(mark[0], ">"))
            continue
        m = form.match(page, start)
        if m is None and form is _TAG:
            # a quote stays open to the end of the page: from here on quotes hide no '>'
            form = _LOOSE
            m = form.match(page, start)
        if m is None:                          # no '>' is left, so no tag either
            if not silent:
                text.append(page[start:])
            break
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if tag in _BLOCK:
                flush()
            if opened[tag]:
                flush()
                last = ""
                while last != tag:
                    last, kind, silent = stack.pop()
                    opened[last] -= 1
            continue
        if tag in _BLOCK:
            flush()
        if tag in ("script", "style", "textarea", "title"):
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = end.start() if end else size
        if tag in _VOID or m[3].endswith("/"):
            continue
        if tag in _SILENT or tag in _CHROME or tag in _MAIN or tag in _BLOCK or m[3]:
            mute = silent or tag in _SILENT
            found = None if kind == CHROME else _chrome(tag, m[3])
            new = CHROME if kind == CHROME else MAIN if tag in _MAIN and not (kind == SOFT and any(s[1] == MAIN for s in stack)) \
                else kind if found is None else found
            if tag == "header" and kind == MAIN and not _named_chrome(m[3]):
                new = kind                     # an article's own heading
            if new != kind:
                flush()
            if tag not in _BLOCK and new == kind and mute == silent:
                continue
            if tag in ("p", "li", "br") and new == kind:
                continue
            stack.append((tag, kind, silent))
            opened[tag] += 1
            kind, silent = new, mute
    flush()
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest, held = [], []
        for t in batch.column(2):
            found = [(k == MAIN, x) for k, x in blocks(t.as_py()) if k != CHROME]
            rest.append([x for _, x in found])
            held.append([own for own, _ in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rest, pa.list_(pa.string())),
                                          pa.array(held, pa.list_(pa.bool_()))], names=["page_id", "url", "rest", "held"])


def _counts(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(host, item, n): items are the tokens of blocks and, behind a space,
    blocks of fewer than ``length`` tokens. Part by part of a task's pages,
    an item that less than SHARE of a host's pages there hold is left out;
    a row without an item has the most that this can hide, and n is the
    number of pages above it. So for each host and item the sum of both is
    at least the number of its pages, and it is below SHARE of the host's
    pages for an item that no part returns."""
    def rows(on: dict[str, Counter[str]], pages: Counter[str]) -> Iterator[pa.RecordBatch]:
        for host, counter in on.items():
            most = math.ceil(SHARE * pages[host]) - 1
            items = [(None, most), *((x, n - most) for x, n in counter.items() if n > most)]
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(items), pa.string()), pa.array([x for x, _ in items], pa.string()),
                                              pa.array([n for _, n in items], pa.int64())], names=["host", "item", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on, pages, size = defaultdict(Counter), Counter(), 0
        for batch in batches:
            for host, rest in zip(*(c.to_pylist() for c in batch.columns)):
                items: set[str] = set()
                for block in rest:
                    tokens = block.split()
                    if len(tokens) < length:
                        items.add(" " + block)
                    else:
                        items.update(tokens)
                counter = on[host]
                size -= len(counter)
                counter.update(items)
                size += len(counter)
                pages[host] += 1
                if size >= COUNTED:
                    yield from rows(on, pages)
                    on, pages, size = defaultdict(Counter), Counter(), 0
        yield from rows(on, pages)
    return run


def _symbols(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(rid, host, least, pos, size, word): the tokens of blocks, of size 0,
    where ``length`` of them in a row are items of the host; a block of
    fewer tokens that is an item is one symbol of its size. A place stays
    free after each block, so no run leaves it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, frozenset[str]] = {}
        for batch in batches:
            items = batch.column(4)
            for row, (rid, host, least, rest) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:4]))):
                if host not in known:
                    if len(known) > 100:
                        known.clear()
                    known[host] = frozenset(items[row].as_py())
                hot = known[host]
                places, sizes, words, at = [], [], [], 0
                for block in rest:
                    tokens = block.split()
                    if len(tokens) < length:
                        if " " + block in hot:
                            places.append(at), sizes.append(len(tokens)), words.append(block)
                    else:
                        start = 0
                        for i in (*(i for i, word in enumerate(tokens) if word not in hot), len(tokens)):
                            if i - start >= length:
                                places += range(at + start, at + i)
                                sizes += [0] * (i - start)
                                words += tokens[start:i]
                            start = i + 1
                    at += len(tokens) + 1
                if places:
                    n = len(places)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rid] * n, pa.int64()), pa.array([host] * n, pa.int64()), pa.array([least] * n, pa.int64()),
                         pa.array(places, pa.int32()), pa.array(sizes, pa.int32()), pa.array(words, pa.string())],
                        names=["rid", "host", "least", "pos", "size", "word"])
    return run


def _beside(texts: DataFrame, other: DataFrame, values: int, on: str, how: str) -> DataFrame:
    """``texts`` joined with a table of so many values: a small one goes to
    every executor and the texts stay where they are, a larger one meets
    them in a shuffle."""
    return texts.join(other.hint("broadcast" if values <= SENT else "merge"), on, how)


def _ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with the rank of their ``by`` columns in sorted order, over
    all partitions; values on fewer than ``least`` pages have none, and
    their rows go."""
    names = rows.groupBy(*by, "least").agg(F.count_distinct("rid").alias("on")).where("on >= least").select(*by)
    names = names.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id())
    return rows.join(names.hint("merge"), by)


def suffixes(spark: SparkSession, symbols: DataFrame, repeat: int = REPEAT) -> Iterator[tuple[int, DataFrame]]:
    """Suffix sort by prefix doubling: (length, rows), where rows hold rid,
    least, pos and rank of the suffixes whose first ``length`` tokens are on
    ``least`` pages of their host, and rank is their order by these tokens.

    The ranks at p and p + length give the order by twice the tokens. A
    suffix leaves once its first tokens are on too few pages, as longer
    beginnings are on no more; lengths grow until none is left, so the rounds
    follow the logarithm of the longest run. Each round is one table.
    """
    live, length = symbols, 1
    live = table(spark, _ranked(live.where("size = 0"), ["host", "word"]).select("rid", "least", "pos", "rank"))
    while live.limit(1).count():
        yield length, live
        more = min(length, repeat - length) if length < repeat else length
        ahead = live.select("rid", (F.col("pos") - more).alias("pos"), F.col("rank").alias("next"))
        pairs = live.withColumnRenamed("rank", "head").join(ahead.hint("merge"), ["rid", "pos"])
        live = table(spark, _ranked(pairs, ["head", "next"]).select("rid", "least", "pos", "rank"))
        length += more


def repeated(spark: SparkSession, streams: DataFrame, hosts: DataFrame, repeat: int = REPEAT) -> DataFrame:
    """(rid, pos, size): what is boilerplate of the distinct pages
    ``streams`` (rid, host, rest) of ``hosts`` (host, number, least): from
    each place the longest run found by the suffix sort, ``repeat`` tokens
    at least, or a whole shorter block."""
    counted = table(spark, streams.select("host", "rest").mapInArrow(_counts(repeat), "host string, item string, n long")
                    .groupBy("host", "item").agg(F.sum("n").alias("n")))
    bounds = hosts.join(counted.where("item is null").select("host", F.col("n").alias("most")), "host")
    items = table(spark, counted.where("item is not null").join(bounds, "host").where("n + most >= least")
                  .select("host", "number", "least", "item"))
    by_host = items.groupBy("host", "number", "least").agg(F.collect_list("item").alias("items"))
    symbols = table(spark, _beside(streams, by_host, items.count(), "host", "inner").select("rid", "number", "least", "rest", "items")
                    .mapInArrow(_symbols(repeat), "rid long, host long, least long, pos int, size int, word string"))
    runs = _ranked(symbols.where("size > 0"), ["host", "size", "word"]).select("rid", "pos", "size")
    for length, found in suffixes(spark, symbols, repeat):
        if length >= repeat:
            runs = runs.unionByName(found.select("rid", "pos", F.lit(length).alias("size")))
    return runs.groupBy("rid", "pos").agg(F.max("size").alias("size"))


def _unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        page_id, url, rest, held, at = batch.columns
        text = pc.binary_join(rest, " ").to_pylist()
        for row in np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False)):
            words = [b.split() for b in rest[row].as_py()]
            keep = np.ones(sum(len(w) + 1 for w in words), bool)
            for p in at[row].as_py():
                keep[p["pos"]:p["pos"] + p["size"]] = False
            n = 0
            for w, own in zip(words, held[row].as_py()):
                if own:
                    keep[n:n + len(w)] = True
                n += len(w) + 1
            if keep.sum() - len(words) < LEFT * (len(keep) - len(words)):
                keep[:] = True
            kept, n = [], 0
            for w in words:
                left = [x for x, k in zip(w, keep[n:n + len(w)]) if k]
                n += len(w) + 1
                if left:
                    kept.append(" ".join(left))
            text[row] = " ".join(kept)
        yield pa.RecordBatch.from_arrays([page_id, url, pa.array(text, pa.string())], names=["page_id", "url", "text"])


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", repeat: int = REPEAT) -> DataFrame:
    """page_id, url, text and n_chars of every row.

    Null and empty pages have the empty text. Rows with equal or null ids
    are extracted one by one. Pages without a host share one. A run of
    ``repeat`` tokens of a block, or a shorter block, is boilerplate if at
    least SHARE of the distinct pages of its host, and PAGES of them, hold
    it, in an article or not; it goes where it is outside an article or main
    element. A page of which less than LEFT would stay is kept whole. Other
    columns are not read.
    """
    src = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                       pages[html_col].alias("html"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][\w+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)), F.lit(""))
    stream = F.unhex(F.sha2(F.concat_ws("\n", "host", "rest", F.col("held").cast("array<string>")).cast("binary"), 256))
    found = table(spark, src.mapInArrow(_blocks, "page_id long, url string, rest array<string>, held array<boolean>")
                  .withColumns({"rid": F.monotonically_increasing_id(), "host": host}).withColumn("stream", stream))
    full = found.where("size(rest) > 0")
    firsts = table(spark, full.groupBy("stream").agg(F.min("rid").alias("first"), F.min("host").alias("host")))
    hosts = firsts.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= PAGES)
    hosts = table(spark, hosts.select("host", F.monotonically_increasing_id().alias("number"),
                                      F.greatest(F.lit(PAGES), F.ceil(SHARE * F.col("pages"))).cast("long").alias("least")))
    copies = table(spark, full.select("rid", "stream").join(firsts.select("stream", "first").hint("merge"), "stream")
                   .where("rid <> first").select("rid", "first"))
    streams = _beside(full, copies.select("rid"), copies.count(), "rid", "left_anti").select("rid", "host", "rest")
    runs = table(spark, repeated(spark, streams, hosts, repeat).groupBy("rid").agg(F.collect_list(F.struct("pos", "size")).alias("at")))
    copied = runs.withColumnRenamed("rid", "first").join(copies, "first").select("rid", "at")
    covered = table(spark, runs.unionByName(copied))
    places = covered.agg(F.sum(F.size("at"))).first()[0] or 0
    return (_beside(found, covered, places, "rid", "left").select("page_id", "url", "rest", "held", "at")
            .mapInArrow(_unique, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long")))
