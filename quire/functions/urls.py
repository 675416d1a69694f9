"""URL expressions: canonical identity (P14, P15), wiki / issue links
(P1-P3) and href resolution against a page URL (P17).

Absolute URLs are read as a browser's URL class reads http and https ones:
tabs and line ends go, back slashes are slashes, the host is decoded,
lower-cased and turned into ASCII (Punycode labels, number hosts as four
decimals), the port is a number without the default one, dot segments are
resolved in plain and in encoded form, and every component is
percent-encoded by its own set. A URL that the class would refuse is null.
Hosts are not brought into Unicode normal form, and addresses in brackets
are lower-cased as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import _c

# the wiki page link form that is rewritten under /wiki (JavaScript \w = [A-Za-z0-9_])
_WIKI_PAGE = r"/spaces/\w+/pages/\d+"

# scheme, authority (any number of slashes before it), path, query, fragment
_URL = r"^([A-Za-z][A-Za-z0-9+.\-]*):[/\\]*+([^/\\?#]*+)([^?#]*+)(\?[^#]*+)?(#.*+)?$"
_PORTS = {"http": "80", "https": "443"}
# What a component leaves as it is (a '%' stays, whatever follows).
_PATH_KEPT = r"!$-;=@-_a-z|~%&'\[\]\\^"
_QUERY_KEPT = r"!$-&(-;=?-~"
_FRAGMENT_KEPT = r"!#-;=?-_a-~"
_HOST_REFUSED = r"[\x00-\x20#%/:<>?@\[\\\]^|\x7F\uFFFD]"


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with ``value`` computed once, however often ``of``
    reads it; the expression stays as small as it is written."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def percent_encoded(c: Column, kept: str) -> Column:
    """Characters outside the class ``kept`` as %XX of their UTF-8 bytes."""
    pieces = F.regexp_extract_all(c, F.lit(f"(?s)[{kept}]+|."), F.lit(0))
    return F.when(c.rlike(f"[^{kept}]"), F.array_join(F.transform(
        pieces, lambda p: F.when(p.rlike(f"^[{kept}]"), p).otherwise(F.regexp_replace(F.hex(p), "(..)", "%$1"))), "")).otherwise(c)


def _percent_decoded(c: Column) -> Column:
    """%XX runs as UTF-8 text; malformed bytes become U+FFFD."""
    pieces = F.regexp_extract_all(c, F.lit(r"(?s)(?:%[0-9A-Fa-f]{2})++|[^%]+|%"), F.lit(0))
    return F.when(c.contains("%"), F.array_join(F.transform(pieces, lambda p: F.when(
        p.rlike("^%[0-9A-Fa-f]{2}"), F.make_valid_utf8(F.unhex(F.replace(p, F.lit("%"), F.lit(""))).cast("string"))).otherwise(p)), "")).otherwise(c)


def _digit(v: Column) -> Column:
    return F.char((v + F.when(v < 26, 97).otherwise(22)).cast("long"))


def _variable_length(delta: Column, bias: Column) -> Column:
    """A number in Punycode digits: thresholds grow with the bias."""
    start = F.struct(delta.alias("q"), F.lit("").alias("out"), F.lit(False).alias("done"))

    def step(acc: Column, k: Column) -> Column:
        t = F.greatest(F.lit(1).cast("long"), F.least(F.lit(26).cast("long"), k * 36 - bias))
        last = acc["q"] < t
        more = F.struct(F.expr("0L").alias("q"), F.concat(acc["out"], _digit(acc["q"])).alias("out"), F.lit(True).alias("done"))
        next_ = let(acc["q"] - t, lambda r: F.struct(F.floor(r / (36 - t)).cast("long").alias("q"),
                                                     F.concat(acc["out"], _digit(t + r % (36 - t))).alias("out"), F.lit(False).alias("done")))
        return F.when(acc["done"], acc).when(last, more).otherwise(next_)
    return F.aggregate(F.expr("transform(sequence(1, 12), x -> cast(x AS bigint))"), start, step)["out"]


def _adapted(delta: Column, points: Column, first: Column) -> Column:
    """The bias after a delta."""
    scaled = F.floor(delta / F.when(first, 700).otherwise(2)).cast("long")
    start = let(scaled, lambda s: F.struct((s + F.floor(s / points).cast("long")).alias("d"), F.expr("0L").alias("k")))

    def step(acc: Column, _: Column) -> Column:
        return F.when(acc["d"] > 455, F.struct(F.floor(acc["d"] / 35).cast("long").alias("d"), (acc["k"] + 36).alias("k"))).otherwise(acc)
    return F.aggregate(F.sequence(F.lit(1), F.lit(8)), start, step,
                       lambda a: a["k"] + F.floor(a["d"] * 36 / (a["d"] + 38)).cast("long"))


def punycode(label: Column) -> Column:
    """A label with letters beyond ASCII in Punycode (without ``xn--``).

    The characters beyond ASCII are inserted in the order of (code point,
    position). The number for an insertion is the distance from the state
    after the last one, where a state counts code points times the places
    of the string so far, plus the place."""
    points = F.transform(F.regexp_extract_all(label, F.lit("(?s)."), F.lit(0)), lambda c: F.ascii(c).cast("long"))
    placed = F.transform(points, lambda p, i: F.struct(p.alias("p"), i.alias("i")))
    wide = F.array_sort(F.filter(placed, lambda x: x["p"] >= 128))
    plain = F.regexp_replace(label, r"[^\x00-\x7F]", "")
    number = lambda v: F.lit(v).cast("long")

    def insert(all_: Column) -> Callable[[Column, Column], Column]:
        def step(acc: Column, x: Column) -> Column:
            # characters before this one that are in the string already
            place = F.size(F.filter(all_, lambda y: (y["i"] < x["i"]) & (y["p"] <= x["p"]))).cast("long")
            delta = (x["p"] - acc["n"]) * (acc["h"] + 1) + place - acc["i"]
            return let(F.struct(delta.alias("d"), place.alias("i")), lambda v: F.struct(
                F.concat(acc["out"], _variable_length(v["d"], acc["bias"])).alias("out"), x["p"].alias("n"), (v["i"] + 1).alias("i"),
                (acc["h"] + 1).alias("h"), _adapted(v["d"], acc["h"] + 1, acc["first"]).alias("bias"), F.lit(False).alias("first")))
        return step
    start = F.struct(F.concat(plain, F.when(plain == "", "").otherwise("-")).alias("out"), number(128).alias("n"), number(0).alias("i"),
                     F.length(plain).cast("long").alias("h"), number(72).alias("bias"), F.lit(True).alias("first"))
    return let(placed, lambda all_: F.aggregate(wide, start, insert(all_))["out"])


def _number(part: Column) -> Column:
    """A part of a number host: hexadecimal, octal or decimal, else null."""
    digits = F.when(part.rlike("^0[xX][0-9a-fA-F]*$"), F.struct(F.substring(part, 3, 20).alias("d"), F.lit(16).alias("b"))).when(
        part.rlike("^0[0-7]+$"), F.struct(F.substring(part, 2, 20).alias("d"), F.lit(8).alias("b"))).when(
        part.rlike("^(?:0|[1-9][0-9]{0,18})$"), F.struct(part.alias("d"), F.lit(10).alias("b")))
    value = lambda v, base: F.conv(F.when(v["d"] == "", F.lit("0")).otherwise(v["d"]), base, 10).try_cast("decimal(20,0)")
    return let(digits, lambda v: F.when(v["b"] == 16, value(v, 16)).when(v["b"] == 8, value(v, 8)).otherwise(value(v, 10)))


def _four_decimals(host: Column) -> Column:
    """A host whose last part is a number as four decimals; null if it is
    no address."""
    parts = F.transform(F.split(F.regexp_replace(host, r"\.$", ""), r"\."), _number)

    def address(p: Column) -> Column:
        n = F.size(p)
        ok = (n <= 4) & ~F.exists(p, lambda x: x.isNull()) & ~F.exists(F.slice(p, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda x: x > 255)
        high = F.aggregate(F.transform(F.slice(p, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda x, i: x.cast("long") * F.pow(F.lit(256), 3 - i).cast("long")),
                           F.lit(0).cast("long"), lambda a, x: a + x)
        fits = F.element_at(p, -1) < F.pow(F.lit(256), 5 - n).cast("decimal(20,0)")
        return F.when(ok, F.when(fits, let(high + F.element_at(p, -1).cast("long"), lambda v: F.concat_ws(
            ".", *[F.shiftright(v, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]))))
    return let(parts, address)


def _host(raw: Column) -> Column:
    """The host in ASCII; null if it is empty or holds a refused character."""
    def ascii_(h: Column) -> Column:
        labels = F.split(F.lower(h), "[.\u3002\uff0e\uff61]")
        named = F.when(h.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(
            labels, lambda x: F.when(x.rlike(r"[^\x00-\x7F]"), F.concat(F.lit("xn--"), punycode(x))).otherwise(x)), ".")).otherwise(F.lower(h))
        checked = let(named, lambda x: F.when(h.rlike(_HOST_REFUSED) | (x == ""), F.lit(None).cast("string"))
                      .when(x.rlike(r"(?:^|\.)(?:[0-9]+|0x[0-9a-f]*)\.?$"), _four_decimals(x)).otherwise(x))
        return F.when(h.rlike(r"^\[[0-9A-Fa-f:.]+\]$"), F.lower(h)).otherwise(checked)
    return let(_percent_decoded(raw), ascii_)


def _path(raw: Column) -> Column:
    """The path with slashes only, encoded, without dot segments."""
    def resolved(p: Column) -> Column:
        segs = F.split(F.substring(p, 2, 2**31 - 1), "/")
        one, two = "^(?:[.]|%2[eE])$", "^(?:[.]|%2[eE]){2}$"
        clean = let(segs, lambda s: let(F.aggregate(
            s, F.array().cast("array<string>"),
            lambda acc, x: F.when(x.rlike(two), F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(x.rlike(one), acc)
            .otherwise(F.array_append(acc, x))), lambda kept: F.concat(F.lit("/"), F.array_join(
                F.when(F.element_at(s, -1).rlike(f"{one}|{two}"), F.array_append(kept, F.lit(""))).otherwise(kept), "/"))))
        return F.when(p.rlike("(?i)/(?:[.]|%2e){1,2}(?:/|$)"), clean).otherwise(p)
    slashed = F.translate(F.when(raw == "", F.lit("/")).otherwise(raw), "\\", "/")
    return let(percent_encoded(slashed, _PATH_KEPT), resolved)


def _stripped(url: Column) -> Column:
    """Without control characters and blanks around it, and without tabs
    and line ends anywhere."""
    bare = F.when(url.rlike(r"[\t\n\r]"), F.regexp_replace(url, r"[\t\n\r]", "")).otherwise(url)
    return F.when(url.rlike(r"^[\x00-\x20]|[\x00-\x20]$|[\t\n\r]"),
                  F.regexp_replace(bare, r"^[\x00-\x20]+|(?<![\x00-\x20])[\x00-\x20]+$", "")).otherwise(url)


def _parsed(url: Column) -> Column:
    """(origin, path, query, fragment) of a stripped absolute http(s) URL;
    origin is null if the URL is none or would be refused."""
    group = lambda n: F.regexp_extract(url, f"(?s){_URL}", n)
    authority = F.regexp_replace(group(2), "(?s)^.*@", "")

    def read(a: Column) -> Column:
        scheme = F.lower(group(1))
        port = F.regexp_extract(a, r"(?s):([^:\]]*)$", 1)
        number = F.regexp_replace(port, "^0+(?=[0-9])", "")
        default = F.when(scheme == "http", _PORTS["http"]).otherwise(_PORTS["https"])
        shown = (F.when((port == "") | (number == default), F.lit("")).when(
            number.rlike("^[0-9]{1,5}$") & (number.try_cast("int") <= 65535), F.concat(F.lit(":"), number)))
        host = _host(F.regexp_replace(a, r"(?s):[^:\]]*$", ""))
        origin = F.when(scheme.isin(*_PORTS), F.concat(scheme, F.lit("://"), host, shown))
        return F.struct(origin.alias("origin"), _path(group(3)).alias("path"), group(4).alias("query"), group(5).alias("fragment"))
    return let(authority, read)


def normalize_url(url) -> Column:
    """Origin + pathname of a URL, null for what is no http(s) URL."""
    return let(_stripped(_c(url)), lambda u: let(_parsed(u), lambda p: F.concat(p["origin"], p["path"])))


def url_id(url) -> Column:
    """Document id of a web page = md5 hex of its normalised URL."""
    return F.md5(normalize_url(url))


def wiki_page_url(base: str, link) -> Column:
    """A page link containing /pages/ and the /spaces/<key>/pages/<id>
    form is rewritten to /wiki + that part; any other link stays raw;
    a missing link is ''."""
    link = F.coalesce(_c(link), F.lit(""))
    rewritten = F.concat(F.lit("/wiki"), F.regexp_extract(link, _WIKI_PAGE, 0))
    use = link.contains("/pages/") & link.rlike(_WIKI_PAGE)
    return F.concat(F.lit(base), F.when(use, rewritten).otherwise(link))


def attachment_url(base: str, link) -> Column:
    """Attachment web / download URL."""
    return F.concat(F.lit(base), F.lit("/wiki"), _c(link))


def issue_url(base: str, key) -> Column:
    """Issue URL = base + /browse/ + key."""
    return F.concat(F.lit(base), F.lit("/browse/"), _c(key))


def _whole(p: Column) -> Column:
    """The text of a parsed URL with query and fragment; a lone '?' or '#' stays."""
    return F.concat(p["origin"], p["path"], percent_encoded(p["query"], _QUERY_KEPT), percent_encoded(p["fragment"], _FRAGMENT_KEPT))


def _joined(h: Column, b: Column) -> Column:
    """A stripped href as an absolute URL beside the parsed page URL."""
    scheme = F.regexp_extract(b["origin"], "^[a-z]+:", 0)
    folder = F.regexp_extract(b["path"], "(?s)^(.*/)", 1)
    relative = (F.when(h.rlike(r"^[/\\]{2}"), F.concat(scheme, h)).when(h.rlike(r"^[/\\]"), F.concat(b["origin"], h))
                .when(h.startswith("?"), F.concat(b["origin"], b["path"], h)).otherwise(F.concat(b["origin"], folder, h)))
    # a scheme without slashes: the page's own one is no scheme, another one is
    same = F.lower(F.regexp_extract(h, r"(?s)^(https?:)(?![/\\])", 1))
    return (F.when((h == "") | h.startswith("#"), F.lit(None).cast("string"))
            .when(h.rlike("(?i)^https?:"), F.when((same != "") & (same == scheme), F.concat(
                b["origin"], folder, F.regexp_replace(h, "(?i)^https?:", ""))).otherwise(h))
            .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None).cast("string")).otherwise(relative))


def resolve_hrefs(hrefs, base_url) -> Column:
    """The hrefs of a page resolved against its URL: an array of
    (link, norm) in their order, norm being the link's origin + pathname.

    Absolute http(s) links are made canonical, ``//host`` takes the page
    scheme, ``/path`` the page origin, ``?q`` the page path, relative paths
    the page directory. Fragment-only, empty, refused and non-http(s) links
    give NULL in both.
    """
    def both(p: Column) -> Column:
        return F.struct(_whole(p).alias("link"), F.concat(p["origin"], p["path"]).alias("norm"))

    def one(b: Column) -> Callable[[Column], Column]:
        return lambda h: let(_stripped(h), lambda s: let(_joined(s, b), lambda x: let(_parsed(x), both)))
    return let(_stripped(_c(base_url)), lambda u: let(_parsed(u), lambda b: F.transform(_c(hrefs), one(b))))


def resolve_href(href, base_url) -> Column:
    """One href resolved (see :func:`resolve_hrefs`)."""
    return F.get(resolve_hrefs(F.array(_c(href)), base_url), F.lit(0))["link"]
