"""HTML without a DOM: tags, <title> text, anchors.

Pages are read tag by tag: quoted attribute values may hold '<' and '>',
comments, scripts and other raw elements hold no markup, and an unclosed
one runs to the end of the page. Every scan moves on after a match and
every repeated group is possessive, so pages of any length take time in
proportion and no nesting.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import _c

# Elements whose content is text up to their end tag.
_RAW = "script|style|textarea|xmp|iframe|noembed|noframes"
# one attribute: a name, and maybe a quoted or a plain value
_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s>"'][^\s>]*+)?+)?+"""
_ATTRIBUTES = rf"(?:[\s/]++|{_ATTRIBUTE})*+"
_COMMENT = r"<!--.*?(?:-->|\z)|<[!?][^>]*+(?:>|\z)"
_RAW_ELEMENT = rf"<(?<raw>{_RAW})(?=[\s/>]){_ATTRIBUTES}(?:\z|>.*?(?:</\k<raw>(?=[\s/>])|\z))"
_TITLE_ELEMENT = rf"<title(?=[\s/>]){_ATTRIBUTES}>(.*?)(?:</title(?=[\s/>])|\z)"
_OTHER = rf"</?[a-z][^\s/>]*+{_ATTRIBUTES}(?:>|\z)"
# group 2: the first title element, behind whatever else there is
_FIRST_TITLE = rf"(?is)\A(?:[^<]++|{_COMMENT}|{_RAW_ELEMENT}|(?!<title[\s/>])(?:{_OTHER}|<))*+{_TITLE_ELEMENT}"
# group 2: the attributes of a closed anchor tag
_ANCHORS = rf"(?is){_COMMENT}|{_RAW_ELEMENT}|{_TITLE_ELEMENT.replace('(.*?)', '.*?')}|<a(?=[\s/>])({_ATTRIBUTES})>|{_OTHER}"
_HREF = rf"""(?is)\A(?:[\s/]++|(?!href[\s=/>]){_ATTRIBUTE})*+href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""

# The attachment marker of wiki storage bodies, the title of a
# page without <title>.
_ATTACHMENT_REF = r'<ri:attachment ri:filename="([^"]+)"'
NO_TITLE = "No title"

# named references: the whole table of the standard library; the old ones may lack the ';'
_NAMES = json.dumps({n[:-1]: c for n, c in html5.items() if n.endswith(";")})
_OLD = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
# code points 128-159 are read as windows-1252
_C1 = json.dumps({str(c): bytes([c]).decode("cp1252") for c in range(128, 160) if c not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)})
_REFERENCE = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*+[;=]?|[^&]++|&"


def _table(text: str) -> Column:
    return F.from_json(F.lit(text), "map<string,string>")


def decode_entities(c, attribute: bool = False) -> Column:
    """Character references to characters in one pass (what a reference
    gives is not read again). A name is looked up with its ``;``, else its
    longest prefix among the old names that need none is taken; in an
    ``attribute`` such a prefix stays as it is before '=', a letter or a
    digit. Numeric ones may have any number of digits and lack the ``;``;
    a code point that is 0, a surrogate or above U+10FFFF becomes U+FFFD."""
    s = _c(c)

    def number(t):
        digits = F.regexp_extract(t, r"^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
        small = F.when((F.length(digits) > 0) & (F.length(digits) <= 8), digits)
        cp = F.when(t.rlike("^&#[xX]"), F.conv(small, 16, 10)).otherwise(small).cast("bigint")
        valid = (cp >= 1) & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
        return F.when(cp.between(128, 159), F.coalesce(F.element_at(_table(_C1), cp.cast("string")), F.chr(cp))).when(
            valid, F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")).otherwise(F.lit("�"))

    def named(t):
        whole = F.element_at(_table(_NAMES), F.regexp_extract(t, "^&([A-Za-z0-9]+);$", 1))
        old = F.regexp_extract(t, f"^&({_OLD})", 1)
        rest = F.substr(t, F.length(old) + 2, F.length(t))
        kept = (old == "") | (rest.rlike("^[=A-Za-z0-9]") if attribute else F.lit(False))
        return F.coalesce(whole, F.when(kept, t).otherwise(F.concat(F.element_at(_table(_NAMES), old), rest)), t)

    def one(t):
        return F.when(~t.startswith("&") | (t == "&"), t).when(t == "&amp;", "&").when(t.startswith("&#"), number(t)).otherwise(named(t))
    tokens = F.regexp_extract_all(s, F.lit(_REFERENCE), F.lit(0))
    return F.when(s.contains("&"), F.array_join(F.transform(tokens, one), "")).otherwise(s)


def page_title(html) -> Column:
    """Text of the first <title> element (an unclosed one runs to the
    end of the page), entity-decoded and not trimmed; 'No title' when the
    page has none."""
    found = F.regexp_extract_all(_c(html), F.lit(_FIRST_TITLE), F.lit(2))
    return F.when(F.size(found) > 0, decode_entities(F.get(found, F.lit(0)))).otherwise(F.when(_c(html).isNotNull(), NO_TITLE))


def href_list(html) -> Column:
    """P17 (first half): every anchor href of the page, in document order,
    duplicates kept, entity-decoded. The first href of a tag counts."""
    tags = F.filter(F.regexp_extract_all(_c(html), F.lit(_ANCHORS), F.lit(2)), lambda a: a != "")
    raw = F.filter(F.transform(tags, lambda a: F.regexp_extract(a, _HREF, 1)), lambda h: h != "")
    return F.transform(raw, lambda h: decode_entities(F.regexp_replace(h, r"""(?s)^(["'])(.*)\1$""", "$2"), attribute=True))


def attachment_refs(body) -> Column:
    """File names referenced by attachment markers in a storage body
    (still HTML-escaped, as the body holds them)."""
    return F.regexp_extract_all(_c(body), F.lit(_ATTACHMENT_REF), F.lit(1))
