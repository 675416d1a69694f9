"""File-name and text helpers (P9-P13, number rendering)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The output file-name rules.
MAX_FILE_NAME = 255
# characters that may not appear in a file name: < > : " / \ | ? * and C0 controls
_FORBIDDEN = r'<>:"/\\|?*\x00-\x1f'
# JavaScript white space + line terminators (String.prototype.trim); Java's
# \s and Spark's trim() only know ASCII white space.
JS_WS_CHARS = ("\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000\ufeff")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_spaces(c) -> Column:
    """Runs of blanks / no-break spaces become one blank (P10)."""
    return F.regexp_replace(_c(c), r"[ \xA0]+", " ")


def sanitize_filename(c) -> Column:
    """Forbidden characters -> blank, leading and trailing dot runs ->
    blank, blank runs collapsed, JS-style trim.

    One pass over the text: blanks at the ends go anyway, so dots there
    are trimmed first, and a run of forbidden characters and blanks is one
    blank (a lone blank is left alone)."""
    s = F.regexp_replace(F.btrim(_c(c), F.lit(".")), rf"[{_FORBIDDEN}\xA0][{_FORBIDDEN}\xA0 ]*+| [{_FORBIDDEN}\xA0 ]++", " ")
    return F.btrim(s, F.lit(JS_WS_CHARS))


def truncate_filename(full) -> Column:
    """Keep at most 255 characters (code points), keeping the text
    after the last dot as extension."""
    full = _c(full)
    ext = F.substring_index(full, ".", -1)
    keep = F.lit(MAX_FILE_NAME) - F.char_length(ext) - F.lit(1)
    cut = F.concat(F.substr(full, F.lit(1), keep), F.lit("."), ext)
    return F.when(F.char_length(full) > MAX_FILE_NAME, cut).otherwise(full)


def file_name(stem, ext: str | Column) -> Column:
    """sanitise(stem) + '.' + ext, then truncate to 255."""
    ext_c = F.lit(ext) if isinstance(ext, str) else ext
    return truncate_filename(F.concat(sanitize_filename(stem), F.lit("."), ext_c))


def basename(c) -> Column:
    """Last '/'-separated segment of a path or URI."""
    return F.substring_index(_c(c), "/", -1)


def js_number(c) -> Column:
    """Render a double the way JavaScript prints it for integral values
    (3.0 -> '3', 2.5 -> '2.5', 1.2E7 -> '12000000')."""
    s = _c(c).cast("string")
    plain = F.regexp_replace(_c(c).try_cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    return F.when(s.contains("E"), F.coalesce(plain, s)).otherwise(F.regexp_replace(s, r"\.0$", ""))
