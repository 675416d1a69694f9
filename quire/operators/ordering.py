"""Ordered numbering and ordered string aggregation that never send a
whole key group to one task.

Rows are range-partitioned on (keys, order), so a hot key spans several
contiguous range slices. Numbering fixes the slices once (a table in the
shared checkpoint folder); the rows stay rows: their counts per (key,
slice) are summed over the earlier slices -- a window over counts only --
and joined back. Strings are joined per slice, then in slice order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.filters import BROADCAST_MAX_ROWS
from quire.session import shared_table

GROUP_ROWS = 10_000            # rows of a key that one aggregate joins; more are split over slices
PART_BYTES = 64 << 20          # bytes of one part of an ordered document

Order = Sequence[tuple[str, bool]]  # (column, ascending)
Getter = Callable[[str], Column]

_PART, _LOCAL, _FIRST, _N, _OFF, _SLICE, _RN = ("_q_part", "_q_local", "_q_first", "_q_n", "_q_off", "_q_slice", "_q_rn")


def sort_cols(order: Order) -> list[Column]:
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order]


def _order_sql(order: Order) -> str:
    return ", ".join(f"`{c}` {'ASC NULLS FIRST' if asc else 'DESC NULLS LAST'}" for c, asc in order)


def sql_literal(s: str) -> str:
    """A Spark SQL string literal holding ``s`` exactly."""
    esc = (s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
           .replace("\r", "\\r").replace("\t", "\\t"))
    return f"'{esc}'"


def _partitions(df: DataFrame, parts: int | None) -> int:
    return parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _range_slices(df: DataFrame, keys: Sequence[str], order: Order, parts: int | None) -> DataFrame:
    """Range-partition on (keys, order); each partition is one run of
    slices, sorted in place, with its partition id and a position that
    grows in sort order (monotonically_increasing_id after the sort)."""
    sort = [F.col(k).asc_nulls_first() for k in keys] + sort_cols(order)
    return (df.repartitionByRange(_partitions(df, parts), *sort).sortWithinPartitions(*sort)
            .withColumn(_PART, F.spark_partition_id()).withColumn(_LOCAL, F.monotonically_increasing_id()))


def _numbered(df: DataFrame, keys: Sequence[str], order: Order, out: str, parts: int | None) -> DataFrame:
    """``df`` with its slice and ``out``, the 1-based position in the key
    group. The only rows that meet by key are counts of slices."""
    t = shared_table(df.sparkSession, _range_slices(df, keys, order, parts))
    counts = t.groupBy(*keys, _PART).agg(F.count(F.lit(1)).alias(_N), F.min(_LOCAL).alias(_FIRST))
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(k).alias(f"_q_k{i}") for i, k in enumerate(keys)], F.col(_PART).alias("_q_p"), _FIRST,
                            F.coalesce(F.sum(_N).over(earlier), F.lit(0)).alias(_OFF))
    same = F.col(_PART) == F.col("_q_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_q_k{i}"))
    return t.join(offsets, same).select(
        *df.columns, _PART, (F.col(_OFF) + F.col(_LOCAL) - F.col(_FIRST) + F.lit(1)).cast("long").alias(out))


def number_rows(df: DataFrame, keys: Sequence[str], order: Order, out: str = "rn",
                parts: int | None = None) -> DataFrame:
    """1-based position of each row inside its key group (``keys`` may be
    empty: one global numbering). ``order`` must be a total order."""
    rest = [c for c in df.columns if c not in keys]
    return _numbered(df, keys, order, out, parts).select(*keys, *rest, out)


def _slices_text(df: DataFrame, keys: Sequence[str], order: Order,
                 render: Callable[[Column | None, Getter], Column], sep: str,
                 numbered: bool, fields: Sequence[str], parts: int | None) -> DataFrame:
    """(keys, slice id, slice text): each range slice of a key rendered and
    joined in order on its own task."""
    sep_sql = sql_literal(sep)
    if numbered:
        pieces = _numbered(df, keys, order, _RN, parts).withColumn("_q_piece", render(F.col(_RN), F.col))
        return pieces.groupBy(*keys, _PART).agg(
            F.expr(f"listagg(_q_piece, {sep_sql}) WITHIN GROUP (ORDER BY {_RN} ASC)").alias(_SLICE))
    sort = [F.col(k).asc_nulls_first() for k in keys] + sort_cols(order)
    parted = df.repartitionByRange(_partitions(df, parts), *sort).withColumn(_PART, F.spark_partition_id())
    pieces = parted.withColumn("_q_piece", render(None, F.col))
    return pieces.groupBy(*keys, _PART).agg(
        F.expr(f"listagg(_q_piece, {sep_sql}) WITHIN GROUP (ORDER BY {_order_sql(order)})").alias(_SLICE))


def _null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & a[k].eqNullSafe(b[k])
    return same


def hot_keys(df: DataFrame, keys: Sequence[str], most: int = GROUP_ROWS) -> DataFrame | None:
    """The keys with more than ``most`` rows, written once; None if there
    are none. Counts are summed before the shuffle."""
    found = shared_table(df.sparkSession, df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_N)).where(F.col(_N) > most).select(*keys))
    return found if found.limit(1).count() else None


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Order, sums: Mapping[str, Column],
                following: Mapping[str, str] | None = None, parts: int | None = None) -> DataFrame:
    """``df`` with, for each name of ``sums``, the sum of that (non-null)
    value over the earlier rows of the same key, and for each name of
    ``following`` the value of that column in the next row (null in the
    last). Two levels: sums inside range slices of (key, order), and sums
    of whole slices, so a key of any size is spread over its slices. The
    result does not depend on the number of slices if ``order`` is total.
    """
    following = following or {}
    names = {out: f"_q_v{i}" for i, out in enumerate(sums)}
    t = shared_table(df.sparkSession, _range_slices(df.withColumns({names[out]: v for out, v in sums.items()}), keys, order, parts))
    stats = t.groupBy(*keys, _PART).agg(
        F.min(_LOCAL).alias(_FIRST), *[F.sum(v).alias(f"{v}s") for v in names.values()],
        *[F.min_by(c, _LOCAL).alias(f"_q_f{i}") for i, c in enumerate(following.values())])
    by_slice = Window.partitionBy(*keys).orderBy(_PART)
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    above = stats.select(*keys, _PART, *[F.coalesce(F.sum(f"{v}s").over(earlier), F.lit(0)).alias(f"{v}s") for v in names.values()],
                         *[F.lead(f"_q_f{i}").over(by_slice).alias(f"_q_f{i}") for i in range(len(following))])
    within = Window.partitionBy(*keys, _PART).orderBy(_LOCAL)
    before, last = within.rowsBetween(Window.unboundedPreceding, -1), F.lead(F.lit(1)).over(within).isNull()
    local = t.select("*", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"{v}l") for v in names.values()],
                     *[F.lead(c).over(within).alias(f"_q_n{i}") for i, c in enumerate(following.values())], last.alias("_q_last"))
    joined = local.join(above, _null_safe(local, above, [*keys, _PART]))
    return joined.select(
        *[local[c] for c in df.columns], *[(local[f"{v}l"] + above[f"{v}s"]).alias(out) for out, v in names.items()],
        *[F.when(local["_q_last"], above[f"_q_f{i}"]).otherwise(local[f"_q_n{i}"]).alias(out) for i, out in enumerate(following)])


def ordered_concat(df: DataFrame, keys: Sequence[str], order: Order,
                   render: Callable[[Column | None, Getter], Column], sep: str, out: str,
                   numbered: bool = False, fields: Sequence[str] = (),
                   parts: int | None = None) -> DataFrame:
    """One row per key: ``render(n, get)`` of every row, in ``order``,
    joined by ``sep``. ``get(name)`` returns a column of the row; ``n`` is
    its 1-based position when ``numbered`` (then ``fields`` lists the
    columns ``render`` reads), else None. ``render`` must not return NULL
    (a NULL piece is skipped, as by ``listagg``). NULL keys form one group;
    NULL order values sort first ascending and last descending. Keys of at
    most ``GROUP_ROWS`` rows are one aggregate; larger ones are built from
    range slices, with the same result."""
    def sliced(rows: DataFrame) -> DataFrame:
        return _slices_text(rows, keys, order, render, sep, numbered, fields, parts).groupBy(*keys).agg(
            F.expr(f"listagg({_SLICE}, {sql_literal(sep)}) WITHIN GROUP (ORDER BY {_PART} ASC)").alias(out))

    hot = hot_keys(df, keys, GROUP_ROWS) if keys else None
    if not keys:
        return sliced(df)
    small = df if hot is None else df.join(F.broadcast(hot) if hot.count() <= BROADCAST_MAX_ROWS else hot, _null_safe(df, hot, keys), "left_anti")
    if numbered:
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort_cols(order))).cast("long")
        by = f"{_RN} ASC"
        small = small.withColumn(_RN, number)
        small = small.withColumn("_q_piece", render(F.col(_RN), F.col))
    else:
        by = _order_sql(order)
        small = small.withColumn("_q_piece", render(None, F.col))
    joined = small.groupBy(*keys).agg(F.expr(f"listagg(_q_piece, {sql_literal(sep)}) WITHIN GROUP (ORDER BY {by})").alias(out))
    if hot is None:
        return joined
    large = df.join(hot, _null_safe(df, hot, keys), "left_semi")
    return joined.unionByName(sliced(large))


def ordered_parts(df: DataFrame, keys: Sequence[str], order: Order,
                  render: Callable[[Column | None, Getter], Column], sep: str, out: str = "text",
                  numbered: bool = False, fields: Sequence[str] = (),
                  parts: int | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Like :func:`ordered_concat`, for outputs that may outgrow one string
    value (Spark strings stop near 2 GB; a key holding a third of 100 TB
    would): one row per (key, part) in order. The document is the parts
    joined by ``sep`` in part order.

    A piece belongs to part ``1 + offset div part_bytes``, where its offset
    is the number of bytes (pieces and separators) before it, so a part
    holds at most ``part_bytes`` bytes and one piece, whatever the number
    of partitions; a piece larger than that leaves part numbers out."""
    if numbered:
        pieces = _numbered(df, keys, order, _RN, parts).drop(_PART).withColumn("_q_piece", render(F.col(_RN), F.col))
    else:
        pieces = df.withColumn("_q_piece", render(None, F.col))
    named = list(dict.fromkeys([*keys, *[c for c, _ in order], "_q_piece"]))
    size = F.octet_length("_q_piece").cast("long") + len(sep.encode())
    placed = prefix_sums(pieces.select(*named).where(F.col("_q_piece").isNotNull()), keys, order, {_OFF: size}, parts=parts)
    part = (F.expr(f"{_OFF} div {int(part_bytes)}") + 1).cast("int").alias("part")
    return placed.withColumn("part", part).groupBy(*keys, "part").agg(
        F.expr(f"listagg(_q_piece, {sql_literal(sep)}) WITHIN GROUP (ORDER BY {_OFF} ASC)").alias(out))
