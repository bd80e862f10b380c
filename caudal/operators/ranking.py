"""Exact global ranks without a one-task sort.

Rows are cut into key ranges, one task each; the rank of a row is the number of rows in earlier ranges
plus its place in its own. What crosses tasks is one count per range, and the number of ranges is the
session's shuffle parallelism, whatever the data size.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import Window
from pyspark.sql import functions as F

from caudal.session import materialise, slice_count

SLICE = "_slice"
PLACE = "_place"
TIE = "_tie"
ENDS = "_ends"

# The low bits of a monotonically increasing id count the rows of its task.
ROW_BITS = 33


def range_slices(df: DataFrame, order_by: Sequence[str], slices: int | None = None) -> DataFrame:
    """``df`` written out in ``slices`` sorted key ranges, with the range number in ``_slice`` and the
    1-based place within the range in ``_place``. One shuffle: a sorted task numbers its own rows."""
    n = slices or slice_count(df.sparkSession)
    row = F.monotonically_increasing_id()
    # Past 2^33 rows in a slice the id runs into the next slice's: an error, never a wrong rank.
    row_of_task = F.when(
        F.shiftright(row, ROW_BITS) == F.spark_partition_id(), row.bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    ).otherwise(F.raise_error(F.lit("a slice has too many rows: raise `slices`")).cast("long"))
    return materialise(
        df.repartitionByRange(n, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumns({SLICE: F.spark_partition_id(), PLACE: row_of_task + 1})
    )


def slice_offsets(sliced: DataFrame) -> DataFrame:
    """Per range: its row count, and the rows before it. At most one row per range."""
    counts = sliced.groupBy(SLICE).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long")))


def with_row_number(df: DataFrame, order_by: Sequence[str], name: str, slices: int | None = None) -> DataFrame:
    """Add the 1-based global rank under ``order_by`` (NULLs first), which should be a unique key."""
    sliced = range_slices(df, order_by, slices)
    offsets = F.broadcast(slice_offsets(sliced).select(SLICE, "before"))
    return sliced.join(offsets, SLICE).withColumn(name, F.col("before") + F.col(PLACE)).select(*df.columns, name)


def _last_ranks(rows: Column, tiles: int) -> Column:
    """The last rank of each tile but the final one: the first ``rows % tiles`` tiles hold one more."""
    small = F.floor(rows / tiles)
    extra = rows % tiles
    return F.array(*(small * t + F.least(F.lit(t).cast("long"), extra) for t in range(1, tiles)))


def tile_bounds(keys: DataFrame, order_by: Sequence[str], tiles: int, slices: int | None = None) -> DataFrame:
    """``tiles - 1`` rows ``(tile, bound)``: the exact key that closes each tile but the last."""
    sliced = range_slices(keys.select(*order_by), order_by, slices)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = (
        slice_offsets(sliced)
        .withColumn("total", F.sum("rows").over(everything))
        .select(SLICE, "before", "rows", F.posexplode(_last_ranks(F.col("total"), tiles)).alias("tile", "rank"))
        .where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("rows")))
        .select((F.col("tile") + 1).alias("tile"), SLICE, (F.col("rank") - F.col("before")).alias(PLACE))
    )
    return sliced.join(F.broadcast(wanted), [SLICE, PLACE]).select("tile", F.struct(*order_by).alias("bound"))


def _range_bounds(stored: DataFrame, keys: Sequence[str], tiles: int, times: str, slices: int | None) -> DataFrame:
    """``(tile, bound, cut)``: the key that closes each tile but the last, and how many of its copies still belong to it.

    Keys are cut into ranges, a sum per range tells which ranges hold a tile's last row, and only those are sorted."""
    n = slices or slice_count(stored.sparkSession)
    sliced = materialise(
        stored.select(*keys, times).repartitionByRange(n, *keys).withColumn(SLICE, F.spark_partition_id())
    )
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = (
        sliced.groupBy(SLICE)
        .agg(F.sum(times).alias("rows"))
        .withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long")))
        .withColumn("total", F.sum("rows").over(everything))
        .select(SLICE, "before", "rows", F.posexplode(_last_ranks(F.col("total"), tiles)).alias("tile", "rank"))
        .where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("rows")))
        .groupBy(SLICE)
        .agg(F.collect_list(F.struct((F.col("tile") + 1).alias("tile"), (F.col("rank") - F.col("before")).alias("rank"))).alias("ends"))
    )
    return _closing_rows(sliced.join(F.broadcast(wanted), SLICE), SLICE, keys, times)


def _closing_rows(near: DataFrame, part: str, keys: Sequence[str], times: str) -> DataFrame:
    """``(tile, bound, cut)`` from rows that come with the ``(tile, rank)`` to be found among those of their part, in ``ends``."""
    so_far = F.sum(times).over(Window.partitionBy(part).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
    return (
        near.withColumn("so_far", so_far)
        .select(*keys, times, "so_far", F.inline("ends"))
        .where((F.col("rank") > F.col("so_far") - F.col(times)) & (F.col("rank") <= F.col("so_far")))
        .select("tile", F.struct(*keys).alias("bound"), (F.col("rank") - F.col("so_far") + F.col(times)).alias("cut"))
    )


@dataclass
class _Place:
    """Where a tile's last row has been narrowed down to: equal values of the first columns, and a span of the next."""

    tile: int
    rank: int  # among the rows of the place
    rows: int
    equal: list[int | None] = field(default_factory=list)
    span: tuple[int, int] | None = None  # None while any value of the next column will do
    least: int = 0
    most: int = 0

    def holds(self, columns: Sequence[str]) -> Column:
        """Which rows are in the place."""
        here = F.lit(True)
        for name, value in zip(columns, self.equal):
            here &= F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
        if self.span:
            here &= F.col(columns[len(self.equal)]).between(*self.span)
        return F.coalesce(here, F.lit(False))

    def spot(self) -> tuple:
        return tuple(self.equal), self.span, self.least, self.most

    def bucket(self, columns: Sequence[str], buckets: int) -> Column:
        """The row's bucket by its value of the next column; NULLs first."""
        value = F.col(columns[len(self.equal)]).cast("long")
        width = (self.most - self.least) // buckets + 1
        if self.most - self.least < 1 << 62:
            number = F.call_function("div", value - F.lit(self.least).cast("long"), F.lit(width).cast("long"))
        else:  # the difference may not fit a long; rounding keeps the order
            number = F.floor(value.cast("double") / F.lit(float(width))) + F.lit(2 * buckets)
        return F.when(value.isNull(), F.lit(-1).cast("long")).otherwise(number.cast("long"))

    def enter(self, seen: Row, columns: Sequence[str], narrowed: bool) -> None:
        """Go on in the part of the place that ``seen`` describes: past every column of which it has one value only."""
        start = len(self.equal)
        self.rows, self.span = seen["rows"], None
        while len(self.equal) < len(columns):
            own = seen[f"s{len(self.equal)}"]
            if own["lo"] is not None and (own["lo"] != own["hi"] or own["none"]):
                self.least, self.most = own["lo"], own["hi"]
                if narrowed and len(self.equal) == start:
                    self.span = (own["lo"], own["hi"])
                return
            self.equal.append(own["lo"])


def _leading_numbers(df: DataFrame, keys: Sequence[str]) -> list[str]:
    kinds = dict(df.dtypes)
    return list(itertools.takewhile(lambda k: kinds[k] in ("tinyint", "smallint", "int", "bigint"), keys))


def _measures(columns: Sequence[str], times: str) -> list[Column]:
    """What a round tells of a place: rows unfolded and not, and least, most and missing values of each column."""
    spans = [
        F.struct(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count_if(F.col(c).isNull()).alias("none")).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    return [F.sum(times).alias("n"), F.count(F.lit(1)).alias("rows"), *spans]


def _marked(df: DataFrame, marks: Sequence[tuple[Column, Column]]) -> DataFrame:
    """A row for each mark ``(condition, struct)`` that it meets, with the struct in ``at``."""
    if len(marks) == 1:
        return df.where(marks[0][0]).withColumn("at", marks[0][1])
    return df.withColumn("at", F.explode(F.array_compact(F.array(*(F.when(here, mark) for here, mark in marks)))))


def select_bounds(
    stored: DataFrame,
    keys: Sequence[str],
    tiles: int,
    times: str,
    enough: int = 20_000,
    buckets: int = 1024,
    seen: Mapping | Row | None = None,
) -> DataFrame:
    """As ``_range_bounds``, by selection: no row is shuffled or sorted but the few next to a bound.

    Each round counts, in one pass with map-side sums, the rows of every place still looked at by the value of the next
    whole-number column, in ``buckets`` spans of equal width, and goes on with the span that holds the rank. A span of one value
    moves the search to the next column, so a value that holds a third of the rows is no harder. What is left, once it has
    at most ``enough`` rows or the leading whole-number columns have run out, is sorted by the full key. The driver sees ``buckets``
    counts a bound and round, whatever the data size. ``seen`` are the measures of the whole, where they are known.
    """
    columns = _leading_numbers(stored, keys)
    measures = _measures(columns, times)
    seen = seen or stored.agg(*measures).first()
    small, extra = divmod(seen["n"] or 0, tiles)
    places = [_Place(t, rank, seen["rows"]) for t in range(1, tiles) if (rank := small * t + min(t, extra))]
    for place in places:
        place.enter(seen, columns, False)
    while asked := [p for p in places if p.rows > enough and len(p.equal) < len(columns)]:
        spots = list({p.spot(): p for p in asked}.values())  # bounds that are still together are counted once
        marks = [(p.holds(columns), F.struct(F.lit(i).alias("spot"), p.bucket(columns, buckets).alias("bucket"))) for i, p in enumerate(spots)]
        counted = _marked(stored.select(*columns, times), marks).groupBy("at.spot", "at.bucket").agg(*measures).collect()
        by_spot = {p.spot(): sorted((r for r in counted if r["spot"] == i), key=lambda r: r["bucket"]) for i, p in enumerate(spots)}
        for place in asked:
            for seen in by_spot[place.spot()]:
                if place.rank <= seen["n"]:
                    break
                place.rank -= seen["n"]
            place.enter(seen, columns, True)
    end = lambda p: F.array(F.struct(F.lit(p.tile).alias("tile"), F.lit(p.rank).cast("long").alias("rank")))
    marks = [(p.holds(columns), F.struct(F.lit(p.tile).alias("part"), end(p).alias("ends"))) for p in places or [_Place(1, 1, 0)]]
    near = _marked(stored.select(*keys, times), marks).select(*keys, times, "at.part", "at.ends")
    return _closing_rows(near, "part", keys, times)


def with_counted_ntile(
    df: DataFrame,
    tiles: int,
    order_by: Sequence[str],
    name: str,
    times: str,
    slices: int | None = None,
    method: str = "select",
) -> DataFrame:
    """``ntile(tiles)`` where a row stands for ``times`` equal rows, which are never unfolded here.

    Each row comes back once for every tile it reaches, with the tile in ``name`` and its share in
    ``times``. The counted rows are written once. ``select`` finds the key that closes each tile by rounds of
    counts, ``ranges`` by cutting all keys into ranges; rows are then compared with those few keys.
    """
    if tiles < 1:
        raise ValueError("tiles must be positive")
    if method not in ("select", "ranges"):
        raise ValueError(f"unknown method {method!r}")
    if tiles == 1:
        return df.withColumn(name, F.lit(1))
    keys = [*order_by, TIE]
    tied, watch = df.withColumn(TIE, F.monotonically_increasing_id()), Observation()
    stored = materialise(tied.observe(watch, *_measures(_leading_numbers(tied, keys), times)))
    if method == "select":
        bounds = select_bounds(stored, keys, tiles, times, seen=watch.get)
    else:
        bounds = _range_bounds(stored, keys, tiles, times, slices)
    closing = bounds.agg(F.map_from_entries(F.collect_list(F.struct("tile", F.struct("bound", "cut")))).alias("closing")).scalar()
    own = F.struct(*keys)
    none = F.lit(0).cast("long")

    def up_to(t: int) -> Column:
        """How many of the row's copies lie in the first ``t`` tiles."""
        end = F.element_at(ENDS, F.lit(t))
        return F.when(own < end["bound"], F.col(times)).when(own == end["bound"], end["cut"]).otherwise(none)

    upper = [none, *(up_to(t) for t in range(1, tiles)), F.col(times)]
    shares = F.array(
        *(F.struct(F.lit(t).alias(name), (upper[t] - upper[t - 1]).alias(times)) for t in range(1, tiles + 1))
    )
    kept = [c for c in df.columns if c != times]
    return stored.withColumn(ENDS, closing).select(*kept, F.inline(shares)).where(F.col(times) > 0)


def with_ntile(
    df: DataFrame,
    tiles: int,
    order_by: Sequence[str],
    name: str,
    method: str = "distributed",
    slices: int | None = None,
) -> DataFrame:
    """Add ``ntile(tiles)`` over the whole frame, ordered by ``order_by`` (NULLs first).

    ``distributed`` writes the frame once, finds the closing key of each tile from the order columns
    alone, and tiles every row by comparing its key to those few bounds: no wide row is sorted. Rows
    with equal keys are told apart by a stored row id, so tile sizes differ by at most one and equal
    keys cannot pile up in one range. ``window`` is the one-task window, for input that fits a task.
    """
    if tiles < 1:
        raise ValueError("tiles must be positive")
    if method == "window":
        return df.withColumn(name, F.ntile(tiles).over(Window.orderBy(*order_by)))
    if method != "distributed":
        raise ValueError(f"unknown method {method!r}")
    if tiles == 1:
        return df.withColumn(name, F.lit(1))
    keys = [*order_by, TIE]
    stored = materialise(df.withColumn(TIE, F.monotonically_increasing_id()))
    bounds = tile_bounds(stored, keys, tiles, slices)
    closing = bounds.agg(F.map_from_entries(F.collect_list(F.struct("tile", "bound"))).alias("closing")).scalar()
    own = F.struct(*keys)
    after = [F.coalesce((own > F.element_at(closing, F.lit(t))).cast("int"), F.lit(0)) for t in range(1, tiles)]
    tile = F.lit(1)
    for step in after:
        tile = tile + step
    return stored.withColumn(name, tile).drop(TIE)
