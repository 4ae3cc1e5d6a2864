"""Ordered work per key (running totals, neighbours, last known values) that survives a hot key.

A window over one key is one task. Keys with more than ``hot_rows`` rows are therefore cut into
pieces of ``width`` seconds, and a piece that still has more than ``hot_rows`` rows (copies of
one event, say) is cut on by second, status and a range of event ids. Each piece is its own
window, and what it needs from earlier ones is carried over from a table with one row per piece.
Other keys keep one piece and take part in no carry. The pieces follow the event order, so
results are the same for any threshold. ``_hot`` follows from the key; it stands in every
partition and join key so that a filter on it reaches the scan, and carry tables are computed
from hot rows alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lotflow.functions.columns import EVENT_ORDER, div


@dataclass(frozen=True)
class HotKeys:
    """When a key counts as hot, how long its pieces are, and how many event ids a finer one spans."""

    hot_rows: int = 1_000_000
    width: int = 300
    ids: int = 1_000_000


def order_key() -> Column:
    return F.struct(*EVENT_ORDER)


def heavy_groups(df: DataFrame, keys: list[str], more_than: int, flag: str) -> DataFrame:
    """Groups of more than so many rows: at most rows / more_than of them, however the rows spread."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > more_than).select(*keys, F.lit(True).alias(flag))


def split_hot(df: DataFrame, keys: list[str], hot: HotKeys = HotKeys()) -> DataFrame:
    """Adds ``_hot`` and ``_piece``; the broadcast sides are heavy groups alone, so their size is bound."""
    timed = df.withColumn("_span", div("timestamp_unix", hot.width))
    heavy = F.broadcast(heavy_groups(timed, keys, hot.hot_rows, "_is_hot"))
    spans = [*keys, "_span"]
    crowded = F.broadcast(heavy_groups(timed.join(heavy, keys), spans, hot.hot_rows, "_is_crowded"))
    marked = timed.join(heavy, keys, "left").join(crowded, spans, "left")
    is_hot, fine = F.coalesce("_is_hot", F.lit(False)), F.col("_is_crowded")
    place = F.struct(
        F.when(is_hot, F.col("_span")).alias("span"),
        F.when(fine, F.col("timestamp_unix")).alias("second"),
        F.when(fine, F.col("status_rank")).alias("rank"),
        F.when(fine, div("event_id", hot.ids)).alias("ids"),
    )
    return marked.withColumns({"_hot": is_hot, "_piece": place}).drop("_is_hot", "_is_crowded", "_span")


def piece(keys: list[str]) -> list[str]:
    return [*keys, "_hot", "_piece"]


def piece_window(keys: list[str], descending: bool = False) -> WindowSpec:
    order = [F.col(name).desc() if descending else F.col(name) for name in EVENT_ORDER]
    return Window.partitionBy(*piece(keys)).orderBy(*order)


def earlier_pieces(keys: list[str]) -> WindowSpec:
    """Over the carry table: the pieces of the key before this one."""
    return Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)


def carried(split: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Joins the carry table back; both sides are spread by (key, piece)."""
    return split.join(carry, piece(keys), "left")


def unsplit(df: DataFrame) -> DataFrame:
    return df.drop("_hot", "_piece")


def running(split: DataFrame, keys: list[str], columns: dict[str, Column], how=F.sum) -> DataFrame:
    """Adds running sums (or ``how=F.max``) of ``columns`` over the rows of the key up to each row."""
    combine = {"sum": lambda near, far: near + F.coalesce(far, F.lit(0).cast("long")), "max": F.greatest}[how.__name__]
    far = {name: f"_{name}_before" for name in columns}
    carry = (
        split.where("_hot")
        .groupBy(*piece(keys))
        .agg(*[how(column).alias(name) for name, column in columns.items()])
        .select(*piece(keys), *[how(name).over(earlier_pieces(keys)).alias(far[name]) for name in columns])
    )
    window = piece_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    local = split.withColumns({name: how(column).over(window) for name, column in columns.items()})
    joined = carried(local, carry, keys)
    return joined.withColumns({name: combine(F.col(name), F.col(far[name])) for name in columns}).drop(*far.values())


def neighbour(split: DataFrame, keys: list[str], columns: list[str], name: str, following: bool = False) -> DataFrame:
    """Struct ``name`` with ``columns`` of the previous (or following) row of the key; null at the end."""
    values = F.struct(*columns)
    # the row of a piece that touches the piece next to it
    edge = (F.min_by if following else F.max_by)(values, order_key())
    step = F.lead if following else F.lag
    carry = (
        split.where("_hot")
        .groupBy(*piece(keys))
        .agg(edge.alias("_edge"))
        .select(*piece(keys), step("_edge").over(Window.partitionBy(*keys).orderBy("_piece")).alias("_beyond"))
        .where(F.col("_beyond").isNotNull())
    )
    local = split.withColumn("_near", step(values).over(piece_window(keys)))
    return carried(local, carry, keys).withColumn(name, F.coalesce("_near", "_beyond")).drop("_near", "_beyond")
