"""Ordered running aggregates that never put a whole key into one task.

A window ``partitionBy(chrom).orderBy(pos)`` sends a contig to one task. Here the genome is cut
into tiles: the running value is taken inside each (key, tile), and one row per tile carries the
value of all earlier tiles. The second window sees one row per tile, so its size is bounded by
contig length / tile size and not by the data. Callers aggregate to one row per (key, pos) first,
which bounds the rows of a tile as well, whatever the depth at a position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = 4096

_FOLD = {"max": F.max, "min": F.min, "sum": F.sum}


def _merge(kind: str, a: Column, b: Column) -> Column:
    if kind == "sum":
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    return F.greatest(a, b) if kind == "max" else F.least(a, b)


def scan(
    df: DataFrame, keys: Sequence[str], pos: str, specs: Mapping[str, tuple[str, Column, bool, bool]], tile: float = TILE
) -> DataFrame:
    """Several running aggregates in one pass over the tiles.

    ``specs`` maps an output name to (max | min | sum, column, reverse, inclusive). Rows must be
    unique per (keys, pos). ``reverse`` runs from the last position to the first; without
    ``inclusive`` the row itself is left out.
    """
    keys = list(keys)
    tiled = df.withColumn("_tile", F.floor(F.col(pos) / F.lit(tile)))

    def window(by, column, reverse, last):
        order = F.col(column).desc() if reverse else F.col(column).asc()
        return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, last)

    totals = tiled.groupBy(*keys, "_tile").agg(*[_FOLD[k](c).alias(f"_total_{n}") for n, (k, c, _, _) in specs.items()])
    carry = totals.select(
        *keys,
        "_tile",
        *[
            _FOLD[k](f"_total_{n}").over(window(keys or [F.lit(0)], "_tile", rev, -1)).alias(f"_carry_{n}")
            for n, (k, _, rev, _) in specs.items()
        ],
    )
    local = tiled.withColumns(
        {
            f"_local_{n}": _FOLD[k](c).over(window([*keys, "_tile"], pos, rev, 0 if inc else -1))
            for n, (k, c, rev, inc) in specs.items()
        }
    )
    done = local.join(carry, keys + ["_tile"], "left").withColumns(
        {n: _merge(k, F.col(f"_carry_{n}"), F.col(f"_local_{n}")) for n, (k, _, _, _) in specs.items()}
    )
    return done.drop("_tile", *[f"_carry_{n}" for n in specs], *[f"_local_{n}" for n in specs])


def running(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    aggs: Mapping[str, tuple[str, Column]],
    tile: float = TILE,
    reverse: bool = False,
    inclusive: bool = True,
) -> DataFrame:
    """Running max / min / sum of columns, all in one direction."""
    return scan(df, keys, pos, {n: (k, c, reverse, inclusive) for n, (k, c) in aggs.items()}, tile)


def islands(df: DataFrame, keys: Sequence[str], pos: str, is_new: Column, out: str = "island", tile: float = TILE):
    """Label each row with the position at which its island starts.

    ``is_new`` marks the rows that begin an island; the label is the last such position so far.
    """
    return running(df, keys, pos, {out: ("max", F.when(is_new, F.col(pos)))}, tile=tile)


def previous(df: DataFrame, keys: Sequence[str], pos: str, cols: Mapping[str, str], tile: float = TILE) -> DataFrame:
    """Values of the preceding row in ``pos`` order: ``lag`` without a whole-key window."""
    fields = F.struct(F.col(pos).alias("_p"), *[F.col(c).alias(n) for n, c in cols.items()])
    d = running(df, keys, pos, {"_prev": ("max", fields)}, tile=tile, inclusive=False)
    return d.select(*df.columns, *[F.col(f"_prev.{n}").alias(n) for n in cols])


def following(df: DataFrame, keys: Sequence[str], pos: str, cols: Mapping[str, str], tile: float = TILE) -> DataFrame:
    """Values of the next row in ``pos`` order: ``lead`` without a whole-key window."""
    fields = F.struct(F.col(pos).alias("_p"), *[F.col(c).alias(n) for n, c in cols.items()])
    d = running(df, keys, pos, {"_next": ("min", fields)}, tile=tile, reverse=True, inclusive=False)
    return d.select(*df.columns, *[F.col(f"_next.{n}").alias(n) for n in cols])


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int = 16) -> DataFrame:
    """The first ``n`` rows per key in ``order``, exact, in two rounds.

    Round one ranks inside (key, salt) so that a key holding a large share of the rows is spread
    over ``salts`` tasks; at most ``n * salts`` rows per key reach round two.
    """
    keys = list(keys)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts)))
    first = Window.partitionBy(*keys, "_salt").orderBy(*order)
    second = Window.partitionBy(*keys).orderBy(*order)
    kept = salted.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= n)
    return (
        kept.withColumn("_rank", F.row_number().over(second)).filter(F.col("_rank") <= n).drop("_salt", "_rank")
    )


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table to every row, as a scalar subquery and not as a join."""
    one = row.select(F.struct(*row.columns)).scalar()
    return df.select("*", one.alias("_one")).select(*df.columns, *[F.col(f"_one.{c}").alias(c) for c in row.columns])
