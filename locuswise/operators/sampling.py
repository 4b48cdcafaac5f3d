"""Downsampling with a reproducible order: rows are ranked by the md5 of a key and a seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locuswise.operators.scan import running, top_n

DIGITS = 4  # leading hex digits that make a bucket: 65,536 buckets


def _draw(df: DataFrame, key: Sequence[str], seed: int) -> DataFrame:
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    return df.withColumn("_draw", F.md5(text))


def reservoir(df: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Uniform sample of exactly ``min(n, rows)`` rows.

    Rows are counted in 65,536 hash buckets; whole buckets below the cut are kept and only the
    bucket at the cut is ranked, so no task sorts the table. The bucket table is broadcast: its
    size is fixed by the number of hash digits. ``key`` must identify a row.
    """
    d = _draw(df, key, seed).withColumn("_bucket", F.conv(F.substr("_draw", F.lit(1), F.lit(DIGITS)), 16, 10).cast("long"))
    sizes = d.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    cum = running(sizes, [], "_bucket", {"_upto": ("sum", F.col("_rows"))}, tile=256)
    quota = cum.select("_bucket", F.greatest(F.lit(0), F.least("_rows", F.lit(n) - F.col("_upto") + F.col("_rows"))).alias("_quota"), "_rows")
    j = d.join(F.broadcast(quota.filter("_quota > 0")), "_bucket")
    whole = j.filter("_quota = _rows")
    edge = j.filter("_quota < _rows")
    ranked = edge.withColumn("_rank", F.row_number().over(Window.partitionBy("_bucket").orderBy("_draw", *key)))
    kept = whole.unionByName(ranked.filter("_rank <= _quota").drop("_rank"))
    return kept.select(*df.columns)


def positional(df: DataFrame, n: int, key: Sequence[str], stack: Sequence[str] = ("chrom", "pos"), seed: int = 0):
    """At most ``n`` rows per start position."""
    d = _draw(df, key, seed)
    return top_n(d, stack, [F.col("_draw"), *[F.col(k) for k in key]], n).drop("_draw")


def fraction(df: DataFrame, share: float, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Rows whose hash falls below ``share``; the same rows for the same seed, with no shuffle."""
    d = _draw(df, key, seed)
    unit = F.conv(F.substr("_draw", F.lit(1), F.lit(8)), 16, 10).cast("double") / float(16**8)
    return d.filter(unit < share).drop("_draw")


def level_stacks(sizes: DataFrame, target: int, stack: Sequence[str], minimum: int = 1, order: str = "_order", tile: float = 4096) -> DataFrame:
    """Quota per stack after removing one row at a time from each stack in turn until ``target`` is left.

    ``sizes`` has the stack columns, ``n`` and an order number (0-based). Removing in turns lowers
    every stack by the same number of rounds, so a stack keeps ``max(min(n, minimum), n - rounds)``
    and the first few stacks in order that can still give lose one more. Rounds come from a
    histogram of stack sizes; its rows are distinct sizes, few even for large inputs.
    """
    spare = F.greatest(F.col("n") - minimum, F.lit(0).cast("long"))
    hist = sizes.groupBy(spare.alias("spare")).agg(F.count("*").alias("stacks"), F.sum("n").alias("rows"))
    one = Window.partitionBy(F.lit(0))
    upto = one.orderBy(F.col("spare")).rowsBetween(Window.unboundedPreceding, 0)
    h = (
        hist.withColumn("total", F.sum("rows").over(one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("excess", F.greatest(F.col("total") - target, F.lit(0).cast("long")))
        .withColumn("above", F.sum("stacks").over(one.orderBy(F.col("spare").desc()).rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("above", F.coalesce("above", F.lit(0).cast("long")))
        .withColumn("given", F.sum(F.col("spare") * F.col("stacks")).over(upto) + F.col("spare") * F.col("above"))
    )
    # `given` is what `spare` full rounds remove; the cut lies before the first size that gives enough
    cut = h.withColumn("before", F.struct(F.col("given"), F.col("spare"))).agg(
        F.first("excess").alias("excess"),
        F.max(F.when(F.col("given") <= F.col("excess"), F.struct("spare", "given", "above"))).alias("full"),
        F.sum("stacks").alias("stacks"),
    )
    spare0 = F.coalesce(F.col("full.spare"), F.lit(0).cast("long"))
    left = F.col("excess") - F.coalesce(F.col("full.given"), F.lit(0).cast("long"))
    alive = F.when(F.col("full").isNull(), F.col("stacks")).otherwise(F.col("full.above"))
    cut = cut.select(
        (spare0 + F.coalesce(F.floor(F.try_divide(left, alive)), F.lit(0).cast("long"))).alias("rounds"),
        F.coalesce(F.try_mod(left, alive), F.lit(0).cast("long")).alias("extra"),
        F.lit(0).alias("_k"),
    )
    j = sizes.withColumn("_k", F.lit(0)).join(F.broadcast(cut), "_k").drop("_k")
    giving = F.col("n") - minimum > F.col("rounds")
    # place among the stacks that can still give, by order
    alive_rows = running(
        j.withColumn("_live", giving.cast("long")), [], order, {"_place": ("sum", F.col("_live"))}, tile=tile
    )
    more = (giving & (F.col("_place") <= F.col("extra"))).cast("long")
    quota = F.least(F.col("n"), F.greatest(F.lit(minimum).cast("long"), F.col("n") - F.col("rounds") - more))
    return alive_rows.select(*stack, "n", quota.alias("quota"))


def leveling(df: DataFrame, target: int, key: Sequence[str], stack: Sequence[str] | None = None, minimum: int = 1, seed: int = 0):
    """Trim the tallest stacks evenly until about ``target`` rows are left; no stack falls below ``minimum``.

    A stack is a position of a contig unless ``stack`` names other columns. Stacks take turns in the order of the key if it is one
    number, else in the order of its hash.
    """
    stack = list(stack or [c for c in ("chrom", "pos") if c in df.columns])
    sizes = df.groupBy(*stack).agg(F.count("*").alias("n"))
    number = len(stack) == 1 and dict(df.dtypes)[stack[0]] in ("tinyint", "smallint", "int", "bigint")
    sizes = sizes.withColumn("_order", F.col(stack[0]) if number else F.xxhash64(*stack))
    # hashes fill the 64-bit range: 4,096 tiles of it
    quota = level_stacks(sizes, target, stack, minimum, tile=4096 if number else 2.0**52)
    d = _draw(df, key, seed)
    # stacks that keep everything need no ranking
    j = d.join(quota, stack)
    full = j.filter("quota >= n")
    salted = j.filter("quota < n").withColumn("_bucket", F.substr("_draw", F.lit(1), F.lit(2)))
    per = salted.groupBy(*stack, "_bucket").agg(F.count("*").alias("_rows"))
    w = Window.partitionBy(*stack).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("_before", F.coalesce(F.sum("_rows").over(w), F.lit(0).cast("long"))).drop("_rows")
    rank = Window.partitionBy(*stack, "_bucket").orderBy("_draw", *key)
    cut = (
        salted.join(per, stack + ["_bucket"])
        .withColumn("_rank", F.row_number().over(rank) + F.col("_before"))
        .filter("_rank <= quota")
    )
    return full.select(*df.columns).unionByName(cut.select(*df.columns))


def cap_window(df: DataFrame, n: int, window: Sequence[str], order: Sequence[str]) -> DataFrame:
    """At most ``n`` rows per window, first in ``order``: an optional guard the user asks for."""
    return top_n(df, window, [F.col(c) for c in order], n)
