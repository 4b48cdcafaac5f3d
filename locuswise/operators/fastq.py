"""FASTQ trimming, adapter cutting, pair filtering and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuswise.functions.quality import rescale
from locuswise.functions.sequence import IUPAC, count_base, reverse_complement


def trim_reads(reads: DataFrame, head1: int, tail1: int, head2: int, tail2: int) -> DataFrame:
    """Cut fixed numbers of bases per mate; trimming more than the read holds is an error."""
    first = F.col("mate_no") == 1
    head = F.when(first, F.lit(head1)).otherwise(F.lit(head2))
    cut = head + F.when(first, F.lit(tail1)).otherwise(F.lit(tail2))
    left = F.length("bases") - cut
    checked = F.when(
        left < 0, F.raise_error(F.concat(F.lit("trim is longer than read "), F.col("read_name"))).cast("int")
    ).otherwise(left)
    return reads.withColumn("_left", checked).withColumns(
        {"bases": F.substr("bases", head + 1, F.col("_left")), "quals": F.substr("quals", head + 1, F.col("_left"))}
    ).drop("_left")


def rescale_quals(reads: DataFrame, from_offset: int = 64, to_offset: int = 33) -> DataFrame:
    return reads.withColumn("quals", rescale(F.col("quals"), from_offset, to_offset))


def _matching(base: str) -> str:
    """Regex class of the read letters whose IUPAC meaning shares a base with ``base``."""
    return "[" + "".join(k for k, v in IUPAC.items() if set(v) & set(IUPAC[base])) + "]"


def _adapter_at(seq, adapter: str, seed: int, tail: int):
    """0-based offset of the adapter in ``seq``; 0 when it is not there.

    First the leftmost place where the ``seed``-base prefix fits with at most one mismatch, then
    the longest exact overlap of more than ``tail`` bases at the end of the read. One regular
    expression covers both, so a read is scanned once.
    """
    prefix = adapter[:seed].upper()
    near = "|".join(
        "".join("." if j == i else _matching(b) for j, b in enumerate(prefix)) for i in range(len(prefix))
    )
    ends = "|".join(prefix[:n] for n in range(len(prefix), tail, -1))
    # an end overlap starts to the right of every place where the whole prefix fits
    pattern = f"(?:{near}|(?:{ends})$)" if ends else f"(?:{near})"
    return F.greatest(F.regexp_instr(F.upper(seq), F.lit(pattern)) - 1, F.lit(0))


def cut_adapters(pairs: DataFrame, adapter: str, seed: int = 12, tail: int = 4, min_len: int = 0) -> DataFrame:
    """Cut both mates where the adapter starts in both; retry from the other end on the reverse complement.

    Input has bases_1, quals_1, bases_2, quals_2. Pairs with one mate missing are left as they are.
    Adds ``cut`` (0 when uncut) and ``from_end``; a pair cut below ``min_len`` is dropped.
    """
    find = lambda seq: _adapter_at(seq, adapter, seed, tail)
    d = pairs.withColumns({"_f1": find(F.col("bases_1")), "_f2": find(F.col("bases_2"))})
    d = d.withColumn("_f", F.when((F.col("_f1") > 0) & (F.col("_f2") > 0), F.least("_f1", "_f2")).otherwise(0))
    d = d.withColumns(
        {
            "_r1": F.when(F.col("_f") == 0, find(reverse_complement(F.col("bases_1")))).otherwise(0),
            "_r2": F.when(F.col("_f") == 0, find(reverse_complement(F.col("bases_2")))).otherwise(0),
        }
    )
    d = d.withColumn("_r", F.when((F.col("_r1") > 0) & (F.col("_r2") > 0), F.least("_r1", "_r2")).otherwise(0))
    d = d.withColumns({"cut": F.coalesce(F.when(F.col("_f") > 0, F.col("_f")).otherwise(F.col("_r")), F.lit(0)),
                       "from_end": F.coalesce((F.col("_f") == 0) & (F.col("_r") > 0), F.lit(False))})
    keep = lambda c: F.when(F.col("cut") == 0, F.col(c)).when(
        F.col("from_end"), F.right(F.col(c), F.col("cut"))
    ).otherwise(F.left(F.col(c), F.col("cut")))
    d = d.withColumns({c: keep(c) for c in ("bases_1", "quals_1", "bases_2", "quals_2")})
    return d.filter((F.col("cut") == 0) | (F.col("cut") >= min_len)).drop("_f1", "_f2", "_f", "_r1", "_r2", "_r")


def _low_count(quals, bound: int, offset: int):
    """Characters whose quality is below ``bound``, counted by deleting all others."""
    low = "".join(chr(c) for c in range(33, min(offset + bound, 127)))
    # translate drops every low character, so the loss in length is the count
    return F.length(quals) - F.length(F.translate(quals, low, ""))


def classify_reads(
    reads: DataFrame, n_rate: float = 0.1, q_rate: float = 0.5, low_q: int = 5, offset: int = 33
) -> DataFrame:
    """Adds one reason at most per read: has_adapter, too_many_n or low_quality, in that priority."""
    n = count_base(F.upper("bases"), "N")
    low = _low_count(F.col("quals"), low_q, offset)
    length = F.length("bases")
    adapter = F.coalesce(F.col("has_adapter"), F.lit(False)) if "has_adapter" in reads.columns else F.lit(False)
    many_n = ~adapter & (n > 0) & (n / length >= n_rate)
    low_quality = ~adapter & ~many_n & (low > 0) & (low / length >= q_rate)
    return reads.withColumns({"has_adapter": adapter, "too_many_n": many_n, "low_quality": low_quality})


def flag_adapter_reads(reads: DataFrame, hits: DataFrame) -> DataFrame:
    """Adds ``has_adapter`` from a list of (read_name, mate_no) hits."""
    marks = hits.select("read_name", "mate_no").distinct().withColumn("_hit", F.lit(True))
    return reads.join(marks, ["read_name", "mate_no"], "left").withColumn(
        "has_adapter", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


def judge_pairs(reads: DataFrame, drop_single: bool = False, **limits) -> DataFrame:
    """Reads with their pair's verdict ``is_clean``; a pair is clean when none of its reads is bad.

    Mates meet in one aggregate over the read name that keeps one row per mate, so its state is
    bounded, and are unfolded again: one scan and one shuffle. More than two reads of one name is
    an error, as are two reads that claim the same mate number.
    """
    c = classify_reads(reads, **limits)
    rest = [n for n in c.columns if n not in ("sample", "read_name")]
    row = F.struct(*rest)
    second = F.coalesce(F.col("mate_no") == 2, F.lit(False))
    bad = F.col("has_adapter") | F.col("too_many_n") | F.col("low_quality")
    pairs = c.groupBy("sample", "read_name").agg(
        F.count("*").alias("pair_reads"),
        F.count_if(bad).alias("bad_reads"),
        F.count_if(second).alias("_seconds"),
        F.first(F.when(~second, row), ignorenulls=True).alias("_m1"),
        F.first(F.when(second, row), ignorenulls=True).alias("_m2"),
    )
    crowded = (F.col("_seconds") > 1) | (F.col("pair_reads") - F.col("_seconds") > 1)
    # the verdict itself carries the error, so pruning cannot remove the check
    pairs = pairs.withColumn(
        "bad_reads",
        F.when(crowded, F.raise_error(F.concat(F.lit("more than two reads named "), F.col("read_name"))).cast("long"))
        .otherwise(F.col("bad_reads")),
    )
    if drop_single:
        pairs = pairs.filter(F.col("pair_reads") == 2)
    return pairs.select(
        "sample",
        "read_name",
        "pair_reads",
        "bad_reads",
        (F.col("bad_reads") == 0).alias("is_clean"),
        F.explode(F.array_compact(F.array("_m1", "_m2"))).alias("_r"),
    ).select("sample", "read_name", "_r.*", "pair_reads", "bad_reads", "is_clean")


def fastq_qc(reads: DataFrame, **limits) -> DataFrame:
    """Reads of clean pairs only."""
    extra = ["too_many_n", "low_quality", "pair_reads", "bad_reads", "is_clean"]
    if "has_adapter" not in reads.columns:
        extra.append("has_adapter")
    return judge_pairs(reads, **limits).filter("is_clean").drop(*extra)


def _at_least(quals, bound: int, offset: int = 33):
    return F.length(quals) - _low_count(quals, bound, offset)


def fastq_report(reads: DataFrame, by_sample: bool = True, **limits) -> DataFrame:
    """The 24 counters: reads, reasons, mates lost to their partner, and raw / clean base counts."""
    j = judge_pairs(reads, **limits)
    keys = ["sample"] if by_sample else []
    bases = {f"{b.lower()}": count_base(F.upper("bases"), b) for b in "ACTGN"}
    bases |= {"q20": _at_least(F.col("quals"), 20), "q30": _at_least(F.col("quals"), 30)}
    alone = (F.col("pair_reads") == 2) & (F.col("bad_reads") == 1)
    return j.groupBy(*keys).agg(
        F.count("*").alias("total_reads"),
        F.count_if("is_clean").alias("clean_reads"),
        F.count_if("has_adapter").alias("adapter_reads"),
        F.count_if("too_many_n").alias("n_reads"),
        F.count_if("low_quality").alias("low_quality_reads"),
        F.count_if(alone & F.col("has_adapter")).alias("adapter_due_to_mate"),
        F.count_if(alone & F.col("too_many_n")).alias("n_due_to_mate"),
        F.count_if(alone & F.col("low_quality")).alias("low_quality_due_to_mate"),
        F.sum(F.length("bases")).alias("raw_bases"),
        F.coalesce(F.sum(F.when(F.col("is_clean"), F.length("bases"))), F.lit(0).cast("long")).alias("clean_bases"),
        *[F.sum(v).alias(f"raw_{k}") for k, v in bases.items()],
        *[F.coalesce(F.sum(F.when(F.col("is_clean"), v)), F.lit(0).cast("long")).alias(f"clean_{k}") for k, v in bases.items()],
    )


def base_by_position(reads: DataFrame, **limits) -> DataFrame:
    """Base, Q20 and Q30 counts per sample and read cycle, for all reads and for clean pairs."""
    j = judge_pairs(reads, **limits).select(
        "sample",
        "is_clean",
        F.posexplode(F.arrays_zip(F.split(F.upper("bases"), "").alias("b"), F.split("quals", "").alias("q"))).alias("cycle", "x"),
    )
    q = F.ascii("x.q") - 33
    tests = {b.lower(): F.col("x.b") == b for b in "ACTGN"} | {"q20": q >= 20, "q30": q >= 30}
    return j.groupBy("sample", "cycle").agg(
        *[F.count_if(t).alias(f"raw_{n}") for n, t in tests.items()],
        *[F.count_if(t & F.col("is_clean")).alias(f"clean_{n}") for n, t in tests.items()],
    )


def split_mates(reads: DataFrame) -> dict[str, DataFrame]:
    """FASTQ text lines of mate 1, mate 2 and single reads, the third line reset to ``+``."""
    text = reads.select(
        "mate_no", F.concat_ws("\n", F.concat(F.lit("@"), F.col("read_name")), "bases", F.lit("+"), "quals").alias("value")
    )
    return {
        "1": text.filter("mate_no = 1").select("value"),
        "2": text.filter("mate_no = 2").select("value"),
        "single": text.filter("mate_no IS NULL OR mate_no NOT IN (1, 2)").select("value"),
    }
