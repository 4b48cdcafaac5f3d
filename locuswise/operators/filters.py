"""Read predicates, filter combinators and per-filter drop counts.

``drop_*`` predicates are true for reads to remove; ``KEEP`` holds predicates that are true for reads
to keep. All are plain columns, so they push down, combine with ``& | ~`` and also work on streams.
Reads follow the ``aligned_reads`` schema: flag, chrom, pos, mapq, cigar, mate_chrom, mate_pos,
insert_size, bases, quals, read_group.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.functions import cigar as cg
from locuswise.functions.flags import has

# Mapping qualities that mean "not available".
MAPQ_UNAVAILABLE = (0, 255)
FLAG = "flag"


def _has(name: str) -> Column:
    return has(F.col(FLAG), name)


def drop_unmapped() -> Column:
    return _has("unmapped") | F.coalesce(F.col("pos") == 0, F.lit(True))


def drop_secondary() -> Column:
    return _has("secondary")


def drop_duplicate() -> Column:
    return _has("duplicate")


def drop_mapq_unavailable(value: int | None = None) -> Column:
    return F.col("mapq").isin(*MAPQ_UNAVAILABLE) if value is None else F.col("mapq") == value


def drop_fails_qc() -> Column:
    return _has("fails_qc")


def drop_bad_cigar(cigar: Column | None = None) -> Column:
    """Leading or trailing deletion, touching insertion and deletion, clip in the middle, hard clip
    inside soft clip, or no element that aligns a base."""
    c = F.col("cigar") if cigar is None else cigar
    c = F.coalesce(c, F.lit("*"))
    core = F.regexp_replace(F.regexp_replace(c, r"^(\d+H)?(\d+S)?", ""), r"(\d+S)?(\d+H)?$", "")
    return (c != "*") & (
        core.rlike(r"^\d+D")
        | core.rlike(r"\d+D$")
        | core.rlike(r"\d+I\d+D|\d+D\d+I")
        | core.rlike(r"[SH]")
        | ~core.rlike(r"[M=XI]")
    )


def drop_no_aligned_base() -> Column:
    return ~cg.contains(F.col("cigar"), "M=X")


def drop_mate_elsewhere() -> Column:
    """Mate mapped to another contig."""
    same = (F.col("mate_chrom") == "=") | (F.col("mate_chrom") == F.col("chrom"))
    return _has("paired") & ~_has("mate_unmapped") & ~_has("unmapped") & ~F.coalesce(same, F.lit(False))


def drop_malformed(strict: bool = False) -> Column:
    """Impossible coordinates. Missing read group and unequal base / quality lengths are errors when strict.

    Needs a ``contig_length`` column for the end-of-contig test; without a value the test is skipped.
    """
    mapped = ~_has("unmapped")
    end = cg.alignment_end(F.col("pos"), F.col("cigar"))
    lengths_differ = F.length("bases") != F.length("quals")
    bad = (
        (mapped & (F.col("pos") <= 0))
        | (mapped & (end < F.col("pos")))
        | (mapped & F.coalesce(F.col("pos") > F.col("contig_length"), F.lit(False)))
    )
    broken = F.col("read_group").isNull() | lengths_differ
    if strict:
        reason = F.when(F.col("read_group").isNull(), F.lit("read without read group: ")).otherwise(
            F.lit("bases and qualities differ in length: ")
        )
        return F.when(broken, F.raise_error(F.concat(reason, F.col("read_name"))).cast("boolean")).otherwise(bad)
    return bad | F.coalesce(broken, F.lit(False))


def drop_realign_ineligible(max_insert: int = 3000) -> Column:
    platform_excluded = F.coalesce(F.upper("platform").rlike("454|ION"), F.lit(False))
    return (
        drop_unmapped()
        | drop_secondary()
        | drop_fails_qc()
        | (F.col("mapq") == 0)
        | drop_mate_elsewhere()
        | (F.abs("insert_size") > max_insert)
        | platform_excluded
    )


def drop_secondary_or_supplementary() -> Column:
    return _has("secondary") | _has("supplementary")


def keep_min_mapq(minimum: int, maximum: int | None = None) -> Column:
    ok = F.col("mapq") >= minimum
    return ok if maximum is None else ok & (F.col("mapq") <= maximum)


def any_of(*preds: Column) -> Column:
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out


def all_of(*preds: Column) -> Column:
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def standard_drop() -> Column:
    return any_of(drop_duplicate(), drop_mapq_unavailable(), drop_secondary(), drop_unmapped(), drop_fails_qc())


def genotyper_drop() -> Column:
    return any_of(standard_drop(), drop_no_aligned_base())


def haplotype_drop() -> Column:
    return any_of(drop_duplicate(), drop_mapq_unavailable(), drop_unmapped(), drop_fails_qc())


def quality_control_drop() -> Column:
    return any_of(standard_drop(), drop_bad_cigar(), drop_mate_elsewhere())


def recalibration_drop() -> Column:
    return standard_drop()


COMPOSITES = {
    "reads": standard_drop,
    "genotyper": genotyper_drop,
    "haplotype": haplotype_drop,
    "quality_control": quality_control_drop,
    "recalibration": recalibration_drop,
}


def _mates_differ_in_strand() -> Column:
    return ~(_has("paired") & ~_has("unmapped") & ~_has("mate_unmapped")) | (_has("reverse") != _has("mate_reverse"))


# Predicates that are true for reads to keep.
KEEP = {
    "allow_all": lambda: F.lit(True),
    "cigar_without_n": lambda: ~cg.contains(F.col("cigar"), "N"),
    "first_of_pair": lambda: _has("paired") & _has("first"),
    "good_cigar": lambda: ~drop_bad_cigar(),
    "nonzero_fragment_length": lambda: F.col("insert_size") != 0,
    "matching_bases_and_quals": lambda: F.length("bases") == F.length("quals"),
    "has_read_group": lambda: F.col("read_group").isNotNull(),
    "mapped": lambda: ~drop_unmapped(),
    "mapq_available": lambda: F.col("mapq") != 255,
    "mapq_not_zero": lambda: F.col("mapq") != 0,
    "mate_on_same_contig_or_unmapped": lambda: ~_has("paired")
    | _has("mate_unmapped")
    | (~_has("unmapped") & F.coalesce((F.col("mate_chrom") == "=") | (F.col("mate_chrom") == F.col("chrom")), F.lit(False))),
    "mate_different_strand": lambda: _has("paired")
    & ~_has("unmapped")
    & ~_has("mate_unmapped")
    & (_has("reverse") != _has("mate_reverse")),
    "nonzero_reference_length": lambda: cg.reference_length(F.col("cigar")) > 0,
    "not_duplicate": lambda: ~_has("duplicate"),
    "not_secondary": lambda: ~_has("secondary"),
    "not_supplementary": lambda: ~_has("supplementary"),
    "paired": lambda: _has("paired"),
    "passes_vendor_qc": lambda: ~_has("fails_qc"),
    "properly_paired": lambda: _has("proper"),
    "primary_line": lambda: ~_has("secondary") & ~_has("supplementary"),
    "read_length_equals_cigar_length": lambda: _has("unmapped")
    | (F.length("bases") == cg.read_length(F.col("cigar"))),
    "second_of_pair": lambda: _has("paired") & _has("second"),
    "seq_is_stored": lambda: F.length("bases") > 0,
    "valid_alignment_start": lambda: _has("unmapped") | (F.col("pos") > 0),
    "valid_alignment_end": lambda: _has("unmapped") | (cg.reference_length(F.col("cigar")) > 0),
}


def filter_counts(reads: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Reads seen and reads rejected by each keep-predicate, one pass, one row per predicate."""
    row = reads.agg(
        F.count("*").alias("total"), *[F.count_if(~F.coalesce(p, F.lit(False))).alias(n) for n, p in predicates.items()]
    )
    return row.unpivot(["total"], list(predicates), "filter", "dropped")
