"""Read-level queries: duplicates, mates, FASTQ quality control, filters, sampling, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from locuswise.functions import alleles as al  # noqa: F401
from locuswise.operators import duplicates as dup
from locuswise.operators import fastq as fq
from locuswise.operators import filters as flt
from locuswise.operators import sampling as smp
from locuswise.plans import fixtures as fx
from locuswise.plans.registry import query

END5 = "CASE WHEN is_reverse THEN pos + read_len - 1 ELSE pos END"
SCORE = "list_sum(list_transform(string_split(quals, ''), lambda x: CASE WHEN ascii(x) - 33 >= 15 THEN ascii(x) - 33 ELSE 0 END))"

# One SQL text for the duplicate flag, also used by queries on duplicate-removed depth.
DUP_SQL = f"""
  SELECT * FROM (
  WITH e AS (SELECT library, read_name, chrom, {END5} AS end5, is_reverse, {SCORE} AS s FROM reads WHERE NOT is_unmapped AND NOT is_secondary),
  f AS (SELECT library, read_name, min(row(chrom, end5, is_reverse)) AS lo, max(row(chrom, end5, is_reverse)) AS hi, sum(s) AS score, count(*) AS n
        FROM e GROUP BY ALL),
  r AS (SELECT library, read_name, row_number() OVER (PARTITION BY library, lo, hi, n ORDER BY score DESC, read_name) AS rk FROM f)
  SELECT d.*, coalesce(r.rk > 1, FALSE) AND NOT is_unmapped AND NOT is_secondary AS is_duplicate
  FROM reads d LEFT JOIN r USING (library, read_name))
"""
fx.SQL["dups"] = DUP_SQL


def with_duplicates(spark, sf_dir):
    r = fx.reads(spark, sf_dir).withColumn("end5", F.expr(END5))
    return dup.mark_duplicates(r).drop("end5")


@query("mark_duplicates", "dups", "SELECT read_name, mate_no, sample, is_duplicate FROM dups")
def _(spark, sf_dir):
    return with_duplicates(spark, sf_dir).select("read_name", "mate_no", "sample", "is_duplicate")


@query(
    "fragment_ends",
    "reads",
    f"""e AS (SELECT library, read_name, row(chrom, {END5}, is_reverse) AS x, is_reverse, {SCORE} AS s FROM reads WHERE NOT is_unmapped AND NOT is_secondary),
    g AS (SELECT library, read_name, sum(s) AS score, count(*) AS n, min(x) AS lo, max(x) AS hi FROM e GROUP BY ALL)
    SELECT library, read_name, CAST(score AS BIGINT) AS score, lo[1] AS chrom1, lo[2] AS pos1, CASE WHEN n > 1 THEN hi[1] END AS chrom2,
      CASE WHEN n > 1 THEN hi[2] END AS pos2,
      concat(CASE WHEN lo[3] THEN 'R' ELSE 'F' END, CASE WHEN n > 1 THEN CASE WHEN hi[3] THEN 'R' ELSE 'F' END ELSE '' END) AS orientation FROM g""",
)
def _(spark, sf_dir):
    r = fx.reads(spark, sf_dir).filter("NOT is_unmapped AND NOT is_secondary").withColumn("end5", F.expr(END5))
    return dup.fragment_ends(r)


@query(
    "best_read",
    "aligned",
    """r AS (SELECT read_name, mate_no, sample, mapq, flag FROM (SELECT * FROM aligned UNION ALL
         SELECT * REPLACE (CAST(mapq % 7 * 9 AS INT) AS mapq, flag + 4096 AS flag) FROM aligned))
    SELECT sample, read_name, mate_no, max(row(mapq, flag))[1] AS mapq, max(row(mapq, flag))[2] AS flag FROM r GROUP BY sample, read_name, mate_no""",
)
def _(spark, sf_dir):
    a = fx.aligned(spark, sf_dir)
    second = a.withColumns({"mapq": F.expr("CAST(mapq % 7 * 9 AS INT)"), "flag": F.col("flag") + 4096})
    return dup.best_read(a.unionByName(second).select("sample", "read_name", "mate_no", "mapq", "flag"))


@query(
    "fix_mates",
    "reads",
    f"""SELECT a.sample, a.read_name, a.mate_no, b.chrom AS mate_chrom, b.pos AS mate_pos, b.is_reverse AS mate_reverse, b.is_unmapped AS mate_unmapped,
      CAST(CASE WHEN a.chrom = b.chrom AND NOT a.is_unmapped THEN
        CASE WHEN m5 - t5 >= 0 THEN m5 - t5 + 1 ELSE m5 - t5 - 1 END ELSE 0 END AS BIGINT) AS insert_size
    FROM (SELECT *, {END5} AS t5 FROM reads) a LEFT JOIN (SELECT *, {END5} AS m5 FROM reads) b
      ON a.sample = b.sample AND a.read_name = b.read_name AND a.mate_no <> b.mate_no""",
)
def _(spark, sf_dir):
    return dup.fix_mates(fx.reads(spark, sf_dir)).select(
        "sample", "read_name", "mate_no", "mate_chrom", "mate_pos", "mate_reverse", "mate_unmapped", "insert_size"
    )


@query(
    "pair_reads",
    "reads",
    """SELECT sample, read_name, max(CASE WHEN mate_no = 1 THEN bases END) AS bases_1, max(CASE WHEN mate_no = 1 THEN pos END) AS pos_1,
       max(CASE WHEN mate_no = 2 THEN bases END) AS bases_2, max(CASE WHEN mate_no = 2 THEN pos END) AS pos_2 FROM reads GROUP BY ALL""",
)
def _(spark, sf_dir):
    return dup.pair_reads(fx.reads(spark, sf_dir).select("sample", "read_name", "mate_no", "bases", "pos"))


# ---- FASTQ ----------------------------------------------------------------------------------

@query(
    "fastq_trim",
    "reads",
    """SELECT read_name, mate_no, CASE WHEN mate_no = 1 THEN substr(bases, 4, 27) ELSE substr(bases, 2, 26) END AS bases,
       CASE WHEN mate_no = 1 THEN substr(quals, 4, 27) ELSE substr(quals, 2, 26) END AS quals FROM reads""",
)
def _(spark, sf_dir):
    return fq.trim_reads(fx.reads(spark, sf_dir), 3, 2, 1, 5).select("read_name", "mate_no", "bases", "quals")


@query(
    "rescale_quals",
    "reads",
    "SELECT read_name, mate_no, list_aggregate(list_transform(string_split(quals, ''), lambda x: chr(ascii(x) + 31)), 'string_agg', '') AS quals FROM reads",
)
def _(spark, sf_dir):
    r = fq.rescale_quals(fx.reads(spark, sf_dir), from_offset=33, to_offset=64)
    return r.select("read_name", "mate_no", "quals")


LIMITS = {"n_rate": 0.1, "q_rate": 0.2, "low_q": 5}
_JUDGED = """
c AS (SELECT r.*, CAST(substr(read_name, 2) AS BIGINT) % 41 = 0 AND mate_no = 1 AS has_adapter,
   length(bases) - length(replace(bases, 'N', '')) AS n_count,
   len(list_filter(string_split(quals, ''), lambda x: ascii(x) - 33 < 5)) AS low FROM reads r),
d AS (SELECT *, NOT has_adapter AND n_count > 0 AND n_count / 32.0 >= 0.1 AS too_many_n FROM c),
e AS (SELECT *, NOT has_adapter AND NOT too_many_n AND low > 0 AND low / 32.0 >= 0.2 AS low_quality FROM d),
j AS (SELECT *, count(*) OVER w AS pair_reads, count(*) FILTER (has_adapter OR too_many_n OR low_quality) OVER w AS bad_reads
      FROM e WINDOW w AS (PARTITION BY sample, read_name))
"""


def _with_hits(spark, sf_dir):
    r = fx.reads(spark, sf_dir)
    hits = r.filter("CAST(substr(read_name, 2) AS BIGINT) % 41 = 0 AND mate_no = 1").select("read_name", "mate_no")
    return fq.flag_adapter_reads(r, hits)


@query("fastq_qc", "reads", _JUDGED + "SELECT sample, read_name, mate_no, bases, quals FROM j WHERE bad_reads = 0")
def _(spark, sf_dir):
    return fq.fastq_qc(_with_hits(spark, sf_dir), **LIMITS).select("sample", "read_name", "mate_no", "bases", "quals")


_BASES = {b.lower(): f"length(bases) - length(replace(bases, '{b}', ''))" for b in "ACTGN"}
_BASES |= {f"q{k}": f"len(list_filter(string_split(quals, ''), lambda x: ascii(x) - 33 >= {k}))" for k in (20, 30)}


@query(
    "fastq_report",
    "reads",
    _JUDGED
    + """SELECT sample, count(*) AS total_reads, count(*) FILTER (bad_reads = 0) AS clean_reads, count(*) FILTER (has_adapter) AS adapter_reads,
    count(*) FILTER (too_many_n) AS n_reads, count(*) FILTER (low_quality) AS low_quality_reads,
    count(*) FILTER (pair_reads = 2 AND bad_reads = 1 AND has_adapter) AS adapter_due_to_mate,
    count(*) FILTER (pair_reads = 2 AND bad_reads = 1 AND too_many_n) AS n_due_to_mate,
    count(*) FILTER (pair_reads = 2 AND bad_reads = 1 AND low_quality) AS low_quality_due_to_mate,
    CAST(sum(length(bases)) AS BIGINT) AS raw_bases, CAST(coalesce(sum(length(bases)) FILTER (bad_reads = 0), 0) AS BIGINT) AS clean_bases, """
    + ", ".join(f"CAST(sum({e}) AS BIGINT) AS raw_{n}, CAST(coalesce(sum({e}) FILTER (bad_reads = 0), 0) AS BIGINT) AS clean_{n}" for n, e in _BASES.items())
    + " FROM j GROUP BY sample",
)
def _(spark, sf_dir):
    return fq.fastq_report(_with_hits(spark, sf_dir), **LIMITS)


_POS = {b.lower(): f"substr(bases, i + 1, 1) = '{b}'" for b in "ACTGN"} | {
    f"q{k}": f"ascii(substr(quals, i + 1, 1)) - 33 >= {k}" for k in (20, 30)
}


@query(
    "base_by_position",
    "reads",
    _JUDGED
    + ", p AS (SELECT j.*, CAST(i AS INT) AS i FROM j, (SELECT unnest(range(32)) AS i)) SELECT sample, i AS cycle, "
    + ", ".join(f"count(*) FILTER ({e}) AS raw_{n}, count(*) FILTER ({e} AND bad_reads = 0) AS clean_{n}" for n, e in _POS.items())
    + " FROM p GROUP BY ALL",
)
def _(spark, sf_dir):
    return fq.base_by_position(_with_hits(spark, sf_dir), **LIMITS)


_ADAPTER = "GCTAG"
_HIT = """coalesce((SELECT min(i) FROM (SELECT unnest(range(0, 28)) AS i) WHERE
   (CASE WHEN substr({s}, i + 1, 1) IN ('{a0}', 'N') THEN 0 ELSE 1 END + CASE WHEN substr({s}, i + 2, 1) IN ('{a1}', 'N') THEN 0 ELSE 1 END
   + CASE WHEN substr({s}, i + 3, 1) IN ('{a2}', 'N') THEN 0 ELSE 1 END + CASE WHEN substr({s}, i + 4, 1) IN ('{a3}', 'N') THEN 0 ELSE 1 END
   + CASE WHEN substr({s}, i + 5, 1) IN ('{a4}', 'N') THEN 0 ELSE 1 END) <= 1 ),
   (SELECT min(i) FROM (SELECT unnest(range(27, 30)) AS i) WHERE i > 27 AND substr({s}, i + 1) = left('GCTAG', 32 - i)), 0)"""


def _hit(s):
    return _HIT.format(s=s, **{f"a{i}": c for i, c in enumerate(_ADAPTER)})


_RC = "reverse(translate({}, 'ACGT', 'TGCA'))"


@query(
    "cut_adapters",
    "reads",
    f"""p AS (SELECT sample, read_name, max(CASE WHEN mate_no = 1 THEN bases END) AS b1, max(CASE WHEN mate_no = 2 THEN bases END) AS b2 FROM reads GROUP BY ALL),
    f AS (SELECT *, {_hit('b1')} AS f1, {_hit('b2')} AS f2, {_RC.format('b1')} AS c1, {_RC.format('b2')} AS c2 FROM p),
    g AS (SELECT *, CASE WHEN f1 > 0 AND f2 > 0 THEN least(f1, f2) ELSE 0 END AS fc, {_hit('c1')} AS r1, {_hit('c2')} AS r2 FROM f),
    h AS (SELECT *, CASE WHEN fc = 0 AND r1 > 0 AND r2 > 0 THEN least(r1, r2) ELSE 0 END AS rc FROM g)
    SELECT sample, read_name, CAST(CASE WHEN fc > 0 THEN fc ELSE rc END AS INT) AS cut, fc = 0 AND rc > 0 AS from_end,
      CASE WHEN fc > 0 THEN left(b1, fc) WHEN rc > 0 THEN right(b1, rc) ELSE b1 END AS bases_1,
      CASE WHEN fc > 0 THEN left(b2, fc) WHEN rc > 0 THEN right(b2, rc) ELSE b2 END AS bases_2
    FROM h WHERE (fc = 0 AND rc = 0) OR fc + rc >= 3""",
)
def _(spark, sf_dir):
    p = dup.pair_reads(fx.reads(spark, sf_dir).select("sample", "read_name", "mate_no", "bases", "quals"))
    return fq.cut_adapters(p, _ADAPTER, seed=5, tail=2, min_len=3).select(
        "sample", "read_name", "cut", "from_end", "bases_1", "bases_2"
    )


# ---- filters --------------------------------------------------------------------------------

_BIT = "flag & {} <> 0"


def _bit(name):
    from locuswise.functions.flags import BITS

    return f"(flag & {BITS[name]} <> 0)"


_REF_LEN = "list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1), lambda x: CAST(x AS INT)))"
_READ_LEN = "list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MIS=X]', 1), lambda x: CAST(x AS INT)))"
_UNMAPPED = f"({_bit('unmapped')} OR pos IS NULL OR pos = 0)"
_BAD_CIGAR = "cigar IN ('4D32M', '10M2I3D20M', '32S')"
_KEEP_SQL = {
    "allow_all": "TRUE",
    "cigar_without_n": "cigar NOT LIKE '%N%'",
    "first_of_pair": f"{_bit('first')}",
    "good_cigar": f"NOT {_BAD_CIGAR}",
    "nonzero_fragment_length": "insert_size <> 0",
    "matching_bases_and_quals": "length(bases) = length(quals)",
    "has_read_group": "read_group IS NOT NULL",
    "mapped": f"NOT {_UNMAPPED}",
    "mapq_available": "mapq <> 255",
    "mapq_not_zero": "mapq <> 0",
    "mate_on_same_contig_or_unmapped": f"{_bit('mate_unmapped')} OR (NOT {_bit('unmapped')} AND mate_chrom = '=')",
    "mate_different_strand": f"NOT {_bit('unmapped')} AND NOT {_bit('mate_unmapped')} AND {_bit('reverse')} <> {_bit('mate_reverse')}",
    "nonzero_reference_length": f"coalesce({_REF_LEN}, 0) > 0",
    "not_duplicate": f"NOT {_bit('duplicate')}",
    "not_secondary": f"NOT {_bit('secondary')}",
    "not_supplementary": f"NOT {_bit('supplementary')}",
    "paired": "flag % 2 = 1",
    "passes_vendor_qc": f"NOT {_bit('fails_qc')}",
    "properly_paired": f"{_bit('proper')}",
    "primary_line": f"NOT {_bit('secondary')} AND NOT {_bit('supplementary')}",
    "read_length_equals_cigar_length": f"{_bit('unmapped')} OR coalesce({_READ_LEN}, 0) = 32",
    "second_of_pair": f"{_bit('second')}",
    "seq_is_stored": "length(bases) > 0",
    "valid_alignment_start": f"{_bit('unmapped')} OR pos > 0",
    "valid_alignment_end": f"{_bit('unmapped')} OR coalesce({_REF_LEN}, 0) > 0",
    "min_mapq_20": "mapq >= 20",
}


@query(
    "filter_counts",
    "aligned",
    " UNION ALL ".join(
        f"SELECT count(*) AS total, '{n}' AS filter, count(*) FILTER (NOT coalesce({e}, FALSE)) AS dropped FROM aligned" for n, e in _KEEP_SQL.items()
    ),
)
def _(spark, sf_dir):
    preds = {n: p() for n, p in flt.KEEP.items()} | {"min_mapq_20": flt.keep_min_mapq(20)}
    return flt.filter_counts(fx.aligned(spark, sf_dir), preds)


_ELSEWHERE = f"(NOT {_bit('mate_unmapped')} AND NOT {_bit('unmapped')} AND mate_chrom = 'chrX')"
_STD = f"({_bit('duplicate')} OR mapq IN (0, 255) OR {_bit('secondary')} OR {_UNMAPPED} OR {_bit('fails_qc')})"
_DROP_SQL = {
    "unmapped": _UNMAPPED,
    "secondary": _bit("secondary"),
    "duplicate": _bit("duplicate"),
    "mapq_unavailable": "mapq IN (0, 255)",
    "fails_qc": _bit("fails_qc"),
    "bad_cigar": _BAD_CIGAR,
    "no_aligned_base": "cigar NOT LIKE '%M%'",
    "mate_elsewhere": _ELSEWHERE,
    "malformed": f"(NOT {_bit('unmapped')} AND (pos <= 0 OR coalesce({_REF_LEN}, 0) < 1 OR pos > 4990))",
    "realign_ineligible": f"({_UNMAPPED} OR {_bit('secondary')} OR {_bit('fails_qc')} OR mapq = 0 OR {_ELSEWHERE} OR abs(insert_size) > 96 OR read_group = 'rg3')",
    "secondary_or_supplementary": f"({_bit('secondary')} OR {_bit('supplementary')})",
    "set_reads": _STD,
    "set_genotyper": f"({_STD} OR cigar NOT LIKE '%M%')",
    "set_haplotype": f"({_bit('duplicate')} OR mapq IN (0, 255) OR {_UNMAPPED} OR {_bit('fails_qc')})",
    "set_quality_control": f"({_STD} OR {_BAD_CIGAR} OR {_ELSEWHERE})",
    "set_recalibration": _STD,
}


@query(
    "drop_flags",
    "aligned",
    "SELECT read_name, mate_no, " + ", ".join(f"coalesce({e}, FALSE) AS {n}" for n, e in _DROP_SQL.items()) + " FROM aligned",
)
def _(spark, sf_dir):
    a = fx.aligned(spark, sf_dir).withColumns(
        {"contig_length": F.lit(4990), "platform": F.when(F.col("read_group") == "rg3", "454").otherwise("ILLUMINA")}
    )
    cols = {
        "unmapped": flt.drop_unmapped(),
        "secondary": flt.drop_secondary(),
        "duplicate": flt.drop_duplicate(),
        "mapq_unavailable": flt.drop_mapq_unavailable(),
        "fails_qc": flt.drop_fails_qc(),
        "bad_cigar": flt.drop_bad_cigar(),
        "no_aligned_base": flt.drop_no_aligned_base(),
        "mate_elsewhere": flt.drop_mate_elsewhere(),
        "malformed": flt.drop_malformed(),
        "realign_ineligible": flt.drop_realign_ineligible(max_insert=96),
        "secondary_or_supplementary": flt.drop_secondary_or_supplementary(),
    } | {f"set_{n}": p() for n, p in flt.COMPOSITES.items()}
    return a.select("read_name", "mate_no", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in cols.items()])


# ---- sampling -------------------------------------------------------------------------------

_DRAW = "md5(concat_ws('|', read_name, CAST(mate_no AS VARCHAR), '7'))"


@query(
    "downsample_reservoir",
    "reads",
    f"SELECT read_name, mate_no FROM reads ORDER BY {_DRAW}, read_name, mate_no LIMIT 1000",
)
def _(spark, sf_dir):
    return smp.reservoir(fx.reads(spark, sf_dir), 1000, ["read_name", "mate_no"], seed=7).select("read_name", "mate_no")


@query(
    "downsample_positional",
    "reads",
    f"""SELECT read_name, mate_no, chrom, pos FROM reads WHERE NOT is_unmapped
    QUALIFY row_number() OVER (PARTITION BY chrom, pos ORDER BY {_DRAW}, read_name, mate_no) <= 3""",
)
def _(spark, sf_dir):
    r = fx.reads(spark, sf_dir).filter("NOT is_unmapped").select("read_name", "mate_no", "chrom", "pos")
    return smp.positional(r, 3, ["read_name", "mate_no"], seed=7)


@query(
    "downsample_fraction",
    "reads",
    f"SELECT read_name, mate_no FROM reads WHERE CAST(concat('0x', left({_DRAW}, 8)) AS BIGINT) / 4294967296.0 < 0.1",
)
def _(spark, sf_dir):
    return smp.fraction(fx.reads(spark, sf_dir), 0.1, ["read_name", "mate_no"], seed=7).select("read_name", "mate_no")


@query(
    "downsample_leveling",
    "reads",
    f"""r AS (SELECT read_name, mate_no, CAST(substr(chrom, 4) AS BIGINT) * 100000 + pos AS gpos FROM reads WHERE NOT is_unmapped),
    s AS (SELECT gpos, count(*) AS n FROM r GROUP BY gpos),
    k AS (SELECT gpos, n, unnest(range(1, n + 1)) AS round FROM s),
    -- removal number: rounds first, then stacks in order; a stack of n rows can give n - 1
    o AS (SELECT gpos, n, row_number() OVER (ORDER BY round, gpos) AS nth FROM k WHERE round < n),
    x AS (SELECT gpos, count(*) AS lost FROM o WHERE nth <= (SELECT greatest(sum(n) - 12000 , 0) FROM s) GROUP BY gpos),
    q AS (SELECT s.gpos, n - coalesce(lost, 0) AS quota FROM s LEFT JOIN x USING (gpos))
    SELECT read_name, mate_no, gpos FROM r JOIN q USING (gpos)
    QUALIFY row_number() OVER (PARTITION BY gpos ORDER BY {_DRAW}, read_name, mate_no) <= any_value(quota) OVER (PARTITION BY gpos)""",
)
def _(spark, sf_dir):
    r = fx.reads(spark, sf_dir).filter("NOT is_unmapped").selectExpr(
        "read_name", "mate_no", "CAST(substr(chrom, 4) AS BIGINT) * 100000 + pos AS gpos"
    )
    return smp.leveling(r, 12000, ["read_name", "mate_no"], stack=["gpos"], seed=7)


@query(
    "cap_window",
    "reads",
    """SELECT read_name, mate_no, chrom, pos, CAST(pos // 1000 AS BIGINT) AS "window" FROM reads WHERE NOT is_unmapped
    QUALIFY row_number() OVER (PARTITION BY chrom, pos // 1000 ORDER BY pos, read_name, mate_no) <= 500""",
)
def _(spark, sf_dir):
    r = fx.reads(spark, sf_dir).filter("NOT is_unmapped").selectExpr(
        "read_name", "mate_no", "chrom", "pos", "floor(pos / 1000) AS window"
    )
    return smp.cap_window(r, 500, ["chrom", "window"], ["pos", "read_name", "mate_no"])
