"""Edge rows of read, variant and calling operators."""

import math

import pytest
from pyspark.sql import functions as F

from locuswise.functions import alleles as al
from locuswise.functions import cigar as cg
from locuswise.functions import stats as st
from locuswise.functions.sequence import iupac_match, reverse_complement
from locuswise.operators import bqsr, duplicates, fastq, filters
from locuswise.operators.allele_counts import allele_count_likelihoods
from locuswise.operators.pileup import pileup
from locuswise.operators.profile import smoothing_kernel


def one(spark, col, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(col.alias("x")).first()[0]


READ = "library string, read_name string, mate_no int, chrom string, end5 long, is_reverse boolean, quals string, is_unmapped boolean, is_secondary boolean"


def test_duplicates_edges(spark):
    q = "I" * 4
    data = [
        ("l", "b", 1, "c", 10, False, q, False, False), ("l", "b", 2, "c", 90, True, q, False, False),
        ("l", "a", 1, "c", 10, False, q, False, False), ("l", "a", 2, "c", 90, True, q, False, False),  # equal score: name decides
        ("l", "s", 1, "c", 10, False, q, False, False),  # single end is its own cluster
        ("l", "t", 1, "c", 10, False, "J" * 4, False, False),  # better single end
        ("m", "x", 1, "c", 10, False, q, False, False),  # other library
        ("l", "u", 1, None, None, False, q, True, False), ("l", "v", 1, None, None, False, q, True, False),
    ]
    got = {(r.read_name, r.mate_no): r.is_duplicate for r in duplicates.mark_duplicates(spark.createDataFrame(data, READ)).collect()}
    assert {k for k, v in got.items() if v} == {("b", 1), ("b", 2), ("s", 1)}


def test_soft_clip_moves_five_prime_end(spark):
    assert one(spark, cg.unclipped_start(F.col("p"), F.col("c")), p=10, c="3S5M") == 7
    assert one(spark, cg.unclipped_end(F.col("p"), F.col("c")), p=10, c="5M2I3M1S2H") == 20


@pytest.mark.parametrize(
    "ref,alt,want",
    [("A", "G", "SNP"), ("AC", "GT", "MNP"), ("AC", "AT", "SNP"), ("A", "ATG", "INS"), ("ATG", "A", "DEL"), ("ATG", "AC", "InDel"), ("A", "<DEL>", "SYMBOLIC"), ("A", "A[chr2:5[", "BND")],
)
def test_variant_type(spark, ref, alt, want):
    assert one(spark, al.variant_type(F.col("r"), F.col("a")), r=ref, a=alt) == want


def test_trim_alleles(spark):
    d = spark.createDataFrame([(10, "CAATG", "CAG"), (5, "A", "T"), (7, "AAA", "A")], "pos long, ref string, alt string")
    assert [tuple(r) for r in al.trim_alleles(d).collect()] == [(11, "AAT", "A"), (5, "A", "T"), (7, "AAA", "A")]


@pytest.mark.parametrize("cigar,bad", [("10M", False), ("2D8M", True), ("8M2D", True), ("5M2I3D5M", True), ("5M2S5M", True), ("2H3S5M", False), ("3S2H5M", True), ("*", False), ("5S", True)])
def test_bad_cigar(spark, cigar, bad):
    assert one(spark, filters.drop_bad_cigar(F.col("c")), c=cigar) is bad


def test_pileup_of_insertion_and_deletion(spark):
    d = spark.createDataFrame([("r", "c", 5, "2M1I1M2D1M", "ACGTA", "IIIII")], "read_name string, chrom string, pos long, cigar string, bases string, quals string")
    got = [(r.pos, r.base, r.is_del, r.next_ins, r.next_del) for r in pileup(d).orderBy("pos").collect()]
    assert got == [(5, "A", False, None, None), (6, "C", False, "G", None), (7, "T", False, None, 2), (8, None, True, None, None), (9, None, True, None, None), (10, "A", False, None, None)]


def test_more_than_two_reads_is_an_error(spark):
    d = spark.createDataFrame([("s", "n", m, "ACGT", "IIII") for m in (1, 2, 2)], "sample string, read_name string, mate_no int, bases string, quals string")
    with pytest.raises(Exception, match="more than two reads"):
        fastq.fastq_qc(d).collect()


def test_trim_longer_than_read_is_an_error(spark):
    d = spark.createDataFrame([("n", 1, "ACGT", "IIII")], "read_name string, mate_no int, bases string, quals string")
    with pytest.raises(Exception, match="trim is longer"):
        fastq.trim_reads(d, 3, 2, 0, 0).collect()


def test_cycle_and_context_edges(spark):
    rev = one(spark, bqsr.cycles(F.lit(3), F.lit(True), F.lit(True)), x=1)
    assert rev == [-3, -2, -1]
    assert one(spark, bqsr.contexts(F.col("b"), F.lit(False)), b="ACNGT") == [None, "AC", None, None, "GT"]
    assert one(spark, bqsr.contexts(F.col("b"), F.lit(True)), b="AAC") == ["TT", "GT", None]
    assert one(spark, bqsr.flow_cycles(F.col("b"), F.lit(False), F.lit(False)), b="TTACTGNA") == [1, 1, 1, 1, 2, 2, 3, 3]
    assert one(spark, bqsr.mask_low_tails(F.col("b"), F.col("q")), b="ACGTA", q="#!II#") == "NNGTN"


def test_context_numbers_and_text(spark):
    for t in ("AA", "AC", "GT", "TT"):
        code = bqsr.context_code(F.col("t"))
        assert one(spark, F.struct(code, bqsr.context_text(code)), t=t) == ("ACGT".index(t[0]) * 4 + "ACGT".index(t[1]), t)


def test_reference_meets_whole_reads(spark):
    text = "".join("ACGT"[(7 * p + p // 3) % 4] for p in range(2500))
    ref = spark.createDataFrame([("c", p + 101, b.lower()) for p, b in enumerate(text)], "chrom string, pos long, base string")
    known = spark.createDataFrame([("c", 103), ("c", 103), ("c", 1000), ("d", 103)], "chrom string, pos long")
    spans = {"before": (98, 8), "masked": (101, 4), "blocks": (995, 12), "long": (150, 2300), "over": (2596, 12), "gone": (4000, 5), "first": (90, 5)}
    rows = [(n, "c", p, "A" * k, "I" * k, "g", 1, False) for n, (p, k) in spans.items()] + [("other", "e", 101, "AAAA", "IIII", "g", 1, False)]
    reads = spark.createDataFrame(rows, "read_name string, chrom string, pos long, bases string, quals string, read_group string, mate_no int, is_reverse boolean")
    at = {p + 101: b for p, b in enumerate(text)} | {103: ".", 1000: "."}
    got = {r.read_name: r.ref_bases for r in bqsr.reference_in_reads(reads, ref, known).collect()}
    want = {n: "".join(at.get(i, ".") for i in range(p, p + k)) for n, (p, k) in spans.items()}
    assert got == {n: x for n, x in want.items() if any(i in at for i in range(spans[n][0], sum(spans[n])))}
    from locuswise.operators.coverage import mismatch_counts, region_gc

    plain = {p + 101: b for p, b in enumerate(text)}
    off = {n: sum(plain[i] != "A" for i in range(p, p + k) if i in plain) for n, (p, k) in spans.items()}
    counts = mismatch_counts(reads, ref, ["read_group"]).collect()
    assert {r.read_name: r.mismatches for r in counts} == {n: off[n] for n in got}
    wide = spark.createDataFrame([("r", "c", 900, 2300), ("none", "c", 9000, 9100)], "name string, chrom string, start long, end long")
    inside = [plain[i] for i in range(900, 2301)]
    assert [tuple(r) for r in region_gc(wide, ref).collect()] == [("r", sum(b in "GC" for b in inside) / len(inside))]
    t = bqsr.bqsr_tables(reads, ref, known)
    total = t.filter("level = 'read_group'").first()
    seen = "".join(want.values()).replace(".", "")
    assert (total.observations, total.errors) == (len(seen), len(seen) - seen.count("A"))
    # what is exchanged: whole reads, spans, reference blocks and counts, no single bases
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = bqsr.bqsr_tables(reads, ref, known)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    lines = plan.split("\n")
    each = next(i for i, x in enumerate(lines) if "Generate posexplode" in x)
    assert "partial_count" in "".join(lines[each - 4 : each])


def test_quantize_keeps_order_and_levels():
    q = bqsr.quantize_quals({10: 1000, 11: 900, 30: 5000, 31: 10}, 4)
    values = [q[k] for k in range(94)]
    assert len(set(values)) <= 4 and len(values) == 94
    assert q[30] == 30 and all(q[k] == q[31] for k in range(31, 94))


def test_statistics(spark):
    c = [F.col(x) for x in "abcd"]
    # tea tasting: 3, 1, 1, 3
    assert math.isclose(one(spark, st.fisher_two_sided(*c), a=3, b=1, c=1, d=3), 0.4857142857, rel_tol=1e-9)
    assert one(spark, st.fisher_two_sided(*c), a=0, b=0, c=0, d=0) == 1.0
    assert math.isclose(one(spark, st.hardy_weinberg_p(*c[:3]), a=57, b=14, c=50), 0.84227975657, rel_tol=1e-6)
    assert one(spark, st.excess_het_p(*c[:3]), a=1, b=0, c=0) == 0.5


def test_allele_counts_by_enumeration(spark):
    d = spark.createDataFrame([([(0.0, -1.0, -3.0), (-2.0, 0.0, -1.5)],)], "g array<struct<rr:double,ra:double,aa:double>>")
    got = d.select(allele_count_likelihoods(F.col("g"))).first()[0]
    g = [[1, 0.1, 1e-3], [0.01, 1, 10**-1.5]]
    want = [0.0] * 5
    for i in range(3):
        for j in range(3):
            want[i + j] += g[0][i] * g[1][j] * (2 if i == 1 else 1) * (2 if j == 1 else 1)
    want = [w / math.comb(4, k) for k, w in enumerate(want)]
    assert all(math.isclose(a / got[0], b / want[0], rel_tol=1e-9) for a, b in zip(got, want))


def test_sequence(spark):
    assert one(spark, reverse_complement(F.col("s")), s="ACGTN") == "NACGT"
    assert one(spark, iupac_match(F.lit("R"), F.lit("G")), s="") is True
    assert one(spark, iupac_match(F.lit("Y"), F.lit("G")), s="") is False


def test_kernel_sums_to_one():
    k = smoothing_kernel()
    assert math.isclose(sum(k), 1.0) and k == k[::-1] and len(k) == 101


def test_supplementary_lines_break_no_cluster(spark):
    q = "I" * 4
    rows = [
        ("l", "a", 1, "c", 10, False, q, False, False, 67), ("l", "a", 2, "c", 90, True, q, False, False, 147),
        ("l", "b", 1, "c", 10, False, q, False, False, 67), ("l", "b", 2, "c", 90, True, q, False, False, 147),
        ("l", "a", 1, "d", 500, False, q, False, False, 67 + 2048),
    ]
    got = [(r.read_name, r.flag, r.is_duplicate) for r in duplicates.mark_duplicates(spark.createDataFrame(rows, READ + ", flag int")).collect()]
    assert sorted(got) == [("a", 67, False), ("a", 147, False), ("a", 2115, False), ("b", 67, True), ("b", 147, True)]


def test_exact_tests_of_deep_tables(spark):
    c = [F.col(x) for x in "abcd"]

    def fisher(a, b, cc, d):
        row, col, n = a + b, a + cc, a + b + cc + d
        w = {x: math.comb(row, x) * math.comb(n - row, col - x) for x in range(max(0, col - (n - row)), min(row, col) + 1)}
        return sum(v for v in w.values() if v <= w[a]) / math.comb(n, col)

    for t in ((600, 400, 60, 10), (5000, 4000, 3000, 6000), (0, 900, 700, 0), (300, 300, 300, 300)):
        got = one(spark, st.fisher_two_sided(*c), **dict(zip("abcd", t)))
        assert math.isclose(got, fisher(*t), rel_tol=1e-6, abs_tol=1e-300)
    assert one(spark, st.fisher_two_sided(*c, scale_above=400), a=600, b=400, c=60, d=10) > fisher(600, 400, 60, 10)

    def het(k, aa, bb):
        n, rare = k + aa + bb, min(2 * aa + k, 2 * bb + k)
        w = {h: 2.0**h * math.factorial(n) / (math.factorial(h) * math.factorial((rare - h) // 2) * math.factorial(n - h - (rare - h) // 2)) for h in range(rare % 2, rare + 1, 2)}
        t = sum(w.values())
        return sum(v for v in w.values() if v <= w[k] * (1 + 1e-9)) / t, (sum(v for h, v in w.items() if h > k) + w[k] / 2) / t

    for k, aa, bb in ((30, 40, 20), (0, 50, 9), (60, 1, 1), (7, 0, 40)):
        assert math.isclose(one(spark, st.hardy_weinberg_p(*c[:3]), a=k, b=aa, c=bb), min(1.0, het(k, aa, bb)[0]), rel_tol=1e-6)
        assert math.isclose(one(spark, st.excess_het_p(*c[:3]), a=k, b=aa, c=bb), het(k, aa, bb)[1], rel_tol=1e-6, abs_tol=1e-12)


def test_poisson_tail(spark):
    for k, lam in ((2, 0.5), (10, 3.0), (5, 40.0), (900, 1000.0)):
        pdf = lambda n, lam=lam: math.exp(n * math.log(lam) - lam - (n * math.log(n) - n + 0.5 * math.log(2 * math.pi * n) if n else 0.0))
        want = math.log(sum(pdf(n) for n in range(k, k + 3000)))
        assert math.isclose(one(spark, st.log_poisson_tail(F.col("k"), F.col("m")), k=k, m=lam), want, rel_tol=1e-9, abs_tol=1e-12)


def test_every_alternate_is_counted_and_called(spark):
    from locuswise.operators import annotations, calling

    g = spark.createDataFrame([("c", 1, "A", ["C", "G", "T", "AC"], [4, 4]), ("c", 1, "A", ["C", "G", "T", "AC"], [0, 1]), ("c", 2, "A", ["C"], [-1, -1])], "chrom string, pos long, ref string, alts array<string>, gt array<int>")
    got = {r.pos: (r.AN, r.AC, r.AF) for r in annotations.chromosome_counts(g).collect()}
    assert got == {1: (4, [1, 0, 0, 2], [0.25, 0.0, 0.0, 0.5]), 2: (0, [0], [None])}
    names = calling.GENOTYPES
    gl = {n: -20.0 for n in names}
    rows = [("s", "c", 1, 9, *({**gl, "CG": 0.0}[n] for n in names)), ("s", "c", 2, 9, *({**gl, "AA": 0.0}[n] for n in names))]
    gls = spark.createDataFrame(rows, "sample string, chrom string, pos long, depth long, " + ", ".join(f"gl_{n} double" for n in names))
    sites = spark.createDataFrame([("c", 1, "A", ["C", "G"]), ("c", 2, "A", ["T"])], "chrom string, pos long, ref string, alts array<string>")
    given = {(r.pos, r.alt): r.mleac for r in calling.genotype_given(gls, sites).collect()}
    assert set(given) == {(1, "C"), (1, "G"), (2, "T")} and given[2, "T"] == 0
    assert {(r.pos, r.alt) for r in calling.assign_genotypes(gls, sites).collect()} == set(given)


def test_repeated_keys_keep_the_first(spark):
    from locuswise.functions.lambdas import first_of_key

    got = spark.sql("SELECT array(named_struct('k', 'a', 'v', '1'), named_struct('k', 'b', 'v', '2'), named_struct('k', 'a', 'v', '3')) AS e").select(first_of_key(F.col("e"))).first()[0]
    assert got == {"a": "1", "b": "2"}


def test_recalibration_keeps_alignments_apart(spark):
    t = spark.createDataFrame(
        [("read_group", "g", None, None, 10, 1, 30.0, 20.0), ("quality", "g", 40, None, 10, 1, 40.0, 30.0), ("cycle", "g", 40, "1", 10, 1, 40.0, 25.0)],
        "level string, read_group string, qual int, value string, observations long, errors long, reported double, empirical double",
    )
    r = spark.createDataFrame([("g", "n", 1, False, "ACGT", "IIII"), ("g", "n", 1, False, "AC", "II"), ("h", "n", 1, False, "AC", "I#"), ("g", "e", 1, False, "", "")], "read_group string, read_name string, mate_no int, is_reverse boolean, bases string, quals string")
    got = sorted((x.read_group, x.read_name, x.quals) for x in bqsr.apply_bqsr(r, t).collect())
    # 40 + (30 - 40), at cycle 1 also (25 - 40) - (30 - 40)
    assert got == [("g", "e", ""), ("g", "n", ":?"), ("g", "n", ":???"), ("h", "n", "I#")]


def test_haplotype_score_query_takes_every_position(spark):
    from locuswise.plans import fixtures as fx
    from locuswise.plans.registry import REGISTRY
    import locuswise.plans.annotation_queries  # noqa: F401

    sf = "/root/testdata/sf0.001"
    reads = fx.reads(spark, sf).filter("NOT is_unmapped").selectExpr("chrom", "pos", "pos + read_len - 1 AS e").distinct().collect()
    bases = {(r.chrom, r.pos) for r in fx.refseq(spark, sf).collect()}
    want = {(r.chrom, p) for r in reads for p in range(r.pos + 5, r.e - 4)} & bases
    got = [(r.chrom, r.pos) for r in REGISTRY["haplotype_score"].build(spark, sf).select("chrom", "pos").collect()]
    assert len(got) == len(want) and set(got) == want


def test_reference_of_any_length(spark):
    from locuswise.operators.annotations import sequence_context
    from locuswise.operators.calling import consensus_indels
    from locuswise.operators.reference import ref_blocks

    bases = "".join("ACGT"[(i * 7 + i // 5) % 4] for i in range(3000)) + "A" * 3000 + "C" + "GT" * 1200 + "".join("ACGT"[(i * 5 + i // 3) % 4] for i in range(4000))
    ref = ref_blocks(spark.createDataFrame([("c", i + 1, b) for i, b in enumerate(bases)], "chrom string, pos long, base string"))
    pile = [("s", "c", 2500, None, 5000)] * 8 + [("s", "c", 2500, None, None)] * 4 + [("s", "c", len(bases) - 10, None, 50)] * 8
    (r,) = consensus_indels(spark.createDataFrame(pile, "sample string, chrom string, pos long, next_ins string, next_del int"), ref).collect()
    assert r.ref == bases[2499:7500] and r.alt == bases[2499] and r.n == 8
    sites = [("c", 3000, "C", "A"), ("c", 6001, "C", "A"), ("c", 6001, "C", "CGT"), ("c", 6001, "CGT", "C"), ("c", 90_000, "C", "A")]
    got = {(x.pos, x.ref, x.alt): x for x in sequence_context(spark.createDataFrame(sites, "chrom string, pos long, ref string, alt string"), ref).collect()}
    assert len(got) == 5 and got[3000, "C", "A"].HRun == 3000 and got[6001, "C", "A"].HRun == 3001
    assert (got[6001, "C", "CGT"].RPA_ref, got[6001, "C", "CGT"].RPA_alt) == (1200, 1201)
    assert (got[6001, "CGT", "C"].RPA_ref, got[6001, "CGT", "C"].RPA_alt) == (1200, 1199)
    assert got[90_000, "C", "A"].GC is None and got[90_000, "C", "A"].HRun is None
