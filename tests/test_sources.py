"""Text formats: written by hand, read back, and round trips of the writers."""

from pyspark.sql import functions as F

from locuswise.operators.filters import drop_duplicate
from locuswise.sources import reads as rd
from locuswise.sources import sinks
from locuswise.sources import variants as vs
from locuswise.streaming.rowwise import clean_single_reads, filter_reads


def test_fastq_styles(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@r1/1\nACGT\n+\n@@II\n@r1/2\nTTTT\n+s9\nIIII\n")
    got = {(r.read_name, r.mate_no): (r.sample, r.bases, r.quals) for r in rd.read_fastq(spark, str(tmp_path / "a.fq")).collect()}
    assert got == {("r1", 1): (None, "ACGT", "@@II"), ("r1", 2): ("s9", "TTTT", "IIII")}
    (tmp_path / "b.fq").write_text("@r2 2:N:0:AC\nA\n+\nI\n")
    r = rd.read_fastq(spark, str(tmp_path / "b.fq"), "space").first()
    assert (r.read_name, r.mate_no) == ("r2", 2)


def test_fastq_over_many_splits(spark, tmp_path):
    text = "".join(f"@r{i}/1\nACGT{'A' * (i % 7)}\n+\nIIII{'I' * (i % 7)}\n" for i in range(3000))
    (tmp_path / "x.fq").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        got = rd.read_fastq(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 3000 and all(len(r.bases) == len(r.quals) == 4 + int(r.read_name[1:]) % 7 for r in got)


def test_records_within_and_across_splits(spark, tmp_path, monkeypatch):
    from locuswise.sources import text

    rec = [[f"@q{i}/1", "ACGT" * (1 + i % 9 * (40 if i % 50 == 0 else 1)), "+", "@+I#" * (1 + i % 9 * (40 if i % 50 == 0 else 1))] for i in range(400)]
    for name, part in (("a.fq", rec[:250]), ("b.fq", rec[250:399]), ("c.fq", rec[399:])):
        (tmp_path / name).write_text("".join("\n".join(r) + "\n" for r in part))
    (tmp_path / "empty.fq").write_text("")
    want = sorted(r[:2] + r[3:] for r in rec)
    for bytes_, most in (("1024", text.BROADCAST_SPLITS), ("170", text.BROADCAST_SPLITS), ("1024", 3)):
        monkeypatch.setattr(text, "BROADCAST_SPLITS", most)
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
        try:
            df = text.records(spark, str(tmp_path), 4)
            assert sorted([r.parts[0], r.parts[1], r.parts[3]] for r in df.collect()) == want
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # the branch of whole records has no exchange of lines
    monkeypatch.setattr(text, "BROADCAST_SPLITS", 1000)
    lines = text.read_lines(spark, str(tmp_path)).select("file", "_block", "value", F.lit(0).alias("_skip"))
    assert "Exchange" not in text._whole_records(lines, 4)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in rd.read_fastq(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_manifest_and_adapters(spark, tmp_path):
    (tmp_path / "m.txt").write_text("s2\t/d/b_1.fq\t/d/b_2.fq\t\t\ns1\t/d/a_1.fq\t/d/a_2.fq\t/d/a.list\n")
    got = sorted((r.sample, r.sample_idx, r.kind, r.mate_no, r.file_name) for r in rd.read_manifest(spark, str(tmp_path / "m.txt")).collect())
    assert got[0] == ("s1", 0, "adapter", 1, "a.list") and len(got) == 5
    (tmp_path / "ad.txt").write_text("#name\tx\nr7/2\t9\n")
    assert [tuple(r) for r in rd.read_adapters(spark, str(tmp_path / "ad.txt")).collect()] == [("r7", 2)]


def test_sam(spark, tmp_path):
    head = "@SQ\tSN:c1\tLN:100\n@SQ\tSN:c2\tLN:50\n@RG\tID:g\tSM:s\tPL:ILLUMINA\n"
    (tmp_path / "a.sam").write_text(head + "r\t1040\tc1\t5\t60\t2S3M\t=\t9\t7\tACGTA\tIIIII\tRG:Z:g\tNM:i:1\n")
    r = rd.read_sam(spark, str(tmp_path)).first()
    assert (r.chrom, r.pos, r.end, r.mate_chrom, r.is_reverse, r.is_duplicate, r.read_group, r.tags["NM"]) == ("c1", 5, 7, "c1", True, True, "g", "1")
    g = rd.read_groups(spark, str(tmp_path)).first()
    assert (g.read_group, g.library, g.platform) == ("g", "s", "ILLUMINA")
    assert [tuple(x) for x in rd.contigs(spark, str(tmp_path)).orderBy("idx").collect()] == [("c1", 0, 100), ("c2", 1, 50)]


VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2
c1\t10\trs1\tA\tG,T\t50\tPASS\tDP=7;DB\tGT:AD:DP:GQ:PL\t0/1:3,4,0:7:50:50,0,60,70,80,90\t./.
c1\t20\t.\tAT\tA\t.\tq10;q20\t.\tGT\t1|1\t0/0
"""


def test_vcf_and_round_trip(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(VCF)
    v = vs.read_vcf(spark, str(tmp_path / "a.vcf"))
    a, b = v.orderBy("pos").collect()
    assert (a.alts, a.info, a.is_filtered, b.end, b.filters, b.qual) == (["G", "T"], {"DP": "7", "DB": ""}, False, 21, ["q10", "q20"], None)
    g = vs.vcf_genotypes(v, vs.vcf_samples(spark, str(tmp_path / "a.vcf")))
    got = {(r.pos, r.sample): (r.gt, r.gq, r.ad, r.phased) for r in g.collect()}
    assert got[(10, "s1")] == ([0, 1], 50, [3, 4, 0], False) and got[(10, "s2")][0] == [-1, -1] and got[(20, "s1")] == ([1, 1], None, None, True)
    sinks.write_vcf(v, str(tmp_path / "out"))
    again = vs.read_vcf(spark, str(tmp_path / "out"))
    cols = ["chrom", "pos", "end", "id", "ref", "alts", "qual", "filters"]
    assert sorted(map(tuple, again.select(cols).collect()), key=str) == sorted(map(tuple, v.select(cols).collect()), key=str)


def test_bed(spark, tmp_path):
    (tmp_path / "r.bed").write_text("#x\n\nc1\t0\t10\tn1\nG\tT\tc2\t5\t6\n")
    assert sorted(map(tuple, vs.read_bed(spark, str(tmp_path)).collect())) == [("c1", 1, 10, "n1"), ("c2", 6, 6, "G:T")]


def test_reference(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">c1 text\nACG\nTA\n>c2\nGGGG\n")
    blocks = vs.read_reference(spark, str(tmp_path))
    assert sorted(map(tuple, blocks.collect())) == [("c1", 1, "ACG"), ("c1", 4, "TA"), ("c2", 1, "GGGG")]
    assert [r.base for r in vs.reference_positions(blocks).filter("chrom = 'c1'").orderBy("pos").collect()] == list("ACGTA")


def test_gene_model(spark, tmp_path):
    line = "585\tNM_1\tc1\t-\t10\t50\t15\t45\t2\t10,30,\t20,50,\t0\tGENE1\n"
    (tmp_path / "g.txt").write_text(line)
    e = vs.read_gene_model(spark, str(tmp_path))
    got = [(r.transcript, r.gene, r.start, r.end, r.cds_start, r.cds_end, r.is_minus) for r in e.orderBy("start").collect()]
    assert got == [("NM_1", "GENE1", 11, 20, 16, 45, True), ("NM_1", "GENE1", 31, 50, 16, 45, True)]
    assert tuple(vs.genes_of(e).select("start", "end", "is_coding").first()) == (11, 50, True)


def test_writers(spark, tmp_path):
    d = spark.createDataFrame([("s1", "c", 5, 1), ("s2", "c", 3, 2), ("s1", "c", 2, 3)], "sample string, chrom string, pos long, v int")
    sinks.write_by_sample(d, str(tmp_path / "o"), partitions=2)
    assert spark.read.parquet(str(tmp_path / "o")).groupBy("sample").count().count() == 2
    sinks.write_tsv(d.withColumn("e", F.lit("")), str(tmp_path / "t"), ["sample", "e"], {"e": "na"})
    assert spark.read.text(str(tmp_path / "t")).filter("value LIKE '%\tna'").count() == 3
    (tmp_path / "db.txt").write_text("#chr\tpos\tx\tref\n1\t5\tz\tA\n")
    assert vs.load_annotation_table(spark, str(tmp_path / "db.txt")).first()["row_key"] == "1-5-A"


def test_rowwise_on_a_stream(spark, tmp_path):
    d = spark.createDataFrame([("s", "a", 1, "ACGT", "IIII", 0), ("s", "b", 1, "NNNT", "IIII", 0), ("s", "c", 1, "ACGT", "IIII", 1024)],
                              "sample string, read_name string, mate_no int, bases string, quals string, flag int")
    d.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(d.schema).parquet(str(tmp_path / "in"))
    out = clean_single_reads(filter_reads(stream, drop_duplicate()))
    q = out.writeStream.format("memory").queryName("clean_reads").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert [r.read_name for r in spark.sql("SELECT * FROM clean_reads").collect()] == ["a"]
