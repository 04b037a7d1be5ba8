"""Text sources, logs, sequence functions and sinks on small files."""

import pytest
from pyspark.sql import functions as F

from cladespark.functions import sequence
from cladespark.operators import counting, probes, reads
from cladespark.sinks import python_boolean, write_fasta, write_report, write_tsv
from cladespark.sources import logs, text
from cladespark.streaming import depth

CALL = "0|1:0|1:0.95:1:12:0:1:0:.:.:.:.:.:.:0|7;1|5:0|6;1|6"


def file(tmp_path, name, body):
    path = tmp_path / name
    path.write_text(body)
    return str(path)


def test_sample_sheet(spark, tmp_path):
    path = file(tmp_path, "s.csv", "sample_id,ms_fastq_1,meth_fastq_1,group\n#x,a.fq,,g\na,a.fq,,g1\n\nb,,m.fq,\n")
    rows = text.sample_sheet(spark, path)
    assert [(r.sample_id, r.grp, r.color) for r in rows.orderBy("sample_id").collect()] == [("a", "g1", "grey"), ("b", "unknown", "grey")]
    assert [r.sample_id for r in text.with_reads(rows).collect()] == ["a"]
    assert [r.sample_id for r in text.with_reads(rows, "meth_fastq_1").collect()] == ["b"]


def test_bed(spark, tmp_path):
    path = file(tmp_path, "t.bed", "chr1\t100\t110\t1\t10\tT1\nchr1\tx\t110\t1\t10\tbad\nchr1\t5\t6\nchr2\t100\t112\t1\t12\tT1\n")
    assert [(r.chrom, r.num_copies) for r in text.bed(spark, path).collect()] == [("chr2", 12)]
    assert {r.target for r in text.bed_intervals(spark, path).collect()} == {"chr1:100-110", "chr1:5-6", "chr2:100-112"}


def test_vcf(spark, tmp_path):
    head = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n"
    fmt = "GT:GB:Q:PQ:DP:DSNP:DSTUTTER:DFLANKINDEL:PDP:PSNP:GLDIFF:AB:DAB:FS:MALLREADS:ALLREADS"
    path = file(tmp_path, "v.vcf", head + f"chr1\t1\tT1\tA\t.\t.\t.\tPERIOD=1\t{fmt}\t{CALL}\t.\n" + f"chr1\t2\tx_12xA\tA\t.\t.\t.\tPERIOD=2\t{fmt}\t{CALL.replace('0|1:0.95', '4|2:0.5')}\t{CALL}\n")
    records = text.vcf(spark, path)
    assert records.count() == 4
    calls = {(r.target, r.sample): r for r in text.calls(records).collect()}
    assert set(calls) == {("T1", "A"), ("x_12xA", "A"), ("x_12xA", "B")}
    one = calls["T1", "A"]
    assert (one.gb, one.q, one.depth, one.stutter, one.reads) == ([0, 1], 0.95, 12, 1, "0|7;1|5")
    assert {(r.target, r.sample): r.depth for r in text.coverage(records).collect()}["T1", "B"] == 0
    assert sorted((r.length, r.q) for r in text.quality_by_length(records, "c").collect()) == [(12, 0.5), (12, 0.95)]
    both = {(r.target, r.sample): (r.lo, r.hi) for r in text.both_alleles(records).collect()}
    assert both["x_12xA", "A"] == (1, 2)
    assert both["T1", "B"] == (None, None)


def test_allc(spark, tmp_path):
    path = file(tmp_path, "allc_c1.tsv", "#h\nchr1\t5\t+\tCGA\t1\t2\t1\nchr1\t6\t+\tCHG\t1\t2\t1\nchr1\t7\t+\tCGT\t3\t2\t1\nchr1\t8\t+\tCGT\t0\t0\t0\nbad\n")
    assert [(r.site, r.frac) for r in text.allc(spark, path).collect()] == [("1_5", 0.5)]
    assert text.allc(spark, path, cg_only=False).count() == 2
    assert text.cpg_lines(spark, path).first().cpgs == 3
    names = spark.createDataFrame([("x/allc_c1.tsv.gz", "x/ref.a.tsv")], "a string, b string").select(text.cell_name(F.col("a")).alias("c"), text.reference_name(F.col("b")).alias("r"))
    assert tuple(names.first()) == ("c1", "ref")


def test_depth_files_and_matrix(spark, tmp_path):
    path = file(tmp_path, "s1.depth.tsv", "target_id\tdepth\nT1\t12\n\nT2\t3\n")
    assert sorted((r.sample, r.target, r.depth) for r in text.depth_files(spark, path).collect()) == [("s1", "T1", 12), ("s1", "T2", 3)]
    path = file(tmp_path, "m.csv", ",A,B\nA,0,3\nB,3,0\n")
    assert {(r.row, r.col): r.value for r in text.matrix(spark, path).collect()}["A", "B"] == 3


def test_fastq_and_fasta(spark, tmp_path):
    path = file(tmp_path, "r.fastq", "@1\nACGT\n+\nIIII\n@2\nGGGG\n+\nIIII\n")
    assert [(r.read_no, r.seq) for r in text.fastq(spark, path).orderBy("read_no").collect()] == [(0, "ACGT"), (1, "GGGG")]
    path = file(tmp_path, "g.fa", ">chr1 x\nacg\nt\n>chr2\n>chr3\nTT\n")
    assert {r.chrom: r.seq for r in text.fasta(spark, path).collect()} == {"chr1": "ACGT", "chr2": "", "chr3": "TT"}
    path = file(tmp_path, "re.txt", "MspI\tC|CGG\n")
    assert [(r.name, r.seq, r.cut) for r in text.enzymes(spark, path).collect()] == [("MspI", "CCGG", 1)]
    path = file(tmp_path, "ms.bed", "#h\n1\tchr1\t2\t6\t4xA\n")
    assert [(r.target, r.end) for r in text.repeat_locations(spark, path).collect()] == [("chr1:2_6_4xA", 6)]
    path = file(tmp_path, "i.list", "@HD\nchr1\t1\t2\t+\tn\n")
    assert text.interval_list(spark, path).count() == 1
    path = file(tmp_path, "p.tsv", "chr1_1_9_3xA\tGGAAACCCCAAAT\n")
    assert [(r.up, r.down) for r in text.probe_info(spark, path).collect()] == [("GG", "CCCC")]
    with pytest.raises(ValueError, match="different numbers"):
        reads.same_number(spark.range(1), spark.range(2))


def test_logs(spark, tmp_path):
    log = "x\nProcessing file: a\nThere are 1,000 total input read pairs\nThere are 900 uniquely mapping read pairs\nThere are 800 non-clonal read pairs\nProcessing file: b\nThere are 5 total input read pairs\n"
    got = logs.methylpy_sessions(logs.whole(spark, file(tmp_path, "l.txt", log))).collect()
    assert [(r.sample, r.total, r.mapped, r.deduplicated) for r in got] == [("a", 1000, 900, 800)]
    flag = "33255366 + 0 in total\n" + "x\n" * 5 + "33212345 + 0 mapped (99.87% : N/A)\n"
    assert tuple(logs.flagstat(logs.whole(spark, file(tmp_path, "f.txt", flag))).first())[1:] == (33255366, 99.87)
    hs = "# x\n## METRICS CLASS\tY\nA\tB\n1\t\n"
    assert {r.metric: r.value for r in logs.hs_metrics(logs.whole(spark, file(tmp_path, "h.txt", hs))).collect()} == {"A": "1", "B": None}
    bis = "Mapping efficiency:\t50.5%\nC methylated in CpG context:\t0.7%\nC methylated in CHG context:\t0.5%\nC methylated in CHH context:\t0.4%\n"
    assert logs.bismark_average(logs.bismark_report(logs.whole(spark, file(tmp_path, "b.txt", bis)))).first().conversion == 99.3
    name = spark.createDataFrame([("a_b_c_liver_20240101_x",)], "n string").select(logs.bismark_sample(F.col("n")).alias("s"))
    assert name.first().s == "liver_x"


def test_sequence_functions(spark):
    df = spark.createDataFrame([("GAAAAAAAAAAAT",), ("GAAAAAAAAAAT",), (None,)], "s string")
    assert [r.r and [tuple(x) for x in r.r] for r in df.select(sequence.runs(F.col("s")).alias("r")).collect()] == [[(2, 12, 10, "A")], [], None]
    one = spark.createDataFrame([("ATCGN", "chr1:5-15_10xA", "junk")], "s string, t string, u string")
    got = one.select(sequence.reverse_complement(F.col("s")).alias("rc"), sequence.parse_target_id(F.col("t")).alias("t"), sequence.parse_target_id(F.col("u")).alias("u"), sequence.cut_sites(F.lit("ACCGGTCCGG"), "C|CGG").alias("c")).first()
    assert got.rc == "NCGAT"
    assert tuple(got.t) == ("chr1", 5, 15, 10, "A")
    assert got.u.chrom is None
    assert got.c == [2, 7]


def test_reads_span_targets(spark):
    targets = spark.createDataFrame([("T", "chr1", 100, 110)], "target string, chrom string, t_start int, t_end int")
    rows = spark.createDataFrame([("s", "chr1", 100, 110), ("s", "chr1", 101, 110), ("s", "chr1", 0, 5000), ("s", "chr2", 0, 5000)], "sample string, chrom string, ref_start int, ref_end int")
    assert [r.depth for r in counting.spanning_counts(rows, targets).collect()] == [2]
    assert counting.spanning_counts(rows.limit(0), targets).count() == 0


def test_stats_of_one_table_only(spark):
    ms = spark.createDataFrame([("a", 200)], "sample string, targets_with_min_reads long")
    cpg = spark.createDataFrame([("b", 5)], "sample string, cpg_count long")
    got = {r.sample: (r.targets_with_min_reads, r.cpg_count, r["pass"]) for r in counting.merged_stats(ms, cpg).collect()}
    assert got == {"a": (200, 0, True), "b": (0, 5, False)}


def test_fragments_between_cuts(spark):
    marks = spark.createDataFrame([("c", 10, "RE_x"), ("c", 15, "MS_t"), ("c", 20, "MS_t"), ("c", 30, "RE_x"), ("c", 40, "RE_y")], "chrom string, pos int, item string")
    got = [(r.start, r.end, r.re_left, r.target) for r in probes.fragments(marks).orderBy("start").collect()]
    assert got == [(0, 10, "Start", None), (10, 30, "x", "t")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", True), ("a", False)], "id string, pass boolean")
    write_tsv(df, str(tmp_path / "o"), ["id"])
    assert [r.value for r in spark.read.text(str(tmp_path / "o")).collect()] == ["id\tpass", "a\tFalse", "b\tTrue"]
    assert df.select(python_boolean(F.col("pass")).alias("v")).first().v == "True"
    write_report(df.limit(1), str(tmp_path / "r"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "r")).collect()) == ["id\tb", "pass\tTrue"]
    write_fasta(spark.createDataFrame([("t", "ACGT")], "target string, seq string"), str(tmp_path / "f"))
    assert [r.value for r in spark.read.text(str(tmp_path / "f")).collect()] == [">t", "ACGT"]


def test_streamed_depth_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([("a", "t1", 12), ("a", "t2", 3), ("b", "t1", 10)], depth.SCHEMA)
    folder = str(tmp_path / "in")
    rows.filter("sample = 'a'").write.parquet(folder)
    rows.filter("sample = 'b'").write.mode("append").parquet(folder)
    query = depth.start(depth.running_stats(depth.arriving_depth(spark, folder, 1)), str(tmp_path / "out"), str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()
    got = {tuple(r) for r in depth.current(spark, str(tmp_path / "out")).collect()}
    assert got == {tuple(r) for r in depth.running_stats(rows).collect()}


def test_stream_versions_are_whole_and_count_once(spark, tmp_path):
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [[("a", "t1", 12), ("a", "t2", 3)], [("b", "t1", 10)], [("a", "t3", 50), ("c", "t1", 0)], [("b", "t2", 11)], [("c", "t2", 30)]]
    table = lambda upto: {tuple(r) for r in depth.running_stats(spark.createDataFrame([r for b in batches[:upto] for r in b], depth.SCHEMA)).collect()}
    assert depth.current(spark, out).count() == 0
    for n, rows in enumerate(batches, 1):  # stopped and started again for each
        spark.createDataFrame(rows, depth.SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stats = depth.running_stats(depth.arriving_depth(spark, folder, 1))
        query = depth.start(stats, out, state, once=True)
        query.awaitTermination()
        assert {tuple(r) for r in depth.current(spark, out).collect()} == table(n)
        assert len(depth.versions(spark, out)) <= 3
    # a version that is being written has no mark yet, and isn't read
    spark.createDataFrame([("x", 9, 9)], depth.STATS).write.parquet(f"{out}/{depth.FOLDER}{999:012d}")
    assert {tuple(r) for r in depth.current(spark, out).collect()} == table(5)
    reader = depth.current(spark, out)
    spark.createDataFrame([("d", "t1", 10)], depth.SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    depth.start(depth.running_stats(depth.arriving_depth(spark, folder, 1)), out, state, once=True).awaitTermination()
    assert {tuple(r) for r in reader.collect()} == table(5)  # one that had begun
    assert depth.current(spark, out).filter("sample = 'd'").count() == 1


def test_vcf_headings(spark, tmp_path):
    from cladespark.sinks import write_vcf

    kinds = "chrom string, pos int, target string, info string, format string, sample string, call string"
    write_vcf(spark.createDataFrame([], kinds), str(tmp_path / "none"), samples=["b", "a"])
    assert [r.value.split("\t")[-2:] for r in spark.read.text(str(tmp_path / "none")).filter("value like '#CHROM%'").collect()] == [["b", "a"]]
    assert text.vcf(spark, str(tmp_path / "none")).count() == 0
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "3")
    try:
        rows = [("chr1", p, f"t{p}", "PERIOD=1", "GT", s, f"{p}") for p in range(20) for s in "ab"]
        write_vcf(spark.createDataFrame(rows, kinds), str(tmp_path / "some"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert sorted((r.pos, r.sample, r.call) for r in text.vcf(spark, str(tmp_path / "some")).collect()) == sorted((p, s, c) for _, p, _, _, _, s, c in rows)


def test_files_of_patterns(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name in ("b.txt", "a.txt", "d/c.txt", ".hidden", "_temporary"):
        (tmp_path / name).write_text("x")
    names = lambda *patterns: [r.file.removeprefix(f"file:{tmp_path}/") for r in text.files(spark, [f"{tmp_path}/{p}" for p in patterns]).collect()]
    assert names("*.txt", "d", "a.txt", "none/*") == ["a.txt", "b.txt", "d/c.txt"]
    assert names("") == ["a.txt", "b.txt"] and names("zzz*") == []
