from seqloom import sources as s


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fastq_and_fasta(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r1 x\nACGT\n+\n@II+\n@r2\nGG\n+\nII\n")
    got = rows(s.fastq(spark, str(tmp_path / "a.fastq")).select("record", "read_id", "seq", "qual"))
    assert got == [(1, "r1 x", "ACGT", "@II+"), (2, "r2", "GG", "II")]
    assert rows(s.fastq_sequences(spark, str(tmp_path / "a.fastq"))) == [("r1 x", "ACGT"), ("r2", "GG")]
    (tmp_path / "a.fa").write_text(">s1_x3\nACG\nT\n>s2\nGG\n")
    assert rows(s.fasta(spark, str(tmp_path / "a.fa"))) == [("s1_x3", "ACGT"), ("s2", "GG")]
    s.write_fasta(s.fasta(spark, str(tmp_path / "a.fa")), str(tmp_path / "out"), "read_id")
    assert rows(s.fasta(spark, str(tmp_path / "out"))) == [("s1_x3", "ACGT"), ("s2", "GG")]
    s.write_fastq(s.fastq(spark, str(tmp_path / "a.fastq")), str(tmp_path / "outq"))
    assert s.fastq(spark, str(tmp_path / "outq")).count() == 2


def test_lines_are_numbered_across_blocks(spark, tmp_path):
    (tmp_path / "long.txt").write_text("".join(f"line {i}\n" for i in range(1, 4001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = s.lines(spark, str(tmp_path / "long.txt")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 4000 and all(r.value == f"line {r.line}" for r in got)


def test_sam_and_junctions(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nq1\t0\tchr1\t5\t255\t4M\t*\t0\t0\tACGT\tIIII\tNH:i:2\tNM:i:0\n")
    r = s.sam(spark, str(tmp_path / "a.sam")).first()
    assert (r.qname, r.flag, r.pos, r.NH, r.HI, r.NM) == ("q1", 0, 5, 2, None, 0)
    (tmp_path / "sj.tab").write_text("chr1\t10\t20\t1\t1\t0\t5\t2\t30\n")
    assert s.junctions(spark, str(tmp_path / "sj.tab")).first().unique_reads == 5


def test_gtf(spark, tmp_path):
    (tmp_path / "a.gtf").write_text('#c\nchr1\tx\ttranscript\t1\t9\t.\t+\t.\tgene_id "G"; transcript_id "T"; gene_name "N"; tag "a"; tag "b";\n')
    g = s.gtf(spark, str(tmp_path / "a.gtf"))
    assert g.first().attributes == {"gene_id": "G", "transcript_id": "T", "gene_name": "N", "tag": "a"}
    assert rows(s.gene_symbols(g)) == [("G", "N", "T")]
    s.write_gtf(g, str(tmp_path / "out"))
    assert s.gtf(spark, str(tmp_path / "out")).first().attributes["tag"] == "a"


def test_report(spark, tmp_path):
    (tmp_path / "r.txt").write_text(">>Basic\tpass\nx\t1\n>>END_MODULE\n>>Adapter Content\tfail\n#Position\tA\tB\n1\t0.5\t0\n2-3\t1.5\t0\n>>END_MODULE\n")
    assert rows(s.report_section(spark, str(tmp_path / "r.txt"), "Adapter Content").select("status", "position", "column", "value")) == [("fail", "1", "A", 0.5), ("fail", "1", "B", 0.0), ("fail", "2-3", "A", 1.5), ("fail", "2-3", "B", 0.0)]


def test_trim_report_and_tables(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"adapter_cutting": {"read1_adapter_sequence": "AG"},\n "summary": {"before_filtering": {"total_reads": 9}}}')
    r = s.trim_report(spark, str(tmp_path / "t.json")).first()
    assert r.adapter_cutting.read1_adapter_sequence == "AG" and r.summary.after_filtering is None
    s.write_table(spark.createDataFrame([(1, "a")], "n int, t string"), str(tmp_path / "csv"))
    assert rows(s.table(spark, str(tmp_path / "csv"))) == [(1, "a")]


def test_listing_and_binding(spark, tmp_path):
    for n in ("R1_1.fastq.gz", "R1_2.fastq.gz", "R2.fastq", "R3.fq"):
        (tmp_path / n).write_text("x")
    files = s.listing(spark, str(tmp_path))
    assert files.count() == 4 and files.first().length == 1
    runs = spark.createDataFrame([("R1", "PAIRED"), ("R2", "SINGLE"), ("R3", "PAIRED"), ("R4", "SINGLE")], "run string, layout string")
    assert rows(s.bind_files(runs, files).select("run", "ok")) == [("R1", True), ("R2", True), ("R3", False), ("R4", False)]


def test_bedgraph(spark, tmp_path):
    s.write_bedgraph(spark.createDataFrame([("c", 1, 3, 2)], "chr string, start int, end int, score int"), str(tmp_path / "b"))
    assert spark.read.text(str(tmp_path / "b")).first()[0] == "c\t0\t3\t2"
