"""Round trips of sources and sinks, and operators that take their tables, on literal fixtures."""

import pytest

from exonlake import store
from exonlake.functions import coords
from exonlake.operators import collapse, events, interval, last_exons, usage
from exonlake.plans import jobs
from exonlake.sources import fasta, genomic, samples


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_bed(spark, tmp_path):
    (tmp_path / "s.bed").write_text("# sites\nchr1\t5\t6\tchr1:6:+\t.\t+\nchr2\t10\t11\tchr2:99:-\t.\t-\n")
    bed = genomic.read_bed(spark, str(tmp_path / "s.bed"))
    assert rows(bed, "chrom", "start", "end", "strand") == [("chr1", 5, 6, "+"), ("chr2", 10, 11, "-")]
    assert rows(genomic.point_features(bed), "chrom", "coordinate", "label") == [("chr1", 6, "CPAS"), ("chr2", 99, "CPAS")]
    assert rows(genomic.point_features(bed, add_chr=True, standard_bed6=True), "chrom", "coordinate") == [("chrchr1", 6), ("chrchr2", 11)]


def test_gtf_round_trip(spark, tmp_path):
    table = spark.createDataFrame([("c", "+", 4, 9, "g", "t", None), ("c", "-", 0, 3, "h", "u", "x")], "chrom string, strand string, start long, end long, gene_id string, transcript_id string, note string")
    genomic.write_gtf(table, str(tmp_path / "out"), ["gene_id", "transcript_id", "note"])
    back = genomic.read_gtf(spark, str(tmp_path / "out"), ["gene_id", "transcript_id", "note"], feature="exon")
    assert set(rows(back, *table.columns)) == {tuple(r) for r in table.collect()}
    assert genomic.read_gtf(spark, str(tmp_path / "out"), feature="CDS").count() == 0


def test_tables_and_experiments(spark, tmp_path):
    table = spark.createDataFrame([("a", 1.5), ("b", None)], "le_id string, v double")
    for k in ("e1", "e2"):
        genomic.write_table(table, str(tmp_path / k / "r.tsv"))
    assert set(rows(genomic.read_table(spark, str(tmp_path / "e1" / "r.tsv"), "le_id string, v double"), "le_id", "v")) == {("a", 1.5), ("b", None)}
    (tmp_path / "x" / "one").mkdir(parents=True)
    (tmp_path / "x" / "two").mkdir()
    for k, v in (("one", "1"), ("two", "NA")):
        (tmp_path / "x" / k / "results.tsv").write_text(f"le_id\tdelta\nle\t{v}\n")
    own = genomic.read_experiments(spark, str(tmp_path / "x"), "results.tsv", "le_id string, delta double")
    assert set(rows(own, "experiment_id", "delta")) == {("one", 1.0), ("two", None)}


def test_motif_list(spark, tmp_path, monkeypatch):
    (tmp_path / "m.txt").write_text("aataaa\n\n ATTAAA \n")
    assert genomic.read_motifs(spark, str(tmp_path / "m.txt")) == ["AATAAA", "ATTAAA"]
    monkeypatch.setattr(genomic, "MAX_MOTIFS", 1)
    with pytest.raises(ValueError, match="more than 1"):
        genomic.read_motifs(spark, str(tmp_path / "m.txt"))


def test_sheets_quantification_and_tracking(spark, tmp_path, monkeypatch):
    for s, tpm in (("s1", 3.0), ("s2", 5.0)):
        (tmp_path / s).mkdir()
        (tmp_path / s / "quant.sf").write_text(f"Name\tLength\tEffectiveLength\tTPM\tNumReads\nt1\t100\t90.5\t{tpm}\t7\n")
    assert rows(samples.read_quant(spark, str(tmp_path), ["s1", "s2"]), "transcript_id", "sample", "length", "tpm", "count") == [("t1", "s1", 90.5, 3.0, 7.0), ("t1", "s2", 90.5, 5.0, 7.0)]
    with pytest.raises(Exception, match="(?i)path"):
        samples.read_quant(spark, str(tmp_path), ["s1", "s3"]).collect()
    (tmp_path / "t.tracking").write_text("T1\tG1\tr|x\t=\tq1:g|tx1|2|0.1|0.2|4.5|900\t-\n")
    assert rows(samples.read_tracking(spark, str(tmp_path / "t.tracking"), ["s1", "s2"]), "transcript_id", "sample", "tpm") == [("T1", "s1", 4.5), ("T1", "s2", 0.0)]
    sheet = spark.createDataFrame([("a", "c", None), ("b", "d", "f")], "sample_name string, condition string, fastq2 string")
    own = samples.design(sheet, "d")
    assert own.base == "d" and own.contrast() == "cvsd" and not own.single_end
    for wrong in ({"base_condition": "z"},):
        with pytest.raises(ValueError):
            samples.design(sheet, **wrong)
    monkeypatch.setattr(samples, "MAX_SAMPLES", 1)
    with pytest.raises(ValueError, match="more than 1"):
        samples.design(sheet)


def test_transcript_files(spark, tmp_path):
    (tmp_path / "t.fa").write_text(">t1 extra\nACGT\nAC\n>t2\nGG\n")
    assert rows(fasta.read_transcripts(spark, str(tmp_path / "t.fa")), "name", "sequence") == [("t1", "ACGTAC"), ("t2", "GG")]
    (tmp_path / "g.fa").write_text(">c1\nACGTA\nCG\n>c2\nTTT\n")
    (tmp_path / "g.fa.fai").write_text("c1\t7\t4\t5\t6\nc2\t3\t17\t3\t4\n")
    for path in (str(tmp_path / "g.fa"), f"file://{tmp_path / 'g.fa'}"):
        assert rows(fasta.read_fasta(spark, path, chunk=3), "chrom", "chunk", "seq") == [("c1", 0, "ACG"), ("c1", 1, "TAC"), ("c1", 2, "G"), ("c2", 0, "TTT")]


def test_metadata_helpers(spark):
    df = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "x", "q"), ("b", 3, "y", "r"), ("b", 3, "z", "s"), ("b", 4, "z", "t")], "id string, k int, c string, d string")
    assert rows(collapse.fill_nulls(df, ["d"]), "d")[0] == ("NULL",) and collapse.count_ids(df, "id").first()[0] == 2
    assert rows(collapse.first_of_duplicates(df, ["id"], ["k", "c"]), "id", "k", "c") == [("a", 1, "x"), ("b", 3, "y")]
    assert rows(collapse.collapse_consistent(df, "id", ["k", "c", "d"], ["k", "c"]), "id", "k", "c", "d") == [("a", "1,2", "x", "NULL,q"), ("b", "3,4", "y,z", "r,s,t")]
    odd = spark.createDataFrame([("o", "1", "x", "p"), ("o", "2", "x", "q"), ("o", "2", "x", "r")], "id string, a string, b string, c string")
    assert rows(collapse.inconsistent_ids(odd, "id", ["a", "b", "c"]), "id") == [("o",)] and collapse.collapse_consistent(odd, "id", ["a", "b", "c"], ["a", "c"]).count() == 3
    tpm = spark.createDataFrame([("t", "s1", 3.0), ("u", "s1", 1.0), ("u", "s2", 2.0)], "transcript_id string, sample string, tpm double")
    assert rows(usage.mean_over_samples(tpm, 2, "transcript_id"), "transcript_id", "mean_tpm") == [("t", 1.5), ("u", 1.5)]
    genes = spark.createDataFrame([("novel1", "n", "g", "G"), ("h", "H", None, None)], "gene_id string, gene_name string, gene_id_ref string, gene_name_ref string")
    assert rows(last_exons.common_gene(genes), "ref_gene_id", "ref_gene_name") == [("g", "G"), ("h", "H")]


def test_run_modes():
    assert jobs.id_maps_for("provided", provided={"tx2le": 1}) == {"tx2le": 1}
    for mode in ("provided", "other"):
        with pytest.raises(ValueError):
            jobs.id_maps_for(mode)


def test_forced_extensions_need_an_id(spark):
    types = spark.createDataFrame([("t_ext", "x"), ("u", "y")], "transcript_id string, event_type string")
    assert rows(events.forced_extensions(types, "_ext"), "transcript_id", "event_type") == [("t_ext", "last_exon_extension"), ("u", "y")]
    with pytest.raises(ValueError, match="contains"):
        events.forced_extensions(types, "none")


def test_strands_and_lengths(spark):
    df = spark.createDataFrame([("+", 1, 2), (".", 1, 2), ("-", 3, 3), (None, 1, 4)], "strand string, start long, end long")
    assert rows(coords.stranded(df), "strand", "start") == [("+", 1), ("-", 3)] and coords.with_length(df).count() == 3


def test_long_rows_meet_few_candidates(spark):
    """Rows of mixed length: copies at coarse levels meet rows of that level alone, so candidates stay near what the fine bins give."""
    import random

    rng = random.Random(4)
    made = [(f"r{k}", "c", "+", s := rng.randrange(40_000_000), s + (rng.choice([2_000_000, 30_000_000]) if k % 400 == 0 else rng.choice([80, 300, 9000]))) for k in range(4000)]
    df = spark.createDataFrame(made, "id string, chrom string, strand string, start long, end long")
    short = df.where("end - start < 10000")
    pairs = interval.overlap_join(df, df).count()
    assert pairs == sum(1 for a in made for b in made if a[3] < b[4] and b[3] < a[4])
    few = interval.candidates(short, short)[0].count()
    assert few <= 4 * interval.overlap_join(short, short).count()
    assert interval.candidates(df, df)[0].count() <= 4 * pairs


def test_tables_of_a_job_go_with_it(spark):
    import os

    before = store.written(spark.range(2), "kept")
    paths = []
    with pytest.raises(ZeroDivisionError), store.job(spark):
        paths += store.written(spark.range(3), "t").inputFiles()
        with store.job(spark):
            paths += store.written(spark.range(3), "u").inputFiles()
        assert not os.path.exists(paths[-1].removeprefix("file://")) and os.path.exists(paths[0].removeprefix("file://"))
        1 / 0
    assert not any(os.path.exists(p.removeprefix("file://")) for p in paths) and before.count() == 2


def test_shared_folder(spark):
    table = store.written(spark.range(3), "t")
    assert table.count() == 3 and table.inputFiles()[0].startswith("file:")
