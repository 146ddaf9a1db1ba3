"""Last-exon detection and its parts against worked examples and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from exonlake.functions.motif import motif_hits, motif_string, parse_motif_string, reverse_complement
from exonlake.functions.stats import benjamini_hochberg, gene_q_values
from exonlake.operators import events, filters, interval, last_exons, structure, three_ends
from exonlake.plans import jobs
from exonlake.sources import fasta, genomic, samples

REFERENCE = """ref_g1_tr_1 g1 chr1 + 100-300 1000-1200 2000-2200 3000-3400
ref_g2_tr_1 g2 chr2 - 100-200 700-800 1000-1200
ref_g3_tr_1 g3 chr3 + 100-400
ref_g3_tr_2 g3 chr3 + 100-200 700-800
ref_g3_tr_3 g3 chr3 + 100-200 1000-1200 1400-1500
ref_g3_tr_4 g3 chr3 + 100-200 1000-1200 1800-2000 2400-2600
ref_g3_tr_5_ext g3 chr3 + 100-200 1000-1200 1800-2000 2400-2800"""
NOVEL = """li_spl_p n1 chr1 + 100-300 1000-1200 2000-2200 3800-4000
le_ext_plus_p n1 chr1 + 100-300 1000-1200 2000-2200 3000-3600
fi_f n1 chr1 + 100-350 500-700
fi_p n1 chr1 + 100-300 500-700
mi_ext_f n1 chr1 + 100-300 1000-1200 1950-2400
mi_ext_no_pas_motif_p n1 chr1 + 100-300 1000-1200 2000-2600
mi_ext_p n1 chr1 + 100-300 1000-1200 2000-2400
mi_s_f n1 chr1 + 100-300 1000-1300 1400-1600
mi_s_no_pas_f n1 chr1 + 100-300 1000-1200 1750-1850
mi_s_p n1 chr1 + 100-300 1000-1200 1400-1600
fi_ext_f n2 chr2 - 880-1500
fi_ext_p n2 chr2 - 880-1200
le_ext_minus_f n2 chr2 - 50-200 700-800 1000-1200
mi_spl_minus_p n2 chr2 - 400-550 700-800 1000-1200"""
SPLICED = {"fi_p": "first_exon_spliced", "li_spl_p": "last_exon_spliced", "mi_ext_f": "internal_exon_spliced", "mi_s_no_pas_f": "internal_exon_spliced", "mi_s_p": "internal_exon_spliced", "mi_spl_minus_p": "last_exon_spliced"}
EXTENDED = {"le_ext_plus_p": "last_exon_extension", "mi_ext_no_pas_motif_p": "internal_exon_extension", "mi_ext_p": "internal_exon_extension", "fi_ext_p": "first_exon_extension"}


def exons(spark, text):
    rows = []
    for line in text.split("\n"):
        tx, gene, chrom, strand, *spans = line.split()
        rows += [(tx, gene, gene.upper(), chrom, strand, *map(int, s.split("-"))) for s in spans]
    return spark.createDataFrame(rows, "transcript_id string, gene_id string, gene_name string, chrom string, strand string, start long, end long")


def test_novel_last_exons(spark):
    novel, ref = exons(spark, NOVEL), exons(spark, REFERENCE)
    got = {r["transcript_id"]: r for r in jobs.novel_last_exons(novel, ref).collect()}
    assert {k: r["event_type"] for k, r in got.items()} == SPLICED | EXTENDED
    assert (got["mi_ext_f"]["start"], got["mi_ext_f"]["end"], got["mi_ext_f"]["gene_id_ref"]) == (1950, 2400, "g1")
    strict = {r["transcript_id"] for r in jobs.novel_last_exons(novel, ref, exclude_five_end_failures=True).collect()}
    assert set(got) - strict == {"mi_ext_f"}
    why = {r["transcript_id"]: r["reason"] for r in events.rejections(novel, ref).collect()}
    assert why == {"fi_f": "no_five_site_match", "mi_s_f": "no_five_site_match", "fi_ext_f": "five_end", "le_ext_minus_f": "length"}


def test_last_exon_ids(spark):
    ref = exons(spark, REFERENCE).where("chrom = 'chr3'")
    plain = {r["transcript_id"]: r["le_id"] for r in jobs.reference_annotation(ref)["last_exons"].collect()}
    assert plain == {"ref_g3_tr_2": "g3_1", "ref_g3_tr_3": "g3_2", "ref_g3_tr_4": "g3_3", "ref_g3_tr_5_ext": "g3_3"}
    forced = {r["transcript_id"]: r["le_id"] for r in jobs.reference_annotation(ref, "_ext")["last_exons"].collect()}
    assert forced == plain | {"ref_g3_tr_5_ext": "g3_4"}


def test_metagenes(spark):
    novel = spark.createDataFrame([("n1", "a,b,a"), ("n2", "c")], "transcript_id string, ref_gene_id string")
    ref = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r3", "c")], "transcript_id string, ref_gene_id string")
    new, old = last_exons.metagenes(novel, ref)
    assert {tuple(r) for r in new.collect()} == {("n1", "a,b"), ("n2", "c")}
    assert {(r["transcript_id"], r["ref_gene_id"]) for r in old.collect()} == {("r1", "a,b"), ("r2", "a,b"), ("r3", "c")}


def test_statistics(spark):
    p = [("g1", 1.2084626559287708e-4), ("g1", 1.01529962365023e-26), ("g1", 0.10163024034168788), ("g1", 0.03928865011600179), ("g3", 0.00110344969142553), ("g3", 0.00110344952597214)]
    frame = spark.createDataFrame([(k, g, v) for k, (g, v) in enumerate(p)] + [(9, "g3", None)], "le_id long, gene_id string, pvalue double")
    padj = {r["le_id"]: r["padj"] for r in benjamini_hochberg(frame).collect()}
    assert [padj[k] for k in range(6)] == pytest.approx([3.625387967786313e-4, 6.091797741901381e-26, 0.10163024034168788, 0.04714638013920215, 0.00165517453713829, 0.00165517453713829], rel=1e-12)
    assert padj[9] is None
    q = {r["gene_id"]: r["gene_q"] for r in gene_q_values(frame).collect()}
    assert q["g3"] == pytest.approx(0.00330608966130019, rel=1e-12) and q["g1"] < 1e-20


def _random(seed, n, top=400):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        s = rng.randrange(top)
        out.append((f"r{k}", rng.choice(["c1", "c2"]), rng.choice("+-"), s, s + rng.choice([1, 5, 20, 150])))
    return out


@pytest.mark.parametrize("bin_size", [7, 64])
def test_interval_operators_by_brute_force(spark, bin_size):
    a, b = _random(1, 40), _random(2, 50)
    b.append(b[0])
    schema = "id string, chrom string, strand string, start long, end long"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    meets = lambda x, y: x[1:3] == y[1:3] and x[3] < y[4] and y[3] < x[4]
    pairs = sorted((r["id"], r["id_ref"]) for r in interval.overlap_join(left, right, bin_size=bin_size).collect())
    assert pairs == sorted((x[0], y[0]) for x in a for y in b if meets(x, y))
    free = {r["id"] for r in interval.not_overlapping(left, right, "id", bin_size=bin_size).collect()}
    assert free == {x[0] for x in a if not any(meets(x, y) for y in b)}
    covered = {(y[1], y[2], p) for y in b for p in range(y[3], y[4])}
    left_over = {(r["id"], p) for r in interval.subtract(left, right, "id", bin_size=bin_size).collect() for p in range(r["start"], r["end"])}
    assert left_over == {(x[0], p) for x in a for p in range(x[3], x[4]) if (x[1], x[2], p) not in covered}
    merged = sorted((r["chrom"], r["strand"], r["start"], r["end"]) for r in interval.merge(right, bin_size=bin_size).collect())
    want = []
    for y in sorted(b, key=lambda y: (y[1], y[2], y[3])):
        if want and want[-1][:2] == [y[1], y[2]] and y[3] <= want[-1][3]:
            want[-1][3] = max(want[-1][3], y[4])
        else:
            want.append([y[1], y[2], y[3], y[4]])
    assert merged == sorted(map(tuple, want))
    sites = [(y[0], y[1], y[2], y[3], y[3] + 1) for y in b]
    near = {r["id"]: r["distance"] for r in interval.nearest(left, spark.createDataFrame(sites, schema), ["id"], bin_size=bin_size).collect()}
    gap = lambda x, y: 0 if meets(x, y) else (x[3] - y[4] + 1 if y[4] <= x[3] else y[3] - x[4] + 1)
    assert near == {x[0]: min(gap(x, y) for y in sites if x[1:3] == y[1:3]) for x in a}


def test_structure(spark):
    own = structure.exon_intron_tables(exons(spark, NOVEL))
    ranks = {r["start"]: r["region_rank"] for r in own["exons"].where("transcript_id = 'le_ext_minus_f'").collect()}
    assert ranks == {1000: "first", 700: "internal", 50: "last"}
    gaps = sorted((r["start"], r["end"], r["region_number"]) for r in own["introns"].where("transcript_id = 'le_ext_minus_f'").collect())
    assert gaps == [(200, 700, 2), (800, 1000, 1)]


def test_structure_in_one_pass_is_that_of_its_parts(spark):
    rng = random.Random(11)
    rows = []
    for k in range(120):
        strand, n = rng.choice("+-"), rng.randrange(1, 9)
        for _ in range(n):
            s = rng.randrange(40) * 5
            rows.append((f"t{k}", "c1", strand, s, s + rng.choice([3, 5, 12, 40])))
    df = spark.createDataFrame(rows + rows[:40], "transcript_id string, chrom string, strand string, start long, end long")
    own = structure.rank_regions(structure.number_regions(df))
    gaps = structure.rank_regions(structure.number_regions(structure.introns(df)))
    want = {"exons": own, "introns": gaps, "last_exons": structure.terminal_regions(own), "last_introns": structure.terminal_regions(gaps)}
    for write in (False, True):
        got = structure.exon_intron_tables(df, write=write)
        for name, table in want.items():
            assert got[name].dtypes == table.dtypes
            assert sorted(map(tuple, got[name].collect())) == sorted(map(tuple, table.collect())), name


def test_motifs_and_sequences(spark, tmp_path):
    seq = "ACGT" * 10 + "AATAAA" + "C" * 14 + "\n"
    genome = "".join(seq.strip()[k : k + 25] + "\n" for k in range(0, 60, 25))
    (tmp_path / "g.fa").write_text(">c1\n" + genome)
    (tmp_path / "g.fa.fai").write_text("c1\t60\t4\t25\t26\n")
    table = fasta.read_fasta(spark, str(tmp_path / "g.fa"), chunk=16)
    assert "".join(r["seq"] for r in table.orderBy("chunk").collect()) == seq.strip()
    rows = spark.createDataFrame([("t", "c1", "+", 10, 60), ("u", "c1", "-", 0, 60)], "transcript_id string, chrom string, strand string, start long, end long")
    found = {r["transcript_id"]: r["motifs"] for r in three_ends.terminal_motifs(rows, table, "transcript_id", 16, ["AATAAA", "ATA"], 20).collect()}
    assert found == {"t": "-16_ATA,-14_AATAAA", "u": "not_found"}
    spliced = {r["transcript_id"]: r["sequence"] for r in fasta.transcript_sequences(rows, table, 16).collect()}
    assert spliced["t"] == seq[10:60]
    one = spark.createDataFrame([("AATAAATAAA",)], "s string").select(motif_string(motif_hits(F.col("s"), ["AATAAA"], 10)).alias("m"), reverse_complement(F.lit("AaCg")).alias("r")).first()
    assert tuple(one) == ("-4_AATAAA,0_AATAAA", "cGtT")
    assert spark.createDataFrame([("not_found",)], "m string").select(parse_motif_string(F.col("m")).alias("d")).first()[0] == []


def test_three_end_filter(spark, tmp_path):
    rows = spark.createDataFrame([("a", "le1", "c1", "+", 0, 30, "x"), ("b", "le1", "c1", "+", 0, 33, "x"), ("c", "le2", "c1", "-", 40, 60, "x")], "transcript_id string, last_exon_id string, chrom string, strand string, start long, end long, event_type string")
    atlas = spark.createDataFrame([("c1", "+", 33, 34, "s1")], "chrom string, strand string, start long, end long, name string")
    genome = spark.createDataFrame([("c1", 0, "A" * 64)], "chrom string, chunk long, seq string")
    got = jobs.filter_three_ends(rows, atlas, genome, 64, max_distance=10, motifs=["TTT"], search_length=20)
    passed = {(r["transcript_id"], r["evidence"], r["start"], r["end"]) for r in got["passed"].collect()}
    assert passed == {("b", "atlas", 0, 34), ("c", "motif", 40, 60)}


def test_gtf(spark):
    line = 'chr1\tx\texon\t101\t300\t.\t+\t.\tgene_id "g"; gene_id_ref "h"; transcript_id "t"; exon_number "1.0"; tag "a"; tag "b";'
    lines = spark.createDataFrame([("# head",), (line,)], "value string")
    row = genomic.gtf_table(lines, ["gene_id", "transcript_id", "exon_number", "tag", "none"], repeated=["tag"]).first()
    assert (row["start"], row["end"], row["gene_id"], row["exon_number"], row["tag"], row["none"]) == (100, 300, "g", 1, "a,b", None)
    assert genomic.gtf_table(lines).first()["attributes"]["tag"] == "a,b"


def test_sources_and_filters(spark, tmp_path):
    for k in "ab":
        (tmp_path / f"{k}.last.gtf").write_text(f'chr1\tx\texon\t1\t9\t.\t+\t.\tgene_id "{k}"; transcript_id "t{k}";\n')
    many = genomic.read_many_gtf(spark, [str(tmp_path / f"{k}.last.gtf") for k in "ab"], ".last.gtf")
    assert {(r["sample_id"], r["gene_id"]) for r in many.collect()} == {("a", "a"), ("b", "b")}
    (tmp_path / "s.csv").write_text("sample_name,condition,path,fastq1,fastq2\nx1,ctl,p,f,\nx2,kd,p,f,\n")
    own = samples.design(samples.read_samples(spark, str(tmp_path / "s.csv")))
    assert own.contrast() == "kdvsctl" and own.single_end
    with pytest.raises(ValueError):
        samples.design(spark.createDataFrame([("a-b", "c", None)], "sample_name string, condition string, fastq2 string"))
    rows = spark.createDataFrame([("1", "x,y", "p"), ("NA", None, "q"), ("5", "z", "r")], "transcript_support_level string, tag string, gene_type string")
    keep = lambda **o: [r["gene_type"] for r in jobs.filter_annotation(rows, **o).collect()]
    assert keep(min_tsl=3) == ["p"] and keep(tag_exclude=["y"]) == ["q", "r"] and keep(groups=["p", "r"], more={"r": [("tag", "eq", "w")]}) == ["p"]
    with pytest.raises(ValueError):
        filters.by_group("gene_type", ["p"], {"z": []})


def test_entry_without_llm():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {"novel_last_exons", "overlap_join"} <= names and set(__spark_entry__.oracle_sql()) <= names


def test_merged_structure_is_that_of_merged_exons(spark):
    rng = random.Random(12)
    rows = []
    for k in range(150):
        for _ in range(rng.randrange(1, 9)):
            s = rng.randrange(40) * 5
            rows.append((f"t{k}", "c1", "+-"[k % 2], s, s + rng.choice([3, 5, 12, 40])))
    df = spark.createDataFrame(rows + rows[:40], "transcript_id string, chrom string, strand string, start long, end long")
    merged = interval.merge(df, ["transcript_id", "chrom", "strand"], bin_size=None).select(df.columns)
    got, want = structure.merged_structure(df), structure.numbered_structure(merged)
    assert got.columns == want.columns
    kept = [c for c in want.columns if c != "_gap_number"]
    assert sorted(map(str, got.select(kept).collect())) == sorted(map(str, want.select(kept).collect()))
    got, want = structure.structure_tables(got), structure.structure_tables(want)
    for name, table in want.items():
        assert got[name].dtypes == table.dtypes
        assert sorted(map(tuple, got[name].collect())) == sorted(map(tuple, table.collect())), name
    plan = structure.merged_structure(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1 and "Aggregate" not in plan


def test_joins_and_windows_sort_by_bins_first(spark):
    df = spark.createDataFrame([("a", "c", "+", 0, 100), ("b", "c", "-", 50, 9000)], "id string, chrom string, strand string, start long, end long")
    plan = interval.overlap_join(df, df)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "(_spot" in next(line for line in plan.splitlines() if "Join" in line)
    plan = interval.cluster(df)._jdf.queryExecution().optimizedPlan().toString()
    assert all(", [_bin#" in line for line in plan.splitlines() if "Window" in line and "_bin#" in line.split("windowspecdefinition", 1)[-1].split("ASC", 1)[0])
