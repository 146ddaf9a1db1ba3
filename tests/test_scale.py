"""What must not end up in one task or one list: huge genes, wide rows, large groups; and the FASTA source."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from exonlake import adapters as ad
from exonlake.functions.motif import motif_hits, motif_string
from exonlake.functions.quantiles import exact_quantiles
from exonlake.operators import events, interval, last_exons, structure
from exonlake.operators.merge import merge_columns
from exonlake.plans import jobs
from exonlake.sources import fasta_source

SPANS = "transcript_id string, chrom string, strand string, ref_gene_id string, start long, end long, event_type string"


def brute_numbers(rows):
    """transcript_id to number of last exons, by gene, with extensions set off."""
    out = {}
    for gene in {r[1:4] for r in rows}:
        own = sorted((r for r in rows if r[1:4] == gene), key=lambda r: (r[4], r[5]))
        islands, reach = [], None
        for r in own:
            if reach is None or r[4] > reach:
                islands.append([])
            islands[-1].append(r)
            reach = r[5] if reach is None else max(reach, r[5])
        if gene[1] == "-":
            islands.reverse()
        shift = 0
        for k, island in enumerate(islands, 1):
            extended = [r for r in island if "last_exon_extension" in (r[6] or "")]
            for r in island:
                out[r[0]] = k + shift + (r in extended)
            shift += bool(extended)
    return out


@pytest.mark.parametrize("bin_size", [50, 4096])
def test_numbers_of_a_huge_gene_and_of_no_gene(spark, monkeypatch, bin_size):
    monkeypatch.setattr(last_exons, "NUMBERS", 7)
    rng = random.Random(3)
    rows = []
    for k in range(900):
        gene = rng.choice(["big", "big", "big", None, "small"])
        chrom, strand = ("c1", "+") if gene == "big" else (rng.choice(["c1", "c2"]), rng.choice("+-"))
        s = rng.randrange(20_000 if gene == "big" else 3000)
        rows.append((f"t{k}", chrom, strand, gene, s, s + rng.choice([3, 10, 200]), rng.choice(["last_exon_extension", "last_exon_spliced", "first_exon_spliced", None])))
    got = {r["transcript_id"]: r["le_number"] for r in last_exons.with_le_ids(spark.createDataFrame(rows, SPANS), bin_size=bin_size).collect()}
    assert got == brute_numbers(rows)
    many = {r["transcript_id"] for r in last_exons.genes_with_choice(spark.createDataFrame(rows, SPANS)).collect()}
    assert many == {r[0] for r in rows if sum(x[1:4] == r[1:4] for x in rows) > 1}


def test_subtract_of_one_row_over_many_islands(spark):
    schema = "id string, chrom string, strand string, start long, end long"
    mask = [(f"m{k}", "c", "+", 10 * k + 3, 10 * k + 7) for k in range(3000)] + [("o", "d", "+", 0, 9)]
    left = [("wide", "c", "+", 0, 30_000), ("in", "c", "+", 4, 6), ("past", "c", "+", 40_000, 40_010), ("free", "c", "-", 5, 9), ("none", "e", "+", 1, 2), ("cut", "d", "+", 3, 12)]
    got = sorted((r["id"], r["start"], r["end"]) for r in interval.subtract(spark.createDataFrame(left, schema), spark.createDataFrame(mask, schema), "id").collect())
    want = [("wide", 0, 3), *(("wide", 10 * k + 7, 10 * k + 13) for k in range(2999)), ("wide", 29_997, 30_000), ("past", 40_000, 40_010), ("free", 5, 9), ("none", 1, 2), ("cut", 9, 12)]
    assert got == sorted(want)
    assert interval.subtract(spark.createDataFrame(left, schema), spark.createDataFrame([], schema), "id").count() == 6
    assert interval.subtract(spark.createDataFrame([], schema), spark.createDataFrame(mask, schema), "id").count() == 0


def test_fitted_bins(spark):
    schema = "id string, chrom string, strand string, start long, end long"
    rng = random.Random(8)
    made = [(f"r{k}", "c", "+", s := rng.randrange(100_000), s + (rng.randrange(50_000) if k % 50 == 0 else rng.randrange(60, 150))) for k in range(1500)]
    df = spark.createDataFrame(made, schema)
    width, ours, theirs = interval.fitted(df, df)
    assert 64 <= width <= 512 and ours == theirs and 0 in ours and len(ours) > 1
    pairs = interval.overlap_join(df, df).count()
    assert pairs == sum(1 for a in made for b in made if a[3] < b[4] and b[3] < a[4])
    assert interval.candidates(df, df)[0].count() <= 4 * pairs
    empty = spark.createDataFrame([], schema)
    assert interval.overlap_join(df, empty).count() == 0 == interval.overlap_join(empty, df).count()


@pytest.mark.parametrize("buckets,few", [(4, 3), (1024, 4096)])
def test_exact_quantiles(spark, buckets, few):
    rng = np.random.default_rng(4)
    groups = {"a": rng.lognormal(0, 3, 500), "b": np.repeat([1.0, 2.0], [400, 3]), "c": np.array([7.0]), None: rng.integers(0, 9, 100).astype(float), "d": np.concatenate([rng.normal(0, 1e-9, 200), [1e12, -1e12]])}
    rows = [(g, float(v)) for g, own in groups.items() for v in own] + [("a", None), ("none", None), ("c", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {r["g"]: r["q"] for r in exact_quantiles(df, "v", shares, ["g"], buckets, few).collect()}
    assert got.keys() == groups.keys()
    for g, own in groups.items():
        assert got[g] == pytest.approx(np.quantile(own, shares).tolist(), rel=1e-12, abs=1e-18)
    whole = exact_quantiles(df, "v", [0.5], (), buckets, few).first()["q"][0]
    assert whole == pytest.approx(float(np.median(np.concatenate(list(groups.values())))), rel=1e-12)
    assert exact_quantiles(df.limit(0), "v", [0.5], ["g"]).count() == 0


def test_merge_columns(spark):
    left = spark.createDataFrame([("c1", "+", "a", 1), ("c1", "+", "b", 2), ("c1", "+", None, 3), ("c2", "+", "a", 4), ("c1", "-", "a", 5)], "chrom string, strand string, id string, n int")
    right = spark.createDataFrame([("c1", "+", "a", 10, "x"), ("c1", "+", "a", 11, "y"), ("c1", "+", None, 12, "z"), ("c1", "-", "q", 13, "w")], "chrom string, strand string, id string, n int, note string")
    row = lambda df: sorted(map(tuple, df.select("chrom", "strand", "id", "n", "n_b", "note").collect()), key=str)
    met = [("c1", "+", "a", 1, 10, "x"), ("c1", "+", "a", 1, 11, "y"), ("c1", "+", None, 3, 12, "z")]
    lone = [("c2", "+", "a", 4, None, None)]
    assert row(merge_columns(left, right, "id", ["id", "n", "note"], "inner")) == sorted(met + lone, key=str)
    assert row(merge_columns(left, right, "id", ["n", "note"])) == sorted([*met, *lone, ("c1", "+", "b", 2, None, None), ("c1", "-", "a", 5, None, None)], key=str)
    none = merge_columns(left, right.limit(0), "id", ["n", "note"], "inner")
    assert none.count() == 5 and none.where("n_b is null and note is null").count() == 5 and dict(none.dtypes)["n_b"] == "int"
    assert merge_columns(left, right, "id", ["n"], suffixes=("_a", "_b")).columns == ["chrom", "strand", "id", "n_a", "n_b"]
    with pytest.raises(ValueError):
        merge_columns(left, right, "id", ["n"], "outer")


def test_fasta_source(spark, tmp_path):
    rng = random.Random(6)
    records = [(f"s{k}", "".join(rng.choice("ACGTN") for _ in range(rng.choice([0, 1, 59, 60, 61, 400, 5000])))) for k in range(40)]
    path = f"file://{tmp_path}/genome"
    fasta_source.write_fasta(spark.createDataFrame(records, "name string, sequence string").repartition(3), path)
    for chunk, size in ((7, 1000), (64, 300), (100_000, 1 << 20)):
        df = fasta_source.read_fasta(spark, path, chunk, bytes=size)
        got = {}
        for r in sorted(df.collect(), key=lambda r: (r["chrom"], r["chunk"])):
            assert r["chunk"] * chunk == len(got.get(r["chrom"], ""))
            got[r["chrom"]] = got.get(r["chrom"], "") + r["seq"]
        assert got == {n: s for n, s in records if s}
    df = fasta_source.read_fasta(spark, path, 64, bytes=640)
    one = max(records, key=lambda r: len(r[1]))
    part = fasta_source.read_fasta(spark, path, 64, [one[0]], bytes=640, low=2, past=4)
    assert sorted(r["seq"] for r in part.collect()) == sorted(one[1][k : k + 64] for k in (128, 192))
    assert part.rdd.getNumPartitions() == 1 < df.rdd.getNumPartitions()
    assert df.where(F.col("chrom") == one[0]).count() == -(-len(one[1]) // 64) < df.count()
    assert fasta_source.read_fasta(spark, path, 64, ["nowhere"]).count() == 0 and df.where("chunk = 1 and seq like 'A%'").count() == sum(s[64:65] == "A" for _, s in records)
    (tmp_path / "g.fa").write_text(">c1\nACGTA\nCG\n>c2\nTTT\n")
    (tmp_path / "g.fa.fai").write_text("c1\t7\t4\t5\t6\nc2\t3\t17\t3\t4\n")
    assert sorted(map(tuple, fasta_source.read_fasta(spark, f"file://{tmp_path}/g.fa", 3).collect())) == [("c1", 0, "ACG"), ("c1", 1, "TAC"), ("c1", 2, "G"), ("c2", 0, "TTT")]


def test_motif_hits_by_brute_force(spark):
    rng = random.Random(2)
    motifs = ["AA", "AAA", "ATA", "TAAT", "C.G"]
    texts = ["".join(rng.choice("AT") for _ in range(n)) for n in (0, 1, 2, 5, 40, 700)] + ["C.GCxGAA", "é" * 5 + "AA", None]
    got = [r["m"] for r in spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", motif_string(motif_hits(F.col("t"), motifs, 100)).alias("m")).orderBy("k").collect()]
    for t, m in zip(texts, got, strict=True):
        hits = sorted((i + len(w) - 100, w) for w in motifs for i in range(len(t or "")) if (t or "")[i : i + len(w)] == w)
        assert m == (",".join(f"{d}_{w}" for d, w in hits) or "not_found")


def test_one_overlap_classifies(spark):
    """in_exon and the shortest extension of the one join are those of the separate operators."""
    rng = random.Random(5)
    exon = lambda k: (f"t{k % 60}", "c", rng.choice("+-"), (s := rng.randrange(3000)), s + rng.randrange(20, 200), f"g{k % 9}", f"G{k % 9}")
    schema = "transcript_id string, chrom string, strand string, start long, end long, gene_id string, gene_name string"
    ref = structure.rank_regions(structure.number_regions(spark.createDataFrame([exon(k) for k in range(120)], schema)))
    last = spark.createDataFrame([(f"n{k}", "c", rng.choice("+-"), (s := rng.randrange(3000)), s + rng.randrange(20, 300)) for k in range(80)], "transcript_id string, chrom string, strand string, start long, end long")
    found = {r["transcript_id"]: r for r in events.classified_last_exons(last, ref, 50, 100, 0).collect()}
    free = {r["transcript_id"] for r in events.no_three_end_overlap(last, ref).collect()}
    assert len(found) == 80 and {k for k, r in found.items() if not r["in_exon"]} == free
    extended = {r["transcript_id"]: (r["extension"], r["reject_reason"], r["event_type"], r["transcript_id_ref"]) for r in events.extension_events(last.where(F.col("transcript_id").isin(*free)), ref, 50, 100, 0).collect()}
    assert {k: (r["extension"], r["reject_reason"], r["event_type"], r["transcript_id_ref"]) for k, r in found.items() if r["extension"] is not None} == extended and extended


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("backward", [False, True])
def test_running_values_over_many_bins(spark, backward, strict):
    rng = random.Random(5)
    rows = [(k, rng.choice(["a", "a", "b", None]), rng.choice([rng.randrange(-500, 3000), 10 * rng.randrange(40)]), rng.choice([None, rng.randrange(99)])) for k in range(700)]
    if not strict:  # an order without ties
        rows = [(k, c, 1000 * s + k, v) for k, c, s, v in rows]
    df = spark.createDataFrame(rows, "id long, c string, start long, v long")
    found = interval.running(df, ["c"], ["start"], {"out": F.col("v")}, 64, backward=backward, strict=strict)
    frames = found._jdf.queryExecution().analyzed().toString().lower()
    assert "unboundedfollowing" not in frames  # such a frame is read anew for every row: quadratic in the rows of a key
    pick = min if backward else max
    far = (lambda x, y: x > y) if backward else (lambda x, y: x < y)
    want = {k: pick((w for _, d, t, w in rows if d == c and far(t, s) and w is not None), default=None) for k, c, s, _ in rows}
    assert {r["id"]: r["out"] for r in found.collect()} == want
    assert found.columns == [*df.columns, "out"]


def test_what_is_read_often_is_worked_out_once(spark, sf_dir):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    novel, ref = ad.side_tables(spark, sf_dir)
    for table in ("exons", "introns"):
        ranked = ref[table]
        kept = events.not_last_regions(ranked)
        assert "Window" not in plan(kept)
        plain = events.not_last_regions(ranked.drop("region_rank"))
        assert sorted(map(tuple, kept.drop("region_rank").collect())) == sorted(map(tuple, plain.collect()))
    found = events.novel_last_exons(None, None, 50, 0, 0, tables=(novel, ref))
    alone = events.novel_last_exons(*ad.sides(spark, sf_dir), 50, 0, 0)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, alone.collect()))
    rows = novel["last_exons"].select("chrom", "strand", "start", "end").withColumns({"experiment_id": F.lit("x"), "event_type": F.lit("y"), "delta": F.lit(0.5)})
    assert "Window" not in plan(jobs.merge_experiments(rows)["merged"])


def test_small_genes_and_gaps_take_one_pass(spark, monkeypatch):
    """Nothing is written between, as passes by bins need, where genes are small; gaps need no named islands."""
    rng = random.Random(4)
    rows = [(f"t{k}", "c", "+-"[g % 2], f"g{g}", s, s + rng.choice([0, 3, 10, 200]), rng.choice(["last_exon_extension", "last_exon_spliced", None])) for k in range(900) for g in [rng.randrange(60)] for s in [rng.randrange(900)]]
    df = spark.createDataFrame(rows, SPANS)

    def refused(df, name):
        raise AssertionError(f"{name} is written")

    monkeypatch.setattr(interval, "written", refused)
    got = {r["transcript_id"]: r["le_number"] for r in last_exons.with_le_ids(df).collect()}
    assert got == brute_numbers(rows)
    plain = {r["transcript_id"]: r["le_number"] for r in last_exons.with_le_ids(df, extensions=False).collect()}
    assert plain == brute_numbers([(*r[:6], None) for r in rows])
    schema = "chrom string, strand string, start long, end long"
    mask = [("c", "+", s, s + rng.randrange(60)) for s in (rng.randrange(20_000) for _ in range(400))] + [("only", "+", 3, 4)]
    bounds = spark.createDataFrame([("c", "+", -5, 30_000), ("d", "-", 2, 9)], "chrom string, strand string, low long, high long")
    covered = {x for c, _, s, e in mask if c == "c" for x in range(s, e)}
    left = interval.gaps(spark.createDataFrame(mask, schema), bounds, bin_size=512).collect()
    assert {(r["chrom"], r["strand"]) for r in left} == {("c", "+"), ("d", "-")}
    free = [x for r in left if r["chrom"] == "c" for x in range(r["start"], r["end"])]
    assert sorted(free) == [x for x in range(-5, 30_000) if x not in covered]


def test_matches_carry_only_what_is_asked(spark, sf_dir):
    novel, ref = ad.side_tables(spark, sf_dir)
    last = novel["last_exons"].select("transcript_id", "chrom", "strand", "start", "end")
    plain, full = (events.classified_last_exons(last, ref["exons"], 50, 60, 5, **more) for more in ({"carry": ()}, {}))
    cols = ["transcript_id", "in_exon", "extension", "reject_reason", "event_type"]
    assert plain.columns == [*last.columns, *cols[1:]]
    assert sorted(map(str, plain.select(*cols).collect())) == sorted(map(str, full.select(*cols).collect()))
    typed = events.typed_last_exons(None, ("gene_id", "start"), tables=ref)
    types = events.reference_event_types(None, tables=ref)
    joined = ref["last_exons"].select("transcript_id", "gene_id", "start").join(types, "transcript_id")
    assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, joined.collect()))


def test_transcripts_take_one_sort(spark):
    """Shapes from one shuffle, also of exons that overlap or begin alike, as brute force gives them; no frame of ranges merges regions."""
    rng = random.Random(9)
    rows = [(f"t{k % 90}", "c", "+", s, s + rng.choice([0, 5, 40])) for k in range(700) for s in [rng.randrange(60) * 10]] + [("one", "c", "-", 3, 9)]
    df = spark.createDataFrame(rows, "transcript_id string, chrom string, strand string, start long, end long")
    found = structure.shapes(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange") == 1
    want = {}
    for t in {r[0] for r in rows}:
        own = sorted(r[3:] for r in rows if r[0] == t)
        reach, chain = own[0][1], []
        for s, e in own:
            if s > reach:
                chain.append(f"{reach}-{s}")
            reach = max(reach, e)
        want[t] = (own[0][0], reach, ",".join(chain) or None)
    assert {r["transcript_id"]: (r["start"], r["end"], r["intron_chain"]) for r in found.collect()} == want
    merged = structure.merged_structure(df.drop("chrom"))
    assert "RangeFrame" not in merged._jdf.queryExecution().analyzed().toString()
    got = {}
    for r in sorted(merged.collect(), key=lambda r: r["start"]):
        got.setdefault(r["transcript_id"], []).append((r["start"], r["end"]))
    for t, spans in got.items():
        assert (spans[0][0], spans[-1][1]) == want[t][:2] and (",".join(f"{a[1]}-{b[0]}" for a, b in zip(spans, spans[1:])) or None) == want[t][2]


def test_all_id_maps_look_genes_up_once(spark):
    rows = [("t1", "c", "+", "g1", "N1", "g1_1"), ("t2", "c", "+", "g1", "N1", "g1_2"), ("t2", "c", "+", "g1", "N1", "g1_2"), ("t3", "c", "-", "g2", None, "g2_1"), ("t4", "d", "+", None, "N", None), ("t5", "d", "+", None, None, "x")]
    df = spark.createDataFrame(rows, "transcript_id string, chrom string, strand string, ref_gene_id string, ref_gene_name string, le_id string")
    found = last_exons.id_map_rows(df)
    want = [(name, *r) for name, own in last_exons.id_maps(df).items() for r in own.collect()]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 1


def test_bins_hold_both_median_lengths(spark):
    rows = spark.range(64).selectExpr("'c' chrom", "'+' strand", "id * 50 start", "id * 50 + 100 end")
    assert interval.fitted(rows, rows)[0] == 256  # 128 had four copies of a row where 256 has three


def test_last_sites_and_numbers_of_genes_from_one_sort(spark):
    """The last exon knows its intron's 5' site, so the two are not joined by transcript, and a gene's windows share one sort."""
    rng = random.Random(21)
    rows = [(f"t{k % 80}", "c", "+-"[k % 2], s, s + rng.choice([3, 5, 12, 40])) for k in range(400) for s in [rng.randrange(40) * 5]]
    df = spark.createDataFrame(rows, "transcript_id string, chrom string, strand string, start long, end long")
    for tables in (structure.exon_intron_tables(df), structure.structure_tables(structure.merged_structure(df))):
        want = {r["transcript_id"]: r["start"] if r["strand"] == "+" else r["end"] for r in tables["last_introns"].collect()}
        assert {r["transcript_id"]: r["site"] for r in tables["last_sites"].collect()} == {f"t{k}": want.get(f"t{k}") for k in range(80)}
        del tables["last_introns"]  # not read
        assert events.reference_event_types(None, tables=tables).count() > 0
    genes = spark.createDataFrame([("t", "c", "+", "g", 0, 5, "last_exon_extension")], SPANS)
    plan = last_exons._number_small_genes(genes, True)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_only_last_exons_that_share_bases_are_cut(spark, sf_dir, monkeypatch):
    """Last exons that are known to share no base with the mask are unique as they are; subtract gets the others alone, with the same result."""
    ref, seen = ad.ref_tables(spark, sf_dir), []

    def noted(left, *args, **options):
        seen.append(left)
        return interval.subtract(left, *args, **options)

    monkeypatch.setattr(jobs, "subtract", noted)
    out = jobs.reference_annotation(None, tables=ref)
    mask = events.not_last_regions(ref["exons"]).select("chrom", "strand", "start", "end")
    cut, rows = seen[0], out["last_exons"]
    assert 0 < cut.count() < rows.count() and interval.not_overlapping(cut, mask, "transcript_id").count() == 0
    want = interval.subtract(rows, mask, "transcript_id")
    assert out["unique"].columns == rows.columns and sorted(map(str, out["unique"].collect())) == sorted(map(str, want.collect()))
