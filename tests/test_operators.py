"""Hand-worked cases, and edge cases that the driver's tables lack."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeworks.functions import names as fn
from cladeworks.operators import alignments as al
from cladeworks.operators import clusters as cl
from cladeworks.operators import downsample as ds
from cladeworks.operators import qc, recombination, rollup, trees
from cladeworks.operators import sketches as sk
from cladeworks.operators.components import connected_components
from cladeworks.plans import workflow
from cladeworks.plans.settings import settings
from cladeworks.sources import readers, sinks
from cladeworks.streaming import placement


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def frame(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_components_and_split(spark):
    pairs = frame(spark, "a string, b string, distance double", ("a", "b", 0.01), ("b", "c", 0.02), ("c", "d", 0.05))
    nodes = frame(spark, "sample_id string", *[(x,) for x in "abcde"])
    found = cl.single_linkage(nodes, sk.edges_within(pairs, 0.02))
    assert rows(found, "sample_id", "component") == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "e")]
    split = cl.split_oversize(found, 2)
    assert rows(split, "cluster_id", "sample_id") == [("cluster_0", "a"), ("cluster_0", "b"), ("cluster_1", "c"), ("cluster_2", "d"), ("cluster_3", "e")]


def test_a_component_over_several_ranges_is_split_in_order(spark):
    members = spark.range(1000).select(F.col("id").alias("sample_id"), F.when(F.col("id") < 900, 0).otherwise(F.col("id")).alias("component"))
    found = rows(cl.split_oversize(members, 40), "sample_id", "cluster_id")
    assert found == [(i, f"cluster_{i // 40 if i < 900 else 23 + i - 900}") for i in range(1000)]


def test_components_of_a_long_path_and_of_no_edges(spark):
    path = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert rows(connected_components(path), "component") == [(0,)] * 61
    assert rows(connected_components(path.filter("a < 0")), "component") == []


def test_medoid(spark):
    classes = frame(spark, "rep string, n bigint, cluster_id int", ("a", 1, 0), ("b", 1, 0), ("c", 1, 0))
    pairs = frame(spark, "a string, b string, distance double", ("a", "b", 0.01), ("b", "c", 0.02), ("a", "c", 0.03))
    assert rows(cl.medoids(classes, pairs), "representative", "distance_sum") == [("b", 0.03)]


@pytest.mark.parametrize(("sizes", "expected"), [((4, 2, 1), {"cluster_0": 4, "merged_small_clusters": 3}), ((4, 1, 1), {"cluster_0": 4})])
def test_small_clusters_merge(spark, sizes, expected):
    members = frame(spark, "sample_id string, cluster_id string", *[(f"{c}.{i}", f"cluster_{c}") for c, n in enumerate(sizes) for i in range(n)])
    assert {r["cluster_id"]: r["n_isolates"] for r in cl.sizes(cl.merge_small(members)).collect()} == expected


def test_core_snps_and_atcg_columns(spark):
    cells = frame(spark, "cluster_id int, seq_id string, seq string", (0, "s1", "ACGTN"), (0, "s2", "ATGT-"), (0, "s3", "ACGAn"))
    positions = al.core_snp_positions(cells)
    assert rows(positions, "position", "ref_base", "alt_bases") == [(2, "C", "T"), (4, "A", "T")]
    assert rows(al.core_snp_sequences(cells, positions), "seq_id", "seq") == [("s1", "CT"), ("s2", "TT"), ("s3", "CA")]
    assert rows(al.atcg_columns(cells), "position") == [(1,), (2,), (3,), (4,)]
    assert rows(al.atcg_sequences(cells, al.atcg_columns(cells)), "seq") == [("ACGA",), ("ACGT",), ("ATGT",)]


def test_column_operators_over_several_masks(spark):
    rng = np.random.default_rng(4)
    seqs = ["".join(rng.choice(list("ACGTN-R"), 200, p=[0.3, 0.3, 0.3, 0.04, 0.02, 0.02, 0.02])) for _ in range(5)]
    seqs = ["".join("A" if k % 3 else c for k, c in enumerate(s)) for s in seqs]
    a = frame(spark, "cluster_id string, seq_id int, seq string", *[("c", i, s) for i, s in enumerate(seqs)], ("d", 9, "acgt"))
    columns = [sorted({s[k] for s in seqs} - set("N-")) for k in range(200)]
    snps = [k for k in range(200) if len(columns[k]) > 1]
    found = al.core_snp_positions(a)
    assert rows(found, "position", "ref_base", "alt_bases") == [(k + 1, columns[k][0], ",".join(columns[k][1:])) for k in snps]
    assert rows(al.core_snp_sequences(a, found), "seq_id", "seq") == [(i, "".join("N" if s[k] in "N-" else s[k] for k in snps)) for i, s in enumerate(seqs)]
    good = [k for k in range(200) if {s[k] for s in seqs} <= set("ACGT")]
    assert rows(al.atcg_columns(a).filter("cluster_id = 'c'"), "position", "n_bases") == [(k + 1, len(columns[k])) for k in good]
    assert rows(al.invariant_counts(al.atcg_columns(a), 20), "cluster_id", "n_invariant", "n_variable") == [("c", sum(len(columns[k]) == 1 for k in good[:20]), sum(len(columns[k]) > 1 for k in good[:20])), ("d", 4, 0)]
    counts = {r["pos"]: (r["n_ref"], r["n_alt"], r["n_missing"]) for r in al.vcf_rows(a, found).collect()}
    for k in snps:
        n = sum(s[k] == columns[k][0] for s in seqs), sum(s[k] in columns[k][1:] for s in seqs), sum(s[k] in "N-" for s in seqs)
        assert counts[k + 1] == n


def test_distances_of_a_cluster_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", 4)
    rng = np.random.default_rng(2)
    seqs = ["".join(rng.choice(list("ACGT-"), 70)) for _ in range(19)]
    classes = al.sequence_classes(frame(spark, "cluster_id int, seq_id int, seq string", *[(0, i, s) for i, s in enumerate(seqs)]))
    brute = [(i, j, sum(x != y and "-" not in (x, y) for x, y in zip(seqs[i], seqs[j]))) for i in range(19) for j in range(i + 1, 19)]
    assert rows(al.snp_distances(classes), "a", "b", "n_snps") == brute
    assert rows(al.snp_distances(classes, most=45), "a", "b", "n_snps") == [x for x in brute if x[2] <= 45]


def test_snp_distances_over_several_masks(spark):
    rng = np.random.default_rng(1)
    seqs = ["".join(rng.choice(list("ACGTN-"), 150)) for _ in range(6)]
    found = al.snp_distances(al.sequence_classes(frame(spark, "cluster_id int, seq_id int, seq string", *[(0, i, s) for i, s in enumerate(seqs)])))
    brute = sorted((i, j, sum(x != y and x in "ACGT" and y in "ACGT" for x, y in zip(seqs[i], seqs[j]))) for i in range(6) for j in range(i + 1, 6))
    assert rows(found, "a", "b", "n_snps") == brute


def test_masking_and_offsets(spark):
    alignment = frame(spark, "seq_id string, seq string", ("x", "ACGTACGTAC"), ("y", "ACGT"))
    spans = frame(spark, "tip string, start int, stop int", ("x", 2, 5), ("x", 9, 99))
    masked = recombination.mask(alignment, spans)
    assert rows(masked, "seq_id", "seq") == [("x", "ACNNNCGTAN"), ("y", "ACGT")]
    assert rows(recombination.mask(masked, spans), "seq") == rows(masked, "seq")
    positions = frame(spark, "cluster_id string, position int, ref_base string, alt_bases string", ("cluster_0", 10, "A", "C"), ("cluster_0", 40, "A", "C"), ("cluster_1", 5, "A", "C"))
    assert rows(al.integrate_positions(positions), "global_position") == [(10,), (40,), (45,)]


def test_closure_intervals_and_unknown_nodes(spark):
    edges = frame(spark, "parent string, child string", ("r", "n"), ("n", "x"), ("n", "y"), ("r", "z"))
    closure = recombination.tip_closure(edges)
    assert rows(closure, "node", "tip") == [("n", "x"), ("n", "y"), ("r", "x"), ("r", "y"), ("r", "z"), ("x", "x"), ("y", "y"), ("z", "z")]
    spans = frame(spark, "node string, start int, stop int", ("n", 0, 5), ("x", 3, 8), ("r", 20, 21), ("q", 1, 2))
    assert rows(recombination.tip_intervals(spans, closure).filter("tip = 'x'"), "start", "stop") == [(0, 8), (20, 21)]
    assert rows(recombination.unknown_nodes(spans, closure), "node") == [("q",)]


@pytest.mark.parametrize(
    ("available", "budget", "least", "most", "expected"),
    [({"A": 10, "B": 4, "C": 1}, 9, 2, 6, (5, 3, 1)), ({"A": 5, "B": 5, "C": 5}, 5, 3, 9, (1, 2, 2)), ({"A": 5, "B": 5, "C": 5}, 2, 1, 9, (0, 1, 1)), ({"A": 2, "B": 1}, 9, 1, 1, (2, 1))],
)
def test_quota(available, budget, least, most, expected):
    assert tuple(ds.allocate(available, budget, least, most).values()) == expected


def test_quota_keeps_its_bounds():
    rng = np.random.default_rng(3)
    for _ in range(200):
        available = {f"c{i}": int(n) for i, n in enumerate(rng.integers(0, 50, rng.integers(1, 9)))}
        budget, least, most = int(rng.integers(0, 120)), int(rng.integers(0, 9)), int(rng.integers(9, 40))
        keep = ds.allocate(available, budget, least, most)
        assert sum(keep.values()) <= max(budget, 0) and all(0 <= keep[c] <= available[c] for c in keep)


def test_round_robin(spark):
    reps = frame(spark, "sample string, country string, subregion string, date string", ("x1", "A", "x", "2010"), ("x2", "A", "x", "2012"), ("x3", "A", "x", ""), ("y1", "A", "y", "2011"))
    chosen = ds.round_robin(reps, frame(spark, "country string, keep bigint", ("A", 3)))
    assert [r["sample"] for r in chosen.filter("kept").orderBy("turn").collect()] == ["x1", "y1", "x2"]
    # spellings of one subregion are one bucket, unknown ones another
    mixed = frame(spark, reps.schema, ("n1", "A", "North", "2010"), ("n2", "A", " NORTH", "2011"), ("n3", "A", "north", "2012"), ("u1", "A", "NA", "2009"), ("u2", "A", "unknown", "2010"), ("s1", "A", "South", "2001"))
    chosen = ds.round_robin(mixed, frame(spark, "country string, keep bigint", ("A", 4)))
    assert [r["sample"] for r in chosen.orderBy("turn").collect()] == ["n1", "u1", "s1", "n2", "u2", "n3"]


def test_metadata_is_found_by_every_id_under_both_keys(spark):
    schema = "line int, accession string, fasta_name string, sample string, country string, subregion string, date string"
    known = frame(
        spark, schema, (1, None, "GCA_000000001.1.fasta", None, " X ", " north", "2001 "), (2, "GCA_000000001.2", None, None, "Y", "", ""), (3, None, None, "GCA_000000002_7", "", None, None), (4, "my.odd.name.fasta", "", "", "Z", "z", "z")
    )
    files = frame(spark, "sample string, path string", *[(p, f"/d/{p}.fasta") for p in ("GCA_000000001.2", "GCA_000000002.3", "my.odd.name", "none")])
    found = {r["sample"]: (r["country"], r["subregion"], r["date"], r["matched"]) for r in ds.join_metadata(files, known, "line").collect()}
    assert found == {"GCA_000000001.2": ("X", "north", "2001", True), "GCA_000000002.3": ("Unknown", "", "", True), "my.odd.name": ("Z", "z", "z", True), "none": ("Unknown", "", "", False)}
    records = ds.join_metadata(files, known.drop("sample"), "line")
    assert rows(ds.unmatched(records, True), "filename", "disposition") == [("GCA_000000002.3.fasta", "dropped"), ("none.fasta", "dropped")]
    assert ds.matched_only(records, True).count() == 2 and ds.matched_only(records, False).count() == 4


def test_names_of_reference_sequences_in_any_case(spark):
    grouped = frame(spark, "sample int, group_id int, subregion string, name string, date string", (1, 0, "x", "GCA_1", "1999"), (2, 0, "x", "gcf_2", "2005"), (3, 0, "NA", "GCF_3", "1990"))
    assert rows(ds.rank_in_group(grouped), "rank", "sample") == [(1, 2), (2, 1), (3, 3)]


def test_sweep_within_countries_and_study_rows(spark):
    records = frame(spark, "sample string, country string", ("a", "X"), ("b", "X"), ("c", "X"), ("d", "Y"))
    edges = frame(spark, "a string, b string, distance double", ("a", "b", 0.01), ("b", "c", 0.05), ("c", "d", 0.0))
    assert rows(ds.sweep(records, edges, [0.0, 0.01, 0.05]), "derep_threshold", "n_groups_kept", "fraction_removed") == [(0.0, 4, "0.0000"), (0.01, 3, "0.2500"), (0.05, 2, "0.5000")]
    study = ds.study_rows(frame(spark, "path string", ("/s/my isolate.fasta",)))
    grouped = frame(spark, "sample string, country string, subregion string, date string, group_id string, is_representative boolean", ("a", "X", "", "", "a", True), ("b", "X", "", "", "a", False), ("d", "Y", "", "", "d", True))
    chosen = frame(spark, "sample string, kept boolean, path string", ("a", True, "/a"), ("d", False, "/d"))
    report = ds.selection_report(grouped, chosen, study)
    assert rows(report, "sample", "source", "kept", "reason") == [("a", "contextual", "yes", "kept"), ("b", "contextual", "no", "redundant_to:a"), ("d", "contextual", "no", "dropped_by_country_cap"), ("my_isolate", "study", "yes", "study_isolate")]
    assert rows(ds.samplesheet(study, chosen.filter("kept")), "part", "sample") == [(0, "my_isolate"), (1, "a")]
    assert ds.budget_left(10, 25) == 0 and ds.budget_left(30, 25) == 5


def test_components_with_a_hot_node(spark, monkeypatch):
    from cladeworks.operators import components

    monkeypatch.setattr(components, "hot_rows", lambda total: 5)
    monkeypatch.setattr(components, "FEW", 0)
    edges = spark.range(1, 400).select(F.when(F.col("id") % 2 == 0, 0).otherwise(500).alias("a"), "id")
    edges = edges.union(spark.createDataFrame([(600, 601), (601, 602)], "a int, id bigint"))
    found = components.connected_components(edges, "a", "id")
    assert rows(found.groupBy("component").count(), "component", "count") == [(0, 200), (1, 201), (600, 3)]


def test_joins_that_split_hot_keys(spark, monkeypatch):
    from cladeworks.operators import skew
    from cladeworks.operators.skew import split_join

    monkeypatch.setattr(skew, "FEW", 0)
    left = spark.range(3000).select(F.when(F.col("id") < 2500, 7).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(0, 4000, 7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert rows(split_join(left, right, "k", "id"), "k", "id", "v") == rows(left.join(right, "k"), "k", "id", "v")
    assert split_join(left, right, "k", "id", "left").count() == 3000


def test_linking_clusters_assemblies_and_representatives(spark):
    members = frame(spark, "cluster_id string, sample_id string", ("c0", "b"), ("c0", "a"), ("c0", "x"), ("c0", "z"), ("c1", "d"))
    files = frame(spark, "sample_id string, file string", ("a", "/a.fa"), ("b", "/b.fa"), ("x", "/x.fa"), ("d", "/d.fa"))
    lists = workflow.cluster_assemblies(members, files)
    assert lists.collect() == [("c0", ["a", "b", "x"], ["/a.fa", "/b.fa", "/x.fa"])]
    assert rows(workflow.unzipped(lists), "sample_id", "file") == [("a", "/a.fa"), ("b", "/b.fa"), ("x", "/x.fa")]
    with pytest.raises(ValueError, match="repeated"):
        workflow.one_to_one(files, files.union(files), "sample_id")
    of = frame(spark, "cluster_id string, file string", ("p", "GCA_1_1.2.fasta"), ("p", "GCA_1_1.1.fasta"), ("q", "y.1.fa"), ("q", "x.fa"), ("r", "n.fa"))
    reps = frame(spark, "cluster_id string, representative string", ("p", "GCA_1_1"), ("q", "x"), ("r", "other"), ("s", "none"))
    assert rows(workflow.representative_files(reps, of), "cluster_id", "file", "match") == [("p", "GCA_1_1.1.fasta", "version"), ("q", "x.fa", "exact"), ("r", "n.fa", "any"), ("s", None, "none")]
    with pytest.raises(ValueError, match="one global"):
        workflow.with_reference(members, files)


def test_plans_that_settings_choose(spark):
    a = frame(spark, "cluster_id int, seq_id string, seq string", *[(0, f"s{i}", s) for i, s in enumerate(("ACGTA", "ACGAA", "TCGTA"))], (1, "t", "AC"))
    closure = frame(spark, "node string, tip string", ("n", "s0"), ("n", "s1"), ("s0", "s0"))
    spans = {"gubbins": frame(spark, "node string, start int, stop int", ("n", 0, 1)), "clonalframeml": frame(spark, "node string, start int, stop int", ("s0", 3, 4))}
    tool = lambda s: rows(workflow.masked_alignments(a, spans, closure, s).filter("cluster_id = 0"), "tool", "seq")
    assert tool(settings()) == [("none", "ACGAA"), ("none", "ACGTA"), ("none", "TCGTA")]
    assert tool(settings(recombination="gubbins")) == [("Gubbins", "NCGAA"), ("Gubbins", "NCGTA"), ("Gubbins", "TCGTA")]
    assert len(tool(settings(recombination="both"))) == 6
    with pytest.raises(ValueError, match="not in the tree"):
        workflow.masked_alignments(a, {"gubbins": frame(spark, "node string, start int, stop int", ("q", 0, 1))}, closure, settings(recombination="gubbins"))
    frames = workflow.recombination_aware(settings(recombination="both", mode="recombination_aware"), a, spans, closure)
    assert rows(frames["routes"], "cluster_id", "route") == [(0, "analysed"), (1, "skipped_low_information")]
    assert rows(frames["trees"], "cluster_id", "n_tips") == [("ClonalFrameML/0", 3), ("Gubbins/0", 3)]


def test_logs_errors_and_summaries(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/c1.diagnostics.log").write_text("Sequence count: 5\nAlignment length (non-header chars): 40\nStarting tree present: yes (9 bytes)\nGubbins exit code: 0\n")
    (tmp_path / "d/c2.diagnostics.log").write_text("Sequence count: 2\nStarting tree: (none provided)\nsays: skipping Gubbins\nERROR: Alignment file missing or empty\n")
    (tmp_path / "t").mkdir()
    (tmp_path / "t/c3.final.treefile").write_text("(a,b);")
    assert [r[0] for r in readers.cluster_ids(spark, str(tmp_path / "d"), str(tmp_path / "t")).collect()] == ["c1", "c2", "c3"]
    logs = readers.diagnostics(spark, str(tmp_path / "d")).drop("path")
    sizes = frame(spark, "cluster_id string, n_isolates bigint", ("c1", 5))
    grown = frame(spark, "cluster_id string, tree_bytes bigint, tree_text string, log_bytes bigint", ("c1", 9, "(a,b);", 5), ("c3", 6, "(a,b);", 0))
    filtered = frame(spark, "cluster_id string, n_records bigint, n_columns bigint", ("c1", 5, 12), ("c3", 4, 1))
    blocks = frame(spark, "cluster_id string, n_blocks bigint", ("c1", 3))
    found = {r["cluster_id"]: r for r in rollup.phylogeny_summary(sizes, logs, grown, filtered, blocks).collect()}
    assert (found["c1"]["gubbins_status"], found["c1"]["confidence_tier"], found["c1"]["starting_tree_present"], found["c1"]["n_recombination_blocks"]) == ("completed", fn.TIERS[1], "true", 3)
    assert (found["c2"]["gubbins_status"], found["c2"]["notes"], found["c2"]["iqtree_status"], found["c2"]["starting_tree_present"]) == ("skipped_low_information", "input_alignment_empty", "failed_no_tree", "false")
    assert (found["c3"]["gubbins_status"], found["c3"]["n_isolates"], found["c3"]["confidence_tier"], found["c3"]["alignment_length"]) == ("no_diagnostics", 4, fn.TIERS[2], "")
    assert len(found["c1"]) == 14
    errors = frame(spark, "sample string, process string, error string, folder string, run string, line int", ("a", "p", "e", "/2", "r", 2), ("a", "p", "e", "/1", "r", 1), ("", "p", "e", "/3", "r", 3), (None, "p", "e", "/3", "r", 3))
    assert rows(rollup.error_rollup(errors, "line"), "sample", "folder") == [("a", "/1")]
    text, _ = sinks.report(rollup.statistics(**{f"m{i}": (spark.range(1), F.count("*")) for i in range(12)}), "Run")
    assert text.count(": 1") == 12
    none = rollup.analysis_statistics(frame(spark, "cluster_id string"), frame(spark, "total_snps bigint"), frame(spark, "n_leaves bigint"))
    assert none.count() == 16 and {r["value"] for r in none.collect()} <= {"0", "0.00"}


@pytest.mark.parametrize(("x", "text"), [(4.125, "4.12"), (4.375, "4.38"), (2.675, "2.67"), (1.005, "1.00"), (-0.125, "-0.12"), (10.0, "10.00"), (0.999, "1.00"), (1e17, "100000000000000000.00")])
def test_numbers_as_text(spark, x, text):
    assert one(spark, fn.fixed(F.lit(x), 2)) == text == f"{x:.2f}"


def test_sql_functions_and_table_functions(spark):
    from cladeworks.functions import sql

    sql.register(spark)
    row = spark.sql("select normalize_name('/a/x.1.fa'), accession_key('/a/GCA_000000001.1.fasta'), canonical_key('a.b.fa'), sequence_year('May 2019'), sanitize_sample(' a b '), known_subregion(' NA '), mash_distance(0.9, 21)").first()
    assert tuple(row)[:6] == ("x.1", "GCA_000000001", "a_b", 2019, "a_b", False) and abs(row[6] - 0.0025746) < 1e-6
    assert spark.sql("select count(*) from newick_edges('t', '((a:1,b:2):0.5,c);') where is_tip").first()[0] == 3
    assert [tuple(r) for r in spark.sql("select * from fasta_records('>a b\\nAC\\nGT\\n>c\\n')").collect()] == [(1, "a b", "ACGT"), (2, "c", "")]


@pytest.mark.parametrize(("date", "year"), [("2019-05", 2019), ("May 2019", 2019), ("20190501", 2019), ("12-2019", fn.NO_YEAR), ("", fn.NO_YEAR), (None, fn.NO_YEAR)])
def test_year(spark, date, year):
    assert one(spark, fn.parse_year(F.lit(date).cast("string"))) == year


def test_names(spark):
    path = F.lit("/a/GCA_000182195.1.fasta")
    assert [one(spark, f(path)) for f in (fn.canonical_key, fn.accession_key, fn.sample_id)] == ["GCA_000182195_1", "GCA_000182195", "GCA_000182195"]
    assert [one(spark, fn.normalize_label(F.lit(x))) for x in ("'IP 0030.fasta'", "ERS012365", "x.fa.gz")] == ["IP_0030", "ERS012365", "x"]
    assert [one(spark, fn.drop_reference_suffix(F.lit(x))) for x in ("a.ref", "a.ref.ref", "a")] == ["a", "a.ref.ref", "a"]
    assert [one(spark, fn.parse_size(F.lit(x))) for x in ("45k", "1c", "2G", "7")] == [46080, 1, 2 << 30, 7]
    assert one(spark, fn.normalize_name(F.lit(".hidden"))) == ".hidden"
    assert round(one(spark, fn.mash_distance(F.lit(0.9), 21)), 7) == 0.0025746 and one(spark, fn.mash_distance(F.lit(0.0), 21)) == 1.0


@pytest.mark.parametrize(
    ("case", "tier"),
    [((6, "completed", "completed", 10), 0), ((5, "completed", "completed", 10), 1), ((3, "completed", "completed", 10), 2), ((1, "completed", "completed", 10), 4), ((8, "completed", "failed_no_tree", 10), 3), ((4, "unknown", "completed", 10), 2)],
)
def test_tier(spark, case, tier):
    assert one(spark, fn.confidence_tier(*map(F.lit, case))) == fn.TIERS[tier]


def test_gate_and_unique(spark):
    checks = frame(spark, "sample string, qc_step string, outcome string", ("x", "a", "PASS"), ("x", "b", "PASS"), ("y", "a", "PASS"), ("y", "b", "FAIL"))
    assert rows(qc.gate(frame(spark, "sample string", ("x",), ("y",)), checks), "sample") == [("x",)]
    with pytest.raises(ValueError, match="repeated"):
        qc.require_unique(checks)


def test_sketch_distance_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("ACGT"), 300))
    texts = [base[: 300 - 9 * i] + "".join(rng.choice(list("ACGT"), 9 * i)) for i in range(12)] + ["", None, base]
    sketches = sk.sketch(frame(spark, "s int, t string", *enumerate(texts)), "s", "t", 8, 40, canonical=True)
    classes = sk.sketch_classes(sketches, "s")
    by = {r["rep"]: r["sketch"] for r in classes.collect()}
    brute = set()
    for a, x in by.items():
        for b, y in by.items():
            union = sorted({*x, *y})[:40]
            if a < b and (n := len(set(x) & set(y) & set(union))):
                j = n / len(union)
                brute.add((a, b, round(abs(-np.log(2 * j / (1 + j)) / 8), 9)))
    for far in (1.0, 0.1, 0.02):
        assert set(rows(sk.distance_pairs(classes, 8, 40, far), "a", "b", "distance")) == {x for x in brute if x[2] <= far}
    assert len(rows(sk.class_members(sketches, classes, "s"), "s")) == 15


def test_newick_and_graft():
    text = "((R1:0.2,'R 2':0.3):0.1,R3:0.4);"
    assert trees.write_newick(trees.parse_newick(text)) == text
    backbone, cluster = "((R1:0.2,R2:0.3):0.1,R3:0.4);", "(R1:0.1,(a:0.2,b:0.3):0.05);"
    kept, report = trees.graft_all(backbone, [("c", cluster, "R1"), ("e", "", None), ("q", "(u,v);", "w")])
    assert kept == "(((R1:0.0,(a:0.2,b:0.3):0.0):0.2,R2:0.3):0.1,R3:0.4);"
    assert [s for *_, s in report] == ["grafted", "skipped_empty", "failed_no_backbone_tip"]
    assert trees.graft_all(backbone, [("c", cluster, "R1")], "zero")[0] == "(((R1:0.2,(a:0.2,b:0.3):0.0):0.0,R2:0.3):0.1,R3:0.4);"
    clash = trees.graft_all(backbone, [("c", "(R1:1.0,R2:1.0,R3:1.0);", "R1")])[0]
    assert sorted(t.name for t in trees.parse_newick(clash).tips()) == ["R1", "R2", "R2_dup1", "R3", "R3_dup1"]


def test_neighbour_joining_recovers_an_additive_tree():
    names = list("abcd")
    d = np.array([[0, 3, 7, 8], [3, 0, 6, 7], [7, 6, 0, 5], [8, 7, 5, 0]], float)
    root = trees.neighbour_joining(names, d)
    assert len(trees.parse_newick(trees.write_newick(root)).tips()) == 4 and "float" not in trees.write_newick(root)
    dist = {}

    def down(node):
        below = {node.name: 0.0} if not node.children else {}
        for c in node.children:
            mine = {t: x + c.length for t, x in down(c).items()}
            dist.update({frozenset((s, t)): x + y for s, x in below.items() for t, y in mine.items()})
            below |= mine
        return below

    down(root)
    assert all(abs(dist[frozenset((names[i], names[j]))] - d[i, j]) < 1e-9 for i in range(4) for j in range(i))


def test_trees_by_cluster(spark):
    rows_ = frame(spark, "cluster_id string, rep int, seq string", *[("x", i, s) for i, s in enumerate(("AAAA", "AAAC", "CCCC", "CCCA"))], ("y", 9, "A"))
    found = trees.nj_trees(al.snp_distances(rows_).withColumnRenamed("n_snps", "distance"), rows_.select("cluster_id", F.col("rep").alias("name")))
    assert rows(found, "cluster_id", "n_tips", "method") == [("x", 4, "neighbour_joining"), ("y", 1, "star")]


def test_nj_tree_is_one_tree_of_a_whole_cluster(spark):
    from cladeworks.plans import queries

    d = "/root/testdata/sf0.001"
    expected = {str(r["cluster_id"]): r["count"] for r in queries._unique_per_cluster(spark, d).groupBy("cluster_id").count().collect()}
    found = queries.nj_tree(spark, d).collect()
    assert {r["cluster_id"]: r["n_tips"] for r in found} == expected and len(found) == len(expected) and max(expected.values()) > 25
    for r in found:
        assert len(trees.parse_newick(r["newick"]).tips()) == r["n_tips"] and (r["method"] == "neighbour_joining") == (r["n_tips"] > 2)


def test_trees_as_rows(spark):
    edges = trees.parse_trees(frame(spark, "tree_id string, newick string", ("t", "((a:1.0,b:2.0)n:0.5,c);")))
    assert rows(trees.write_trees(edges), "newick") == [("((a:1.0,b:2.0)n:0.5,c);",)]
    assert edges.filter("is_tip").count() == 3


def test_files_there_and_back(spark, tmp_path):
    (tmp_path / "s.csv").write_text("sample,file\nx,x.fasta\ny,y.fa.gz\n")
    assert rows(readers.samplesheet(spark, str(tmp_path / "s.csv")), "sample") == [("x",), ("y",)]
    (tmp_path / "g").mkdir()
    (tmp_path / "g/x.fasta").write_text(">c1 one\nACG\nT\n>c2\nGG\n")
    assert rows(readers.fasta(spark, str(tmp_path / "g/x.fasta")), "sample", "contig_ord", "header", "seq") == [("x", 1, "c1 one", "ACGT"), ("x", 2, "c2", "GG")]
    assert readers.sequence_files(spark, str(tmp_path / "g")).count() == 1
    (tmp_path / "tri").write_text("3\nA\nB\t0.1\nC\t0.2\t0.3\n")
    assert rows(readers.distances(spark, str(tmp_path / "tri")), "a", "b", "distance") == [("B", "A", 0.1), ("C", "A", 0.2), ("C", "B", 0.3)]
    (tmp_path / "long").write_text("A\tA\t0\t0\t1/1\nA\tB\t0.5\t0\t1/2\n")
    assert rows(readers.distances(spark, str(tmp_path / "long")), "a", "b", "distance") == [("A", "B", 0.5)]
    (tmp_path / "gff").write_text('##gff\nSEQ\tG\tCDS\t3\t5\t0\t.\t0\tnode="n1->n2";x\n')
    assert rows(readers.gff_intervals(spark, str(tmp_path / "gff")), "node", "start", "stop") == [("n2", 2, 5)]
    (tmp_path / "cfm").write_text("Node\tBeg\tEnd\nn1\t3\t5\n")
    assert rows(readers.clonalframe_intervals(spark, str(tmp_path / "cfm")), "node", "start", "stop") == [("n1", 2, 5)]
    (tmp_path / "reps").write_text("# c\ncluster_0\tx\n")
    assert rows(readers.representatives(spark, str(tmp_path / "reps")), "cluster_id") == [("cluster_0",), ("cluster_0.final",)]
    sinks.table(frame(spark, "cluster_id string, sample_id string", ("c", "x")), str(tmp_path / "out"))
    assert rows(readers.clusters(spark, str(tmp_path / "out")), "cluster_id", "sample_id") == [("c", "x")]
    sinks.fasta(frame(spark, "seq_id string, seq string", ("a", "AC"), ("b", "")), str(tmp_path / "fa"))
    assert rows(readers.fasta(spark, str(tmp_path / "fa")), "header", "seq") == [("a", "AC")]
    assert readers.existing(spark, [str(tmp_path / "fa")]) and readers.fasta(spark, str(tmp_path / "g")).count() == 2
    with pytest.raises(ValueError, match="no such input"):
        readers.existing(spark, [str(tmp_path / "not there")])
    assert rows(rollup.fasta_counts(readers.fasta(spark, str(tmp_path / "g"))), "n_records", "n_columns") == [(2, 4)]
    edges = frame(spark, "ref string, query string, distance double", ("b", "a", 0.5), ("a", "a", 0.0))
    sinks.matrix(edges, str(tmp_path / "matrix"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "matrix")).collect()] == ["\ta\tb", "a\t0.0\t", "b\t0.5\t"]
    assert rows(readers.distance_matrix(spark, str(tmp_path / "matrix")), "ref", "query") == [("a", "a"), ("b", "a")]
    said = []
    done = sinks.publish({"clusters/members": frame(spark, "cluster_id string", ("c",))}, str(tmp_path / "pub"), log=said.append)
    assert list(done.values()) == [1] and "Clusters/members.tsv" in said[0]
    sinks.samplesheet(frame(spark, "part int, sample string, file string", (1, "b", "/b"), (1, "a", "/a"), (0, "z", "/z")), str(tmp_path / "sheet"))
    assert [r["sample"] for r in spark.read.csv(str(tmp_path / "sheet"), header=True).collect()] == ["z", "a", "b"]
    report = frame(spark, "tree_id string, cluster_id string, representative string, status string", ("t", "c", "r", "grafted"), ("t", "d", "s", "skipped_empty"))
    sinks.graft_log(report, str(tmp_path / "log"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "log")).collect()][-1] == "t: 2 cluster trees, 1 grafted, 1 not"
    text, page = sinks.report(rollup.statistics(n=(spark.range(3), F.count("*"))), "Run <1>")
    assert "n: 3" in text and "&lt;1&gt;" in page


def test_placement_stream(spark, tmp_path):
    known = sk.sketch(frame(spark, "sample string, seq string", ("k1", "ACGTACGTTGCAAGCT" * 3), ("k2", "TTTTGGGGCCCCAAAATTGG" * 3)), "sample", "seq", 6, 50)
    known = known.withColumn("cluster_id", F.concat(F.lit("of_"), "sample"))
    frame(spark, "sample string, seq string", ("n1", "ACGTACGTTGCAAGCT" * 3), ("n2", "GATTACA" * 5)).write.parquet(str(tmp_path / "in"))
    arrivals = spark.readStream.schema("sample string, seq string").parquet(str(tmp_path / "in"))
    placement.placement_stream(arrivals, known, str(tmp_path / "out"), str(tmp_path / "ck"), 6, 50, 0.1).awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "sample", "cluster_id") == [("n1", "of_k1"), ("n2", None)]


def test_windowed_counts_of_a_stream(spark, tmp_path):
    schema = "ts timestamp, event_type string, value double"
    frame(spark, "ts string, event_type string, value double", ("2024-01-01 00:01:00", "a", 1.0), ("2024-01-01 00:04:00", "a", 2.0), ("2024-01-01 00:06:00", "b", 3.0)).selectExpr("cast(ts as timestamp) ts", "event_type", "value").write.parquet(str(tmp_path / "in"))
    counted = placement.windowed_counts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    query = counted.writeStream.format("memory").queryName("counted").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted((r["event_type"], r["n"], r["total"]) for r in spark.table("counted").collect()) == [("a", 2, 3.0), ("b", 1, 3.0)]


def test_guards_on_files_and_a_backbone(spark):
    files = frame(spark, "path string", ("/a/x.fasta",), ("/b/y.fa.gz",))
    assert readers.guarded(files).count() == 2
    for more, what in (("/c/x.fa", "one base name"), ("/c/z z.fa", "blanks"), ("/c/z.txt", "blanks")):
        with pytest.raises(ValueError, match=what):
            readers.guarded(files.union(frame(spark, "path string", (more,))))
    tree = trees.backbone_tree(frame(spark, "a string, b string, distance double", ("r1", "r2", 0.1), ("r2", "r3", 0.2)), frame(spark, "representative string", ("r1",), ("r2",), ("r3",), ("r 4",))).collect()
    assert len(tree) == 1 and sorted(t.name for t in trees.parse_newick(tree[0]["newick"]).tips()) == ["r 4", "r1", "r2", "r3"]


def test_kept_tables_are_removed(spark):
    import os

    from cladeworks.plans.shared import kept, remove

    df = kept(spark.range(3).toDF("n"), "x")
    path = df._cladeworks_path.removeprefix("file://").removeprefix("file:")
    assert df.count() == 3 and os.path.exists(path)
    remove(df)
    assert not os.path.exists(path)


def test_settings(tmp_path):
    from cladeworks.plans.settings import from_arguments, from_file

    (tmp_path / "p.json").write_text('{"mash_threshold": 0.01, "graft": false}')
    assert from_file(str(tmp_path / "p.json"), graft=True) == settings(mash_threshold=0.01) and not from_file(str(tmp_path / "p.json")).graft
    assert from_arguments(["--preset", "bp", "--kmer=15", "--use-global-reference"]) == settings("bp", kmer=15, use_global_reference=True)
    for bad in (["--kmer", "x"], ["--nothing", "1"], ["--graft", "maybe"]):
        with pytest.raises(ValueError):
            from_arguments(bad)
    with pytest.raises(ValueError, match="type int"):
        settings(kmer="21")
    assert settings("bp", mash_threshold=0.0).mash_threshold == 0.0 and settings("bp").max_cluster_size == 50
    with pytest.raises(ValueError, match="unknown"):
        settings(x=1)


def test_packed_sketches_are_the_heads_of_the_hashes(spark):
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(list("abc déß漢😀"), n)) for n in (0, 3, 11, 12, 13, 60, 400)] + [None, "plain words only " * 40]
    df = frame(spark, "s int, t string", *enumerate(texts))
    long = {r["s"]: [int(x[:16], 16) - 2**63 for x in r["sketch"]] for r in sk.sketch(df, "s", "t", 12, 20).collect()}
    assert {r["s"]: r["sketch"] for r in sk.packed_sketch(df, "s", "t", 12, 20).collect()} == long


@pytest.mark.parametrize("cells", [1 << 22, 16])
def test_pairs_of_blocks_equal_pairs_by_index(spark, monkeypatch, cells):
    for name, value in (("BLOCK", 5), ("BLOCKS", 2), ("SMALL", 4), ("CELLS", cells)):
        monkeypatch.setattr(sk, name, value)
    rng = np.random.default_rng(7)
    base = "".join(rng.choice(list("ACGT"), 300))
    texts = [base[: 300 - 9 * i] + "".join(rng.choice(list("ACGT"), 9 * i)) for i in range(25)] + ["", None, base, "ACGTACGT"]
    sketches = sk.packed_sketch(frame(spark, "s int, t string", *enumerate(texts)), "s", "t", 8, 40)
    classes = sk.sketch_classes(sketches, "s").withColumn("g", F.col("rep") % 3).localCheckpoint()
    names = ["a", "b", "n_a", "n_b", "shared", "compared", "distance"]
    for far in (1.0, 0.25, 0.1, 0.02):
        expected = rows(sk.distance_pairs(classes, 8, 40, far), *names)
        assert rows(sk.block_pairs(classes, 8, 40, far), *names) == expected
        assert rows(sk.block_pairs(classes, 8, 40, far, "g"), *names) == [x for x in expected if x[0] % 3 == x[1] % 3]
    assert rows(sk.block_pairs(classes.limit(0), 8, 40, 0.1), *names) == []


def test_matrix_moves_sketches_not_candidates(spark):
    from cladeworks.plans import queries

    plan = queries.mash_matrix_long(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_results_are_counted_without_pairs(spark):
    a = frame(spark, "cluster_id int, seq_id int, seq string", (0, 1, "AC"), (0, 2, "ac"), (0, 3, "AG"), (1, 4, "AA"), (2, 5, None), (None, 6, "AC"))
    counted = al.pair_count(a)
    assert rows(counted, "num_results") == [(al.pair_table(a).count(),)] == [(10,)]
    assert rows(al.pair_count(a.limit(0)), "num_results") == [(0,)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "MapInArrow" not in plan


def test_num_results_makes_no_pairs(spark):
    from cladeworks.plans import queries

    plan = queries.num_results(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "MapInArrow" not in plan


def test_medoids_compare_classes_of_one_cluster_only(spark, monkeypatch):
    from cladeworks.plans import queries

    calls, pairs = [], sk.block_pairs
    monkeypatch.setattr(sk, "block_pairs", lambda classes, k, size, far, group=None: calls.append((far, group)) or pairs(classes, k, size, far, group))
    assert queries.cluster_medoid(spark, "/root/testdata/sf0.001").count()
    assert sorted(calls) == [(0.02, None), (0.25, "component")]


@pytest.mark.parametrize("held", [1 << 19, 10])
def test_a_forest_of_pairs_has_the_components_of_all(spark, monkeypatch, held):
    for name, value in (("BLOCK", 12), ("BLOCKS", 2), ("SMALL", 4), ("CELLS", 64), ("EDGES", held)):
        monkeypatch.setattr(sk, name, value)
    rng = np.random.default_rng(8)
    bases = ["".join(rng.choice(list("ACGT"), 300)) for _ in range(3)]
    texts = [b[: 300 - 2 * i] + "".join(rng.choice(list("ACGT"), 2 * i)) for b in bases for i in range(20)]
    classes = sk.sketch_classes(sk.packed_sketch(frame(spark, "s int, t string", *enumerate(texts)), "s", "t", 8, 40), "s").localCheckpoint()
    every = sk.block_pairs(classes, 8, 40, 0.1).localCheckpoint()
    few = sk.block_pairs(classes, 8, 40, 0.1, forest=True).localCheckpoint()
    assert few.count() < every.count() / 2 and not few.join(every, every.columns, "left_anti").count()
    for far in (0.1, 0.02, 0.005):
        parts = [rows(connected_components(sk.edges_within(x, far)), "node", "component") for x in (few, every)]
        assert parts[0] == parts[1]


def test_sweep_has_fewer_links_than_samples(spark):
    from cladeworks.plans import queries

    d = "/root/testdata/sf0.001"
    records = queries._records(spark, d).localCheckpoint()
    assert queries._country_links(spark, d, records, 0.25).count() < records.count()


def test_pair_table_leaves_the_tasks_that_compare(spark, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", 4)
    rng = np.random.default_rng(9)
    seqs = ["".join(rng.choice(list("ACGTNacg-R"), n)) for n in (70, 70, 130, 64, 1, 0)]
    seqs += [*seqs[:3], *("".join(rng.choice(list("ACGT"), 70)) for _ in range(8))]
    a = frame(spark, "cluster_id string, seq_id int, seq string", *[("x", i, s) for i, s in enumerate(seqs)], ("y", 99, "AC"), ("y", 98, None))
    n = lambda s, t: sum(p != q and p in "ACGT" and q in "ACGT" for p, q in zip(s.upper(), t.upper()))
    brute = [("x", i, j, n(s, t), i == j) for i, s in enumerate(seqs) for j, t in enumerate(seqs)] + [("y", 99, 99, 0, True)]
    table = al.pair_table(a)
    assert rows(table, "cluster_id", "sample_a", "sample_b", "n_snps", "is_self") == brute
    assert "sample_a" not in table._jdf.queryExecution().executedPlan().toString().split("MapInArrow", 1)[1]
    assert not any(x in table._jdf.queryExecution().executedPlan().toString().split("MapInArrow", 1)[0] for x in ("Join", "Exchange"))


def test_trees_of_sequences_are_those_of_their_distances(spark):
    rng = np.random.default_rng(10)
    seqs = ["".join(rng.choice(list("ACGTN-"), 90)) for _ in range(30)]
    a = frame(spark, "cluster_id string, seq_id int, seq string", *[("x", i, s) for i, s in enumerate(seqs)], ("x", 40, seqs[0].lower()), ("y", 50, "AC"), ("z", 60, "A"), ("z", 61, "C"))
    classes = al.sequence_classes(a).localCheckpoint()
    pairs = al.snp_distances(classes).withColumnRenamed("n_snps", "distance")
    names = ["cluster_id", "n_tips", "method", "newick"]
    assert rows(trees.sequence_trees(classes), *names) == rows(trees.nj_trees(pairs, classes.select("cluster_id", F.col("rep").alias("name"))), *names)


def test_nj_tree_shuffles_no_pairs(spark):
    from cladeworks.plans import queries

    plan = queries.nj_tree(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "distance" not in plan


def test_distance_pairs_leave_the_tasks_that_count(spark):
    from cladeworks.plans import queries

    plan = queries.mash_distance_pairs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan.split("MapInArrow", 1)[0] for x in ("Join", "Exchange")) and "SortMergeJoin" not in plan


def test_distance_pairs_read_blocks_that_are_written_once(spark, monkeypatch):
    from cladeworks.plans import queries

    d = "/root/testdata/sf0.001"
    whole = rows(queries.mash_distance_pairs(spark, d), "a", "b", "shared", "distance")
    monkeypatch.setattr(sk, "SMALL", 50)
    monkeypatch.setattr(sk, "BLOCK", 40)
    pairs = queries.mash_distance_pairs(spark, d)
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert rows(pairs, "a", "b", "shared", "distance") == whole


def joined_plainly(d):
    """Neighbour joining that looks at every pair in every step: which nodes are joined, by place, and the lengths."""
    d, out = d.astype(float), []
    while (n := len(d)) > 3:
        total = d.sum(axis=1)
        q = np.round((n - 2) * d - total - total[:, None], 9)
        np.fill_diagonal(q, np.inf)
        i, j = sorted(divmod(int(np.argmin(q)), n))
        half = d[i, j] / 2 + (total[i] - total[j]) / (2 * (n - 2))
        out.append((i, j, max(half, 0.0), max(d[i, j] - half, 0.0)))
        d[i] = d[:, i] = (d[i] + d[j] - d[i, j]) / 2
        d[i, i] = 0.0
        order = [n - 1 if k == j else k for k in range(n - 1)]
        d = d[np.ix_(order, order)]
    return out


def tree_of(names, steps, d):
    nodes, n = [trees.Node(x) for x in names], len(names)
    for i, j, a, b in steps:
        nodes[i].length, nodes[j].length = a, b
        nodes[i], nodes[j] = trees.Node(children=[nodes[i], nodes[j]]), nodes[n - 1]
        n -= 1
    return [(x.name, x.length) for node in nodes[:n] for x in node.walk() if x is not node]


@pytest.mark.parametrize("letters, width, changed", [("ACGTN-", 90, 1.0), ("AC", 12, 1.0), ("ACGT", 70, 0.05), ("AN", 9, 1.0)])
def test_joining_by_bounds_is_that_of_all_pairs(letters, width, changed):
    rng = np.random.default_rng(3)
    first = rng.choice(list(letters), width)
    seqs = sorted({"".join(np.where(rng.random(width) < changed, rng.choice(list(letters), width), first)) for _ in range(150)})
    names, every, planes = [f"s{i}" for i in range(len(seqs))], np.arange(len(seqs)), al.base_planes(seqs)
    d = al.differences(planes, every, every)
    expected = tree_of(names, joined_plainly(d), d)
    for source in (trees.Matrix(d.astype(float)), trees.Profiles(planes)):
        assert np.array_equal(source.sums(), d.sum(axis=1)) and np.array_equal(source.rows(every[3:9], 80), d[3:9, :80])
        top = trees.joined_tree(names, *trees.joins(len(names), source))
        found = [(x.name, x.length) for node in top.children for x in node.walk() if x is not node]
        assert [n for n, _ in found] == [n for n, _ in expected] and np.allclose([x for _, x in found], [x for _, x in expected])


def test_a_large_cluster_is_joined_without_a_matrix():
    import tracemalloc

    rng = np.random.default_rng(4)
    seqs = sorted({"".join(x) for x in rng.choice(list("ACGTN"), (2100, 64))})
    tracemalloc.start()
    root = trees.sequence_tree([f"s{i}" for i in range(len(seqs))], seqs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(root.tips()) == len(seqs) and peak < 8 * len(seqs) ** 2
