"""Queries over the driver's tables, one for each operator group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names as fn
from ..operators import alignments as al
from ..operators import clusters as cl
from ..operators import downsample as ds
from ..operators import qc, recombination, rollup, trees
from ..operators import sketches as sk
from .shared import kept
from ..sources import readers, sinks
from . import workflow
from .settings import settings
from .stand_ins import FAR, K, SIZE, THRESHOLD, alignment, genomes, intervals, metadata, read, study, tree


def _sketches(spark, d) -> DataFrame:
    return sk.sketch(read(spark, d, "documents"), "doc_id", "text", K, SIZE)


def _classes(spark, d) -> tuple[DataFrame, DataFrame]:
    sketches = kept(sk.packed_sketch(read(spark, d, "documents"), "doc_id", "text", K, SIZE), "sketches")
    return sketches, kept(sk.sketch_classes(sketches, "doc_id"), "classes")


def _pairs(classes, far=FAR) -> DataFrame:
    return sk.block_pairs(classes, K, SIZE, far)


def _components(spark, d, threshold=THRESHOLD, far=THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members: sample_id, component; classes with component; pairs up to far)."""
    sketches, classes = _classes(spark, d)
    pairs = kept(_pairs(classes, far), "pairs")
    found = cl.single_linkage(classes.select(F.col("rep").alias("sample_id")), sk.edges_within(pairs, threshold))
    found = kept(found, "components").withColumnRenamed("sample_id", "rep")
    members = sk.class_members(sketches, classes, "doc_id").join(found, "rep")
    return members.select(F.col("doc_id").alias("sample_id"), "component"), classes.join(found, "rep"), pairs


def minhash_sketch(spark: SparkSession, d: str) -> DataFrame:
    s = _sketches(spark, d)
    return s.select("doc_id", F.size("sketch").cast("bigint").alias("n_hashes"), F.get("sketch", F.lit(0)).alias("first_hash"), F.md5(F.array_join("sketch", ",")).alias("digest"))


def mash_distance_pairs(spark, d):
    return _pairs(_classes(spark, d)[1]).withColumns({c: F.col(c).cast("bigint") for c in ("shared", "compared")})


def mash_edges_threshold(spark, d):
    return sk.edges_within(_pairs(_classes(spark, d)[1], THRESHOLD), THRESHOLD)


def mash_matrix_long(spark, d):
    _, classes = _classes(spark, d)
    # read twice: once for each direction
    return sk.symmetric(kept(_pairs(classes, 0.1), "pairs"), classes.select("rep"))


def cluster_components(spark, d):
    return _components(spark, d)[0]


def _clusters(spark, d, most=1 << 30) -> DataFrame:
    return kept(cl.split_oversize(_components(spark, d)[0], most), "clusters")


def cluster_sizes(spark, d):
    return cl.sizes(_clusters(spark, d))


def cluster_size_classes(spark, d):
    return cl.size_classes(cl.sizes(_clusters(spark, d)))


def cluster_split_oversize(spark, d):
    return _clusters(spark, d, 3)


def cluster_route_by_size(spark, d):
    return cl.route(cl.sizes(_clusters(spark, d)))


def cluster_merge_small(spark, d):
    return cl.merge_small(_clusters(spark, d))


def cluster_medoid(spark, d):
    classes = kept(_components(spark, d)[1], "in_components")
    pairs = kept(sk.block_pairs(classes, K, SIZE, FAR, "component"), "far_pairs")  # of one cluster only; read twice
    return cl.medoids(classes.select("rep", "n", F.col("component").alias("cluster_id")), pairs)


def core_snp_positions(spark, d):
    return al.core_snp_positions(alignment(spark, d))


def core_snp_sequences(spark, d):
    return al.core_snp_sequences(alignment(spark, d), al.core_snp_positions(alignment(spark, d)))


def keep_atcg_columns(spark, d):
    return al.atcg_columns(alignment(spark, d))


def invariant_counts(spark, d):
    return al.invariant_counts(al.atcg_columns(alignment(spark, d)))


def snp_distance_pairs(spark, d):
    return al.snp_distances(al.sequence_classes(alignment(spark, d)))


def _masked(spark, d) -> DataFrame:
    closure = recombination.tip_closure(tree(spark, d))
    spans = recombination.tip_intervals(intervals(spark, d), closure)
    # sequence i hangs on customer i + 1
    spans = spans.select((F.expr("substring(tip, 2)").cast("bigint") - 1).alias("tip"), "start", "stop")
    rows = alignment(spark, d)
    return recombination.mask(rows, spans).join(rows.select("seq_id", "cluster_id"), "seq_id")


def mask_positions(spark, d):
    return _masked(spark, d).select("seq_id", "seq")


def snp_distance_masked(spark, d):
    return al.snp_distances(al.sequence_classes(_masked(spark, d)))


def snp_pair_table(spark, d):
    return al.pair_table(alignment(spark, d))


def num_results(spark, d):
    return al.pair_count(alignment(spark, d))


def snp_vcf_rows(spark, d):
    return al.vcf_rows(alignment(spark, d), al.core_snp_positions(alignment(spark, d)))


def integrate_snp_offsets(spark, d):
    return al.integrate_positions(al.core_snp_positions(alignment(spark, d)))


def _sample_snps(spark, d) -> DataFrame:
    """A sample in several clusters: the first sequences of all clusters are one sample, the second ones another."""
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy("seq_id")).cast("bigint")
    return core_snp_sequences(spark, d).withColumn("sample_id", place)


def integrate_snp_concat(spark, d):
    return al.integrate_sequences(_sample_snps(spark, d))


def sample_cluster_mapping(spark, d):
    """Which cluster a sample is listed in: the first of those where its SNPs begin with A; most samples have one."""
    snps = kept(_sample_snps(spark, d), "snps")
    known = snps.filter(F.startswith("seq", F.lit("A"))).groupBy("sample_id").agg(F.min("cluster_id").cast("string").alias("cluster_id"))
    return al.sample_mapping(al.integrate_sequences(snps).select("sample_id", "total_snps"), known)


def integration_summary(spark, d):
    return al.integration_summary(integrate_snp_concat(spark, d), core_snp_positions(spark, d))


def integrated_report(spark, d):
    return rollup.integrated_report(sample_cluster_mapping(spark, d))


def alignment_digest(spark, d):
    return sinks.alignment_digest(alignment(spark, d))


def masked_by_tool(spark, d):
    """Intervals of nations from one tool, of regions from another; settings ask for both."""
    closure = recombination.tip_closure(tree(spark, d))
    closure = closure.select(F.when(F.startswith("node", F.lit("c")), F.concat(F.lit("c"), (F.expr("substring(node, 2)").cast("bigint") - 1).cast("string"))).otherwise(F.col("node")).alias("node"), (F.expr("substring(tip, 2)").cast("bigint") - 1).alias("tip"))
    spans = intervals(spark, d)
    by = {"gubbins": spans.filter(F.startswith("node", F.lit("n"))), "clonalframeml": spans.filter(F.startswith("node", F.lit("r")))}
    return workflow.masked_alignments(alignment(spark, d), by, kept(closure, "closure"), settings(recombination="both")).select("tool", "seq_id", "seq")


def unmasked(spark, d):
    return workflow.masked_alignments(alignment(spark, d), {}, None, settings(recombination="none")).select("tool", "seq_id", "seq")


def plan_routes(spark, d):
    """What the recombination-aware plan analyses, and how many sequences and core SNP columns of each cluster it keeps."""
    frames = workflow.recombination_aware(settings(mode="recombination_aware"), alignment(spark, d), {}, None)
    columns = frames["positions"].groupBy(F.regexp_extract("cluster_id", "([^/]*)$", 1).cast("bigint").alias("cluster_id")).agg(F.count("*").alias("n_snps"))
    return frames["routes"].join(columns, "cluster_id", "left").select("cluster_id", "n_isolates", "route", F.coalesce("n_snps", F.lit(0)).alias("n_snps"))


def recomb_tip_closure(spark, d):
    return recombination.tip_closure(tree(spark, d))


def qc_pass_fail(spark, d):
    return qc.size_check(genomes(spark, d), F.col("size"), 1024)


def qc_gate(spark, d):
    files = genomes(spark, d)
    labels = read(spark, d, "labels").select(F.col("doc_id").alias("sample"), F.lit("Label").alias("qc_step"), F.when(F.col("quality") == 1, "PASS").otherwise("FAIL").alias("outcome"))
    return qc.gate(files.select("sample", "size"), qc.size_check(files, F.col("size"), 1024).unionByName(labels))


def reference_largest(spark, d):
    return qc.largest(genomes(spark, d).select("name", "size"), "name", "size")


def _file_names(spark, d) -> DataFrame:
    """Names of which some differ only in dots and underscores."""
    g = genomes(spark, d)
    other = F.when(F.col("sample") % 10 == 0, F.regexp_replace("path", r"\.([0-9])\.fasta$", "_$1.fasta"))
    return g.select("path").unionByName(g.select(other.alias("path")).filter("path is not null"))


def dedup_canonical(spark, d):
    return ds.dedup_canonical(_file_names(spark, d))


def _records(spark, d) -> DataFrame:
    g = genomes(spark, d)
    return ds.join_metadata(g.select("sample", "path"), metadata(spark, d), "line").join(g.select("sample", "name"), "sample")


def metadata_two_key_join(spark, d):
    return _records(spark, d).drop("name")


def unmatched_genomes(spark, d):
    records = _records(spark, d)
    return ds.unmatched(records, True).unionByName(ds.unmatched(records, False))


def matched_genomes(spark, d):
    return ds.matched_only(_records(spark, d), True).select("sample", "country", "matched")


def _country_links(spark, d, records, threshold) -> DataFrame:
    """Links (a, b, distance) of samples of one country that have the same components as all, at every distance up to threshold."""
    sketches, classes = _classes(spark, d)
    members = sk.class_members(sketches, classes, "doc_id")
    # equal sketches are links of distance 0; across classes every country has its own
    home = kept(members.withColumnRenamed("doc_id", "sample").join(records.select("sample", "country"), "sample"), "home")
    own = home.groupBy("rep", "country").agg(F.min("sample").alias("first"))
    inside = home.join(own, ["rep", "country"]).select(F.col("first").alias("a"), F.col("sample").alias("b"), F.lit(0.0).alias("distance")).filter("a <> b")
    by_country = kept(own.join(classes.select("rep", "n", "sketch"), "rep").select("country", F.col("first").alias("rep"), "n", "sketch"), "by_country")
    across = sk.block_pairs(by_country, K, SIZE, threshold, "country", forest=True).select("a", "b", "distance")
    return inside.unionByName(sk.edges_within(across, threshold))


def _grouped(spark, d) -> DataFrame:
    """Records with group_id, rank and is_representative; links within a country at the usual threshold."""
    records = kept(_records(spark, d), "records")
    groups = ds.dereplicate(records, _country_links(spark, d, records, THRESHOLD), THRESHOLD)
    ranked = ds.rank_in_group(records.join(groups, "sample"))
    return kept(ranked.withColumn("is_representative", F.col("rank") == 1), "grouped")


def derep_within_group(spark, d):
    return _grouped(spark, d).select("sample", "country", "group_id")


def representative_rank(spark, d):
    return _grouped(spark, d).select("sample", "group_id", F.col("rank").cast("bigint").alias("rank"), "is_representative")


def derep_sweep(spark, d):
    records = kept(_records(spark, d), "records")
    return ds.sweep(records, _country_links(spark, d, records, 0.1), [0.005, 0.02, 0.1])


def _chosen(spark, d) -> tuple[DataFrame, DataFrame]:
    """(grouped records, representatives with turn and kept): quotas of what study isolates leave of the target."""
    s = settings(target_total=425, min_per_country=30, max_per_country=250)
    grouped = _grouped(spark, d)
    reps = grouped.filter("is_representative")
    keep = ds.quotas(reps, ds.budget_left(s.target_total, study(spark, d).count()), s.min_per_country, s.max_per_country)
    return grouped, ds.round_robin(reps, keep, s.seed).select("sample", "country", "subregion", "path", "turn", "kept")


def quota_allocate(spark, d):
    reps = _grouped(spark, d).filter("is_representative")
    return ds.quotas(reps, ds.budget_left(425, study(spark, d).count()), 30, 250)


def round_robin_select(spark, d):
    return _chosen(spark, d)[1].select("sample", "country", "subregion", F.col("turn").cast("bigint").alias("turn"), "kept")


def selection_report(spark, d):
    return ds.selection_report(*_chosen(spark, d), ds.study_rows(study(spark, d)))


def samplesheet(spark, d):
    return ds.samplesheet(ds.study_rows(study(spark, d)), _chosen(spark, d)[1].filter("kept"))


def country_summary(spark, d):
    grouped, chosen = _chosen(spark, d)
    return ds.country_summary(grouped.join(chosen.select("sample", "kept"), "sample", "left"))


def _logs(spark, d) -> DataFrame:
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.floor("o_totalprice").cast("bigint").alias("p"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    code = F.when(F.col("k") % 5 == 0, F.lit(None).cast("string")).when(F.col("k") % 5 == 1, "NA").when(F.col("k") % 5 == 2, "3").otherwise("0")
    return o.select("k", "p", "status", "priority", (F.col("k") % 13 == 0).alias("skipped"), (F.col("k") % 17 == 0).alias("failed"), code.alias("code"), (F.col("k") % 9).alias("n"), (F.col("k") % 23).alias("sites"), (F.col("k") % 3 * 100).alias("tree_bytes"), (F.col("k") % 4 * 10).alias("log_bytes"))


def _log_lines(logs: DataFrame) -> DataFrame:
    """(path, value): what a run of each cluster wrote to its log; orders that are pending have none."""
    says = lambda when, *parts: F.when(when, F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)))
    always = F.lit(True)
    lines = F.array(
        says(always, "Sequence count: ", F.col("n")), says(F.col("n") > 0, "Alignment length (non-header chars): ", F.col("p")), says(F.col("n") == 0, "ERROR: Alignment file missing or empty"),
        says(F.col("p") % 2 == 0, "Starting tree present: yes (", F.col("p"), " bytes)"), says(F.col("p") % 2 == 1, "Starting tree: (none provided)"), says(F.col("skipped"), "Too few: skipping Gubbins"),
        says(F.col("failed"), "ERROR: Gubbins failed; going on"), says(F.col("code").isNotNull(), "Gubbins exit code: ", F.col("code")),
    )
    return logs.filter("status <> 'P'").select(F.col("k").cast("string").alias("path"), F.explode(F.array_compact(lines)).alias("value"))


def gubbins_status_case(spark, d):
    tree_state = fn.tree_status(F.col("tree_bytes"), F.lit("(a,b);"), F.col("n"), F.col("log_bytes"))
    return _logs(spark, d).select("k", fn.gubbins_status(F.col("skipped"), F.col("failed"), F.col("code")).alias("gubbins_status"), tree_state.alias("iqtree_status"))


def confidence_tier(spark, d):
    states = gubbins_status_case(spark, d).join(_logs(spark, d).select("k", "n", "sites"), "k")
    return states.select("k", fn.confidence_tier(F.col("n"), F.col("gubbins_status"), F.col("iqtree_status"), F.col("sites")).alias("tier"))


def phylogeny_summary(spark, d):
    """Clusters of sequences, and of orders: logs unless pending, trees unless of low priority, filtered alignments if filled."""
    logs = _logs(spark, d)
    diagnostics = readers.diagnostics_of(_log_lines(logs)).select(F.col("path").cast("bigint").alias("cluster_id"), "seq_count", "alignment_length", "starting_tree", "skipped", "failed", "code", "empty_input")
    key = F.col("k").alias("cluster_id")
    grown = logs.filter("priority <> '5-LOW'").select(key, "tree_bytes", F.lit("(a,b);").alias("tree_text"), "log_bytes")
    filtered = logs.filter("status = 'F'").select(key, F.col("n").alias("n_records"), F.col("sites").alias("n_columns"))
    blocks = logs.filter("status = 'O'").select(key, (F.col("k") % 7).alias("n_blocks"))
    return rollup.phylogeny_summary(cl.sizes(alignment(spark, d)), diagnostics, grown, filtered, blocks)


def analysis_statistics(spark, d):
    leaves = graft_trees(spark, d).select(F.col("n_tips").alias("n_leaves"))
    return rollup.analysis_statistics(alignment(spark, d), integrate_snp_concat(spark, d), leaves)


def error_rollup(spark, d):
    """Events as errors of tasks: nobody's if the user is the first."""
    e = read(spark, d, "events")
    errors = e.select(
        F.when(F.col("user_id") % 50 == 1, "").otherwise(F.col("user_id").cast("string")).alias("sample"), F.col("event_type").alias("process"), F.floor("value").cast("string").alias("error"),
        F.concat(F.lit("/work/"), F.col("event_id").cast("string")).alias("folder"), F.lit("run").alias("run"), "event_id",
    )
    return rollup.error_rollup(errors, "event_id").drop("event_id")


def failed_tasks(spark, d):
    """Work folders of suppliers as tasks that ended with an exit code."""
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("n"), F.floor("s_acctbal").cast("string").alias("b"))
    line = lambda file, no, *parts: F.struct(F.lit(file).alias("file"), F.lit(no).alias("line_no"), F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)).alias("value"))
    lines = F.array(
        line(".command.run", 1, "### NEXTFLOW TASK: A:B:STEP_", F.col("n"), " (x)"), line(".command.run", 2, "-name nf-", F.col("k"), "(", F.col("name"), ")"),
        line(".command.err", 1, "starts"), line(".command.err", 2, "[31m]stopped at ", F.col("b"), "[0m]"), line(".exitcode", 1, F.when(F.col("n") > 12, "137").otherwise("1")),
    )
    rows = s.select(F.concat(F.lit("/work/"), F.col("k").cast("string")).alias("folder"), F.explode(lines).alias("x")).select("folder", "x.*")
    return rollup.failed_tasks(rows)


def _assemblies(spark, d) -> DataFrame:
    return genomes(spark, d).select(F.col("sample").alias("sample_id"), F.col("path").alias("file"))


def cluster_assembly_lists(spark, d):
    lists = workflow.cluster_assemblies(_clusters(spark, d), _assemblies(spark, d))
    return lists.select("cluster_id", F.size("files").cast("bigint").alias("n"), F.array_join("files", ",").alias("files"))


def cluster_assembly_rows(spark, d):
    return workflow.unzipped(workflow.cluster_assemblies(_clusters(spark, d), _assemblies(spark, d)))


def _representatives(spark, d) -> tuple[DataFrame, DataFrame]:
    """(members with file; cluster_id, representative: the name, without version, of each cluster's least genome)."""
    files = kept(_clusters(spark, d).join(genomes(spark, d).select(F.col("sample").alias("sample_id"), "path", "name"), "sample_id"), "files")
    least = files.groupBy("cluster_id").agg(F.min_by("name", "sample_id").alias("name"), F.min("sample_id").alias("sample_id"))
    # some by full name, some without version, some by a name that no file has
    label = F.when(F.col("sample_id") % 3 == 0, F.col("name")).when(F.col("sample_id") % 3 == 1, F.substring_index("name", ".", 1)).otherwise(F.lit("other"))
    return files, least.select("cluster_id", label.alias("representative"))


def representative_files(spark, d):
    files, representatives = _representatives(spark, d)
    return workflow.representative_files(representatives, files.select("cluster_id", F.col("path").alias("file")))


def alignment_references(spark, d):
    """Each cluster of three or more with the file it is aligned to: its representative's."""
    files, representatives = _representatives(spark, d)
    found = workflow.representative_files(representatives, files.select("cluster_id", F.col("path").alias("file")))
    viable = cl.route(cl.sizes(files)).filter("route = 'viable'").select("cluster_id", "n_isolates")
    return workflow.alignment_references(viable, found, settings())


def global_references(spark, d):
    """The same aligned to the one largest genome."""
    files, representatives = _representatives(spark, d)
    found = workflow.representative_files(representatives, files.select("cluster_id", F.col("path").alias("file")))
    viable = cl.route(cl.sizes(files)).filter("route = 'viable'").select("cluster_id", "n_isolates")
    largest = qc.largest(genomes(spark, d).select("path", "size"), "path", "size").select(F.col("path").alias("file"))
    return workflow.alignment_references(viable, found, settings(use_global_reference=True), largest)


def without_reference(spark, d):
    g = genomes(spark, d)
    return qc.without_reference(g.select("sample", "name"), qc.largest(g.select("name", "size"), "name", "size"), "name")


def alignments_with_trees(spark, d):
    """Alignments of clusters with their starting trees, matched one to one; only clusters that have both."""
    a = rollup.alignment_sizes(alignment(spark, d)).withColumn("cluster_id", F.col("cluster_id").cast("string"))
    trees_ = _logs(spark, d).filter("priority <> '5-LOW'").select(F.col("k").cast("string").alias("cluster_id"), "tree_bytes")
    return workflow.one_to_one(a, trees_, "cluster_id")


def cluster_summary_lines(spark, d):
    return cl.summary_lines(cl.sizes(_clusters(spark, d)))


def number_formats(spark, d):
    p = read(spark, d, "part")
    price = F.col("p_retailprice")
    return p.select(
        "p_partkey", fn.fixed(F.col("p_size") / 8, 2).alias("two"), fn.thousands(F.floor(price * 1000)).alias("grouped"), fn.ending(F.concat("p_name", F.lit(".fa."), "p_brand")).alias("ending"),
        fn.strip_quotes(F.concat(F.lit("'"), "p_name", F.lit("'"))).alias("label"), fn.at_most(F.col("p_size"), F.lit(16)).alias("cpus"), fn.runtime_hours(F.col("p_size") * 7).alias("hours"),
        fn.base_name(F.concat(F.lit("/a/"), "p_brand")).alias("base"), fn.drop_reference_suffix(F.concat("p_brand", F.lit(".ref"))).alias("bare"),
    )


def parse_names(spark, d):
    p = F.col("path")
    return _file_names(spark, d).select(
        "path", fn.normalize_name(p).alias("normal"), fn.sample_id(p).alias("sample_id"), fn.canonical_key(p).alias("canonical_key"), fn.accession_key(p).alias("accession_key"),
        fn.has_ending(p).alias("is_fasta"), fn.remove_endings(F.element_at(F.split(p, "/"), -1)).alias("bare"), fn.sheet_name(p).alias("sheet"),
        fn.sheet_name(p, last=True).alias("last_part"), fn.normalize_label(F.concat(F.lit("'"), F.element_at(F.split(p, "/"), -1), F.lit("'"))).alias("label"),
    )


def parse_year(spark, d):
    g = genomes(spark, d)
    size = F.concat((F.col("sample") % 90).cast("string"), F.element_at(F.array(F.lit("k"), F.lit("m"), F.lit("G"), F.lit("c"), F.lit("")), (F.col("sample") % 5 + 1).cast("int")))
    return g.select("sample", "date", fn.parse_year(F.col("date")).alias("year"), fn.known_subregion(F.col("subregion")).alias("known"), fn.parse_size(size).alias("bytes"), fn.sanitize_sample(F.concat(F.lit(" "), "country", F.lit(" x "))).alias("clean"))


def split_kmer_columns(spark, d):
    return al.split_kmers(alignment(spark, d), "seq_id", "seq", flank=2)


def split_kmer_strands(spark, d):
    return al.split_kmers(alignment(spark, d), "seq_id", "seq", flank=2, both_strands=True)


def _unique_per_cluster(spark, d):
    return al.sequence_classes(alignment(spark, d)).select("cluster_id", "rep", "seq")


def nj_tree(spark, d):
    return trees.sequence_trees(_unique_per_cluster(spark, d).withColumn("cluster_id", F.col("cluster_id").cast("string")))


def _trees(spark, d) -> tuple[DataFrame, DataFrame]:
    """A backbone of nations for each region; clusters: a star of customers for each nation, and one of suppliers for each,
    whose representative no backbone has; nobody's is empty."""
    n = read(spark, d, "nation")
    tip = F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))
    backbones = n.groupBy(F.col("n_regionkey").cast("string").alias("tree_id")).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list(F.concat(tip, F.lit(":0.5")))), ","), F.lit(");")).alias("newick"))

    def stars(table, key, nation, letter):
        tips = F.array_join(F.array_sort(F.collect_list(F.concat(F.lit(letter), F.col(key).cast("string"), F.lit(":0.1")))), ",")
        people = n.join(read(spark, d, table).groupBy(F.col(nation).alias("n_nationkey")).agg(tips.alias("tips")), "n_nationkey", "left")
        name = F.concat(F.lit("N" if letter == "c" else "S"), F.col("n_nationkey").cast("string"))
        newick = F.when(F.col("tips").isNotNull(), F.concat(F.lit("("), name, F.lit(":0.2,("), "tips", F.lit("):0.3);")))
        return people.select(F.col("n_regionkey").cast("string").alias("tree_id"), name.alias("cluster_id"), F.coalesce(newick, F.lit("")).alias("newick"), name.alias("representative"))

    return backbones, stars("customer", "c_custkey", "c_nationkey", "c").unionByName(stars("supplier", "s_suppkey", "s_nationkey", "s"))


def graft_trees(spark, d):
    return trees.graft_trees(*_trees(spark, d))


def graft_report(spark, d):
    return trees.graft_report(*_trees(spark, d))


def newick_edges(spark, d):
    grown = graft_trees(spark, d).select("tree_id", "newick")
    return trees.parse_trees(grown)


QUERIES = {
    f.__name__: f
    for f in (
        minhash_sketch, mash_distance_pairs, mash_edges_threshold, mash_matrix_long, cluster_components, cluster_sizes, cluster_size_classes, cluster_split_oversize,
        cluster_route_by_size, cluster_merge_small, cluster_medoid, cluster_summary_lines, core_snp_positions, core_snp_sequences, keep_atcg_columns, invariant_counts,
        snp_distance_pairs, snp_pair_table, num_results, snp_distance_masked, snp_vcf_rows, integrate_snp_offsets, integrate_snp_concat, sample_cluster_mapping,
        integration_summary, integrated_report, alignment_digest, recomb_tip_closure, mask_positions, masked_by_tool, unmasked, plan_routes, qc_pass_fail, qc_gate,
        reference_largest, without_reference, dedup_canonical, metadata_two_key_join, unmatched_genomes, matched_genomes, derep_within_group, representative_rank,
        derep_sweep, quota_allocate, round_robin_select, selection_report, samplesheet, country_summary, gubbins_status_case, confidence_tier, phylogeny_summary,
        analysis_statistics, error_rollup, failed_tasks, cluster_assembly_lists, cluster_assembly_rows, representative_files, alignment_references, global_references,
        alignments_with_trees, number_formats, parse_names, parse_year, split_kmer_columns, split_kmer_strands, nj_tree, graft_trees, graft_report, newick_edges,
    )
}
