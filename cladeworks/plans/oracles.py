"""DuckDB SQL that says the same as each query, written apart from the Spark code."""

from __future__ import annotations

_SKETCH = """
km AS (SELECT DISTINCT doc_id, md5(substr(text, i, 12)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 10)) AS i FROM documents)),
sk AS (SELECT doc_id, h FROM (SELECT doc_id, h, row_number() OVER (PARTITION BY doc_id ORDER BY h) AS rn FROM km) WHERE rn <= 64),
dg AS (SELECT doc_id, md5(string_agg(h, ',' ORDER BY h)) AS g, count(*) AS n_h FROM sk GROUP BY doc_id),
cls AS (SELECT min(doc_id) AS rep, count(*) AS n, g FROM dg GROUP BY g UNION ALL SELECT doc_id, 1, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM dg)),
mem AS (SELECT d.doc_id, coalesce(c.rep, d.doc_id) AS rep FROM documents d LEFT JOIN dg ON d.doc_id = dg.doc_id LEFT JOIN cls c ON c.g = dg.g),
rs AS (SELECT c.rep, sk.h FROM cls c JOIN sk ON sk.doc_id = c.rep),
cand AS (SELECT DISTINCT p.rep AS a, q.rep AS b FROM rs p JOIN rs q ON p.h = q.h AND p.rep < q.rep),
un AS (SELECT a, b, h, count(*) AS c FROM (SELECT a, b, h FROM cand JOIN rs ON rs.rep = cand.a UNION ALL SELECT a, b, h FROM cand JOIN rs ON rs.rep = cand.b) GROUP BY a, b, h),
bot AS (SELECT a, b, c FROM (SELECT a, b, c, row_number() OVER (PARTITION BY a, b ORDER BY h) AS rn FROM un) WHERE rn <= 64),
ct AS (SELECT a, b, count(*) FILTER (WHERE c = 2) AS shared, count(*) AS compared FROM bot GROUP BY a, b),
pairs AS (SELECT a, b, shared, compared, round(abs(-ln(2 * (shared / compared) / (1 + shared / compared)) / 12), 9) AS distance
          FROM (SELECT a, b, CAST(shared AS DOUBLE) AS shared, CAST(compared AS DOUBLE) AS compared FROM ct WHERE shared > 0))
"""


def _components(threshold: float = 0.02) -> str:
    return f"""{_SKETCH},
e AS (SELECT a, b FROM pairs WHERE distance <= {threshold} UNION ALL SELECT b, a FROM pairs WHERE distance <= {threshold}),
reach AS (SELECT rep AS x, rep AS y FROM cls UNION SELECT r.x, e.b FROM reach r JOIN e ON r.y = e.a),
comp AS (SELECT x AS rep, min(y) AS component FROM reach GROUP BY x),
members AS (SELECT mem.doc_id AS sample_id, comp.component FROM mem JOIN comp ON mem.rep = comp.rep)"""


def _clusters(most: int) -> str:
    return f"""{_components()},
chunked AS (SELECT sample_id, component, CAST(floor((row_number() OVER (PARTITION BY component ORDER BY sample_id) - 1) / {most}) AS BIGINT) AS chunk FROM members),
clusters AS (SELECT 'cluster_' || CAST(dense_rank() OVER (ORDER BY component, chunk) - 1 AS VARCHAR) AS cluster_id, sample_id FROM chunked),
sizes AS (SELECT cluster_id, count(*) AS n_isolates FROM clusters GROUP BY cluster_id)"""


_SEQ = """
cell AS (SELECT CAST(label AS BIGINT) AS cluster_id, vec_id AS seq_id, i AS position, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT label, vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)),
cells AS (SELECT cluster_id, seq_id, position, CASE WHEN abs(x) < 0.01 THEN 'N' WHEN x < -0.085 THEN 'A' WHEN x < 0 THEN 'C' WHEN x < 0.085 THEN 'G' ELSE 'T' END AS base FROM cell),
seqs AS (SELECT cluster_id, seq_id, string_agg(base, '' ORDER BY position) AS seq FROM cells GROUP BY cluster_id, seq_id)"""
_SNPS = f"""{_SEQ},
col AS (SELECT cluster_id, position, base FROM cells WHERE base <> 'N' GROUP BY cluster_id, position, base),
alts AS (SELECT cluster_id, position, min(base) AS ref_base, count(*) AS n FROM col GROUP BY cluster_id, position HAVING count(*) > 1),
pos AS (SELECT alts.cluster_id, alts.position, alts.ref_base, string_agg(col.base, ',' ORDER BY col.base) AS alt_bases FROM alts JOIN col ON col.cluster_id = alts.cluster_id AND col.position = alts.position AND col.base <> alts.ref_base GROUP BY alts.cluster_id, alts.position, alts.ref_base),
snp AS (SELECT c.cluster_id, c.seq_id, count(*) AS n_snps, string_agg(c.base, '' ORDER BY c.position) AS seq FROM cells c JOIN pos p ON c.cluster_id = p.cluster_id AND c.position = p.position GROUP BY c.cluster_id, c.seq_id)"""
_TREE = """
edge AS (SELECT 'r' || CAST(r_regionkey AS VARCHAR) AS child, 'root' AS parent FROM region
         UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'r' || CAST(n_regionkey AS VARCHAR) FROM nation
         UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), 'n' || CAST(c_nationkey AS VARCHAR) FROM customer),
tips AS (SELECT DISTINCT child AS tip FROM edge WHERE child NOT IN (SELECT parent FROM edge)),
below AS (SELECT parent AS node, child AS x FROM edge UNION SELECT b.node, e.child FROM below b JOIN edge e ON e.parent = b.x),
closure AS (SELECT node, x AS tip FROM below WHERE x IN (SELECT tip FROM tips) UNION SELECT tip, tip FROM tips)"""
_MASK = f"""{_TREE}, {_SEQ},
iv AS (SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS node, n_nationkey * 7 % 50 AS start, n_nationkey * 7 % 50 + 5 AS stop FROM nation
       UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), r_regionkey * 11 % 50, r_regionkey * 11 % 50 + 3 FROM region),
hit AS (SELECT DISTINCT CAST(substr(tip, 2) AS BIGINT) - 1 AS seq_id, start + k AS position FROM (SELECT closure.tip, iv.start, unnest(range(1, iv.stop - iv.start + 1)) AS k FROM iv JOIN closure ON closure.node = iv.node)),
mcells AS (SELECT c.cluster_id, c.seq_id, c.position, CASE WHEN h.position IS NULL THEN c.base ELSE 'N' END AS base FROM cells c LEFT JOIN hit h ON h.seq_id = c.seq_id AND h.position = c.position),
mseqs AS (SELECT cluster_id, seq_id, string_agg(base, '' ORDER BY position) AS seq FROM mcells GROUP BY cluster_id, seq_id)"""


def _distances(seqs: str, cells: str) -> str:
    return f"""scls AS (SELECT cluster_id, seq, min(seq_id) AS rep FROM {seqs} GROUP BY cluster_id, seq),
rc AS (SELECT c.cluster_id, c.seq_id, c.position, c.base FROM {cells} c JOIN scls s ON s.cluster_id = c.cluster_id AND s.rep = c.seq_id)
SELECT p.cluster_id, p.seq_id AS a, q.seq_id AS b, CAST(sum(CASE WHEN p.base <> q.base AND p.base <> 'N' AND q.base <> 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n_snps
FROM rc p JOIN rc q ON p.cluster_id = q.cluster_id AND p.position = q.position AND p.seq_id < q.seq_id GROUP BY p.cluster_id, p.seq_id, q.seq_id"""


_STEM = "regexp_replace(regexp_extract({0}, '([^/]*)$', 1), '^(.+)\\.[^.]*$', '\\1')"
_GENOMES = """
nm AS (SELECT doc_id, lang, source, n_chars, CASE WHEN doc_id % 6 = 0 THEN 'gcf_' WHEN doc_id % 3 = 0 THEN 'GCF_' ELSE 'GCA_' END || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.' || CAST(doc_id % 4 AS VARCHAR) AS name FROM documents),
g AS (SELECT doc_id AS sample, '/in/' || source || '/' || name || '.fasta' AS path, name, lang AS country,
      CASE WHEN doc_id % 5 = 0 THEN 'NA' WHEN doc_id % 11 = 0 THEN ' Unknown' WHEN doc_id % 4 = 0 THEN upper(source) WHEN doc_id % 4 = 1 THEN ' ' || source || ' ' ELSE source END AS subregion,
      CASE WHEN doc_id % 7 = 0 THEN 'unknown' WHEN doc_id % 7 = 1 THEN 'May ' || CAST(1990 + n_chars % 30 AS VARCHAR) ELSE CAST(1990 + n_chars % 30 AS VARCHAR) || '-05' END AS date, n_chars AS size FROM nm)"""
_YEAR = "CASE WHEN regexp_matches({0}, '^[^0-9]*[0-9]{{4}}') THEN CAST(regexp_extract({0}, '^[^0-9]*([0-9]{{4}})', 1) AS INTEGER) ELSE 1000000000 END"
_FILES = f"""{_GENOMES},
files AS (SELECT path FROM g UNION ALL SELECT regexp_replace(path, '\\.([0-9])\\.fasta$', '_\\1.fasta') FROM g WHERE sample % 10 = 0)"""
# every id of a metadata row stands under both keys, the first row of a key counts; a genome's accession key is tried first
_RECORDS = f"""{_GENOMES},
md AS (SELECT sample * 2 AS line, CASE WHEN sample % 2 = 0 THEN split_part(name, '.', 1) || '.' || CAST(sample % 4 + 1 AS VARCHAR) || '.fasta' END AS i1, CASE WHEN sample % 3 = 1 THEN replace(name, '.', '_') || '.fasta' END AS i2,
       CASE WHEN sample % 5 = 0 THEN ' ' || name || '.fa' END AS i3, CASE WHEN sample % 11 = 0 THEN ' ' ELSE country || ' ' END AS country, subregion, date FROM g
       UNION ALL SELECT sample * 2 + 1, NULL, split_part(name, '.', 1) || '.' || CAST(sample % 4 + 1 AS VARCHAR) || '.fasta', '', 'elsewhere', 'x', '1980' FROM g WHERE sample % 2 = 0),
ids AS (SELECT line, trim(i) AS i, coalesce(nullif(trim(country), ''), 'Unknown') AS country, coalesce(trim(subregion), '') AS subregion, coalesce(trim(date), '') AS date FROM (SELECT *, unnest([i1, i2, i3]) AS i FROM md) WHERE trim(i) <> ''),
stems AS (SELECT *, {_STEM.format('i')} AS stem FROM ids),
keyed AS (SELECT line, regexp_replace(stem, '[._][0-9]{{1,3}}$', '') AS k, country, subregion, date FROM stems UNION SELECT line, replace(stem, '.', '_'), country, subregion, date FROM stems),
idx AS (SELECT k, country, subregion, date FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY line) AS rn FROM keyed) WHERE rn = 1),
records AS (SELECT g.sample, g.path, g.name, coalesce(x.country, y.country, 'Unknown') AS country, CASE WHEN x.k IS NOT NULL THEN x.subregion ELSE coalesce(y.subregion, '') END AS subregion,
            CASE WHEN x.k IS NOT NULL THEN x.date ELSE coalesce(y.date, '') END AS date, x.k IS NOT NULL OR y.k IS NOT NULL AS matched
            FROM g LEFT JOIN idx x ON x.k = regexp_replace(g.name, '[._][0-9]{{1,3}}$', '') LEFT JOIN idx y ON y.k = replace(g.name, '.', '_'))"""
_KNOWN = "lower(trim(subregion)) NOT IN ('', 'unknown', 'na', 'n/a', 'none')"
# links of samples of a country: of one sketch (distance 0) or of near ones
_LINKS = f"""{_SKETCH}, {_RECORDS},
near AS (SELECT a, b, distance FROM pairs WHERE distance <= 0.1 UNION ALL SELECT b, a, distance FROM pairs WHERE distance <= 0.1 UNION ALL SELECT rep, rep, 0 FROM cls),
links AS (SELECT p.doc_id AS a, q.doc_id AS b, near.distance FROM near JOIN mem p ON p.rep = near.a JOIN mem q ON q.rep = near.b JOIN records x ON x.sample = p.doc_id JOIN records y ON y.sample = q.doc_id WHERE x.country = y.country)"""
_GROUPS = f"""{_LINKS},
link AS (SELECT a, b FROM links WHERE distance <= 0.02),
reach AS (SELECT sample AS x, sample AS y FROM records UNION SELECT r.x, link.b FROM reach r JOIN link ON link.a = r.y),
grp AS (SELECT x AS sample, min(y) AS group_id FROM reach GROUP BY x),
ranked AS (SELECT records.*, group_id, row_number() OVER (PARTITION BY group_id ORDER BY CASE WHEN {_KNOWN} THEN 0 ELSE 1 END,
           CASE WHEN upper(name) LIKE 'GCF%' THEN 0 ELSE 1 END, {_YEAR.format('date')}, md5(CAST(records.sample AS VARCHAR) || ':42'), records.sample) AS rank FROM records JOIN grp ON grp.sample = records.sample),
reps AS (SELECT * FROM ranked WHERE rank = 1)"""
# quotas: floors, lowered in turns if they are too much; else shares of what is left by free capacity, pass by pass
_QUOTAS = f"""{_GROUPS},
bud AS (SELECT greatest(0, 425 - count(*)) AS b FROM nation),
av AS (SELECT country, count(*) AS n FROM reps GROUP BY country),
al AS (SELECT 0 AS step, country, least(n, 30) AS keep0, CAST(least(n, 30) AS BIGINT) AS keep, least(n, 250) AS cap, CAST((SELECT b FROM bud) - sum(least(n, 30)) OVER () AS BIGINT) AS lft FROM av
  UNION ALL
  SELECT step + 1, country, keep0, CAST(CASE WHEN lft < 0 THEN keep - CASE WHEN keep > 0 AND rk <= -lft THEN 1 ELSE 0 END WHEN g > 0 THEN keep + give ELSE keep + CASE WHEN room > 0 AND frk <= lft THEN 1 ELSE 0 END END AS BIGINT), cap,
         CAST(CASE WHEN lft < 0 THEN lft + least(-lft, npos) WHEN g > 0 THEN lft - g ELSE 0 END AS BIGINT)
  FROM (SELECT *, sum(give) OVER () AS g, count(*) FILTER (WHERE keep > 0) OVER () AS npos, row_number() OVER (ORDER BY CASE WHEN keep > 0 THEN 0 ELSE 1 END, keep0 DESC, country) AS rk,
               row_number() OVER (ORDER BY CASE WHEN room > 0 THEN 0 ELSE 1 END, share - floor(share) DESC, country) AS frk
        FROM (SELECT *, CASE WHEN lft > 0 THEN least(CAST(floor(share) AS BIGINT), room) ELSE 0 END AS give
              FROM (SELECT *, CASE WHEN pool > 0 THEN CAST(lft * room AS DOUBLE) / pool ELSE 0 END AS share FROM (SELECT *, cap - keep AS room, sum(cap - keep) OVER () AS pool FROM al WHERE lft <> 0)))) WHERE (lft < 0 AND npos > 0) OR (lft > 0 AND pool > 0)),
quota AS (SELECT av.country, av.n, CASE WHEN (SELECT sum(n) FROM av) <= (SELECT b FROM bud) THEN av.n ELSE k.keep END AS keep FROM av JOIN (SELECT country, arg_max(keep, step) AS keep FROM al GROUP BY country) k ON k.country = av.country)"""
_SELECT = f"""{_QUOTAS},
bk AS (SELECT *, CASE WHEN {_KNOWN} THEN lower(trim(subregion)) ELSE '~unknown' END AS bucket FROM reps),
posd AS (SELECT *, row_number() OVER (PARTITION BY country, bucket ORDER BY {_YEAR.format('date')}, md5(CAST(sample AS VARCHAR) || ':42'), sample) AS pos, count(*) OVER (PARTITION BY country, bucket) AS nb FROM bk),
turns AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY pos, nb DESC, bucket) AS turn FROM posd),
sel AS (SELECT t.sample, t.country, t.subregion, t.path, t.turn, t.turn <= q.keep AS kept FROM turns t JOIN quota q ON q.country = t.country),
stu AS (SELECT replace(trim({_STEM.format("('/study/' || n_name || '.fasta')")}), ' ', '_') AS sample, '/study/' || n_name || '.fasta' AS path FROM nation)"""
_LOGS = """
lg AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS p, o_orderstatus AS status, o_orderpriority AS priority, o_orderkey % 13 = 0 AS skipped, o_orderkey % 17 = 0 AS failed, CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'NA' WHEN 2 THEN '3' ELSE '0' END AS code,
       o_orderkey % 9 AS n, o_orderkey % 23 AS sites, o_orderkey % 3 * 100 AS tb, o_orderkey % 4 * 10 AS lb FROM orders),
st AS (SELECT *, CASE WHEN skipped THEN 'skipped_low_information' WHEN failed THEN 'failed_fallback_to_sanitized_alignment' WHEN code = '0' THEN 'completed' WHEN code IS NULL OR code = 'NA' THEN 'unknown' ELSE 'failed_exit_' || code END AS gubbins_status,
       CASE WHEN tb = 0 THEN 'failed_no_tree' WHEN n < 3 THEN 'skipped_low_information' WHEN lb = 0 THEN 'minimal_tree_no_log' ELSE 'completed' END AS iqtree_status FROM lg)"""
# a cluster's members by name, and its representative's label
_FILES_OF = f"""{_clusters(1 << 30)}, {_GENOMES},
cf AS (SELECT clusters.cluster_id, sample_id, path, name FROM clusters JOIN g ON g.sample = clusters.sample_id),
lab AS (SELECT cluster_id, CASE m % 3 WHEN 0 THEN name WHEN 1 THEN split_part(name, '.', 1) ELSE 'other' END AS representative FROM (SELECT cluster_id, min(sample_id) AS m, arg_min(name, sample_id) AS name FROM cf GROUP BY cluster_id)),
rf AS (SELECT cluster_id, representative, path AS file, CASE place WHEN 1 THEN 'exact' WHEN 2 THEN 'version' ELSE 'any' END AS match FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY place, path) AS rn
       FROM (SELECT lab.cluster_id, representative, path, CASE WHEN name = representative THEN 1 WHEN split_part(name, '.', 1) IN (representative, regexp_replace({_STEM.format('representative')}, '[._][0-9]{{1,3}}$', '')) THEN 2 ELSE 3 END AS place FROM lab JOIN cf ON cf.cluster_id = lab.cluster_id)) WHERE rn = 1)"""
_SAMPLES = f"""{{0}}, ss AS (SELECT row_number() OVER (PARTITION BY cluster_id ORDER BY seq_id) AS sample_id, cluster_id, seq, n_snps FROM snp),
tot AS (SELECT sample_id, count(*) AS n_clusters, CAST(sum(length(seq)) AS BIGINT) AS total_snps, string_agg(seq, '' ORDER BY cluster_id) AS seq FROM ss GROUP BY sample_id),
kn AS (SELECT sample_id, CAST(min(cluster_id) AS VARCHAR) AS cluster_id FROM ss WHERE seq LIKE 'A%' GROUP BY sample_id),
mp AS (SELECT tot.sample_id, coalesce(kn.cluster_id, 'unknown') AS cluster_id, total_snps FROM tot LEFT JOIN kn ON kn.sample_id = tot.sample_id)"""
_GRAFTS = """
cu AS (SELECT c_nationkey AS k, string_agg('c' || CAST(c_custkey AS VARCHAR) || ':0.1', ',' ORDER BY 'c' || CAST(c_custkey AS VARCHAR) || ':0.1') AS tips, count(*) AS n FROM customer GROUP BY c_nationkey),
tp AS (SELECT n_regionkey, 'N' || CAST(n_nationkey AS VARCHAR) AS tip, tips, coalesce(n, 0) AS n FROM nation LEFT JOIN cu ON cu.k = n_nationkey),
gr AS (SELECT CAST(n_regionkey AS VARCHAR) AS tree_id, '(' || string_agg(CASE WHEN tips IS NULL THEN tip || ':0.5' ELSE '(' || tip || ':0.0,(' || tips || '):0.0):0.5' END, ',' ORDER BY tip || ':0.5') || ');' AS newick, CAST(sum(n + 1) AS BIGINT) AS n_tips,
       count(*) FILTER (WHERE n > 0) AS n_grafted, 2 * count(*) - count(*) FILTER (WHERE n > 0) AS n_failed FROM tp GROUP BY n_regionkey)"""
_TIER = """CASE WHEN {n} <= 1 THEN 'Tier4_singleton_or_uninterpretable' WHEN {t} NOT IN ('completed', 'minimal_tree_no_log') THEN 'Tier4_no_meaningful_tree'
WHEN {g} = 'completed' AND {t} = 'completed' AND {n} >= 6 AND {s} >= 10 THEN 'Tier1_high_confidence'
WHEN {g} IN ('completed', 'skipped_low_information', 'failed_fallback_to_sanitized_alignment') AND {n} >= 4 AND {t} = 'completed' THEN 'Tier2_moderate_confidence' ELSE 'Tier3_low_confidence_exploratory' END"""
_LAST = "regexp_extract(path, '([^/]*)$', 1)"

ORACLES = {
    "minhash_sketch": f"WITH {_SKETCH} SELECT d.doc_id, coalesce(n_h, 0) AS n_hashes, (SELECT min(h) FROM sk WHERE sk.doc_id = d.doc_id) AS first_hash, coalesce(g, md5('')) AS digest FROM documents d LEFT JOIN dg ON dg.doc_id = d.doc_id",
    "mash_distance_pairs": f"WITH {_SKETCH} SELECT a, b, x.n AS n_a, y.n AS n_b, CAST(shared AS BIGINT) AS shared, CAST(compared AS BIGINT) AS compared, distance FROM pairs JOIN cls x ON x.rep = a JOIN cls y ON y.rep = b WHERE distance <= 0.25",
    "mash_edges_threshold": f"WITH {_SKETCH} SELECT a, b, distance FROM pairs WHERE distance <= 0.02",
    "mash_matrix_long": f"WITH {_SKETCH} SELECT a AS ref, b AS query, distance FROM pairs WHERE distance <= 0.1 UNION ALL SELECT b, a, distance FROM pairs WHERE distance <= 0.1 UNION ALL SELECT rep, rep, CAST(0 AS DOUBLE) FROM cls",
    "cluster_components": f"WITH RECURSIVE {_components()} SELECT sample_id, component FROM members",
    "cluster_sizes": f"WITH RECURSIVE {_clusters(1 << 30)} SELECT cluster_id, n_isolates FROM sizes",
    "cluster_size_classes": f"""WITH RECURSIVE {_clusters(1 << 30)} SELECT count(*) AS n_clusters, CAST(sum(n_isolates) AS BIGINT) AS n_samples, round(avg(n_isolates), 6) AS mean_size, max(n_isolates) AS max_size, min(n_isolates) AS min_size,
        count(*) FILTER (WHERE n_isolates = 1) AS size_1, count(*) FILTER (WHERE n_isolates BETWEEN 2 AND 5) AS size_2_5, count(*) FILTER (WHERE n_isolates BETWEEN 6 AND 20) AS size_6_20, count(*) FILTER (WHERE n_isolates > 20) AS size_over_20 FROM sizes""",
    "cluster_split_oversize": f"WITH RECURSIVE {_clusters(3)} SELECT cluster_id, sample_id FROM clusters",
    "cluster_route_by_size": f"WITH RECURSIVE {_clusters(1 << 30)} SELECT cluster_id, n_isolates, CASE WHEN n_isolates >= 3 THEN 'viable' WHEN n_isolates = 2 THEN 'small' ELSE 'singleton' END AS route FROM sizes",
    "cluster_merge_small": f"""WITH RECURSIVE {_clusters(1 << 30)} SELECT sample_id, clusters.cluster_id FROM clusters JOIN sizes ON sizes.cluster_id = clusters.cluster_id WHERE n_isolates >= 3
        UNION ALL SELECT sample_id, 'merged_small_clusters' FROM clusters JOIN sizes ON sizes.cluster_id = clusters.cluster_id WHERE n_isolates < 3 AND (SELECT sum(n_isolates) FROM sizes WHERE n_isolates < 3) >= 3""",
    "cluster_medoid": f"""WITH RECURSIVE {_components()}, cc AS (SELECT cls.rep, cls.n, comp.component FROM cls JOIN comp ON comp.rep = cls.rep), far AS (SELECT a, b, distance FROM pairs WHERE distance <= 0.25 UNION ALL SELECT b, a, distance FROM pairs WHERE distance <= 0.25),
        su AS (SELECT x.component AS cluster_id, x.rep, CAST(sum(y.n) AS BIGINT) AS n_members, round(sum(CASE WHEN x.rep = y.rep THEN 0.0 ELSE y.n * coalesce(far.distance, CAST(1 AS DOUBLE)) END), 6) AS s FROM cc x JOIN cc y ON x.component = y.component LEFT JOIN far ON far.a = x.rep AND far.b = y.rep GROUP BY x.component, x.rep),
        rk AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY s, rep) AS rn FROM su) SELECT cluster_id, rep AS representative, n_members, CAST(s AS DOUBLE) AS distance_sum FROM rk WHERE rn = 1""",
    "core_snp_positions": f"WITH {_SNPS} SELECT cluster_id, CAST(position AS INTEGER) AS position, ref_base, alt_bases FROM pos",
    "core_snp_sequences": f"WITH {_SNPS} SELECT cluster_id, seq_id, n_snps, seq FROM snp",
    "keep_atcg_columns": f"WITH {_SEQ} SELECT cluster_id, CAST(position AS INTEGER) AS position, count(DISTINCT base) AS n_bases FROM cells GROUP BY cluster_id, position HAVING count(*) FILTER (WHERE base = 'N') = 0",
    "snp_distance_pairs": f"WITH {_SEQ}, {_distances('seqs', 'cells')}",
    "snp_distance_masked": f"WITH RECURSIVE {_MASK}, {_distances('mseqs', 'mcells')}",
    "snp_vcf_rows": f"WITH {_SNPS} SELECT c.cluster_id, CAST(c.position AS INTEGER) AS pos, ref_base AS ref, alt_bases AS alt, count(*) FILTER (WHERE base = ref_base) AS n_ref, count(*) FILTER (WHERE base <> 'N' AND base <> ref_base) AS n_alt, count(*) FILTER (WHERE base = 'N') AS n_missing FROM cells c JOIN pos p ON c.cluster_id = p.cluster_id AND c.position = p.position GROUP BY c.cluster_id, c.position, ref_base, alt_bases",
    "integrate_snp_offsets": f"""WITH {_SNPS}, mx AS (SELECT cluster_id, max(position) AS m FROM pos GROUP BY cluster_id), o AS (SELECT x.cluster_id, coalesce(sum(y.m), 0) AS off FROM mx x LEFT JOIN mx y ON y.cluster_id < x.cluster_id GROUP BY x.cluster_id)
        SELECT pos.cluster_id, CAST(position + off AS BIGINT) AS global_position, CAST(position AS BIGINT) AS original_position, ref_base, alt_bases FROM pos JOIN o ON o.cluster_id = pos.cluster_id""",
    "recomb_tip_closure": f"WITH RECURSIVE {_TREE} SELECT node, tip FROM closure",
    "mask_positions": f"WITH RECURSIVE {_MASK} SELECT seq_id, seq FROM mseqs",
    "qc_pass_fail": "SELECT doc_id AS sample, 'Minimum file size' AS qc_step, CASE WHEN n_chars >= 1024 THEN 'PASS' ELSE 'FAIL' END AS outcome FROM documents",
    "qc_gate": "SELECT doc_id AS sample, n_chars AS size FROM documents WHERE n_chars >= 1024 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality IS NULL OR quality <> 1)",
    "reference_largest": f"WITH {_GENOMES} SELECT name, size FROM g ORDER BY size DESC, name LIMIT 1",
    "dedup_canonical": f"""WITH {_FILES}, f AS (SELECT path, {_LAST} AS nm FROM files), k AS (SELECT path, nm, replace(regexp_replace(nm, '^(.+)\\.[^.]*$', '\\1'), '.', '_') AS key, length(nm) - length(replace(nm, '.', '')) AS dots FROM f)
        SELECT key, path, n_same FROM (SELECT key, path, row_number() OVER (PARTITION BY key ORDER BY dots, nm) AS rn, count(*) OVER (PARTITION BY key) AS n_same FROM k) WHERE rn = 1""",
    "gubbins_status_case": f"WITH {_LOGS} SELECT k, gubbins_status, iqtree_status FROM st",
    "confidence_tier": f"WITH {_LOGS} SELECT k, {_TIER.format(n='n', t='iqtree_status', g='gubbins_status', s='sites')} AS tier FROM st",
    "parse_names": f"""WITH {_FILES}, f AS (SELECT path, {_LAST} AS nm FROM files), n AS (SELECT path, nm, regexp_replace(nm, '^(.+)\\.[^.]*$', '\\1') AS normal FROM f)
        SELECT path, normal, regexp_extract(nm, '^([^.]*)', 1) AS sample_id, replace(normal, '.', '_') AS canonical_key, regexp_replace(normal, '[._][0-9]{{1,3}}$', '') AS accession_key, nm LIKE '%.fasta' AS is_fasta,
        replace(regexp_replace(nm, '\\.fasta$', ''), '.', '_') AS bare, split_part(nm, '.', 2) AS sheet, regexp_extract(nm, '([^.]*)$', 1) AS last_part, regexp_replace(nm, '\\.fasta$', '') AS label FROM n""",
    "parse_year": f"""WITH {_GENOMES} SELECT sample, date, {_YEAR.format('date')} AS year, {_KNOWN} AS known, CAST(CASE sample % 5 WHEN 0 THEN 1024 WHEN 1 THEN 1048576 WHEN 2 THEN 1073741824 ELSE 1 END * (sample % 90) AS BIGINT) AS bytes, country || '_x' AS clean FROM g""",
    "split_kmer_columns": f"""WITH {_SEQ}, cut AS (SELECT seq_id, substr(seq, i, 2) AS l, substr(seq, i + 2, 1) AS m, substr(seq, i + 3, 2) AS r FROM (SELECT seq_id, seq, unnest(range(1, length(seq) - 3)) AS i FROM seqs)),
        one AS (SELECT seq_id, l, r, CASE WHEN min(m) = max(m) THEN min(m) ELSE 'N' END AS m FROM cut GROUP BY seq_id, l, r), ms AS (SELECT l, r, m, count(*) AS n FROM one GROUP BY l, r, m)
        SELECT l AS "left", r AS "right", CAST(sum(n) AS BIGINT) AS n_samples, string_agg(m, '' ORDER BY m) AS bases FROM ms GROUP BY l, r HAVING count(*) FILTER (WHERE m <> 'N') > 1""",
    "invariant_counts": f"WITH {_SEQ}, kc AS (SELECT cluster_id, position, count(DISTINCT base) AS n_bases FROM cells GROUP BY cluster_id, position HAVING count(*) FILTER (WHERE base = 'N') = 0), k AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY position) AS rn FROM kc) SELECT cluster_id, count(*) FILTER (WHERE n_bases = 1) AS n_invariant, count(*) FILTER (WHERE n_bases > 1) AS n_variable FROM k WHERE rn <= 1000 GROUP BY cluster_id",
    "snp_pair_table": f"WITH {_SEQ} SELECT p.cluster_id, p.seq_id AS sample_a, q.seq_id AS sample_b, CAST(sum(CASE WHEN p.base <> q.base AND p.base <> 'N' AND q.base <> 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n_snps, p.seq_id = q.seq_id AS is_self FROM cells p JOIN cells q ON p.cluster_id = q.cluster_id AND p.position = q.position GROUP BY p.cluster_id, p.seq_id, q.seq_id",
    "num_results": f"WITH {_SEQ}, n AS (SELECT cluster_id, count(*) AS n FROM seqs GROUP BY cluster_id) SELECT CAST(sum(n * n) AS BIGINT) AS num_results FROM n",
    "integrate_snp_concat": f"WITH {_SAMPLES.format(_SNPS)} SELECT sample_id, n_clusters, total_snps, seq FROM tot",
    "sample_cluster_mapping": f"WITH {_SAMPLES.format(_SNPS)} SELECT * FROM mp",
    "integration_summary": f"WITH {_SAMPLES.format(_SNPS)} SELECT count(*) AS n_samples, max(total_snps) AS longest, min(total_snps) = max(total_snps) AS is_rectangular, printf('%.2f', avg(total_snps)) AS average, (SELECT count(DISTINCT cluster_id) FROM pos) AS n_clusters, (SELECT count(*) FROM pos) AS total_positions FROM tot",
    "integrated_report": f"WITH {_SAMPLES.format(_SNPS)} SELECT count(*) AS n_samples, count(DISTINCT cluster_id) AS n_clusters FROM mp",
    "alignment_digest": f"WITH {_SEQ} SELECT cluster_id, md5(string_agg(CAST(seq_id AS VARCHAR) || ':' || md5(seq), ',' ORDER BY seq_id)) AS md5 FROM seqs GROUP BY cluster_id",
    "masked_by_tool": f"""WITH RECURSIVE {_MASK}, tl AS (SELECT 'Gubbins' AS tool, 'n' AS letter UNION ALL SELECT 'ClonalFrameML', 'r'),
        th AS (SELECT DISTINCT tool, CAST(substr(tip, 2) AS BIGINT) - 1 AS seq_id, start + k AS position FROM (SELECT tool, closure.tip, iv.start, unnest(range(1, iv.stop - iv.start + 1)) AS k FROM iv JOIN closure ON closure.node = iv.node JOIN tl ON tl.letter = substr(iv.node, 1, 1)))
        SELECT tl.tool, c.seq_id, string_agg(CASE WHEN th.position IS NULL THEN c.base ELSE 'N' END, '' ORDER BY c.position) AS seq FROM tl CROSS JOIN cells c LEFT JOIN th ON th.tool = tl.tool AND th.seq_id = c.seq_id AND th.position = c.position GROUP BY tl.tool, c.seq_id""",
    "unmasked": f"WITH {_SEQ} SELECT 'none' AS tool, seq_id, seq FROM seqs",
    "plan_routes": f"WITH {_SEQ}, n AS (SELECT cluster_id, count(*) AS n_isolates FROM seqs GROUP BY cluster_id), ok AS (SELECT cluster_id, position FROM cells GROUP BY cluster_id, position HAVING count(*) FILTER (WHERE base = 'N') = 0 AND count(DISTINCT base) > 1) SELECT n.cluster_id, n_isolates, CASE WHEN n_isolates < 3 THEN 'skipped_low_information' ELSE 'analysed' END AS route, count(ok.position) FILTER (WHERE n_isolates >= 3) AS n_snps FROM n LEFT JOIN ok ON ok.cluster_id = n.cluster_id GROUP BY n.cluster_id, n_isolates",
    "without_reference": f"WITH {_GENOMES} SELECT sample, name FROM g WHERE name <> (SELECT name FROM g ORDER BY size DESC, name LIMIT 1)",
    "metadata_two_key_join": f"WITH {_RECORDS} SELECT sample, path, country, subregion, date, matched FROM records",
    "unmatched_genomes": f"WITH {_RECORDS}, u AS (SELECT name || '.fasta' AS filename, regexp_replace(name, '[._][0-9]{{1,3}}$', '') AS accession_key, path FROM records WHERE NOT matched) SELECT *, 'dropped' AS disposition FROM u UNION ALL SELECT *, 'kept_as_Unknown' FROM u",
    "matched_genomes": f"WITH {_RECORDS} SELECT sample, country, matched FROM records WHERE matched",
    "derep_within_group": f"WITH RECURSIVE {_GROUPS} SELECT sample, country, group_id FROM ranked",
    "representative_rank": f"WITH RECURSIVE {_GROUPS} SELECT sample, group_id, rank, rank = 1 AS is_representative FROM ranked",
    "derep_sweep": f"""WITH RECURSIVE {_LINKS}, t AS (SELECT unnest([CAST(0.005 AS DOUBLE), 0.02, 0.1]) AS threshold),
        reach AS (SELECT threshold, sample AS x, sample AS y FROM records, t UNION SELECT r.threshold, r.x, links.b FROM reach r JOIN links ON links.a = r.y AND links.distance <= r.threshold),
        c AS (SELECT threshold, x, min(y) AS c FROM reach GROUP BY threshold, x) SELECT threshold AS derep_threshold, count(*) AS n_contextual, count(DISTINCT c) AS n_groups_kept, printf('%.4f', CAST(count(*) - count(DISTINCT c) AS DOUBLE) / count(*)) AS fraction_removed FROM c GROUP BY threshold""",
    "quota_allocate": f"WITH RECURSIVE {_QUOTAS} SELECT country, n AS available, keep FROM quota",
    "round_robin_select": f"WITH RECURSIVE {_SELECT} SELECT sample, country, subregion, turn, kept FROM sel",
    "selection_report": f"""WITH RECURSIVE {_SELECT} SELECT CAST(r.sample AS VARCHAR) AS sample, 'contextual' AS source, r.country, r.subregion, r.date, CAST(r.group_id AS VARCHAR) AS group_id, CASE WHEN rank = 1 THEN 'representative' ELSE 'redundant' END AS role, CASE WHEN kept THEN 'yes' ELSE 'no' END AS kept,
        CASE WHEN rank > 1 THEN 'redundant_to:' || CAST(reps_.sample AS VARCHAR) WHEN kept THEN 'kept' ELSE 'dropped_by_country_cap' END AS reason FROM ranked r LEFT JOIN sel ON sel.sample = r.sample JOIN (SELECT sample, group_id FROM reps) reps_ ON reps_.group_id = r.group_id
        UNION ALL SELECT sample, 'study', '', '', '', '', 'study', 'yes', 'study_isolate' FROM stu""",
    "samplesheet": f"WITH RECURSIVE {_SELECT} SELECT 0 AS part, sample, path AS file FROM stu UNION ALL SELECT 1, CAST(sample AS VARCHAR), path FROM sel WHERE kept",
    "country_summary": f"WITH RECURSIVE {_SELECT} SELECT r.country, count(*) AS n_input, count(*) FILTER (WHERE rank = 1) AS n_after_derep, count(*) FILTER (WHERE kept) AS n_final FROM ranked r LEFT JOIN sel ON sel.sample = r.sample GROUP BY r.country",
    "phylogeny_summary": f"""WITH {_LOGS}, {_SEQ}, sz AS (SELECT cluster_id, count(*) AS n FROM seqs GROUP BY cluster_id), ids AS (SELECT cluster_id FROM sz UNION SELECT k FROM lg WHERE status <> 'P' OR priority <> '5-LOW'),
        x AS (SELECT ids.cluster_id, sz.n AS size, d.k IS NOT NULL AS has_log, d.n AS seq_count, d.p, d.gubbins_status AS gs, d.code, t.tb, t.lb, f.n AS n_records, f.sites, o.k % 7 AS blocks FROM ids LEFT JOIN sz ON sz.cluster_id = ids.cluster_id LEFT JOIN st d ON d.k = ids.cluster_id AND d.status <> 'P'
              LEFT JOIN st t ON t.k = ids.cluster_id AND t.priority <> '5-LOW' LEFT JOIN st f ON f.k = ids.cluster_id AND f.status = 'F' LEFT JOIN st o ON o.k = ids.cluster_id AND o.status = 'O'),
        y AS (SELECT cluster_id, coalesce(size, n_records, 0) AS n_isolates, CASE WHEN seq_count > 0 THEN CAST(p AS VARCHAR) ELSE '' END AS alignment_length, coalesce(CAST(seq_count AS VARCHAR), '') AS seq_count_in_alignment, CASE WHEN has_log AND p % 2 = 0 THEN 'true' ELSE 'false' END AS starting_tree_present,
              CASE WHEN has_log THEN gs ELSE 'no_diagnostics' END AS gubbins_status, coalesce(code, '') AS gubbins_exit_code, coalesce(blocks, 0) AS n_recombination_blocks, coalesce(sites, 0) AS n_filtered_polymorphic_sites,
              CASE WHEN coalesce(tb, 0) = 0 THEN 'failed_no_tree' WHEN coalesce(seq_count, 3) < 3 THEN 'skipped_low_information' WHEN coalesce(lb, 0) = 0 THEN 'minimal_tree_no_log' ELSE 'completed' END AS iqtree_status,
              coalesce(tb, 0) AS treefile_size_bytes, coalesce(lb, 0) AS iqtree_log_size_bytes, CASE WHEN seq_count = 0 THEN 'input_alignment_empty' ELSE '' END AS notes FROM x)
        SELECT *, {_TIER.format(n='n_isolates', t='iqtree_status', g='gubbins_status', s='n_filtered_polymorphic_sites')} AS confidence_tier FROM y""",
    "analysis_statistics": f"""WITH {_SAMPLES.format(_SNPS)}, {_GRAFTS}, sz AS (SELECT cluster_id, count(*) AS n FROM seqs GROUP BY cluster_id), v AS (SELECT [
        (SELECT CAST(sum(n) AS VARCHAR) FROM sz), (SELECT CAST(count(*) AS VARCHAR) FROM sz), (SELECT printf('%.2f', avg(n)) FROM sz), (SELECT CAST(max(n) AS VARCHAR) FROM sz), (SELECT CAST(min(n) AS VARCHAR) FROM sz), (SELECT CAST(count(*) FILTER (WHERE n = 1) AS VARCHAR) FROM sz),
        (SELECT CAST(count(*) FILTER (WHERE n BETWEEN 2 AND 5) AS VARCHAR) FROM sz), (SELECT CAST(count(*) FILTER (WHERE n BETWEEN 6 AND 20) AS VARCHAR) FROM sz), (SELECT CAST(count(*) FILTER (WHERE n > 20) AS VARCHAR) FROM sz), (SELECT CAST(count(*) AS VARCHAR) FROM gr),
        (SELECT CAST(sum(total_snps) AS VARCHAR) FROM tot), (SELECT printf('%.2f', avg(total_snps)) FROM tot), (SELECT CAST(max(total_snps) AS VARCHAR) FROM tot), (SELECT CAST(min(total_snps) AS VARCHAR) FROM tot), (SELECT printf('%.2f', avg(n_tips)) FROM gr), (SELECT CAST(sum(n_tips) AS VARCHAR) FROM gr)] AS vs,
        ['Total Samples', 'Total Clusters', 'Average Cluster Size', 'Largest Cluster', 'Smallest Cluster', 'Singleton Clusters', 'Small Clusters (2-5 samples)', 'Medium Clusters (6-20 samples)', 'Large Clusters (>20 samples)', 'Total Phylogenetic Trees', 'Total SNP Positions',
         'Average SNPs per Sample', 'Maximum SNPs per Sample', 'Minimum SNPs per Sample', 'Average Tree Size (leaves)', 'Total Tree Leaves'] AS ms) SELECT CAST(i - 1 AS INTEGER) AS place, ms[i] AS metric, vs[i] AS value FROM (SELECT vs, ms, unnest(range(1, 17)) AS i FROM v)""",
    "error_rollup": "SELECT CAST(user_id AS VARCHAR) AS sample, event_type AS process, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS error, '/work/' || CAST(min(event_id) AS VARCHAR) AS folder, 'run' AS run FROM events WHERE user_id % 50 <> 1 GROUP BY user_id, event_type, floor(value)",
    "failed_tasks": "SELECT '/work/' || CAST(s_suppkey AS VARCHAR) AS folder, s_name AS sample, 'STEP_' || CAST(s_nationkey AS VARCHAR) AS process, 'stopped at ' || CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) AS error, s_nationkey > 12 AS retried FROM supplier",
    "cluster_assembly_lists": f"WITH RECURSIVE {_FILES_OF} SELECT cluster_id, count(*) AS n, string_agg(path, ',' ORDER BY sample_id) AS files FROM cf GROUP BY cluster_id HAVING count(*) >= 3",
    "cluster_assembly_rows": f"WITH RECURSIVE {_FILES_OF} SELECT cluster_id, sample_id, path AS file FROM cf WHERE cluster_id IN (SELECT cluster_id FROM sizes WHERE n_isolates >= 3)",
    "representative_files": f"WITH RECURSIVE {_FILES_OF} SELECT * FROM rf",
    "alignment_references": f"WITH RECURSIVE {_FILES_OF} SELECT sizes.cluster_id, n_isolates, representative, file AS aligned_to FROM sizes JOIN rf ON rf.cluster_id = sizes.cluster_id WHERE n_isolates >= 3",
    "global_references": f"WITH RECURSIVE {_FILES_OF} SELECT sizes.cluster_id, n_isolates, representative, (SELECT path FROM g ORDER BY size DESC, path LIMIT 1) AS aligned_to FROM sizes JOIN rf ON rf.cluster_id = sizes.cluster_id WHERE n_isolates >= 3",
    "alignments_with_trees": f"WITH {_SEQ}, {_LOGS} SELECT CAST(cluster_id AS VARCHAR) AS cluster_id, count(*) AS n_sequences, CAST(sum(length(seq)) AS BIGINT) AS alignment_length, CAST(max(length(seq)) AS BIGINT) AS n_columns, min(tb) AS tree_bytes FROM seqs JOIN lg ON lg.k = cluster_id AND priority <> '5-LOW' GROUP BY cluster_id",
    "cluster_summary_lines": f"WITH RECURSIVE {_clusters(1 << 30)} SELECT printf('%d clusters of %d samples, largest %d', count(*), CAST(sum(n_isolates) AS BIGINT), max(n_isolates)) AS line FROM sizes UNION ALL SELECT cluster_id || ': ' || CAST(n_isolates AS VARCHAR) FROM sizes",
    "number_formats": """SELECT p_partkey, printf('%.2f', p_size / 8.0) AS two, format('{:,}', CAST(floor(p_retailprice * 1000) AS BIGINT)) AS grouped, regexp_extract(p_name || '.fa.' || p_brand, '\\.([^.]*)$', 1) AS ending, p_name AS label, least(p_size, 16) AS cpus, CAST(round(p_size * 7 / 60.0) AS BIGINT) AS hours,
        p_brand AS base, p_brand AS bare FROM part""",
    "split_kmer_strands": f"""WITH {_SEQ}, c0 AS (SELECT seq_id, substr(seq, i, 2) AS l, substr(seq, i + 2, 1) AS m, substr(seq, i + 3, 2) AS r FROM (SELECT seq_id, seq, unnest(range(1, length(seq) - 3)) AS i FROM seqs)),
        c1 AS (SELECT *, reverse(translate(r, 'ACGT', 'TGCA')) AS l2, translate(m, 'ACGT', 'TGCA') AS m2, reverse(translate(l, 'ACGT', 'TGCA')) AS r2 FROM c0),
        cut AS (SELECT seq_id, CASE WHEN l || r <= l2 || r2 THEN l ELSE l2 END AS l, CASE WHEN l || r = l2 || r2 THEN least(m, m2) WHEN l || r < l2 || r2 THEN m ELSE m2 END AS m, CASE WHEN l || r <= l2 || r2 THEN r ELSE r2 END AS r FROM c1),
        one AS (SELECT seq_id, l, r, CASE WHEN min(m) = max(m) THEN min(m) ELSE 'N' END AS m FROM cut GROUP BY seq_id, l, r), ms AS (SELECT l, r, m, count(*) AS n FROM one GROUP BY l, r, m)
        SELECT l AS "left", r AS "right", CAST(sum(n) AS BIGINT) AS n_samples, string_agg(m, '' ORDER BY m) AS bases FROM ms GROUP BY l, r HAVING count(*) FILTER (WHERE m <> 'N') > 1""",
    "graft_trees": f"WITH {_GRAFTS} SELECT * FROM gr",
    "graft_report": """SELECT CAST(n_regionkey AS VARCHAR) AS tree_id, 'N' || CAST(n_nationkey AS VARCHAR) AS cluster_id, 'N' || CAST(n_nationkey AS VARCHAR) AS representative, CASE WHEN n_nationkey IN (SELECT c_nationkey FROM customer) THEN 'grafted' ELSE 'skipped_empty' END AS status FROM nation
        UNION ALL SELECT CAST(n_regionkey AS VARCHAR), 'S' || CAST(n_nationkey AS VARCHAR), 'S' || CAST(n_nationkey AS VARCHAR), CASE WHEN n_nationkey IN (SELECT s_nationkey FROM supplier) THEN 'failed_no_backbone_tip' ELSE 'skipped_empty' END FROM nation""",
}
