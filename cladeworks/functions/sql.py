"""The scalar functions of this library under SQL names, and readers of Newick and FASTA text as table functions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..operators.trees import EDGES, edges_of, parse_newick
from ..plans.shared import ship

# Bodies say what functions.names says as columns, in SQL, so that they stay inside the optimizer.
_BASE = "element_at(split(p, '/'), -1)"
FUNCTIONS = {
    "normalize_name(p STRING) RETURNS STRING": rf"regexp_replace({_BASE}, r'^(.+)\.[^.]*$', '$1')",
    "sample_id(p STRING) RETURNS STRING": f"substring_index({_BASE}, '.', 1)",
    "sanitize_sample(p STRING) RETURNS STRING": "replace(trim(p), ' ', '_')",
    "canonical_key(p STRING) RETURNS STRING": rf"translate(regexp_replace({_BASE}, r'^(.+)\.[^.]*$', '$1'), '.', '_')",
    "accession_key(p STRING) RETURNS STRING": rf"regexp_replace(regexp_replace({_BASE}, r'^(.+)\.[^.]*$', '$1'), r'[._][0-9]{{1,3}}$', '')",
    "sequence_year(p STRING) RETURNS INT": "coalesce(try_cast(nullif(regexp_extract(coalesce(p, ''), '^[^0-9]*([0-9]{4})', 1), '') AS INT), 1000000000)",
    "known_subregion(p STRING) RETURNS BOOLEAN": "coalesce(lower(trim(p)), '') NOT IN ('', 'unknown', 'na', 'n/a', 'none')",
    "mash_distance(j DOUBLE, k INT) RETURNS DOUBLE": "CASE WHEN j <= 0 THEN 1 ELSE abs(-ln(2 * j / (1 + j)) / k) END",
}


@udtf(returnType=EDGES)
class NewickEdges:
    """The edges of a Newick text."""

    def eval(self, tree_id: str, newick: str):
        rows = edges_of(tree_id, parse_newick(newick)).astype(object)
        yield from rows.where(rows.notna(), None).itertuples(index=False, name=None)


@udtf(returnType="contig_ord int, header string, seq string")
class FastaRecords:
    """The records of a FASTA text."""

    def eval(self, text: str):
        for i, record in enumerate(r for r in ("\n" + (text or "").replace("\r", "")).split("\n>")[1:]):
            header, _, seq = record.partition("\n")
            yield i + 1, header.strip(), "".join(seq.split())


def register(spark: SparkSession) -> None:
    """Make the functions known to spark.sql of this session."""
    ship(spark)
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    spark.udtf.register("newick_edges", NewickEdges)
    spark.udtf.register("fasta_records", FastaRecords)
