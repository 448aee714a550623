"""Balancing over-sampled groups: de-duplication, dereplication, quotas and round-robin selection."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import accession_key, canonical_key, fixed, known_subregion, normalize_name, parse_year, sanitize_sample, tie_break, unknown_if_empty
from .clusters import single_linkage
from .components import connected_components


def dedup_canonical(files: DataFrame, path: str = "path") -> DataFrame:
    """One file for each canonical key: fewest dots, then least name; n_same counts all of the key."""
    name = F.element_at(F.split(path, "/"), -1)
    best = F.min_by(path, F.struct(F.size(F.split(name, r"\.")), name))
    return files.groupBy(canonical_key(F.col(path)).alias("key")).agg(best.alias("path"), F.count("*").alias("n_same"))


#: Id columns of metadata, each under both of its keys.
ID_COLUMNS = ("accession", "fasta_name", "sample")


def join_metadata(genomes: DataFrame, metadata: DataFrame, order: str) -> DataFrame:
    """genomes (sample, path) with country, subregion, date, matched.

    metadata: id columns of ID_COLUMNS that it has, country, subregion, date. Every id of a row stands under its accession
    key and its canonical key; of several rows for a key the first by `order` counts. A genome is looked up by its
    accession key, then by its canonical key.
    """
    ids = [F.trim(F.col(c).cast("string")) for c in ID_COLUMNS if c in metadata.columns]
    keys = F.flatten(F.transform(F.filter(F.array(*ids), lambda v: v != ""), lambda v: F.array(accession_key(v), canonical_key(v))))
    fields = F.struct(unknown_if_empty(F.col("country")).alias("country"), *(F.coalesce(F.trim(c), F.lit("")).alias(c) for c in ("subregion", "date")))
    index = metadata.select(F.col(order).alias("__line"), fields.alias("__fields"), F.explode(F.array_distinct(keys)).alias("__key"))
    index = index.groupBy("__key").agg(F.min_by("__fields", "__line").alias("__row"))
    by = lambda name: index.select(F.col("__key").alias(f"__{name}_key"), F.col("__row").alias(f"__{name}"))
    rows = genomes.withColumn("__a_key", accession_key(F.col("path"))).withColumn("__c_key", canonical_key(F.col("path")))
    rows = rows.join(by("a"), "__a_key", "left").join(by("c"), "__c_key", "left")
    found = F.coalesce("__a", "__c")
    return rows.select(
        "sample", "path", F.coalesce(found["country"], F.lit("Unknown")).alias("country"), F.coalesce(found["subregion"], F.lit("")).alias("subregion"),
        F.coalesce(found["date"], F.lit("")).alias("date"), found.isNotNull().alias("matched"),
    )


def unmatched(records: DataFrame, drop: bool) -> DataFrame:
    """(filename, accession_key, path, disposition) of the genomes without metadata."""
    name = F.element_at(F.split("path", "/"), -1)
    rows = records.filter(~F.col("matched"))
    return rows.select(name.alias("filename"), accession_key(F.col("path")).alias("accession_key"), "path", F.lit("dropped" if drop else "kept_as_Unknown").alias("disposition"))


def matched_only(records: DataFrame, drop: bool) -> DataFrame:
    """Genomes without metadata go, or stay under the country Unknown."""
    return records.filter("matched") if drop else records


def dereplicate(records: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """(sample, group_id): samples linked by edges within a country; a group is named by its least sample."""
    country = records.select(F.col("sample"), "country")
    near = edges.filter(F.col("distance") <= threshold)
    near = near.join(country.withColumnsRenamed({"sample": "a", "country": "country_a"}), "a").join(country.withColumnsRenamed({"sample": "b", "country": "country_b"}), "b")
    return single_linkage(records, near.filter("country_a = country_b"), "sample").withColumnRenamed("component", "group_id")


def rank_in_group(grouped: DataFrame, seed: int = 42) -> DataFrame:
    """Adds rank: known subregion first, then names of reference sequences (GCF), earlier years, and a random order."""
    order = [F.when(known_subregion(F.col("subregion")), 0).otherwise(1), F.when(F.startswith(F.upper("name"), F.lit("GCF")), 0).otherwise(1), parse_year(F.col("date")), tie_break(F.col("sample"), seed)]
    return grouped.withColumn("rank", F.row_number().over(Window.partitionBy("group_id").orderBy(*order, "sample")))


def allocate(available: dict[str, int], budget: int, least: int, most: int) -> dict[str, int]:
    """How many each country keeps: a floor, then shares of what is left by free capacity, up to a cap.

    Countries are taken in order of name. Floors beyond the budget are lowered in turns, largest first.
    """
    names = sorted(available)
    have = np.array([available[c] for c in names], np.int64)
    if have.sum() <= budget:
        return dict(zip(names, have.tolist()))
    keep, cap = np.minimum(have, least), np.minimum(have, most)
    over = int(keep.sum() - budget)
    if over > 0:
        turns = np.argsort(-keep, kind="stable")
        while over > 0 and keep.any():
            who = turns[keep[turns] > 0][:over]
            keep[who] -= 1
            over -= len(who)
        return dict(zip(names, keep.tolist()))
    left = -over
    while left > 0 and (room := cap - keep).any():
        share = left * room / room.sum()
        give = np.minimum(np.floor(share).astype(np.int64), room)
        if not give.any():
            who = np.argsort(-np.where(room > 0, share - np.floor(share), -1), kind="stable")[: min(left, int((room > 0).sum()))]
            keep[who] += 1
            break
        keep += give
        left -= int(give.sum())
    return dict(zip(names, keep.tolist()))


def quotas(representatives: DataFrame, budget: int, least: int, most: int) -> DataFrame:
    """(country, available, keep). Countries are few (a row for each reaches the driver, never samples)."""
    rows = representatives.groupBy("country").agg(F.count("*").alias("available")).collect()
    available = {r["country"]: r["available"] for r in rows}
    keep = allocate(available, max(0, budget), least, most)
    return representatives.sparkSession.createDataFrame([(c, available[c], keep[c]) for c in sorted(keep)], "country string, available bigint, keep bigint")


def bucket(subregion: Column) -> Column:
    """The subregion without case and blanks; one bucket for all that say nothing, after any name."""
    return F.when(known_subregion(subregion), F.lower(F.trim(subregion))).otherwise(F.lit("~unknown"))


def round_robin(representatives: DataFrame, keep: DataFrame, seed: int = 42) -> DataFrame:
    """Adds turn and kept: within a country subregions take turns, larger ones first, earlier years first inside one.

    keep: country, keep. A turn needs no sort of the country: all subregions with at least `pos` rows are a prefix of the
    order by size, so the turn is what the subregions gave in earlier rounds, plus the subregion's place in that order.
    Both come from a country's table of subregion sizes.
    """
    inside = Window.partitionBy("country", "__bucket").orderBy(parse_year(F.col("date")), tie_break(F.col("sample"), seed), "sample")
    named = representatives.withColumn("__bucket", bucket(F.col("subregion")))
    rows = named.withColumn("pos", F.row_number().over(inside))
    sizes = named.groupBy("country", "__bucket").agg(F.count("*").alias("n"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), F.col("__bucket").alias("b"))))
    tables = sizes.groupBy("country").agg(order.alias("__buckets")).join(F.broadcast(keep.select("country", "keep")), "country")
    rows = rows.join(tables, "country")
    earlier = F.aggregate("__buckets", F.lit(0).cast("bigint"), lambda a, b: a + F.least(-b["less"], F.col("pos") - 1))
    place = F.array_position(F.transform("__buckets", lambda b: b["b"]), F.col("__bucket"))
    return rows.withColumn("turn", earlier + place).withColumn("kept", F.col("turn") <= F.col("keep")).drop("__buckets", "__bucket")


def budget_left(target: int, n_study: int) -> int:
    """What study isolates, which are always kept, leave of the target."""
    return max(0, target - n_study)


def study_rows(files: DataFrame) -> DataFrame:
    """(sample, path) of study isolates: they pass by dereplication and quotas."""
    return files.select(sanitize_sample(normalize_name(F.col("path"))).alias("sample"), "path")


def selection_report(grouped: DataFrame, chosen: DataFrame, study: DataFrame) -> DataFrame:
    """One row for each genome: sample, source, country, subregion, date, group_id, role, kept, reason.

    grouped: records with group_id and is_representative; chosen: sample, kept of representatives; study: sample, path.
    """
    text = lambda c: F.col(c).cast("string").alias(c)
    reps = grouped.filter("is_representative").select("group_id", F.col("sample").cast("string").alias("__rep"))
    rows = grouped.join(chosen.select("sample", "kept"), "sample", "left").join(reps, "group_id")
    is_rep, kept = F.col("is_representative"), F.coalesce("kept", F.lit(False))
    reason = F.when(~is_rep, F.concat(F.lit("redundant_to:"), "__rep")).when(kept, "kept").otherwise("dropped_by_country_cap")
    rows = rows.select(
        text("sample"), F.lit("contextual").alias("source"), "country", "subregion", "date", text("group_id"), F.when(is_rep, "representative").otherwise("redundant").alias("role"),
        F.when(kept, "yes").otherwise("no").alias("kept"), reason.alias("reason"),
    )
    empty = F.lit("")
    own = study.select(
        text("sample"), F.lit("study").alias("source"), empty.alias("country"), empty.alias("subregion"), empty.alias("date"), empty.alias("group_id"), F.lit("study").alias("role"),
        F.lit("yes").alias("kept"), F.lit("study_isolate").alias("reason"),
    )
    return own.unionByName(rows)


def samplesheet(study: DataFrame, selected: DataFrame) -> DataFrame:
    """(part, sample, file): study rows (part 0), then what was selected (part 1); written in this order."""
    row = lambda df, part: df.select(F.lit(part).alias("part"), F.col("sample").cast("string").alias("sample"), F.col("path").alias("file"))
    return row(study, 0).unionByName(row(selected, 1))


def sweep(records: DataFrame, edges: DataFrame, thresholds: list[float]) -> DataFrame:
    """(derep_threshold, n_contextual, n_groups_kept, fraction_removed) of dereplication within countries.

    records: sample, country; edges: a, b, distance of samples. All thresholds go through one run of components, over
    nodes that carry the threshold's number; a threshold's groups are its samples less what components take away.
    """
    country = records.select("sample", "country")
    near = edges.filter(F.col("distance") <= max(thresholds)).join(country.select(F.col("sample").alias("a"), F.col("country").alias("x")), "a")
    near = near.join(country.select(F.col("sample").alias("b"), F.col("country").alias("y")), "b").filter("x = y and a <> b")
    number = F.explode(F.filter(F.array(*(F.when(F.col("distance") <= t, i) for i, t in enumerate(thresholds))), lambda i: i.isNotNull())).alias("i")
    node = lambda c: F.concat_ws(":", F.lpad(F.col("i").cast("string"), 4, "0"), F.col(c).cast("string")).alias(c)
    found = connected_components(near.select("a", "b", number).select(node("a"), node("b")))
    lost = found.groupBy(F.substring("node", 1, 4).cast("int").alias("i")).agg((F.count("*") - F.countDistinct("component")).alias("lost"))
    table = records.sparkSession.createDataFrame(list(enumerate(thresholds)), "i int, derep_threshold double")
    n = records.agg(F.count("*").alias("n_contextual"))
    rows = table.join(F.broadcast(lost), "i", "left").crossJoin(F.broadcast(n)).withColumn("lost", F.coalesce("lost", F.lit(0)))
    share = F.when(F.col("n_contextual") > 0, fixed(F.col("lost") / F.col("n_contextual"), 4)).otherwise(F.lit("0"))
    return rows.select("derep_threshold", "n_contextual", (F.col("n_contextual") - F.col("lost")).alias("n_groups_kept"), share.alias("fraction_removed"))


def country_summary(records: DataFrame) -> DataFrame:
    """(country, n_input, n_after_derep, n_final) from rows with flags is_representative and kept; sinks order by n_input."""
    return records.groupBy("country").agg(
        F.count("*").alias("n_input"), F.count_if("is_representative").alias("n_after_derep"), F.count_if(F.coalesce("kept", F.lit(False))).alias("n_final")
    )
