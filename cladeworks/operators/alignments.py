"""Column operators over multiple alignments, and SNP distances.

An alignment is (cluster_id, seq_id, seq). Columns are looked at WORD at a time as bit masks of each base, aggregated
before any shuffle, so no operator has a row for every base of every sequence.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import fixed
from ..plans.shared import kept, ship
from .skew import split_join

BASES = ("A", "C", "G", "T")
#: Columns of one bit mask.
WORD = 63
#: Sequences in a block of a cluster whose pairs are compared, unless that makes more than PARTS blocks; text of a block at
#: most; words that are compared at once.
BLOCK, PARTS, BYTES, PAIRS = 200, 8, 1 << 28, 1 << 17
_CODES = np.array([[chr(c) in known for c in range(256)] for known in ("CT", "GT", "ACGT")])


def long_form(alignment: DataFrame) -> DataFrame:
    """(cluster_id, seq_id, position, base) from (cluster_id, seq_id, seq); positions begin at 1."""
    return alignment.select("cluster_id", "seq_id", F.posexplode(F.split("seq", "")).alias("p", "base")).select("cluster_id", "seq_id", (F.col("p") + 1).alias("position"), "base")


def _words(seq: str | Column) -> Column:
    """The upper-cased sequence in parts of WORD columns, cut in one pass."""
    return F.regexp_extract_all(F.upper(seq), F.lit(f"(.{{1,{WORD}}})"), F.lit(1))


def _mask(part: Column, base: str) -> Column:
    """Bits of a part's columns that have a base, the first column highest."""
    return F.conv(F.rpad(F.translate(F.regexp_replace(part, f"[^{base}]", "0"), base, "1"), WORD, "0"), 2, 10).cast("bigint")


def masks(alignment: DataFrame) -> DataFrame:
    """(cluster_id, seq_id, w, part, A, C, G, T): a row for each WORD columns of a sequence."""
    parts = alignment.select("cluster_id", "seq_id", F.posexplode(_words("seq")).alias("w", "part"))
    return parts.select("*", *(_mask(F.col("part"), b).alias(b) for b in BASES))


def _positions(words: DataFrame, *columns: Column) -> DataFrame:
    """(cluster_id, position, *columns) of rows (cluster_id, w); columns may name i, a column's bit."""
    every = words.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(WORD - 1)))).withColumn("i", F.lit(WORD - 1) - F.col("__k"))
    return every.select("cluster_id", (F.col("w") * WORD + F.col("__k") + 1).cast("int").alias("position"), *columns)


def _bit(mask: str) -> Column:
    return F.expr(f"shiftright({mask}, i) & 1L") == 1


def equal_lengths(alignment: DataFrame) -> DataFrame:
    """Clusters whose sequences differ in length; empty if the alignment is sound."""
    return alignment.groupBy("cluster_id").agg(F.min(F.length("seq")).alias("least"), F.max(F.length("seq")).alias("most")).filter("least <> most")


def column_bases(alignment: DataFrame) -> DataFrame:
    """(cluster_id, position, bases): the distinct bases of every column besides gaps and N, sorted; ambiguity codes count."""
    parts = masks(alignment)
    words = parts.groupBy("cluster_id", "w").agg(*(F.bit_or(b).alias(b) for b in BASES))
    here = F.filter(F.array(*(F.when(_bit(b), F.lit(b)) for b in BASES)), lambda x: x.isNotNull())
    common = _positions(words, here.alias("bases")).filter(F.size("bases") > 0)
    odd = parts.filter(F.col("part").rlike("[^ACGTN-]")).select("cluster_id", "w", F.posexplode(F.split("part", "")).alias("k", "base"))
    odd = odd.filter(F.col("base").rlike("[^ACGTN-]")).select("cluster_id", (F.col("w") * WORD + F.col("k") + 1).cast("int").alias("position"), "base").distinct()
    both = common.unionByName(odd.select("cluster_id", "position", F.array("base").alias("bases")))
    return both.groupBy("cluster_id", "position").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("bases")))).alias("bases"))


def core_snp_positions(alignment: DataFrame) -> DataFrame:
    """(cluster_id, position, ref_base, alt_bases): columns with two or more bases besides gaps and N."""
    found = column_bases(alignment).filter(F.size("bases") > 1)
    return found.select("cluster_id", "position", F.element_at("bases", 1).alias("ref_base"), F.array_join(F.slice("bases", 2, 1 << 20), ",").alias("alt_bases"))


def normal_base(base: Column) -> Column:
    return F.when(F.upper(base).isin("-", "N"), F.lit("N")).otherwise(F.upper(base))


def core_snp_sequences(alignment: DataFrame, positions: DataFrame) -> DataFrame:
    """(cluster_id, seq_id, n_snps, seq): each sequence at its cluster's core SNP columns, whose list goes to the sequences."""
    lists = positions.groupBy("cluster_id").agg(F.sort_array(F.collect_list("position")).alias("places"))
    rows = split_join(alignment.select("cluster_id", "seq_id", _words("seq").alias("parts")), lists, "cluster_id", "seq_id", counted=alignment)
    base = lambda p: F.substr(F.get("parts", F.floor((p - 1) / WORD).cast("int")), (p - 1) % WORD + 1, F.lit(1))
    seq = F.array_join(F.transform("places", lambda p: normal_base(base(p))), "")
    return rows.select("cluster_id", "seq_id", F.size("places").cast("bigint").alias("n_snps"), seq.alias("seq"))


def atcg_columns(alignment: DataFrame) -> DataFrame:
    """(cluster_id, position, n_bases): columns where every base is A, C, G or T; n_bases 1 marks invariant ones."""
    every = reduce(Column.bitwiseOR, (F.col(b) for b in BASES))
    words = masks(alignment).groupBy("cluster_id", "w").agg(F.bit_and(every).alias("good"), *(F.bit_or(b).alias(b) for b in BASES))
    n = reduce(Column.__add__, (F.when(_bit(b), 1).otherwise(0) for b in BASES))
    return _positions(words, _bit("good").alias("good"), n.cast("bigint").alias("n_bases")).filter("good").select("cluster_id", "position", "n_bases")


def atcg_sequences(alignment: DataFrame, columns: DataFrame) -> DataFrame:
    """(cluster_id, seq_id, seq): each sequence at the columns of atcg_columns; N where a cluster has none."""
    found = core_snp_sequences(alignment, columns).select("cluster_id", "seq_id", "seq")
    none = alignment.join(columns.select("cluster_id").distinct(), "cluster_id", "left_anti")
    return found.unionByName(none.select("cluster_id", "seq_id", F.lit("N").alias("seq")))


def invariant_counts(columns: DataFrame, first: int = 1000) -> DataFrame:
    """(cluster_id, n_invariant, n_variable) among the first so many columns of atcg_columns, by position."""
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy("position"))
    rows = columns.withColumn("k", place).filter(F.col("k") <= first)
    return rows.groupBy("cluster_id").agg(F.count_if(F.col("n_bases") == 1).alias("n_invariant"), F.count_if(F.col("n_bases") > 1).alias("n_variable"))


def sequence_classes(alignment: DataFrame) -> DataFrame:
    """(cluster_id, rep, n, seq): equal sequences of a cluster as one, named by the least seq_id."""
    return alignment.withColumn("seq", F.upper("seq")).groupBy("cluster_id", "seq").agg(F.min("seq_id").alias("rep"), F.count("*").alias("n"))


def base_planes(seqs: list[str], rows: int = 1 << 22) -> np.ndarray:
    """Bits of sequences' columns, 64 in a word: two that tell A, C, G and T apart and one of columns that have one of these."""
    width = max(map(len, seqs), default=0)
    step, out = max(1, rows // max(width, 1)), []
    for i in range(0, len(seqs), step):
        some = seqs[i : i + step]
        cells = np.frombuffer("".join(s.ljust(width) for s in some).encode("ascii", "replace"), np.uint8).reshape(len(some), width)
        bits = np.packbits(_CODES[:, cells], axis=2)
        out.append(np.ascontiguousarray(np.pad(bits, ((0, 0), (0, 0), (0, -bits.shape[2] % 8)))).view(np.uint64))
    return np.concatenate(out, axis=1) if out else np.zeros((3, 0, 0), np.uint64)


def differences(planes: np.ndarray, some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """How many columns differ between each of some and each of others, where both have one of ACGT."""
    one, two, known = (p[some][:, None] for p in planes)
    odd = ((one ^ planes[0][others]) | (two ^ planes[1][others])) & known & planes[2][others]
    return np.bitwise_count(odd).sum(axis=2, dtype=np.int64)


def _compared(rows: DataFrame, whole: bool, most: int | None) -> DataFrame:
    """(cluster_id, a, b, n_snps) of rows (cluster_id, rep, seq), a written table: of rep a < b, or whole: of all ordered pairs.

    A cluster's rows are cut into blocks, more than PARTS only where their text is beyond BYTES; a pair of blocks is one task,
    which compares 64 columns with a few integer operations. What is shuffled are the sequences, once for each block.
    """
    ship(rows.sparkSession)
    blocks = F.greatest(F.least(F.ceil(F.count("*") / BLOCK), F.lit(PARTS)), F.ceil(F.sum(F.length("seq")) / BYTES), F.lit(1))
    sizes = rows.groupBy("cluster_id").agg(blocks.cast("int").alias("blocks"))
    dealt = split_join(rows, sizes, "cluster_id", "rep")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = dealt.select("cluster_id", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"), "rep", "mine", "seq")
    tasks = tasks.repartition("cluster_id", "one", "two").sortWithinPartitions("cluster_id", "one", "two", "rep")
    names, fields = ["cluster_id", "a", "b", "n_snps"], {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def found(key, held):
        cross, rep = key[1] != key[2], pa.concat_arrays([h[0] for h in held])
        mine, width = np.concatenate([h[1] for h in held]), max(h[2].shape[2] for h in held)
        planes = np.concatenate([np.pad(h[2], ((0, 0), (0, 0), (0, width - h[2].shape[2]))) for h in held], axis=1)
        left = np.flatnonzero(mine == key[1])
        right = np.flatnonzero(mine == key[2]) if cross else left
        step = max(1, PAIRS // max(1, len(right) * max(width, 1)))
        for i in range(0, len(left) if len(right) else 0, step):
            some = left[i : i + step]
            n = differences(planes, some, right).ravel()
            a, b = np.repeat(some, len(right)), np.tile(right, len(some))
            keep = np.ones(len(n), bool) if cross or whole else a < b
            if most is not None:
                keep &= n <= most
            a, b, n = a[keep], b[keep], n[keep]
            if not whole:
                a, b = np.minimum(a, b), np.maximum(a, b)  # rows are in order of rep
            for x, y in ((a, b), (b, a)) if whole and cross else ((a, b),):
                yield pa.RecordBatch.from_arrays([pa.repeat(key[0], len(n)), rep.take(pa.array(x)), rep.take(pa.array(y)), pa.array(n)], names)

    def run(batches):
        held, key = [], None
        for batch in batches:
            keys = [batch.column(i).to_pylist() for i in range(3)]
            cuts = [i for i in range(batch.num_rows) if i == 0 or any(c[i] != c[i - 1] for c in keys)] + [batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                now = (batch.column(0)[i], keys[1][i], keys[2][i])
                if key is None or (now[0].as_py(), *now[1:]) != (key[0].as_py(), *key[1:]):
                    if held:
                        yield from found(key, held)
                    held, key = [], now
                part = batch.slice(i, j - i)
                held.append((part.column(3), part.column(4).to_numpy(), base_planes(part.column(5).to_pylist())))
        if held:
            yield from found(key, held)

    return tasks.mapInArrow(run, f"cluster_id {fields['cluster_id']}, a {fields['rep']}, b {fields['rep']}, n_snps bigint")


def snp_distances(classes: DataFrame, most: int | None = None) -> DataFrame:
    """(cluster_id, a, b, n_snps) of classes a < b: columns where both have one of ACGT, and not the same; up to `most`.

    A cluster of any size spreads over tasks. The result is quadratic in a cluster's classes unless `most` bounds it.
    """
    rows = classes.filter("cluster_id is not null and seq is not null").select("cluster_id", "rep", F.upper("seq").alias("seq"))
    return _compared(kept(rows, "classes"), False, most)


def pair_count(alignment: DataFrame) -> DataFrame:
    """One row: how many rows the pair table has, the sum of the squares of the clusters' sizes; no pair is made."""
    sizes = alignment.filter("cluster_id is not null and seq is not null").groupBy("cluster_id").agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)).cast("bigint").alias("num_results"))


def pair_table(alignment: DataFrame) -> DataFrame:
    """(cluster_id, sample_a, sample_b, n_snps, is_self): every ordered pair of a cluster's samples, also with itself.

    The rows leave the tasks that compare them: no pair is joined or shuffled. sinks.pair_table writes by distance, pairs of
    a sample with itself last.
    """
    rows = alignment.filter("cluster_id is not null and seq is not null").select("cluster_id", F.col("seq_id").alias("rep"), F.upper("seq").alias("seq"))
    pairs = _compared(kept(rows, "samples"), True, None)
    return pairs.select("cluster_id", F.col("a").alias("sample_a"), F.col("b").alias("sample_b"), "n_snps", (F.col("a") == F.col("b")).alias("is_self"))


def vcf_rows(alignment: DataFrame, positions: DataFrame) -> DataFrame:
    """(cluster_id, pos, ref, alt, n_ref, n_alt, n_missing): one row for each core SNP column; of these alone cells are counted."""
    cells = core_snp_sequences(alignment, positions).select("cluster_id", F.posexplode(F.split("seq", "")).alias("k", "base"))
    counts = cells.groupBy("cluster_id", "k", "base").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy("position")) - 1
    rows = counts.join(positions.withColumn("k", place), ["cluster_id", "k"])
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("bigint")
    missing, base = F.col("base") == "N", F.col("base")
    return rows.groupBy("cluster_id", F.col("position").alias("pos"), F.col("ref_base").alias("ref"), F.col("alt_bases").alias("alt")).agg(
        total(base == F.col("ref_base")).alias("n_ref"), total(~missing & (base != F.col("ref_base"))).alias("n_alt"), total(missing).alias("n_missing")
    )


def integrate_positions(positions: DataFrame) -> DataFrame:
    """Positions of all clusters on one axis: each cluster begins after the largest position of those before it."""
    most = positions.groupBy("cluster_id").agg(F.max("position").alias("m"))
    before = Window.orderBy("cluster_id").rowsBetween(Window.unboundedPreceding, -1)  # one task: a row for each cluster
    offset = most.withColumn("offset", F.coalesce(F.sum("m").over(before), F.lit(0)))  # one row for each cluster
    rows = positions.join(offset.select("cluster_id", "offset"), "cluster_id")
    return rows.select("cluster_id", (F.col("position") + F.col("offset")).cast("bigint").alias("global_position"), F.col("position").cast("bigint").alias("original_position"), "ref_base", "alt_bases")


def integrate_sequences(snps: DataFrame) -> DataFrame:
    """(sample_id, n_clusters, total_snps, seq): a sample's SNP sequences joined in order of cluster."""
    rows = snps.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("cluster_id", "seq"))).alias("x"))
    seq = F.array_join(F.transform("x", lambda c: c["seq"]), "")
    return rows.select("sample_id", F.size("x").cast("bigint").alias("n_clusters"), F.length(seq).cast("bigint").alias("total_snps"), seq.alias("seq"))


def sample_mapping(samples: DataFrame, clusters: DataFrame) -> DataFrame:
    """(sample_id, cluster_id, total_snps); samples without cluster are `unknown`."""
    return samples.join(clusters, "sample_id", "left").select("sample_id", F.coalesce("cluster_id", F.lit("unknown")).alias("cluster_id"), "total_snps")


def integration_summary(samples: DataFrame, positions: DataFrame) -> DataFrame:
    """One row: n_samples, n_clusters, total_snps, longest and mean length; samples: of integrate_sequences."""
    of = positions.groupBy("cluster_id").agg(F.count("*").alias("n"))
    one = of.agg(F.count("*").alias("n_clusters"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_positions"))
    length = F.col("total_snps")
    two = samples.agg(F.count("*").alias("n_samples"), F.coalesce(F.max(length), F.lit(0)).cast("bigint").alias("longest"), F.coalesce(F.min(length) == F.max(length), F.lit(True)).alias("is_rectangular"), fixed(F.coalesce(F.avg(length), F.lit(0.0)), 2).alias("average"))
    return two.crossJoin(F.broadcast(one))  # one row with one row


def split_kmers(df: DataFrame, sample: str, seq: str, flank: int = 7, both_strands: bool = False) -> DataFrame:
    """(left, right, n_samples, bases): split k-mers whose middle base differs between samples.

    A sample with several middle bases between the same flanks has N there. both_strands reads each k-mer from the strand
    whose flanks come first; flanks that are equal on both strands take the lesser middle base.
    """
    size = 2 * flank + 1
    text = F.upper(F.col(seq))
    places = df.filter(F.length(seq) >= size).select(F.col(sample).alias("s"), text.alias("t"), F.explode(F.sequence(F.lit(1), F.length(seq) - size + 1)).alias("i"))
    cut = places.select("s", F.substring("t", F.col("i"), F.lit(flank)).alias("left"), F.substring("t", F.col("i") + flank, F.lit(1)).alias("m"), F.substring("t", F.col("i") + flank + 1, F.lit(flank)).alias("right"))
    if both_strands:
        turned = lambda c: F.reverse(F.translate(c, "ACGT", "TGCA"))
        here, there = F.concat("left", "right"), F.concat(turned("right"), turned("left"))
        pick = lambda a, b: F.when(here <= there, a).otherwise(b)
        middle = F.when(here == there, F.least("m", turned("m"))).otherwise(pick(F.col("m"), turned("m")))
        cut = cut.select("s", pick(F.col("left"), turned("right")).alias("left"), middle.alias("m"), pick(F.col("right"), turned("left")).alias("right"))
    one = cut.groupBy("s", "left", "right").agg(F.min("m").alias("lo"), F.max("m").alias("hi")).select("left", "right", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.lit("N")).alias("m"))
    sites = one.groupBy("left", "right").agg(F.count("*").alias("n_samples"), F.array_join(F.array_sort(F.collect_set("m")), "").alias("bases"))
    return sites.filter(F.length(F.replace(F.col("bases"), F.lit("N"), F.lit(""))) > 1)
