"""MinHash near-deduplication with ProbMinHash.

A text is a weighted set: its runs of five words (0-9, a-z with A-Z lower-cased, characters beyond ASCII), weighted
by how often they occur; a text of fewer words is one run. Two texts are linked if their probability Jaccard
similarity, sum over common i of 1 / sum over j of max(x_j / x_i, y_j / y_i), is 0.8 or more; for runs that do not
repeat this is the plain Jaccard similarity. A class is a connected component of links and exact copies.

1. Signatures: every weighted run is a Poisson process whose arrivals fall on random registers; a register keeps the
   run that arrives first, and a run stops once its next arrival is later than every register of its text.
2. Exact copies collapse by digest, pre-aggregated, so copies cost one row from here on; that row has a number.
3. Bands of registers give buckets. Buckets are read in sorted ranges that may split a bucket. A member's candidate is
   the most central of a bucket (of its part of it): the one with the most company in all its buckets, as the common
   origin of near copies has. Of its up to BANDS candidates the one whose registers agree best is verified on the exact
   sets. The components of these links are what most buckets consist of entirely.
4. What is left are buckets with members of several components. Only their members of different components are
   compared: those of the bucket's largest component with the others, and the others among themselves, in blocks, and a
   pair in the first of the bands it shares only. First registers alone say who has a candidate at all; then such members
   meet with their sets, and each pair that would join two components is verified. So every pair that shares a bucket is
   linked, verified or already in one component.

A link is missed only if the texts share no band (below 4e-6 at similarity 0.8) or if registers underestimate by 0.15
(4.7 standard deviations at 0.8, below 2e-6).

A class is named by its least doc_id. Rows of one doc_id with different texts are different documents: such a doc_id
names no class that has another, and a class of only such doc_ids is named by a negative hash of its texts.

Edge cases: texts without words are linked to exact copies only; a null text is a class of its own; rows of equal
doc_id and text are one document; a text without doc_id can only be an exact copy; an empty table gives an empty result;
other columns are ignored and returned as they are, `class_id` is replaced. A very long text is one row of work: its set
is held by one task at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..operators.skew import split_join
from ..plans.shared import kept, remove
from .common import in_arrow, spread, table
from .words import Words, mix, runs

SHINGLE, SIMILARITY = 5, 0.8
ROWS, BANDS = 5, 32
REGISTERS = ROWS * BANDS
#: Pairs whose registers agree less are not verified.
LEAST_AGREEMENT = 0.65
#: Texts in a block of a bucket: of its largest component, and of the others. Salts for classes of many exact copies.
MAIN_BLOCK, BLOCK, SALTS = 4000, 400, 16


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, hash, weight) of every distinct run of words, sorted by owner and hash."""
    w = Words(texts)
    run, whole = runs(w.hashes, w.offsets, SHINGLE)
    owner, n = w.owner(), np.diff(w.offsets)
    for k in np.flatnonzero((n > 0) & (n < SHINGLE)):
        a = w.offsets[k]
        run[a], whole[a] = mix(np.bitwise_xor.reduce(mix(w.hashes[a : a + n[k]] + np.arange(n[k]).astype(np.uint64)), keepdims=True))[0], True
    owner, run = owner[whole], run[whole]
    order = np.lexsort((run, owner))
    owner, run = owner[order], run[order]
    first = np.ones(len(run), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (run[1:] != run[:-1])
    at = np.flatnonzero(first)
    return owner[at], run[at], np.diff(np.append(at, len(run)))


def signatures(owner: np.ndarray, run: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """The run that arrives first at each register of each of n texts (0 where a text has none)."""
    times = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    clock, live, step = np.zeros(len(run)), np.arange(len(run)), 0
    rate = weight.astype(float)
    while len(live):
        step += 1
        drawn = mix(run[live] + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        clock[live] -= np.log(((drawn >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate[live]
        slot = owner[live] * registers + (mix(drawn) % np.uint64(registers)).astype(np.int64)
        sooner = np.flatnonzero(clock[live] < times[slot])
        slot, t = slot[sooner], clock[live[sooner]]
        np.minimum.at(times, slot, t)
        won = t == times[slot]
        winner[slot[won]] = run[live[sooner[won]]]
        # a later arrival can't win where all registers were reached sooner
        live = live[clock[live] < times.reshape(n, registers).max(axis=1)[owner[live]]]
    return winner.reshape(n, registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted elements, weights)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1].astype(float), b[1].astype(float)
    rest = x.sum() - x[i].sum(), y.sum() - y[j].sum()
    pairs, count = np.unique(np.stack([x[i], y[j]]), axis=1, return_counts=True)
    p, q = pairs
    denominator = (count * np.maximum(p / p[:, None], q / q[:, None])).sum(axis=1) + rest[0] / p + rest[1] / q
    return float((count / denominator).sum())


def sign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, copy_key (digest of the text), bands (hashes; empty without words) and registers (16 bits of each)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.md5(F.col(text).cast("binary"))).alias("copy_key"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            owner, run_, weight = shingles(texts)
            winner = signatures(owner, run_, weight, len(texts))
            band = np.zeros((len(texts), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                band = mix(band + winner[:, r::ROWS])
            some = np.bincount(owner, minlength=len(texts)) > 0
            low = (winner & np.uint64(0xFFFF)).astype("<u2")
            bands = [b.view(np.int64) if s else np.zeros(0, np.int64) for b, s in zip(band, some)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bands, pa.list_(pa.int64())), pa.array([x.tobytes() for x in low], pa.binary())],
                ["doc_id", "copy_key", "bands", "registers"],
            )

    return in_arrow(rows, run, "doc_id bigint, copy_key binary, bands array<bigint>, registers binary")


def _batch(names: list[str], kinds: list, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def shared_buckets(classes: DataFrame) -> DataFrame:
    """(bucket, band, node, company) of the buckets of two members or more; company: members in the range.

    A range may begin or end within a bucket, so what stands alone at its ends stays too.
    """
    buckets = classes.select(F.posexplode("bands").alias("band", "bucket"), "node").select("bucket", "band", "node")
    rows = buckets.repartitionByRange("bucket", "node").sortWithinPartitions("bucket", "node")
    names, kinds = ["bucket", "band", "node", "company"], [pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def run(batches):
        held, opening = [np.zeros(0, t) for t in (np.int64, np.int32, np.int64)], True

        def out(columns, all_=False):
            bucket = columns[0]
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
            size = np.diff(np.append(starts, len(bucket)))
            company = np.repeat(size, size)
            stay = company > 1
            if len(starts) and opening:
                stay[: size[0]] = True
            if len(starts) and all_:
                stay[starts[-1] :] = True
            return _batch(names, kinds, *(c[stay] for c in columns), company[stay])

        parts = []
        for batch in batches:
            if not batch.num_rows:
                continue
            parts.append([batch.column(i).to_numpy() for i in range(3)])
            if len(held[0]) and parts[-1][0][-1] == held[0][0] or len(parts) > 1 and parts[-1][0][-1] == parts[0][0][0]:
                continue  # one bucket so far
            held, parts = [np.concatenate(x) for x in zip(held, *parts)], []
            cut = np.searchsorted(held[0], held[0][-1])  # the last bucket may go on
            if cut:
                yield out([x[:cut] for x in held])
                held, opening = [x[cut:] for x in held], False
        held = [np.concatenate(x) for x in zip(held, *parts)]
        yield out(held, all_=True)

    return in_arrow(rows, run, "bucket bigint, band int, node bigint, company bigint")


def firsts(shared: DataFrame, company: DataFrame) -> DataFrame:
    """(a, b): members of shared buckets and the member with the most company, of the bucket or of what a range holds of it."""
    order = ["bucket", "less", "node"]
    rows = shared.select("bucket", "node").join(company.select("node", (-F.col("company")).alias("less")), "node").select(*order)
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("bucket", "node")

    def run(batches):
        last, leader = None, None
        for batch in batches:
            bucket, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(node):
                continue
            new = np.ones(len(node), bool)
            new[1:] = bucket[1:] != bucket[:-1]
            new[0] = bucket[0] != last
            starts = np.flatnonzero(new)
            at = np.searchsorted(starts, np.arange(len(node)), side="right") - 1
            leaders = np.append(node[starts], leader if leader is not None else 0)[at]
            last, leader = int(bucket[-1]), int(leaders[-1])
            other = leaders != node
            yield _batch(["a", "b"], [pa.int64()] * 2, node[other], leaders[other])

    return in_arrow(rows, run, "a bigint, b bigint").distinct()


def agreement(pairs: DataFrame) -> DataFrame:
    """(a, b, agree): the share of equal registers; pairs: a, b, x, y (registers)."""

    def run(batches):
        for batch in batches:
            x, y = (np.array([np.frombuffer(v, "<u2") for v in batch.column(i).to_pylist()]).reshape(batch.num_rows, REGISTERS) for i in (2, 3))
            share = (x == y).mean(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share, pa.float64())], ["a", "b", "agree"])

    return in_arrow(pairs.select("a", "b", "x", "y"), run, "a bigint, b bigint, agree double")


def packed_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, runs): the runs of five words of each class's text, sorted; docs: doc_id, copy_key, text."""
    texts = docs.join(classes.select("node", F.col("rep").alias("doc_id"), "copy_key"), ["doc_id", "copy_key"]).select("node", "text")

    def run(batches):
        seen = set()  # a repeated row has the same number, and is in the same task
        for batch in batches:
            nodes = batch.column(0).to_pylist()
            fresh = [i for i, n in enumerate(nodes) if not (n in seen or seen.add(n))]
            batch = batch.take(pa.array(fresh, pa.int64()))
            owner, run_, weight = shingles(batch.column(1).to_pylist())
            whole = np.repeat(run_, weight).astype("<u8")
            cuts = np.searchsorted(np.repeat(owner, weight), np.arange(batch.num_rows + 1))
            yield _batch(["node", "runs"], [pa.int64(), pa.binary()], batch.column(0), [whole[a:b].tobytes() for a, b in zip(cuts, cuts[1:])])

    return in_arrow(texts, run, "node bigint, runs binary")


def weighted(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.frombuffer(packed, "<u8"), return_counts=True)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of a written table of pairs (a, b), those that are linked. A first of very many is split over tasks."""
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("runs").alias("x")), "a")
    both = split_join(one, sets.select(F.col("node").alias("b"), F.col("runs").alias("y")), "b", "a", counted=pairs)

    def run(batches):
        for batch in batches:
            good = [similarity(weighted(x), weighted(y)) >= SIMILARITY for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return in_arrow(both.select("a", "b", "x", "y"), run, "a bigint, b bigint")


def mixed(shared: DataFrame, components: DataFrame) -> DataFrame:
    """(bucket, band, node, component, is_main, mains, others) of the members of buckets with several components.

    is_main: of the bucket's largest component; mains, others: blocks of these and of the rest.
    """
    rows = shared.join(components, "node", "left").select("bucket", "band", "node", F.coalesce("component", "node").alias("component"))
    rows = kept(rows, "members")
    counts = rows.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    of = counts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.count("*").alias("several")).filter("several > 1")
    blocks = lambda n, size: F.ceil(n / size).cast("int")
    of = of.select("bucket", F.col("main.component").alias("main"), blocks(F.col("main.n"), MAIN_BLOCK).alias("mains"), blocks(F.col("all") - F.col("main.n"), BLOCK).alias("others"))
    out = split_join(rows, kept(of, "mixed"), "bucket", "node")
    return out.select("bucket", "band", "node", "component", (F.col("component") == F.col("main")).alias("is_main"), "mains", "others")


def blocked(rows: DataFrame) -> DataFrame:
    """rows of `mixed` dealt to tasks (bucket, one, two): a main block one < 0 or another block, with another block two.

    Members of the largest component never meet each other; a row goes to a task for each block that it has to meet.
    """
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))).cast("int")
    task = lambda one, two: F.struct(one.cast("int").alias("one"), two.cast("int").alias("two"))
    others = F.sequence(F.lit(0), F.col("others") - 1)
    of_main = F.transform(others, lambda j: task(-1 - F.col("mine"), j))
    with_main = F.transform(F.sequence(F.lit(1), F.col("mains")), lambda i: task(-i, F.col("mine")))
    with_others = F.transform(others, lambda j: task(F.least("mine", j), F.greatest("mine", j)))
    dealt = rows.withColumn("mine", mine).withColumn("task", F.explode(F.when(F.col("is_main"), of_main).otherwise(F.concat(with_main, with_others))))
    first = F.when(F.col("is_main"), F.lit(True)).otherwise((F.col("task.one") >= 0) & (F.col("mine") == F.col("task.one")))
    dealt = dealt.withColumn("side", first).select("*", "task.one", "task.two").drop("task", "mine", "mains", "others", "is_main")
    return dealt.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two", "node")


def _tasks(batches, keys: int, work):
    """work(key, rows) for each run of rows with equal first `keys` columns; rows hold the other columns."""
    key, rows = None, []
    for batch in batches:
        done = []
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if row[:keys] != key:
                if len(rows) > 1:
                    done += work(key, rows)
                key, rows = row[:keys], []
            rows.append(row[keys:])
        yield done
    yield work(key, rows) if len(rows) > 1 else []


def candidate_pairs(key: tuple, rows: list[tuple]) -> list[tuple[int, int, float]]:
    """Places (i, j) of rows of different components whose registers agree, and share no band before this one; best first.

    rows: node, component, side, registers, band, bands, ...; a task of two blocks compares them, a task of one block its rows.
    """
    registers, before = np.array([np.frombuffer(r[3], "<u2") for r in rows]), np.array([r[5][: r[4]] for r in rows], np.int64).reshape(len(rows), -1)
    component, side = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    two = key[1] != key[2]
    right = np.flatnonzero(~side) if two else np.arange(len(rows))
    found = []
    for i in (np.flatnonzero(side) if two else right).tolist():
        others = right if two else right[right > i]
        others = others[component[others] != component[i]]
        if len(others):
            agree = (registers[others] == registers[i]).mean(axis=1)
            good = np.flatnonzero(agree >= LEAST_AGREEMENT)
            good = good[~(before[others[good]] == before[i]).any(axis=1)]
            found += [(i, j, x) for j, x in zip(others[good].tolist(), agree[good].tolist())]
    return sorted(found, key=lambda f: (-f[2], f[0], f[1]))


def similarities(sets: list[tuple[np.ndarray, np.ndarray]], pairs: list[tuple[int, int]]) -> np.ndarray:
    """Similarity of pairs of sets. Where no run repeats it is |common| / |union|, for all partners of a set at once."""
    out, plain = np.zeros(len(pairs)), [bool((s[1] == 1).all()) for s in sets]
    runs_, place = np.unique(np.concatenate([s[0] for s in sets]), return_inverse=True)
    cuts = np.cumsum([0, *(len(s[0]) for s in sets)])
    ids, mark, partners = [place[a:b] for a, b in zip(cuts, cuts[1:])], np.zeros(len(runs_), np.int64), {}
    for k, (i, j) in enumerate(pairs):
        if plain[i] and plain[j]:
            partners.setdefault(i, []).append((k, j))
        else:
            out[k] = similarity(sets[i], sets[j])
    for i, found in partners.items():
        mark[ids[i]] = 1
        for at in range(0, len(found), 1000):
            part = found[at : at + 1000]
            sizes = np.array([len(ids[j]) for _, j in part])
            common = np.add.reduceat(mark[np.concatenate([ids[j] for _, j in part])], np.cumsum(sizes) - sizes)
            out[[k for k, _ in part]] = common / (sizes + len(ids[i]) - common)
        mark[ids[i]] = 0
    return out


def linking(key: tuple, rows: list[tuple]) -> list[tuple[int, int]]:
    """A spanning forest, over components, of the links of a task; rows as for candidate_pairs, then runs."""
    pairs = [(i, j) for i, j, _ in candidate_pairs(key, rows)]
    if not pairs:
        return []
    parent, out = {}, []

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k in np.flatnonzero(similarities([weighted(r[6]) for r in rows], pairs) >= SIMILARITY).tolist():
        i, j = pairs[k]
        if (p := find(rows[i][1])) != (q := find(rows[j][1])):
            parent[p] = q
            out.append((rows[i][0], rows[j][0]))
    return out


def rest_of_links(rows: DataFrame, registers: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components, within the buckets of `mixed`; registers: node, registers, bands; sets: node, runs."""
    names = ["bucket", "one", "two", "node", "component", "side", "registers", "band", "bands"]

    def some(batches):  # who has a candidate at all
        work = lambda key, r: [(key[0], r[i][0]) for i in {k for i, j, _ in candidate_pairs(key, r) for k in (i, j)}]
        for found in _tasks(batches, 3, work):
            yield _batch(["bucket", "node"], [pa.int64()] * 2, *([f[k] for f in found] for k in (0, 1)))

    dealt = blocked(rows.join(registers, "node"))
    asked = kept(in_arrow(dealt.select(*names), some, "bucket bigint, node bigint").distinct(), "asked")
    left = rows.join(asked, ["bucket", "node"], "left_semi")
    # a pair with both ends here; blocks are of those who are left
    n = left.groupBy("bucket").agg(F.count_if("is_main").alias("m"), F.count_if(~F.col("is_main")).alias("o"))
    left = split_join(left.drop("mains", "others"), n, "bucket", "node", counted=asked).filter("o > 0")
    blocks = lambda c: F.greatest(F.ceil(F.col(c) / BLOCK), F.lit(1)).cast("int")
    left = left.withColumn("mains", blocks("m")).withColumn("others", blocks("o")).drop("m", "o")

    def join(batches):
        for found in _tasks(batches, 3, linking):
            yield _batch(["a", "b"], [pa.int64()] * 2, *([f[k] for f in found] for k in (0, 1)))

    whole = left.join(registers, "node").join(sets, "node")
    return in_arrow(blocked(whole).select(*names, "runs"), join, "a bigint, b bigint").distinct()


def near_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, component) of every class that is linked to another; docs: doc_id, copy_key, text."""
    shared = kept(shared_buckets(classes), "shared")
    company = kept(shared.groupBy("node").agg(F.sum("company").alias("company")), "company")
    pairs = kept(firsts(shared, company), "pairs")
    near = kept(classes.select("node", "registers", "bands", "rep", "copy_key").join(company.select("node"), "node", "left_semi"), "registers")
    registers = near.select("node", "registers", "bands")
    one = pairs.join(registers.select(F.col("node").alias("a"), F.col("registers").alias("x")), "a")
    both = split_join(one, registers.select(F.col("node").alias("b"), F.col("registers").alias("y")), "b", "a", counted=pairs)
    best = agreement(both).filter(F.col("agree") >= LEAST_AGREEMENT).groupBy("a").agg(F.max(F.struct("agree", "b")).alias("m"))
    best = kept(best.select("a", "m.b"), "best")
    sets = kept(packed_sets(docs, near), "sets")
    links = kept(verified(best, sets), "links")
    components = kept(connected_components(links), "components")
    left = kept(mixed(shared, components), "rows")
    more = None if left.isEmpty() else kept(rest_of_links(left, registers, sets), "more")
    if more is not None and not more.isEmpty():  # the components that these links join, as nodes of a smaller graph
        of = lambda c: components.select(F.col("node").alias(c), F.col("component").alias(f"{c}_component"))
        ends = more.join(of("a"), "a", "left").join(of("b"), "b", "left")
        ends = ends.select(F.coalesce("a_component", "a").alias("a"), F.coalesce("b_component", "b").alias("b"))
        joined = kept(connected_components(ends), "joined").select(F.col("node").alias("component"), F.col("component").alias("whole"))
        every = components.unionByName(joined.select(F.col("component").alias("node"), "component")).distinct()
        components = kept(every.join(joined, "component", "left").select("node", F.coalesce("whole", "component").alias("component")), "components")
    for frame in (pairs, near, best, sets, shared):
        remove(frame)
    return components


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs plus class_id."""
    docs = docs.drop("class_id")
    key = F.unhex(F.md5(F.col(text).cast("binary")))
    small = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), key.alias("copy_key"), F.col(text).alias("text")).filter("text is not null")
    signed = sign(spread(small))
    classes = signed.groupBy("copy_key").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("registers").alias("registers")
    )
    # numbers are fixed by writing them
    classes = kept(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    joined = near_links(small, classes.filter("rep is not null"))
    # a doc_id with several texts names no class that has another doc_id
    hashed = small.select("doc_id", F.xxhash64("text").alias("h")).filter("doc_id is not null")
    several = hashed.groupBy("doc_id").agg(F.min("h").alias("x"), F.max("h").alias("y")).filter("x <> y").select("doc_id")
    members = classes.select("copy_key", "node", "rep", "copies").join(joined, "node", "left").withColumn("group", F.coalesce("component", "node"))
    names = kept(_names(members, several, small), "names")
    found = members.join(names, "group", "left").filter("copies > 1 or component is not null or name is not null")
    found = found.select("copy_key", F.coalesce("name", "rep").alias("__class"))
    found = found.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("copy_key", "__key")
    rows = docs.withColumn("__key", key).withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(doc_id), F.lit(SALTS)), F.lit(0)).cast("int"))
    out = rows.join(found, ["__key", "__salt"], "left")
    return out.withColumn("class_id", F.coalesce("__class", F.col(doc_id))).drop("__key", "__salt", "__class")


def _names(members: DataFrame, several: DataFrame, docs: DataFrame) -> DataFrame:
    """(group, name) of the groups of more than one text, and of those that a doc_id of several texts would name."""
    plain = members.filter("component is not null").groupBy("group").agg(F.min("rep").alias("name"))
    if several.isEmpty():
        return plain
    several = kept(several, "several")
    texts = docs.join(several, "doc_id", "left_semi").select("copy_key").distinct()
    touched = kept(members.join(texts, "copy_key", "left_semi").select("group").distinct(), "touched")
    inside = members.join(touched, "group", "left_semi").select("group", "copy_key")
    ids = docs.select("doc_id", "copy_key").join(inside, "copy_key").join(several.withColumn("s", F.lit(True)), "doc_id", "left")
    hashed = -1 - F.pmod(F.min(F.xxhash64("copy_key")), F.lit(1 << 62))
    own = ids.groupBy("group").agg(F.coalesce(F.min(F.when(F.col("s").isNull(), F.col("doc_id"))), hashed).alias("name"))
    return plain.join(touched, "group", "left_anti").unionByName(own)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs plus class_id, one row of every class: the row that names it, else that of its least doc_id and text.

    Of rows that repeat a doc_id and text one stays, as of rows without doc_id that repeat a text; null texts all stay.
    """
    named = near_duplicate_classes(docs, doc_id, text)
    nulls = docs.drop("class_id").filter(F.col(text).isNull()).withColumn("class_id", F.col(doc_id).cast(named.schema["class_id"].dataType))
    some = named.filter(F.col(text).isNotNull())
    repeated = docs.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).groupBy(doc_id).count().filter("count > 1")
    out = some.filter(F.col(doc_id) == F.col("class_id"))
    if not repeated.isEmpty():
        one = some.filter(F.col(doc_id).isNotNull()).withColumn("__key", F.md5(F.col(text).cast("binary"))).dropDuplicates([doc_id, "__key"])
        first = one.groupBy("class_id").agg(F.min(F.struct(F.col(doc_id).alias("d"), F.col("__key").alias("k"))).alias("f"))
        first = first.select(F.col("f.d").alias(doc_id), F.col("f.k").alias("__key"))
        out = one.join(first, [doc_id, "__key"], "left_semi").drop("__key")
    if not docs.filter(F.col(doc_id).isNull()).isEmpty():
        out = out.unionByName(some.filter(F.col(doc_id).isNull() & F.col("class_id").isNull()).dropDuplicates([text]))
    return out.unionByName(nulls)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicate_classes(docs).select("doc_id", "class_id")
