"""MinHash sketches and distances between them, through an inverted index."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import mash_distance
from ..plans.shared import dealt, give_back, kept, ship
from .skew import split_join

try:  # half the cost a call of hashlib's
    from _md5 import md5
except ImportError:
    from hashlib import md5

_COMPLEMENT = bytes.maketrans(b"ACGTacgt", b"TGCAtgca")
#: Classes in a block whose pairs are compared, blocks that more than SMALL classes make at least, cells of one step's counts,
#: hashes of the sketches that are merged at once, pairs that are held before a forest of them is taken, hashes of a written block.
BLOCK, BLOCKS, SMALL, CELLS, MERGED, EDGES, HASHES = 60_000, 6, 3_000, 1 << 21, 1 << 18, 1 << 19, 1 << 25
#: Hashes that are computed at once, and characters of texts that are joined for it.
LANES, CHARS = 1 << 14, 1 << 19

_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_ORDER = [[(step * i + first) % 16 for i in range(16)] for step, first in ((1, 0), (5, 1), (3, 5), (7, 0))]


def _md5_heads(words: list) -> np.ndarray:
    """The first eight bytes of md5 of many one-block messages: words has 16 arrays of uint32, or numbers where all agree."""
    n = next(len(w) for w in words if isinstance(w, np.ndarray))
    start = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
    a, b, c, d = (np.full(n, x, np.uint32) for x in start)
    f, high = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        part, j = divmod(i, 16)
        if part == 0:
            np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
        elif part == 1:
            np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
        elif part == 2:
            np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
        word, turn = words[_ORDER[part][j]], _TURNS[part][j % 4]
        if isinstance(word, np.ndarray):
            np.add(f, word, out=f), np.add(f, np.uint32(_SINES[i]), out=f)
        else:
            np.add(f, np.uint32((_SINES[i] + word) % 2**32), out=f)
        np.add(f, a, out=f)
        np.right_shift(f, np.uint32(32 - turn), out=high), np.left_shift(f, np.uint32(turn), out=f), np.bitwise_or(f, high, out=f)
        np.add(f, b, out=f)
        a, b, c, d, f = d, f, b, c, a
    a, b = a + np.uint32(start[0]), b + np.uint32(start[1])
    return a.byteswap().astype(np.uint64) << np.uint64(32) | b.byteswap()


def _heads(texts: list[str], k: int) -> list[np.ndarray]:
    """For each text the first eight bytes of md5 of its k-mers, k characters of at most 55 bytes, in order of place."""
    raw = "".join(texts).encode()
    data = np.frombuffer(raw + bytes(64), np.uint8)
    starts = np.append(np.flatnonzero((data[: len(raw)] & 0xC0) != 0x80), len(raw))
    ends = np.cumsum([len(t) for t in texts])
    counts = [max(len(t) - k + 1, 0) for t in texts]
    first = np.concatenate([np.arange(e - len(t), e - len(t) + n) for t, e, n in zip(texts, ends.tolist(), counts)])
    at, length = starts[first], starts[first + k] - starts[first]
    wide = data.astype(np.uint32)
    quads = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
    out = np.empty(len(first), np.uint64)
    for size in np.unique(length).tolist():
        every = np.flatnonzero(length == size)
        whole, rest = divmod(size, 4)
        for i in range(0, len(every), LANES):
            some = every[i : i + LANES]
            words = [quads[at[some] + 4 * j] for j in range(whole + 1)]
            words[whole] = words[whole] & np.uint32((1 << 8 * rest) - 1) | np.uint32(0x80 << 8 * rest)
            out[some] = _md5_heads([*words, *[0] * (15 - len(words) - 1), 8 * size, 0] if whole < 13 else [*words, 8 * size, 0])
    return np.split(out, np.cumsum(counts)[:-1])


def _least_heads(found: np.ndarray, size: int) -> np.ndarray:
    """The `size` least different numbers, sorted, as signed ones of the same order."""
    if len(found) > 4 * size:
        some = np.unique(found[found <= np.partition(found, 3 * size)[3 * size]])
        found = some if len(some) >= size else found
    return (np.unique(found)[:size] ^ np.uint64(1 << 63)).view(np.int64)


def packed_sketch(df: DataFrame, sample: str, seq: str, k: int, size: int) -> DataFrame:
    """(sample, sketch): as `sketch`, of each md5 hash the first eight bytes, as a signed number of the same order.

    A quarter of the hex text's bytes. Two k-mers whose hashes begin with the same 64 bits count as one.
    """
    if 4 * k > 55:
        raise ValueError("k-mers of at most 13 characters")
    ship(df.sparkSession)

    def run(batches):
        for batch in batches:
            texts, found, i = [t or "" for t in batch.column(1).to_pylist()], [], 0
            while i < len(texts):
                j, n = i + 1, len(texts[i])
                while j < len(texts) and n < CHARS:
                    j, n = j + 1, n + len(texts[j])
                found += [_least_heads(x, size) for x in _heads(texts[i:j], k)] if any(len(t) >= k for t in texts[i:j]) else [np.empty(0, np.int64)] * (j - i)
                i = j
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [sample, "sketch"])

    kind = df.schema[sample].dataType.simpleString()
    return dealt(df.select(sample, seq)).mapInArrow(run, f"`{sample}` {kind}, sketch array<bigint>")


def sketch(df: DataFrame, sample: str, seq: str, k: int = 21, size: int = 10_000, min_copies: int = 1, canonical: bool = False) -> DataFrame:
    """(sample, sketch): the `size` least md5 hashes of the k-mers that occur min_copies times, as sorted hex text.

    canonical takes the lesser of a k-mer and its reverse complement. A sequence without k-mers has an empty sketch.
    """
    ship(df.sparkSession)

    def least(text: str | None) -> list[str]:
        # a k-mer is a slice of bytes where each character is one
        text = text or ""
        data = text.encode() if text.isascii() else None
        pieces = data if data is not None else text
        kmers = [pieces[i : i + k] for i in range(len(pieces) - k + 1)]
        if data is None:
            kmers = [x.encode() for x in kmers]
        if canonical:
            kmers = [min(x, x.translate(_COMPLEMENT)[::-1]) for x in kmers]
        if min_copies > 1:
            kmers = [x for x, n in Counter(kmers).items() if n >= min_copies]
        digests = [md5(x).digest() for x in set(kmers)]
        if len(digests) > size:  # those whose first eight bytes are not beyond the size-th
            first = np.frombuffer(b"".join(digests), ">u8")[::2]
            bound = np.partition(first, size - 1)[size - 1]
            digests = [digests[i] for i in np.flatnonzero(first <= bound).tolist()]
        return [d.hex() for d in sorted(set(digests))[:size]]

    def run(batches):
        for batch in batches:
            hashes = [least(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.list_(pa.string()))], [sample, "sketch"])

    kind = df.schema[sample].dataType.simpleString()
    return dealt(df.select(sample, seq)).mapInArrow(run, f"`{sample}` {kind}, sketch array<string>")


def sketch_classes(sketches: DataFrame, sample: str) -> DataFrame:
    """(rep, n, sketch): samples of equal sketches as one class, named by the least; empty sketches stay apart."""
    some = sketches.filter(F.size("sketch") > 0).groupBy("sketch").agg(F.min(sample).alias("rep"), F.count("*").alias("n"))
    none = sketches.filter(F.size("sketch") == 0).select(F.col(sample).alias("rep"), F.lit(1).cast("bigint").alias("n"), "sketch")
    return some.select("rep", "n", "sketch").unionByName(none)


def class_members(sketches: DataFrame, classes: DataFrame, sample: str) -> DataFrame:
    """(sample, rep) of every sample."""
    some = sketches.filter(F.size("sketch") > 0).join(classes.filter(F.size("sketch") > 0), "sketch").select(sample, "rep")
    return some.unionByName(sketches.filter(F.size("sketch") == 0).select(sample, F.col(sample).alias("rep")))


def distance_pairs(classes: DataFrame, k: int, size: int, max_distance: float) -> DataFrame:
    """(a, b, n_a, n_b, shared, compared, distance) of classes a < b that share a hash, up to max_distance.

    Pairs that share nothing have distance 1 and are not listed. Instead of all pairs, hashes are joined with
    themselves; a max_distance below 1 means that a pair must share so many hashes that the rarest ones of each
    sketch already decide: only that prefix is joined, so hashes that very many samples share make no pairs.
    """
    least = 0.0
    if max_distance < 1:
        e = math.exp(-k * max_distance)
        least = e / (2 - e)
    rows = classes.select("rep", F.size("sketch").alias("len"), F.explode("sketch").alias("hash"))
    frequency = rows.groupBy("hash").agg(F.count("*").alias("f"))
    rare = rows.join(frequency.filter("f > 1"), "hash")
    # a sketch's hashes that no other sample has need no join, but come first in its order of rarity
    shared = rare.groupBy("rep", "len").agg(F.sort_array(F.collect_list(F.struct("f", "hash"))).alias("by"))
    prefix = F.col("len") - F.greatest(F.ceil(F.lit(least * (1 - 1e-9)) * F.col("len")), F.lit(1)) + 1
    alone = F.col("len") - F.size("by")
    first = shared.select("rep", F.explode(F.slice("by", 1, F.greatest(prefix - alone, F.lit(0)).cast("int"))).alias("x")).select("rep", "x.hash")
    pairs = first.alias("p").join(first.alias("q"), F.expr("p.hash = q.hash and p.rep < q.rep")).select(F.col("p.rep").alias("a"), F.col("q.rep").alias("b")).distinct()
    left = classes.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("x"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.withColumn("u", F.slice(F.array_sort(F.array_union("x", "y")), 1, size))
    both = both.withColumn("shared", F.size(F.array_intersect(F.array_intersect("x", "y"), "u"))).withColumn("compared", F.size("u"))
    jaccard = F.col("shared") / F.col("compared")
    out = both.filter("shared > 0").withColumn("distance", F.round(mash_distance(jaccard, k), 9))
    return out.filter(F.col("distance") <= max_distance).select("a", "b", "n_a", "n_b", "shared", "compared", "distance")


def block_pairs(classes: DataFrame, k: int, size: int, max_distance: float, group: str | None = None, forest: bool = False) -> DataFrame:
    """As distance_pairs, of packed sketches, for distances at which very many pairs share hashes; group: only pairs inside one.

    classes is a written table. Neither shared hashes nor candidates are rows: classes are dealt into blocks, and a pair of
    blocks is one task, which counts what its pairs share from postings. Without a group the blocks are written, of a quarter
    of the classes if it is not for a forest, and read by the tasks of their pairs, so what is shuffled is each sketch once;
    within groups it is the sketches once for each block of theirs. In ascending order the i-th shared hash has place
    x + y - i in the union if x and y are its places in the sketches, so the `size` least of the union need no merging. Where
    max_distance says that few pairs can be near, only those whose rarest hashes meet are looked at, as in distance_pairs.

    forest leaves of each task's pairs a spanning forest of the nearest: at every distance up to max_distance the pairs left
    have the same connected components as all, and a task gives fewer pairs than it has classes.
    """
    ship(classes.sparkSession)
    least = 0.0
    if max_distance < 1:
        e = math.exp(-k * max_distance)
        least = e / (2 - e) * (1 - 1e-9)
    some = classes.filter(F.size("sketch") > 0).select((F.col(group) if group else F.lit(0)).alias("g"), "rep", "n", "sketch")
    names = ["a", "b", "n_a", "n_b", "shared", "compared"]

    def compared(part: pa.Table, mine: np.ndarray, one: int, two: int):
        lists = part.column("sketch").combine_chunks()
        values, length = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
        cross, left = one != two, np.equal(mine, one)
        right = ~left if cross else left
        owner = np.repeat(np.arange(len(length), dtype=np.int32), length)
        place = np.arange(1, len(values) + 1, dtype=np.int32)
        place -= np.repeat((np.cumsum(length) - length).astype(np.int32), length)
        order = np.argsort(values)
        ranked = values[order]
        code = np.empty(len(values), np.int32)  # a hash by its rank among those here
        code[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]), dtype=np.int32)
        del ranked, values, order
        found = by_prefix(code, owner, place, length, left, right) or by_count(code, owner, place, length, left, right)
        rep, n = part.column("rep").combine_chunks(), part.column("n").combine_chunks()

        def near():
            for a, b, common, seen in found:
                both = np.minimum(size, length[a] + length[b] - seen)
                keep = np.flatnonzero((common >= np.maximum(least * both, 1)) & (True if cross else a < b))
                yield a[keep], b[keep], common[keep], both[keep]

        for a, b, common, both in nearest_forest(near(), len(length)) if forest else near():
            x, y = pa.array(a), pa.array(b)
            yield pa.RecordBatch.from_arrays([rep.take(x), rep.take(y), n.take(x), n.take(y), pa.array(common.astype(np.int32)), pa.array(both.astype(np.int32))], names)

    def nearest_forest(pairs, nodes):
        """A spanning forest of the nearest pairs; when EDGES are held, those that it leaves out go."""
        held, n = [], 0

        def reduced():
            edges = [np.concatenate(c) for c in zip(*held)]
            above, left = list(range(nodes)), []
            for i in np.argsort(-edges[2] / edges[3], kind="stable").tolist():
                a, b = int(edges[0][i]), int(edges[1][i])
                while above[a] != a:
                    above[a] = a = above[above[a]]
                while above[b] != b:
                    above[b] = b = above[above[b]]
                if a != b:
                    above[a] = b
                    left.append(i)
            return tuple(c[left] for c in edges)

        for some in pairs:
            held, n = [*held, some], n + len(some[0])
            if n >= EDGES + nodes:
                held = [reduced()]
                n = len(held[0][0])
        return [reduced()] if n else []

    def by_count(code, owner, place, length, left, right):
        """(a, b, shared, seen in both) of all pairs that share a hash."""
        post, begin, many, mine, use, first, last = postings(code, owner, left, right)
        to, ids, width = (np.cumsum(right) - 1).astype(np.int32), np.flatnonzero(right), int(right.sum())
        post, post_place, height = to[owner[post]], place[post], max(1, CELLS // width)
        number, low = (np.uint16, 255) if size < 256 else (np.int64, (1 << 32) - 1)
        one, up = number(1), number(low + 1)
        for i in range(0, len(mine), height):
            start, stop = first[i : i + height], last[i : i + height]
            counts = np.zeros(len(start) * width, number)  # what both have in the low half, what counts in the high one
            for step in range(int((stop - start).max())):
                here = np.flatnonzero(start + step < stop)
                x = use[start[here] + step]
                cell, at = cells(here, x, code, begin, many, post, width)
                old = counts[cell]
                far = np.repeat(place[x], many[code[x]]) + post_place[at] - (old & number(low)) > size + 1
                counts[cell] = old + np.where(far, one, one + up)
            cell = np.flatnonzero(counts > low)
            yield mine[i + cell // width], ids[cell % width], counts[cell] // up, (counts[cell] & number(low)).astype(np.int64)

    def by_prefix(code, owner, place, length, left, right):
        """The same of pairs whose rarest hashes meet, as those within max_distance do; None if that saves little."""
        kinds = int(code.max()) + 1
        pad = np.arange(size, dtype=np.int32) + kinds
        rows = np.repeat(pad[None], len(length), 0)
        rows[owner, place - 1] = code
        often = np.append(np.bincount(code, minlength=kinds), np.full(size, len(owner) + 1))
        rare = np.sort(often[rows] << 32 | rows, axis=1)
        prefix = length - np.maximum(np.ceil(least * length), 1).astype(np.int64) + 1
        taken = np.arange(size) < prefix[:, None]
        few, few_owner = (rare[taken] & 0xFFFFFFFF).astype(np.int32), np.repeat(np.arange(len(length), dtype=np.int32), prefix)
        del rare, taken
        work = lambda c, o: int((np.bincount(c[left[o]], minlength=kinds) * np.bincount(c[right[o]], minlength=kinds)).sum())
        if work(few, few_owner) * 8 > work(code, owner):
            return None
        return verified(rows, pad, *postings(few, few_owner, left, right), few, few_owner, right)

    def verified(rows, pad, post, begin, many, mine, use, first, last, code, owner, right):
        to, ids, width = (np.cumsum(right) - 1).astype(np.int32), np.flatnonzero(right), int(right.sum())
        post, height = to[owner[post]], max(1, CELLS // width)
        at_most = np.arange(2, 2 * size + 1, dtype=np.int32) - size
        for i in range(0, len(mine), height):
            start, stop = first[i : i + height], last[i : i + height]
            x = use[start[0] : stop[-1]]
            cell, _ = cells(np.repeat(np.arange(len(start)), stop - start), x, code, begin, many, post, width)
            if len(cell) * 16 < len(start) * width:
                cell = np.unique(cell)
            else:
                mark = np.zeros(len(start) * width, bool)
                mark[cell] = True
                cell = np.flatnonzero(mark)
            for j in range(0, len(cell), MERGED // size):
                some = cell[j : j + MERGED // size]
                a, b = mine[i + some // width], ids[some % width]
                theirs = rows[b]
                theirs[theirs >= pad[0]] += size  # what fills up one sketch is not what fills up the other
                union = np.sort(np.concatenate([rows[a], theirs], axis=1), axis=1)
                same = union[:, 1:] == union[:, :-1]
                seen = np.cumsum(same, axis=1, dtype=np.int32)
                yield a, b, (same & (seen >= at_most)).sum(axis=1), seen[:, -1].astype(np.int64)

    def postings(code, owner, left, right):
        """Elements of the right side by hash, where each hash's begin, how many; classes of the left and their elements that meet any."""
        theirs = np.flatnonzero(right[owner])
        post = theirs[np.argsort(code[theirs], kind="stable")]
        many = np.bincount(code[theirs], minlength=int(code.max()) + 1)
        use = np.flatnonzero(left[owner] & (many[code] > int(left[owner[theirs[0]]] if len(theirs) else 0)))  # in order of owner, then hash
        mine, first = np.unique(owner[use], return_index=True)
        return post, np.cumsum(many) - many, many, mine, use, first, np.append(first[1:], len(use))

    def cells(row, x, code, begin, many, post, width):
        """(row and class of every posting of elements x, as one number; the postings)."""
        h = many[code[x]]
        ends = np.cumsum(h)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[code[x]] - ends + h, h)
        return np.repeat(row * width, h) + post[at], at

    def grouped(batches, width):
        """A table for all rows that agree in the first columns; they come one after the other."""
        held, key = [], None
        for batch in batches:
            keys = [batch.column(i).to_pylist() for i in range(width)]
            cuts = [i for i in range(batch.num_rows) if i == 0 or any(c[i] != c[i - 1] for c in keys)] + [batch.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                if (now := tuple(c[i] for c in keys)) != key:
                    if held:
                        yield pa.Table.from_batches(held)
                    held, key = [], now
                held.append(batch.slice(i, j - i))
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        for part in grouped(batches, 3):
            yield from compared(part, part.column("mine").to_numpy(), part.column("one")[0].as_py(), part.column("two")[0].as_py())

    def packed(batches):
        for part in grouped(batches, 1):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, part.drop_columns("mine").schema) as stream:
                stream.write_table(part.drop_columns("mine"))
            yield pa.RecordBatch.from_arrays([pa.array([part.column("mine")[0].as_py()], pa.int32()), pa.array([out.getvalue().to_pybytes()])], ["mine", "block"])

    def met(batches):
        for batch in batches:
            for one, left, two, right in zip(*batch.columns):
                give_back()
                sides = {one.as_py(): left, two.as_py(): right}
                parts = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in sides.values()]
                yield from compared(pa.concat_tables(parts), np.repeat(list(sides), [len(p) for p in parts]), one.as_py(), two.as_py())

    if group:
        blocks = F.when(F.col("c") > SMALL, F.greatest(F.ceil(F.col("c") / BLOCK), F.lit(BLOCKS))).otherwise(1).cast("int").alias("blocks")
        rows = split_join(some, some.groupBy("g").agg(F.count("*").alias("c")).filter("c > 1").select("g", blocks), "g", "rep")
        rows = rows.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        tasks = rows.select("g", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"), "mine", "rep", "n", "sketch")
        tasks = tasks.repartition("g", "one", "two").sortWithinPartitions("g", "one", "two")
    else:
        count = some.count()
        blocks = max(math.ceil((1 if forest else 4) * count / BLOCK), math.ceil(count * size / HASHES), BLOCKS) if count > SMALL else 1
        rows = some.select(F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int").alias("mine"), "rep", "n", "sketch")
        written = kept(rows.repartition("mine").sortWithinPartitions("mine").mapInArrow(packed, "mine int, block binary"), "blocks", maxRecordsPerFile=1)
        left, right = (written.select(F.col("mine").alias(x), F.col("block").alias(f"block_{x}")) for x in ("one", "two"))
        tasks = left.join(right.hint("shuffle_replicate_nl"), F.expr("one <= two"))

    kind = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    found = tasks.mapInArrow(run if group else met, f"a {kind['rep']}, b {kind['rep']}, n_a {kind['n']}, n_b {kind['n']}, shared int, compared int")
    turned = F.col("a") > F.col("b")
    ends = [F.when(turned, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("a", "b"), ("b", "a"), ("n_a", "n_b"), ("n_b", "n_a"))]
    out = found.select(*ends, "shared", "compared", F.round(mash_distance(F.col("shared") / F.col("compared"), k), 9).alias("distance"))
    return out.filter(F.col("distance") <= max_distance)


def edges_within(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs at most `threshold` apart; a threshold of 0 is honoured."""
    return pairs.filter((F.col("distance") <= threshold) & (F.col("a") != F.col("b"))).select("a", "b", "distance")


def symmetric(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """(ref, query, distance): both directions of every pair and a zero diagonal; missing pairs are not listed."""
    forth = pairs.select(F.col("a").alias("ref"), F.col("b").alias("query"), "distance")
    back = pairs.select(F.col("b").alias("ref"), F.col("a").alias("query"), "distance")
    diagonal = names.select(F.col(names.columns[0]).alias("ref"), F.col(names.columns[0]).alias("query"), F.lit(0.0).alias("distance"))
    return forth.filter("ref <> query").unionByName(back.filter("ref <> query")).unionByName(diagonal)
