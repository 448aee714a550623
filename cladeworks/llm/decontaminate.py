"""Benchmark decontamination with suffix arrays over the training texts.

Every batch of documents is a shard with a word-level suffix array of its own: the suffixes in lexicographic order
of their first WINDOW words. Only suffixes that begin with two adjacent words of some test item are kept, as no
other can match two words of the test set. Every suffix of every test item is looked up by binary search, column
by column, and the range it ends in gives all places of the match. Matches on one diagonal join into the longest
verbatim match. Shards need no shuffle; the test set is sent to them in blocks of a checked size.

Words are the runs of 0-9, a-z (A-Z lower-cased) and all characters beyond ASCII. An item of fewer words than a
window, but not none, is one window. Edge cases: a null or empty text has no words and no hits; a null or empty item
matches nothing; equal items each count; an item with a null id marks words but is not listed; an empty test set
leaves all documents clean; columns of the input named like the added ones are replaced.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, spread, table, worker_cache
from .words import Words

WINDOW = 10
#: Bytes of test text that one pass holds; a larger test set takes several passes.
BLOCK_BYTES = 32 << 20


class TestSet:
    """A block of test items: its distinct windows and which items have them."""

    def __init__(self, ids: list, texts: list[str | None], window: int):
        w = Words(texts)
        self.window = window
        self.vocabulary, word_ids = np.unique(w.hashes, return_inverse=True)
        rows, items, offsets = [], [], []
        for k, (a, b) in enumerate(zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist())):
            size = min(window, b - a)
            for i in range(a, b - size + 1 if size else a):
                row = np.zeros(window, np.int64)
                row[:size] = word_ids[i : i + size] + 1
                rows.append(row)
                items.append(k)
                offsets.append(i - a)
        grid = np.array(rows, np.int64).reshape(-1, window)
        self.suffixes, inverse = np.unique(grid, axis=0, return_inverse=True)
        self.sizes = (self.suffixes > 0).sum(axis=1)
        order = np.argsort(inverse.ravel(), kind="stable")
        self.items, self.offsets = np.array(items, np.int64)[order], np.array(offsets, np.int64)[order]
        self.bounds = np.searchsorted(inverse.ravel()[order], np.arange(len(self.suffixes) + 1))
        self.ids = ids
        pairs = self.suffixes[:, 0] * (len(self.vocabulary) + 1) + (self.suffixes[:, 1] if window > 1 else 0)
        self.pairs = np.unique(pairs[self.sizes > 1])
        self.alone = np.unique(self.suffixes[self.sizes == 1, 0])
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.vocabulary & np.uint64((1 << 20) - 1)] = True

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """1-based place in the vocabulary, 0 for words that no item has."""
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.sieve[hashes & np.uint64((1 << 20) - 1)])
        if len(maybe) and len(self.vocabulary):
            at = np.minimum(np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1)
            good = self.vocabulary[at] == hashes[maybe]
            out[maybe[good]] = at[good] + 1
        return out

    def matches(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word position, window) of every occurrence of a window in the shard."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        n, width = len(w.hashes), self.window
        if not n or not len(self.suffixes):
            return none
        ids = np.concatenate([self.word_ids(w.hashes), np.zeros(width, np.int64)])
        last = np.repeat(w.offsets[1:], np.diff(w.offsets))
        here = np.flatnonzero(ids[:n])
        second = np.where(here + 1 < last[here], ids[here + 1], 0)
        pair = ids[here] * (len(self.vocabulary) + 1) + second
        keep = np.isin(pair, self.pairs) & (second > 0)
        if len(self.alone):
            keep |= np.isin(ids[here], self.alone)
        here = here[keep]
        if not len(here):
            return none
        columns = [np.where(here + j < last[here], ids[np.minimum(here + j, n)], 0) for j in range(width)]
        order = np.lexsort(columns[::-1])
        suffix_array, columns = here[order], [c[order] for c in columns]
        low, high = np.zeros(len(self.suffixes), np.int64), np.full(len(self.suffixes), len(order), np.int64)
        for j, column in enumerate(columns):
            live = np.flatnonzero((self.sizes > j) & (low < high))
            wanted = self.suffixes[live, j]
            low[live], high[live] = (
                _bisect(column, low[live], high[live], wanted),
                _bisect(column, low[live], high[live], wanted + 1),
            )
        found = high - low
        window = np.repeat(np.arange(len(found)), found)
        begin = np.repeat(low - np.concatenate([[0], np.cumsum(found)[:-1]]), found)
        return suffix_array[begin + np.arange(len(window))], window


def _bisect(column: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """First place in each [low, high) whose value is not below wanted."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        less = open_ & (column[np.minimum(middle, len(column) - 1)] < wanted)
        low = np.where(less, middle + 1, low)
        high = np.where(open_ & ~less, middle, high)
    return low


def longest(position: np.ndarray, item: np.ndarray, offset: np.ndarray, size: np.ndarray):
    """Join matches of one item on one diagonal: (begin, end, item) of maximal verbatim matches."""
    order = np.lexsort((position, position - offset, item))
    position, item, offset, size = position[order], item[order], offset[order], size[order]
    new = np.ones(len(order), bool)
    new[1:] = (item[1:] != item[:-1]) | (np.diff(position - offset) != 0) | (np.diff(position) != 1)
    stop = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(order) - 1]]) if len(order) else np.zeros(0, np.int64)
    return position[new], position[stop] + size[stop], item[new]


def _blocks(test: DataFrame, item_id: str, text: str, block_bytes: int):
    """The test items in blocks of about block_bytes, each small enough to hold."""
    size = test.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    n = max(1, -(-int(size) // block_bytes))
    for k in range(n):
        part = test if n == 1 else test.filter(F.pmod(F.xxhash64(item_id, text), F.lit(n)) == k)
        yield part.select(F.col(item_id).alias("item"), F.col(text).alias("text")).toPandas()


def decontaminate(
    docs: DataFrame, test: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """docs plus n_words, n_hit, items (sorted ids of items with a match) and matches.

    matches: array of (begin, end, item), word positions of maximal verbatim matches of at least a window.
    """
    added = ("n_words", "n_hit", "items", "matches")
    fields = [f for f in docs.schema.fields if f.name not in added]
    item_type = test.schema[item_id].dataType.simpleString()
    kind = f"array<struct<begin:bigint,end:bigint,item:{item_type}>>"
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    out = docs.select(*[F.col(f"`{f.name}`") for f in fields], F.lit(0).cast("bigint").alias("n_words"), F.expr(f"cast(array() as {kind})").alias("matches"))
    for block in _blocks(test, item_id, text, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(([None if v != v else v for v in block["item"].tolist()], block["text"].tolist()))

        key = ("test set", uuid.uuid4().hex)

        def run(batches, sent=sent, key=key):
            tests = worker_cache(key, lambda: TestSet(*sent.value, window))
            for batch in batches:
                yield _matched(batch, tests, text)

        out = in_arrow(out, run, f"{names}, n_words bigint, matches {kind}", key)
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["begin"].alias("b"), m["end"].alias("e"))))
    # words in the union of spans: each span adds what lies beyond the reach of those before it
    reach = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("r")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["e"] - F.greatest(a["r"], s["b"]))).alias("n"), F.greatest(a["r"], s["e"]).alias("r")),
        lambda a: a["n"],
    )
    items = F.array_compact(F.array_distinct(F.transform("matches", lambda m: m["item"])))
    return out.withColumn("n_hit", reach).withColumn("items", F.array_sort(items))


def _matched(batch: pa.RecordBatch, tests: TestSet, text: str) -> pa.RecordBatch:
    names = batch.schema.names
    w = Words(batch.column(names.index(text)).to_pylist())
    position, window = tests.matches(w)
    count = tests.bounds[window + 1] - tests.bounds[window]
    at = np.repeat(tests.bounds[window] - np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else count, count) + np.arange(count.sum())
    item, position, window = tests.items[at], np.repeat(position, count), np.repeat(window, count)
    begin, end, item = longest(position, item, tests.offsets[at], tests.sizes[window])
    owner = np.searchsorted(w.offsets, begin, side="right") - 1
    order = np.lexsort((item, begin, owner))
    begin, end, item, owner = begin[order], end[order], item[order], owner[order]
    cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
    shift = w.offsets[owner]
    kind = batch.schema.field(names.index("matches")).type
    ids = pa.array(tests.ids, kind.value_type.field("item").type)
    values = pa.StructArray.from_arrays([pa.array(begin - shift), pa.array(end - shift), ids.take(pa.array(item))], fields=[kind.value_type.field(i) for i in range(3)])
    fresh = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values, type=kind)
    before = batch.column(names.index("matches"))
    if len(before.flatten()):
        fresh = pa.array([a + b for a, b in zip(before.to_pylist(), fresh.to_pylist())], kind)
    arrays = [batch.column(i) for i in range(batch.num_columns)]
    arrays[names.index("matches")], arrays[names.index("n_words")] = fresh, pa.array(np.diff(w.offsets), pa.int64())
    return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
