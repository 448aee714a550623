"""Repeated passages across documents, by sparse suffixes and exact windows.

A passage is PASSAGE or more consecutive words (0-9, a-z with A-Z lower-cased, characters beyond ASCII) that also
occur in another document. A document is a doc_id and a text: rows of one doc_id with different texts are different
documents.

1. Suffixes are kept at minimisers: of every WINDOW adjacent runs of GRAM words, the one with the least hash. The
   choice depends on content only, so every window of PASSAGE words has a kept suffix, no later than REACH words
   after its beginning, that shares its first KEY words with the window's other occurrences.
2. Suffixes are put in order of their first KEY words by a range sort that may split a key, and only those with an
   equal neighbour stay. Exact copies of a text take part once, by the text's digest.
3. Every window of PASSAGE words whose kept suffix stayed is hashed whole and put in order of that hash by a range sort
   that may split a window's rows; those in two or more documents are matches. So no candidate is left out, however many
   documents share a line or a key: they meet only where all PASSAGE words are equal, each costs one row, and a range
   that holds only one document's rows of a window is told by one row whether another range has others. Passages are the
   unions of the windows.

Two different windows count as equal where their 64-bit hashes are, two texts where 64 bits of their digests are.

Edge cases: null texts and texts of fewer than PASSAGE words have no passages; a text that occurs in several
documents is a passage from end to end; repeats inside one document alone do not count; rows without doc_id are left
out; rows of equal doc_id and text are one document; other columns are ignored; an empty table gives no rows. A very long
text is worked on alone, and its own matches meet in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import split_join
from ..plans.shared import kept
from .common import in_arrow, spread, table
from .words import Words, mix, runs

PASSAGE, GRAM, WINDOW = 50, 8, 34
#: A window's kept suffix begins at most REACH words in, so KEY words of it are inside.
REACH = WINDOW - 1
KEY = PASSAGE - REACH


def _least(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Every place with WINDOW runs of GRAM words from there on, and the place of the least run among them."""
    gram, _ = runs(w.hashes, w.offsets, GRAM)
    n, span = len(gram), WINDOW + GRAM - 1
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = np.repeat(w.offsets[1:], np.diff(w.offsets))
    rank = mix(gram ^ np.uint64(0x5DEECE66D))
    least = sliding_window_view(rank, WINDOW).argmin(axis=1)
    begin = np.flatnonzero(np.arange(len(least)) + span <= last[: len(least)])
    return begin, begin + least[begin]


def minimisers(w: Words) -> np.ndarray:
    """Word positions of the kept suffixes that have KEY words."""
    at = np.unique(_least(w)[1])
    last = np.repeat(w.offsets[1:], np.diff(w.offsets))
    return at[at + KEY <= last[at]]


def _keys(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for j in range(KEY):
        out = mix(out + hashes[at + j] * np.uint64(2 * j + 1))
    return out


def _digest(text: str = "text"):
    """64 bits of a text's digest."""
    return F.conv(F.substring(F.md5(F.col(text).cast("binary")), 1, 15), 16, 10).cast("bigint")


def suffixes(texts: DataFrame) -> DataFrame:
    """(key, digest, pos) of every kept suffix; texts: digest, text."""

    def run(batches):
        for batch in batches:
            w = Words(batch.column(1).to_pylist())
            at = minimisers(w)
            owner = np.searchsorted(w.offsets, at, side="right") - 1
            digest = batch.column(0).to_numpy()[owner]
            yield pa.RecordBatch.from_arrays([pa.array(_keys(w.hashes, at).view(np.int64)), pa.array(digest, pa.int64()), pa.array((at - w.offsets[owner]).astype(np.int32))], ["key", "digest", "pos"])

    return in_arrow(texts, run, "key bigint, digest bigint, pos int")


def with_equal_neighbour(found: DataFrame) -> DataFrame:
    """The suffixes whose key occurs again, however often; first and last of a range stay in any case."""
    ranged = found.select("key", "digest", "pos").repartitionByRange("key", "digest", "pos").sortWithinPartitions("key", "digest", "pos")

    def run(batches):
        def out(key, digest, pos):
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(digest, pa.int64()), pa.array(pos, pa.int32())], ["key", "digest", "pos"])

        last = None  # a row whose neighbour is still unknown: key, digest, pos, whether it stays
        for batch in batches:
            key, digest, pos = (batch.column(i).to_numpy() for i in range(3))
            if not len(key):
                continue
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            new[0] = last is None or key[0] != last[0]
            again = np.append(~new[1:], False)  # the next row has the same key
            stay = ~new | again
            if last is not None and (not new[0] or last[3]):
                yield out(*([v] for v in last[:3]))
            if last is None:
                stay[0] = True
            body = np.flatnonzero(stay[:-1])
            if len(body):
                yield out(key[body], digest[body], pos[body])
            last = (key[-1], digest[-1], pos[-1], bool(stay[-1]))
        if last is not None:
            yield out(*([v] for v in last[:3]))

    return in_arrow(ranged, run, "key bigint, digest bigint, pos int")


def _window_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hash of the PASSAGE words from every word on, put together from runs of 1, 2, 4, ... words."""
    ahead = lambda x, k: np.append(x[k:], np.zeros(min(k, len(x)), np.uint64))
    out, done, part, width = np.zeros(len(hashes), np.uint64), 0, hashes, 1
    while width <= PASSAGE:
        if PASSAGE & width:
            out = mix(out + ahead(part, done) * np.uint64(2 * width + 1))
            done += width
        part = mix(part + ahead(part, width) * np.uint64(5))
        width *= 2
    return out


def windows(rows: DataFrame) -> DataFrame:
    """(window, doc_id, digest, begin): hash and place of the passage-long windows whose kept suffix is listed.

    rows: doc_id, text, places (array of the listed suffixes' pos), digest; a text that is repeated in a task counts once.
    """

    def run(batches):
        seen = set()
        for batch in batches:
            digests = batch.column(3).to_pylist()
            fresh = [i for i, d in enumerate(digests) if not (d in seen or seen.add(d))]
            batch = batch.take(pa.array(fresh, pa.int64()))
            w, lists = Words(batch.column(1).to_pylist()), batch.column(2)
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            listed = np.zeros(len(w.hashes), bool)
            listed[w.offsets[owner] + lists.flatten().to_numpy()] = True
            begin, least = _least(w)
            last = np.repeat(w.offsets[1:], np.diff(w.offsets))
            begin = begin[listed[least] & (begin + PASSAGE <= last[begin])]
            owner = np.searchsorted(w.offsets, begin, side="right") - 1
            doc, digest = batch.column(0).to_numpy()[owner], batch.column(3).to_numpy()[owner]
            yield pa.RecordBatch.from_arrays([pa.array(_window_hashes(w.hashes)[begin].view(np.int64)), pa.array(doc, pa.int64()), pa.array(digest, pa.int64()), pa.array((begin - w.offsets[owner]).astype(np.int32))], ["window", "doc_id", "digest", "begin"])

    return in_arrow(rows, run, "window bigint, doc_id bigint, digest bigint, begin int")


PLACE = ["doc_id", "digest", "begin"]
MATCH = "window bigint, doc_id bigint, digest bigint, begin int, other_doc_id bigint, other_begin int, other_digest bigint, edge boolean"
_MATCH = pa.schema([("window", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.int64()), ("begin", pa.int32()), ("other_doc_id", pa.int64()), ("other_begin", pa.int32()), ("other_digest", pa.int64()), ("edge", pa.bool_())])


def _within_ranges(batches):
    """Rows of MATCH for sorted rows (window, doc_id, digest, begin) of one range.

    A row's partner is the window's first place in the range, or its first place in a second document. Edge rows have no
    partner: all rows of a window that the range's border may cut and that has one document here, and one row (or one
    of each of two documents) of every such window.
    """

    def out(rows, other, edge):
        columns = [x[rows] for x in held]
        partner = [pa.nulls(len(rows), t) if other is None else pa.array(held[k][other], t) for k, t in ((1, pa.int64()), (3, pa.int32()), (2, pa.int64()))]
        return pa.RecordBatch.from_arrays([pa.array(columns[0]), *(pa.array(columns[k]) for k in (1, 2, 3)), *partner, pa.array(np.full(len(rows), edge))], schema=_MATCH)

    # of the last window so far: its first two documents' first rows, or all rows of its only document
    held, sent, opening, more = [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int32)], 0, True, []
    for batch in batches:
        if not batch.num_rows:
            continue
        more.append([batch.column(i).to_numpy() for i in range(4)])
        if not sent and len(held[0]) and all((x == h[0]).all() for x, h in zip(more[-1][:3], held)):
            continue  # nothing but the same window of the same document: put together once, when another comes
        held, more = [np.concatenate(x) for x in zip(held, *more)], []
        window, doc, digest, _ = held
        new = np.append(True, window[1:] != window[:-1])
        group, starts = np.cumsum(new) - 1, np.flatnonzero(new)
        first = starts[group]
        beyond = (doc != doc[first]) | (digest != digest[first])
        seconds = np.flatnonzero(beyond & ~np.append(False, beyond[:-1]))
        second = np.full(len(starts), -1)
        second[group[seconds]] = seconds
        other = np.where(beyond, first, second[group])
        rows = np.flatnonzero(other >= 0)
        rows = rows[rows >= sent]
        if len(rows):
            yield out(rows, other[rows], False)
        if opening and len(starts) > 1:  # the range's first window is complete
            at = np.array([starts[0], second[0]]) if second[0] >= 0 else np.arange(starts[0], starts[1])
            yield out(at, None, True)
            opening = False
        at, sent = (np.array([starts[-1], second[-1]]), 2) if second[-1] >= 0 else (np.arange(starts[-1], len(window)), 0)
        held = [x[at] for x in held]
    held = [np.concatenate(x) for x in zip(held, *more)]
    if len(held[0]):
        yield out(np.arange(len(held[0])), None, True)


def matches(found: DataFrame) -> DataFrame:
    """(doc_id, digest, begin, other_doc_id, other_digest, other_begin) of every window that another document has too."""
    order = ["window", *PLACE]
    ranged = found.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = kept(in_arrow(ranged, _within_ranges, MATCH), "matches")
    inside = rows.filter("not edge").drop("window", "edge")
    # windows at the borders of ranges: few rows, for each range those of two windows
    edges = rows.filter("edge").select(*order).repartition("window").sortWithinPartitions(*order)
    across = in_arrow(edges, _within_ranges, MATCH).filter("not edge").drop("window", "edge")
    return inside.unionByName(across)


def merged(spans: DataFrame) -> DataFrame:
    """One row per text: digest, n_repeated words and passages, the disjoint unions of its matches.

    A passage names the partner of its first match, the longest there; they share PASSAGE words at least.
    """
    names = ["digest", "begin", "end", "other_doc_id", "other_begin"]
    fields = names[1:]
    dealt = spans.select(*names).repartition("digest").sortWithinPartitions("digest", "begin", F.desc("end"), "other_doc_id", "other_begin")
    kind = "array<struct<begin:bigint,end:bigint,other_doc_id:bigint,other_begin:bigint>>"
    arrow = pa.list_(pa.struct([(n, pa.int64()) for n in fields]))

    def out(docs):
        sizes = [sum(p["end"] - p["begin"] for p in x) for _, x in docs]
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in docs], pa.int64()), pa.array(sizes, pa.int64()), pa.array([x for _, x in docs], arrow)], ["digest", "n_repeated", "passages"])

    def run(batches):
        docs: list[tuple[int, list[dict]]] = []  # the last may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, begin, end = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
            new = np.append(True, doc[1:] != doc[:-1])
            # the farthest end so far within each text
            rank = np.cumsum(new) << 40
            if docs and docs[-1][0] == doc[0]:
                end[0] = max(end[0], docs[-1][1][-1]["end"])
            far = np.maximum.accumulate(rank + end) - rank
            starts = np.flatnonzero(new | np.append(True, begin[1:] > far[:-1]))
            ends = far[np.append(starts[1:], len(doc)) - 1]
            for row, stop in zip(batch.take(pa.array(starts)).to_pylist(), ends.tolist()):
                if not docs or docs[-1][0] != row["digest"]:
                    if len(docs) >= 1000:
                        yield out(docs)
                        docs = []
                    docs.append((row["digest"], []))
                all_ = docs[-1][1]
                if all_ and row["begin"] <= all_[-1]["end"]:
                    all_[-1]["end"] = max(all_[-1]["end"], stop)
                else:
                    all_.append({n: row[n] for n in fields} | {"end": stop})
        if docs:
            yield out(docs)

    return in_arrow(dealt, run, f"digest bigint, n_repeated bigint, passages {kind}")


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_repeated, passages) of every document with a passage that another document has too."""
    small = docs.filter(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
    small = small.select(F.col(doc_id).cast("bigint").alias("doc_id"), _digest(text).alias("digest"), F.col(text).alias("text"))

    def count(batches):
        for batch in batches:
            sizes = np.diff(Words(batch.column(2).to_pylist()).offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], ["doc_id", "digest", "n_words"])

    ids = kept(in_arrow(spread(small), count, "doc_id bigint, digest bigint, n_words bigint"), "ids")
    classes = ids.filter(F.col("n_words") >= PASSAGE).groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.first("n_words").alias("n_words")
    )
    classes = kept(classes, "classes")
    found = kept(suffixes(spread(small.select("digest", "text"))).distinct(), "suffixes")
    listed = with_equal_neighbour(found).groupBy("digest").agg(F.collect_set("pos").alias("places"))
    texts = listed.join(classes.select(F.col("rep").alias("doc_id"), "digest"), "digest").join(small, ["doc_id", "digest"])
    spans = matches(windows(texts.select("doc_id", "text", "places", "digest")))
    spans = spans.withColumn("end", F.col("begin") + PASSAGE).select("digest", *(F.col(c).cast("bigint") for c in ("begin", "end", "other_doc_id", "other_begin")))
    one = merged(spans)
    # a text of several documents is a passage from end to end, for each of them; another text's passages are its own
    several = classes.filter("last <> rep")
    alone = one.join(several.select("digest"), "digest", "left_anti").join(classes.select("digest", F.col("rep").alias("doc_id")), "digest").select("doc_id", "n_repeated", "passages")
    copies = split_join(ids.select("doc_id", "digest").distinct(), several, "digest", "doc_id", counted=ids)
    other = F.when(F.col("doc_id") == F.col("rep"), F.col("last")).otherwise(F.col("rep"))
    zero = F.lit(0).cast("bigint")
    whole = F.array(F.struct(zero.alias("begin"), F.col("n_words").alias("end"), other.alias("other_doc_id"), zero.alias("other_begin")))
    return alone.unionByName(copies.select("doc_id", F.col("n_words").alias("n_repeated"), whole.alias("passages")))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
