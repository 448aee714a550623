"""Toxicity by class-conditional Kneser-Ney models.

Symbols are the bytes of words (0-9, a-z with A-Z lower-cased, all beyond ASCII) and one boundary after each word;
contexts are the ORDER - 1 symbols before, not beyond the word. Each class, toxic and ordinary, has an interpolated
Kneser-Ney model whose highest order is counted on that class's labelled documents. Both share all lower orders:
continuation counts (in how many distinct contexts an expression occurs) gathered from every document, so that an
expression too rare for one class is judged alike by both. Where a class has not seen a context it backs off
entirely, and the shared part cancels in the comparison.

A document's toxic and ordinary log-likelihoods are compared word by word and normalised by its number of words:
mean difference, mean excess over two margins, share and number of words beyond two margins, the largest
difference. A logistic calibration turns these into a score. It is fitted on documents scored by models of
the other half of the labelled sample, so no document is judged by counts of itself.

The labelled sample is bounded (labelled.MAX_LABELLED rows, MAX_BYTES of texts) and leaves out the held-out fold; what is
gathered from the corpus is not: counts of all lower orders are of all expressions in all documents, and grow with
them. Only the probabilities of the sample's own n-grams are looked up in them, so the model is bounded by the sample.

Edge cases: null and empty texts, and texts without words, are scored like a text of no evidence; without labels of
both kinds every score is the prior; repeated rows get equal scores; added columns replace those of the input.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_codec import mapped
from ..plans.shared import kept
from .common import in_arrow, spread, table
from .labelled import MAX_LABELLED, fold, label_sample, labelled_documents
from .words import ALNUM

ORDER, DISCOUNT = 6, 0.75
FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
#: Bytes of text that are turned into n-grams at once, and distinct n-grams that a task holds before sending them.
PIECE, MOST_HELD = 1 << 20, 1 << 20
FEATURES = 8
#: Symbols of the longest expressions whose probabilities the driver computes.
SHORT = 2
#: Bytes of the sample's texts, and so its n-grams at most.
MAX_BYTES = 16 << 20
_BYTE = np.uint64(8)


def pieces(texts: list[str | None]):
    """Blocks of (owner of each part, parts as bytes) of at most about PIECE bytes; long texts are cut at a space."""
    owners, parts, size = [], [], 0
    for k, text in enumerate(texts):
        raw, at = (text or "").lower().encode(), 0
        while at < len(raw):
            cut = len(raw) if len(raw) - at <= PIECE else raw.rfind(b" ", at + 1, at + PIECE)
            cut = cut if cut > at else min(len(raw), at + PIECE)
            owners.append(k)
            parts.append(raw[at:cut])
            size += cut - at + 1
            at = cut
            if size >= PIECE:
                yield owners, parts
                owners, parts, size = [], [], 0
    if parts:
        yield owners, parts


def grams(owners: list[int], parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram, owner, whether it ends a word) at every symbol; byte k of an n-gram is the k-th symbol back."""
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    owner = np.repeat(np.array(owners), [len(p) + 1 for p in parts])
    inside = ALNUM[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    symbol, owner = np.where(inside, data, 0)[keep].astype(np.uint64), owner[keep]
    out, open_ = symbol.copy(), np.ones(len(symbol), bool)
    for k in range(1, ORDER):
        back = np.zeros_like(symbol)
        back[k:] = symbol[:-k]
        out |= np.where(open_, back, 0).astype(np.uint64) << np.uint64(8 * k)
        open_ &= back != 0
    return out, owner, symbol == 0


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted value in sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


@dataclass
class Ratio:
    """Log of toxic over ordinary probability: by n-gram, else by context, else 0."""

    keys: np.ndarray
    values: np.ndarray
    contexts: np.ndarray
    defaults: np.ndarray

    def words(self, found: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The summed log ratio of every word; ends marks the last symbol of each."""
        at, known = _lookup(self.keys, found)
        x = np.zeros(len(found))
        x[known] = self.values[at[known]]
        rest = np.flatnonzero(~known)
        at, known = _lookup(self.contexts, found[rest] >> _BYTE)
        x[rest[known]] = self.defaults[at[known]]
        return np.add.reduceat(x, np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1])) if len(x) else x


def ratio(keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, shared: np.ndarray) -> Ratio:
    """Compare the two class models given the counts of each n-gram and its shared lower-order probability."""
    contexts, c = np.unique(keys >> _BYTE, return_inverse=True)
    logs, backoff = [], []
    for count in (toxic.astype(float), ordinary.astype(float)):
        total, types = np.bincount(c, count, len(contexts)), np.bincount(c, count > 0, len(contexts))
        back = np.where(total > 0, DISCOUNT * types / np.maximum(total, 1), 1.0)
        logs.append(np.log(np.maximum(count - DISCOUNT, 0) / np.maximum(total[c], 1) + back[c] * shared))
        backoff.append(np.log(back))
    return Ratio(keys, (logs[0] - logs[1]).astype(np.float32), contexts, (backoff[0] - backoff[1]).astype(np.float32))


def evidence(texts: list[str | None], model: Ratio) -> np.ndarray:
    """The compared log-likelihoods of each text, FEATURES columns."""
    n = len(texts)
    sums, most, words = np.zeros((n, 5)), np.full(n, -50.0), np.zeros(n)
    for owners, parts in pieces(texts):
        found, owner, ends = grams(owners, parts)
        if not len(found):
            continue
        x, owner = model.words(found, ends), owner[ends]
        for k, v in enumerate((x, np.maximum(x - 2, 0), np.maximum(x - 4, 0), x > 4, x > 6)):
            sums[:, k] += np.bincount(owner, v, n)
        words += np.bincount(owner, minlength=n)
        np.maximum.at(most, owner, x)
    most[words == 0] = 0
    return np.column_stack([sums / np.maximum(words, 1)[:, None], sums[:, 3:], most])


@dataclass
class Toxicity:
    model: Ratio
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(texts), self.prior)
        z = (evidence(texts, self.model) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + z @ self.weights[1:], -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, steps: int = 60) -> np.ndarray:
    """Weights (intercept first) of a penalised logistic regression, by Newton's method."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + penalty * np.eye(len(w))
        w += np.linalg.solve(hessian, z.T @ (y - p) - penalty * w)
    return w


def _class_counts(rows: DataFrame) -> DataFrame:
    """Counts of each n-gram by label and half of the sample; counted in each task, summed after."""

    def run(batches):
        for batch in batches:
            label, half = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for owners, parts in pieces(batch.column(1).to_pylist()):
                found, owner, _ = grams(owners, parts)
                group = 2 * label[owner] + half[owner]
                for g in range(4):
                    keys, counts = np.unique(found[group == g], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.astype(np.int64)), pa.array(np.full(len(keys), g, np.int32)), pa.array(counts)], ["gram", "part", "n"]
                    )

    return in_arrow(rows, run, "gram bigint, part int, n bigint").groupBy("gram").pivot("part", [0, 1, 2, 3]).agg(F.sum("n"))


def continuations(docs: DataFrame) -> list[DataFrame]:
    """Of orders 1 to ORDER - 1, (expression, n): in how many contexts each expression occurs, over all documents.

    A task sends each n-gram once for every MOST_HELD distinct ones it meets; all else are counts by key.
    """

    def run(batches):
        held: list[np.ndarray] = []
        size = 0
        rows = lambda x: pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64))], ["gram"])
        for batch in batches:
            for owners, parts in pieces(batch.column(0).to_pylist()):
                held.append(np.unique(grams(owners, parts)[0]))
                size += len(held[-1])
                if size > 2 * MOST_HELD:
                    held = [np.unique(np.concatenate(held))]
                    if (size := len(held[0])) > MOST_HELD:
                        yield rows(held[0])
                        held, size = [], 0
        if held:
            yield rows(np.unique(np.concatenate(held)))

    whole = in_arrow(docs.select("text"), run, "gram bigint").distinct()
    orders = [kept(_shorter(whole.withColumnRenamed("gram", "expression"), ORDER - 1), "continuations")]
    for order in range(ORDER - 2, 0, -1):  # an expression's contexts are the expressions of one symbol more that end in it
        orders.append(kept(_shorter(orders[-1], order), "continuations"))
    return orders[::-1]


def _last(expression: str, order: int) -> Column:
    """The last `order` symbols."""
    return F.col(expression).bitwiseAND(F.lit((1 << 8 * order) - 1))


def _shorter(expressions: DataFrame, order: int) -> DataFrame:
    return expressions.groupBy(_last("expression", order).alias("expression")).agg(F.count("*").alias("n"))


def _interpolated(rows: pa.Table, orders: range, below: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Expressions, sorted, and probabilities of the last of some orders, given those of the order below the first."""
    every = {name: rows.column(name).to_numpy() for name in ("order", "expression", "n", "total", "types")}
    for order in orders:
        expression, n, total, types = (every[name][every["order"] == order] for name in ("expression", "n", "total", "types"))
        lower = 1 / 256 if below is None else below[1][_lookup(below[0], expression & ((1 << 8 * (order - 1)) - 1))[0]]
        shared = (np.maximum(n - DISCOUNT, 0) + DISCOUNT * types * lower) / total
        at = np.argsort(expression)
        below = expression[at], shared[at]
    return below


def shared_probabilities(wanted: DataFrame, orders: list[DataFrame]) -> DataFrame:
    """(expression, shared): interpolated Kneser-Ney probability of the last symbol of each wanted expression.

    wanted: expression, of the highest of the orders (see continuations). Only what is wanted is joined, all orders at once,
    as the driver keeps some memory for every exchange of a plan. Orders up to SHORT, at most 256 ** SHORT expressions, are
    interpolated by the driver; of the longer ones, those that end alike meet in one task.
    """
    numbered = [counts.select(F.lit(order).alias("order"), "expression", "n") for order, counts in enumerate(orders, 1)]
    counts = reduce(DataFrame.unionByName, numbered)
    every = F.array(*(F.struct(F.lit(order).alias("order"), _last("expression", order).alias("expression")) for order in range(1, len(orders) + 1)))
    need = wanted.select(F.inline(every)).distinct()
    context = F.shiftright("expression", 8).alias("context")
    contexts = counts.groupBy("order", context).agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    rows = need.join(counts, ["order", "expression"]).select("order", "expression", "n", context).join(contexts, ["order", "context"])
    rows = kept(rows.select("order", "expression", "n", "total", "types"), "wanted")
    short = _interpolated(rows.filter(F.col("order") <= SHORT).toArrow(), range(1, SHORT + 1), None)
    long = range(SHORT + 1, len(orders) + 1)

    def run(batches):
        if held := list(batches):
            found = _interpolated(pa.Table.from_batches(held), long, short)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["expression", "shared"])

    longer = rows.filter(F.col("order") > SHORT).repartition(_last("expression", SHORT + 1))
    return in_arrow(longer, run, "expression bigint, shared double")


def fit_toxicity(docs: DataFrame, labels: DataFrame, column: str = "toxic", most: int = MAX_LABELLED, most_bytes: int = MAX_BYTES) -> Toxicity:
    """Class models and calibration from labelled documents outside the held-out fold, backoff from all documents.

    The driver and each worker hold the distinct n-grams of the sample, so no more than most_bytes of them.
    """
    sample = label_sample(labels, column, FOLDS, HELD_OUT, most)
    positive = sum(label for _, label in sample)
    prior = (positive + 0.5) / (len(sample) + 1)
    nothing = Toxicity(Ratio(*(np.zeros(0, t) for t in (np.uint64, np.float32, np.uint64, np.float32))), *[np.zeros(0)] * 3, prior)
    if not 0 < positive < len(sample):
        return nothing
    rows = labelled_documents(spread(docs), sample, most_bytes).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    rows = kept(rows, "labelled")
    counted = kept(_class_counts(rows).fillna(0), "counts")
    wanted = counted.select(_last("gram", ORDER - 1).alias("expression"))
    shared_ = shared_probabilities(wanted, continuations(spread(docs.select("text"))))
    table_ = counted.withColumn("expression", _last("gram", ORDER - 1)).join(shared_, "expression")
    found = table_.select("gram", *(F.col(str(k)).cast("int").alias(f"n{k}") for k in range(4)), "shared").toArrow()
    keys = found["gram"].to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    keys, shared = keys[order], found["shared"].to_numpy()[order]
    n = [found[f"n{k}"].to_numpy()[order] for k in range(4)]
    if not len(keys) or not (n[0] + n[1]).any() or not (n[2] + n[3]).any():
        return nothing
    models = [ratio(keys, n[2 + h], n[h], shared) for h in (0, 1)]
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in batches:
            texts, half = batch.column(1).to_pylist(), batch.column(3).to_numpy()
            both = [evidence(texts, sent.value[1 - h]) for h in (0, 1)]
            x = np.where((half == 0)[:, None], *both)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(2)], ["x", "label"])

    held = in_arrow(rows, run, "x array<double>, label int").collect()
    sent.destroy()
    x, y = np.array([r["x"] for r in held], float), np.array([r["label"] for r in held], float)
    order = np.lexsort((*x.T, y))  # row order must not matter
    x, y = x[order], y[order]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model = ratio(keys, n[2] + n[3], n[0] + n[1], shared)
    return Toxicity(model, mean, scale, logistic((x - mean) / scale, y), prior)


def score_toxicity(docs: DataFrame, fitted: Toxicity, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """docs plus `score` and `predicted`; one narrow stage."""
    sent = docs.sparkSession.sparkContext.broadcast(fitted)

    def make(texts):
        p = sent.value.score(texts)
        return p, (p >= threshold).astype(np.int32)

    return mapped(docs, text, [("score", "double", pa.float64()), ("predicted", "int", pa.int32())], make)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fitted = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(spread(docs), fitted).drop("text")
    return scored.withColumn("held_out", fold(FOLDS) == HELD_OUT).select("doc_id", "held_out", "score", "predicted")
