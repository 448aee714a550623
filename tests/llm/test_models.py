"""Fitted operators: held-out accuracy, guards on labels, and the pipeline."""

import collections
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cladeworks.llm import gbt, quality_classifier, text_statistics, toxicity
from cladeworks.llm.labelled import fold, label_sample

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs, spark.read.parquet(f"{SF}/labels.parquet")


def test_trees_learn_a_rule_and_step_as_written():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.5)).astype(float)
    trees = gbt.fit(x[:1500], y[:1500])
    assert ((trees.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    for row, raw in zip(x[:20], trees.raw(x[:20])):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        assert abs(total - raw) < 1e-9


def test_quality_on_the_held_out_fold(spark, tables):
    docs, labels = tables
    scored = quality_classifier.score(docs, quality_classifier.fit_quality(docs, labels)).join(labels, "doc_id")
    held = scored.filter(fold(quality_classifier.FOLDS) == quality_classifier.HELD_OUT)
    assert held.filter("predicted = quality").count() >= 0.95 * held.count() > 0


def test_toxicity_on_the_held_out_fold(spark, tables):
    docs, labels = tables
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).join(labels, "doc_id")
    held = scored.filter(fold(toxicity.FOLDS) == toxicity.HELD_OUT)
    assert held.filter("predicted = toxic").count() >= 0.9 * held.count() > 0


def test_held_out_labels_change_nothing(spark, tables):
    docs, labels = tables
    other = labels.withColumn("toxic", F.when(fold(toxicity.FOLDS) == toxicity.HELD_OUT, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (label_sample(x, "toxic", toxicity.FOLDS, toxicity.HELD_OUT) for x in (labels, other))
    assert one == two and sum(label for _, label in one) > 0


def test_models_without_labels_or_texts(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "words of a text", "z"), (3, "words of a text", "z")], "doc_id bigint, text string, score string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for scored in (quality_classifier.score(docs, quality_classifier.fit_quality(docs, none)), toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none))):
        values = [r["score"] for r in scored.collect()]
        assert len(values) == 4 and all(v == values[0] and 0 <= v <= 1 for v in values)
    labels = spark.createDataFrame([(3, None, 1), (3, 1, 0), (None, 1, 1), (3, 0, 1)], none.schema)
    assert len(label_sample(labels, "quality", 3, 1)) <= 1


def plain_grams(text, order):
    """Every symbol with its context, as tuples: last symbol first, boundaries 0, nothing beyond the word."""
    out = []
    for word in re.findall(rb"[0-9a-z\x80-\xff]+", text.lower().encode()):
        symbols = [*word, 0]
        for i, c in enumerate(symbols):
            back = symbols[max(0, i - order + 1) : i][::-1]
            out.append((c, *back, *[0] * (order - 1 - len(back))))
    return out


def test_shared_probabilities_are_those_of_all_documents(spark):
    texts = ["banana bandana", "Ban an anagram, été", None, "", "aa a b " * 50, "banana bandana", "zebra zen"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    seen = {g for t in texts for g in plain_grams(t or "", toxicity.ORDER)}
    counts = {}  # order: expression: number of contexts
    for order in range(toxicity.ORDER - 1, 0, -1):
        seen, longer = {g[:order] for g in seen}, seen
        counts[order] = collections.Counter(g[:order] for g in longer)

    def probability(e):
        order = len(e)
        same = [n for x, n in counts[order].items() if x[1:] == e[1:]]
        below = probability(e[:-1]) if order > 1 else 1 / 256
        return (max(counts[order][e] - toxicity.DISCOUNT, 0) + toxicity.DISCOUNT * len(same) * below) / sum(same)

    packed = lambda e: sum(c << 8 * k for k, c in enumerate(e))
    expected = {packed(e): probability(e) for e in counts[toxicity.ORDER - 1] if e[0] != ord("z")}
    wanted = spark.createDataFrame([(e,) for e in expected], "expression bigint")
    found = {r["expression"]: r["shared"] for r in toxicity.shared_probabilities(wanted, toxicity.continuations(docs)).collect()}
    assert found.keys() == expected.keys() and all(abs(found[e] - expected[e]) < 1e-12 for e in expected)
    one = sum(probability(e) for e in {(c, *e[1:]) for e in counts[1] for c in (e[0],)})
    assert one <= 1 + 1e-9


def test_shared_probabilities_need_few_exchanges(spark):
    docs = spark.createDataFrame([(1, "banana bandana"), (2, "zebra zen")], "doc_id bigint, text string")
    orders = toxicity.continuations(docs)
    shared = toxicity.shared_probabilities(orders[-1].select("expression"), orders)
    for frame in (*orders, shared):
        assert frame._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 2
    assert shared.count() == orders[-1].count()


def test_ratios_and_evidence_are_those_of_plain_models():
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abc"), rng.integers(1, 6))) for _ in range(400)]
    halves = " ".join(words[:200]), " ".join(words[200:])
    grams = [collections.Counter(plain_grams(t, toxicity.ORDER)) for t in halves]
    packed = lambda e: sum(c << 8 * k for k, c in enumerate(e))
    known = sorted({packed(g): g for x in grams for g in x}.items())
    shared = {g: 0.1 + 0.8 * rng.random() for _, g in known}
    keys = np.array([k for k, _ in known], np.uint64)
    n = [np.array([x[g] for _, g in known]) for x in grams]
    model = toxicity.ratio(keys, n[0], n[1], np.array([shared[g] for _, g in known]))

    def log_probability(counts, g):
        same = {x: c for x, c in counts.items() if x[1:] == g[1:]}
        if not same:
            return np.log(shared[g]) if g in shared else 0.0
        total = sum(same.values())
        back = toxicity.DISCOUNT * len(same) / total
        return np.log(max(counts[g] - toxicity.DISCOUNT, 0) / total + back * shared[g]) if g in shared else np.log(back)

    text = " ".join(words[150:260]) + " abcabcab zz"
    difference = [sum(log_probability(grams[0], g) - log_probability(grams[1], g) for g in plain_grams(w, toxicity.ORDER)) for w in text.split()]
    found = toxicity.evidence(["", text], model)[1]
    x = np.array(difference)
    expected = [x.mean(), np.maximum(x - 2, 0).mean(), np.maximum(x - 4, 0).mean(), (x > 4).mean(), (x > 6).mean(), (x > 4).sum(), (x > 6).sum(), x.max()]
    assert np.allclose(found, expected, atol=1e-4)


def test_statistics_are_those_of_a_plain_program():
    texts = [r["text"] for r in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).to_pylist()[:60]] + ["", None, " ", "A\n\nA\nb", "one two three four five one two three four five", "é|#!? 99"]
    for text, row in zip(texts, text_statistics.statistics(texts)):
        raw = (text or "").encode()
        words = re.findall(rb"[^\x20\x09-\x0d]+", raw)
        lines = [x for x in raw.split(b"\n") if x]
        fives = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        share = lambda chars: sum(c in chars for c in raw) / max(len(raw), 1)
        expected = {
            "log_words": np.log1p(len(words)), "log_bytes": np.log1p(len(raw)), "word_bytes": sum(map(len, words)) / max(len(words), 1), "upper": share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            "digit": share(b"0123456789"), "stop": share(b".,;:?"), "shout": share(b"!"), "bar": share(b"|"), "mark": share(b"#*$%&<>"), "quote": share(b"\"'()-"), "high": sum(c > 127 for c in raw) / max(len(raw), 1),
            "blank": share(b" \t\r\x0b\x0c"), "words_per_line": len(words) / max(len(lines), 1), "repeated_lines": 1 - len(set(lines)) / len(lines) if lines else 0.0,
            "repeated_runs": 1 - len(set(fives)) / len(fives) if fives else 0.0, "distinct_words": len(set(words)) / max(len(words), 1), "distinct_in_square_root": len(set(words)) / np.sqrt(max(len(words), 1)),
            "long_words": sum(len(w) > 20 for w in words) / max(len(words), 1), "short_words": sum(len(w) <= 3 for w in words) / max(len(words), 1),
        }
        found = dict(zip(text_statistics.NAMES, row))
        assert all(abs(found[k] - v) < 1e-9 for k, v in expected.items()), text
        assert abs(sum(found[k] for k in ("upper", "digit", "stop", "shout", "bar", "mark", "quote", "other", "high", "blank")) - sum(c not in b"abcdefghijklmnopqrstuvwxyz\n" for c in raw) / max(len(raw), 1)) < 1e-9


def test_pipeline_stages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = docs.limit(60).withColumn("score", F.lit("mine")).withColumn("n_words", F.lit(7))
    odd = spark.createDataFrame([(None, None, None, None, None, "mine", 7), (5, "", "en", "s", 0, "mine", 7)], extra.schema)
    rows = extra.unionByName(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, "/root/testdata/sf0.001")
        assert out.columns == rows.columns, name
        assert out.filter("score <> 'mine' or n_words <> 7").count() == 0
        assert out.count() <= rows.count()
    assert corpus_pipeline.STAGES[-1][1](spark, rows, "").filter("not round_trip").count() == 0


def test_pipeline_run_keeps_one_of_each_class_and_no_benchmark(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").cache()
    assert 0 < out.count() == out.select("doc_id").distinct().count()
    assert out.filter("not round_trip or n_tokens * 4 <> length(ids)").count() == 0
