"""Each stage of the pipeline against a plain program on its own input; odd rows for every operator and stage."""

import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cladeworks.llm import bpe_codec, chat_format, decontaminate, gbt, near_duplicates, personal_data, quality_classifier, quality_rules, repeated_passages, text_statistics, token_counts, toxicity
from cladeworks.llm.vocabularies import path

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_quality_drops_what_the_trees_reject(spark, docs):
    trees = quality_classifier.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    before, after = rows(docs), rows(STAGES["quality"](spark, docs, SF))
    good = set()
    for d, r in before.items():
        x = text_statistics.statistics([r["text"]])[0]
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if x[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
            total += trees.value[node]
        good |= {d} if 1 / (1 + np.exp(-total)) >= 0.5 else set()
    assert after == {d: before[d] for d in good} and isinstance(trees, gbt.Trees)


def test_near_dedup_keeps_the_least_of_each_class(spark, docs):
    before, after = rows(docs), rows(STAGES["near_dedup"](spark, docs, SF))
    ids = sorted(before)
    owner, run, weight = near_duplicates.shingles([before[d]["text"] for d in ids])
    cuts = np.searchsorted(owner, np.arange(len(ids) + 1))
    sets = [(run[a:b], weight[a:b]) for a, b in zip(cuts, cuts[1:])]
    least = list(range(len(ids)))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if before[ids[i]]["text"] == before[ids[j]]["text"] or near_duplicates.similarity(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                least[b] = a
    assert after == {ids[i]: before[ids[i]] for i in range(len(ids)) if find(i) == i} and len(after) < len(before)


def test_decontamination_drops_documents_with_a_window(spark, docs):
    low = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    windows = {}
    for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist():
        w = low(r["text"])
        n = min(10, len(w))
        windows.setdefault(n, set()).update(tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n)
    before, after = rows(docs), rows(STAGES["decontamination"](spark, docs, SF))
    hit = set()
    for d, r in before.items():
        w = low(r["text"])
        if any(tuple(w[i : i + n]) in known for n, known in windows.items() for i in range(len(w) - n + 1)):
            hit.add(d)
    assert hit and after == {d: r for d, r in before.items() if d not in hit}


def test_personal_data_is_replaced_span_by_span(spark, docs):
    model = personal_data.model()
    before, after = rows(docs), rows(STAGES["personal_data"](spark, docs, SF))
    for d, r in before.items():
        spans = sorted(personal_data.find(r["text"], *model)[1], key=lambda s: (s[1], -s[2]))
        expected, at = "", 0
        for kind, b, e in spans:
            if b >= at:
                expected += r["text"][at:b] + f"<{kind.upper()}>"
            at = max(at, e)
        expected += r["text"][at:]
        assert after[d] == r | {"text": expected, "n_chars": len(expected)}
    assert sum(before[d]["text"] != after[d]["text"] for d in before) > 3 and before.keys() == after.keys()


def test_tokens_are_the_library_s(spark, docs):
    library = tokenizers.Tokenizer.from_file(path("byte_bpe_50k.json"))
    for r in STAGES["tokens"](spark, docs, SF).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(r["text"], add_special_tokens=False).ids and r["round_trip"] and r["n_tokens"] == len(r["ids"]) // 4


def test_spans_of_the_query_are_those_of_the_finder(spark, docs):
    model, texts = personal_data.model(), {d: r["text"] for d, r in rows(docs).items()}
    for r in personal_data.op7_personal_data(spark, SF).collect():
        base, spans = personal_data.find(texts[r["doc_id"]], *model)
        joined = lambda x: ",".join(f"{k}:{b}:{e}" for k, b, e in x)
        assert r["spans"] == joined(spans)
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in base) for k in ("email", "ip", "card", "phone")]
        assert set(base) <= set(spans)


#: Columns that operators add or use inside, to clash with.
CLASH = ("class_id", "score", "predicted", "ids", "n_tokens", "decoded", "n_words", "n_hit", "items", "matches", "spans", "base_spans", "digest", "key", "node", "kept", "language", "n_bytes", "over_limit")


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long texts, repeated rows, ties, and columns with clashing names."""
    long = " ".join(f"word{k % 977}" for k in range(120_000))
    texts = [(1, None), (2, ""), (None, "no id here, though words"), (None, None), (3, "same words again and again"), (3, "same words again and again"), (4, "same words again and again"), (5, long), (6, "x" * 300_000), (7, "\n \t"), (3, "another text of one id")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    return frame.select("*", *(F.lit("mine").alias(c) for c in CLASH))


def operators(spark):
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    corpus = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    trees, toxic = quality_classifier.fit_quality(corpus, labels), toxicity.fit_toxicity(corpus, labels)
    return {
        "toxicity": lambda d: toxicity.score_toxicity(d, toxic),
        "rules": quality_rules.quality_rules,
        "counts": lambda d: token_counts.count_tokens(d, path("word_bpe_49k.json")),
        "codec": lambda d: bpe_codec.there_and_back(d, path("byte_bpe_50k.json")),
        "quality": lambda d: quality_classifier.score(d, trees),
        "personal": personal_data.find_personal_data,
        "decontaminate": lambda d: decontaminate.decontaminate(d, bench),
        "near": near_duplicates.near_duplicate_classes,
    }


def test_operators_on_odd_rows_and_empty_tables(spark, odd):
    for name, operator in operators(spark).items():
        out = operator(odd)
        assert set(odd.columns) <= set(out.columns) and out.count() == odd.count(), name
        untouched = [c for c in CLASH if c in out.columns and dict(out.dtypes)[c] == "string" and c not in ("decoded", "language", "spans")]
        assert all(r[c] == "mine" for r in out.select(*untouched).collect() for c in untouched), name
        assert operator(odd.filter("doc_id = -5")).count() == 0, name
    passages = repeated_passages.repeated_passages(odd)
    assert passages.count() == 0 and repeated_passages.repeated_passages(odd.filter("doc_id = -5")).count() == 0


def test_stages_on_odd_rows_and_empty_tables(spark, odd):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns, name
        assert out.filter(" or ".join(f"{c} <> 'mine'" for c in CLASH)).count() == 0 and out.count() <= odd.count(), name
        assert stage(spark, odd.filter("doc_id = -5"), SF).count() == 0, name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, odd, SF).filter("not round_trip").count() == 0 and last(spark, odd.filter("doc_id = -5"), SF).count() == 0


def test_fits_without_any_document(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    some = spark.createDataFrame([(1, "a text")], none.schema)
    assert 0 <= quality_classifier.score(some, quality_classifier.fit_quality(none, labels)).first()["score"] <= 1
    assert 0 <= toxicity.score_toxicity(some, toxicity.fit_toxicity(none, labels)).first()["score"] <= 1


def test_chats_of_very_many_turns_and_odd_rows(spark):
    rows_ = [(1, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(6000)] + [(2, None, None, None), (2, 0, "system", "x"), (2, 0, "system", "x"), (None, 1, "tool", "[INST]")]
    frame = spark.createDataFrame(rows_, "conv_id bigint, turn bigint, role string, text string").withColumn("pack", F.lit("mine")).withColumn("ids", F.lit(1))
    back = {r["conv_id"]: r for r in chat_format.read_back(chat_format.pack_conversations(frame, path("byte_bpe_50k.json")), path("byte_bpe_50k.json")).collect()}
    assert [(t["role"], t["text"]) for t in back[1]["turns"]] == [(r, t) for c, _, r, t in rows_ if c == 1]
    assert back[1]["loss_text"] == "".join(t for c, _, r, t in rows_ if c == 1 and r == "assistant")
    assert [(t["role"], t["text"]) for t in back[2]["turns"]] == [("", ""), ("system", "x"), ("system", "x")] and len(back) == 3


def test_many_spans_take_time_in_proportion():
    import time

    model = personal_data.model()

    def seconds(n):
        text = " ".join(f"user{k}@host{k}.org 4111 1111 1111 1111 token{k}=abcDEF{k}987ghi" for k in range(n))
        began = time.process_time()
        assert len(personal_data.find(text, *model)[0]) >= 2 * n
        return time.process_time() - began

    seconds(100)
    assert seconds(4000) < 12 * seconds(1000) + 1
