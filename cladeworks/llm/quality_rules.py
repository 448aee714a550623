"""Quality rules by distribution divergence, in DataFrame functions only.

Base counts of every text (see `base_counts`) give the base rules. The method compares two histograms of a document
with those of its language by the Jensen-Shannon distance (base 2, 0 to 1): the shares of character classes, and the
shares of the language's common words among all common words. The language of a document is the one whose common
words it has most of. References are learnt from the table (one of all languages serves documents without any common
word): the mean histogram of the documents that pass the base rules, are long enough and have few symbols; a mean of
per-document shares gives a long text no more say than a short one, and integer shares make it exact in any order. A
document is kept if both distances are within their limits; documents with fewer than MIN_CHARS characters in words, or fewer than MIN_COMMON common words, are too short for
the histogram in question and pass it. A language without reference documents rejects nothing.

The texts are read once and never shuffled: counts and histograms, a row of fixed width for each document, are written
to the shared folder, and read for the references and for the verdicts. Only reference sums, a row for each language,
are exchanged.
Edge cases: null and empty texts have no words and fail the base rules; repeated rows get equal results; only
doc_id and the text are used, other columns pass through `quality_rules` (added columns replace theirs).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import kept as written
from .common import spread, table

# The most common words of each language.
COMMON = {
    "en": "the of and to in a is that it for on was be with as this by are from an".split(),
    "fr": "de la le et les des un en une que du dans qui sur pour par est au pas plus".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los del se las por un para con no una su al es".split(),
}
#: Character classes of the histogram, as regular expressions; the rest of the text is the last class.
BLANK, SYMBOLS = "\\x20\\x09-\\x0D", "#*$%&|<>"
CLASSES = ("a-z", "A-Z", "0-9", BLANK, ".,;:'\"()?-", "!", SYMBOLS, "\\x{80}-\\x{10FFFF}")
SPACE = "[\\x20\\x09-\\x0D]+"
MIN_WORDS, REPEATED_PERCENT = 10, 20
MIN_CHARS, MIN_COMMON = 200, 25
#: Largest distances that are kept.
CHAR_LIMIT, WORD_LIMIT = 0.18, 0.7
#: The reference of all languages together, for documents without any common word.
ANY = "any"
#: Shares are whole numbers of this many parts.
PARTS = 1_000_000


def _let(value: Column, body) -> Column:
    """body(value), with value computed once however often body names it, even where a filter is pushed down."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Size of the union of the five-word windows that occur twice or more."""

    def windows(hashes):
        starts = F.sequence(F.lit(1), F.greatest(F.size(hashes) - 4, F.lit(1)))
        return F.when(F.size(hashes) >= 5, F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, 5)))).otherwise(F.expr("cast(array() as array<bigint>)"))

    def placed(w):  # (hash, place), sorted: equal ones are neighbours
        return F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(w):
        same = lambda x, i, d: F.coalesce(F.get(w, i + d)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(w, lambda x, i: same(x, i, 1) | same(x, i, -1)), lambda x: x["i"]))

    def covered(p):  # each place adds what its window has before the next one begins
        steps = F.transform(p, lambda x, i: F.least(F.lit(5), F.coalesce(F.get(p, i + 1) - x, F.lit(5))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def counted(w):  # most texts repeat no window and need no sort
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_let(placed(w), lambda x: _let(places(x), covered)))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(hashes, lambda h: _let(windows(h), counted)).cast("bigint")


def _left(text: Column, chars: str) -> Column:
    """Number of characters that are not of a class."""
    return F.char_length(F.regexp_replace(text, f"[{chars}]+", ""))


def char_counts(text: Column) -> Column:
    """Characters of each of CLASSES, and the rest: what is left without a-z is short, and holds all other classes."""

    def others(rest):
        counts = F.array(*(F.char_length(rest) - _left(rest, c) for c in CLASSES[1:]))
        return F.concat(F.array(F.char_length(text) - F.char_length(rest)), counts, F.array(F.char_length(rest) - _total(counts).cast("int")))

    return _let(F.regexp_replace(text, f"[{CLASSES[0]}]+", ""), others)


def base_counts(text: Column, words: Column, chars: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text, its words and its class counts."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": (_total(chars) - F.get(chars, F.lit(CLASSES.index(BLANK)))).cast("bigint"),
        "n_symbols": F.get(chars, F.lit(CLASSES.index(SYMBOLS))).cast("bigint"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        "n_repeat_words": _repeated_words(words),
    }


def _histograms(df: DataFrame) -> DataFrame:
    """Adds the language and the counts of its common words; a word counts in lower, capital and upper case."""
    every = sorted({f(w) for v in COMMON.values() for w in v for f in (str.lower, str.capitalize, str.upper)})
    df = df.withColumn("__common", F.transform(F.filter("__words", lambda w: w.isin(every)), lambda w: F.lower(w)))
    for name, words in COMMON.items():
        df = df.withColumn(f"__n_{name}", F.size(F.filter("__common", _among(words))))
    best = F.greatest(*(F.col(f"__n_{k}") for k in COMMON))
    language = reduce(lambda a, k: a.when(F.col(f"__n_{k}") == best, F.lit(k)), COMMON, F.when(best == 0, F.lit(None).cast("string")))
    df = df.withColumn("language", language)
    hist = F.lit(None).cast("array<int>")
    for name, words in COMMON.items():
        own = F.array(*(F.size(F.filter("__common", _among([x]))) for x in words))
        hist = F.when(F.col("language") == name, own).otherwise(hist)
    return df.withColumn("__word_hist", hist)


def _among(words: list[str]):
    return lambda w: w.isin(words)


def _shares(a: Column, total: Column) -> Column:
    return F.transform(a, lambda x: x / total)


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)


def _distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two histograms; null if either is empty."""
    p, q = _shares(a, _total(a)), _shares(b, _total(b))
    half = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda x, y: (half(x, (x + y) / 2) + half(y, (x + y) / 2)) / 2)
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.when((_total(a) > 0) & (_total(b) > 0), F.sqrt(F.greatest(total, F.lit(0.0))))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs plus base counts, base_failed, language and histograms."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("__text", t).withColumn("__words", F.filter(F.split("__text", SPACE), lambda w: w != ""))
    df = df.withColumn("__chars", char_counts(F.col("__text")))
    df = df.withColumns(base_counts(F.col("__text"), F.col("__words"), F.col("__chars")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    df = _histograms(df.withColumn("base_failed", failed))
    return df.drop("__words", "__common", "__text", *(f"__n_{k}" for k in COMMON))


def references(df: DataFrame) -> DataFrame:
    """(language, char_reference, word_reference): summed whole shares of the documents fit to be an example."""
    # conditional sums, not a filter, which would compute every count twice
    fit = (~F.col("base_failed") & F.col("language").isNotNull() & (F.col("word_chars") >= MIN_CHARS) & (100 * F.col("n_symbols") <= F.col("word_chars")))
    df = df.select("language", fit.alias("__fit"), F.col("__chars").alias("c"), F.col("__word_hist").alias("w"), _total(F.col("__chars")).alias("nc"), _total(F.col("__word_hist")).alias("nw"))

    def sums(name, n):
        whole = lambda i: F.expr(f"{name}[{i}] * {PARTS}L div greatest(n{name}, 1L)")
        return [F.sum(F.when(F.col("__fit"), whole(i))).alias(f"{name}{i}") for i in range(n)]

    n_chars, n_words = len(CLASSES) + 1, len(next(iter(COMMON.values())))
    out = df.rollup("language").agg(F.grouping_id().alias("all"), *sums("c", n_chars), *sums("w", n_words)).filter("c0 is not null")
    out = out.withColumn("language", F.when(F.col("all") > 0, F.lit(ANY)).otherwise(F.col("language")))
    return out.select("language", F.array(*(f"c{i}" for i in range(n_chars))).alias("__char_ref"), F.array(*(f"w{i}" for i in range(n_words))).alias("__word_ref"))


def quality_rules(docs: DataFrame, text: str = "text", columns: list[str] | None = None) -> DataFrame:
    """docs plus base counts, base_failed, language, char_distance, word_distance and kept.

    columns: those of docs that the result has, all if not given; a result without the text writes no text either.
    """
    df = measured(docs, text)
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "language", "__chars", "__word_hist"]
    own = [c for c in (docs.columns if columns is None else columns) if c not in added]
    df = written(df.select(*(F.col(f"`{c}`") for c in own), *added), "measured")
    # a reference is one row of fixed width for each language of COMMON
    known = references(df).withColumnRenamed("language", "__reference")
    df = df.withColumn("__reference", F.coalesce("language", F.lit(ANY))).join(F.broadcast(known), "__reference", "left")
    df = df.withColumn("char_distance", _distance(F.col("__chars"), F.col("__char_ref")))
    df = df.withColumn("word_distance", _distance(F.col("__word_hist"), F.col("__word_ref")))
    chars = (F.col("word_chars") < MIN_CHARS) | F.coalesce(F.col("char_distance") <= CHAR_LIMIT, F.lit(True))
    words = (_total(F.col("__word_hist")) < MIN_COMMON) | F.coalesce(F.col("word_distance") <= WORD_LIMIT, F.lit(True))
    kept = ~F.col("base_failed") & chars & F.coalesce(words, F.lit(True))
    return df.withColumn("kept", kept).drop("__reference", "__chars", "__word_hist", "__char_ref", "__word_ref")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = quality_rules(docs, columns=["doc_id"])
    rounded = [F.round(c, 6).alias(c) for c in ("char_distance", "word_distance")]
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "language", *rounded)
