"""Names, sizes and dates, as Spark columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# File endings that a sequence file may carry, in the order in which labels lose them.
ENDINGS = (".fasta", ".fas", ".fna", ".fsa", ".fa")
#: Subregions that say nothing.
UNKNOWN = ("", "unknown", "na", "n/a", "none")
#: The year of a missing date: it sorts last.
NO_YEAR = 1_000_000_000


def normalize_name(path: Column) -> Column:
    """The base name without its last ending; a leading dot begins no ending."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"^(.+)\.[^.]*$", "$1")


def sample_id(path: Column) -> Column:
    """The base name up to its first dot."""
    return F.substring_index(F.element_at(F.split(path, "/"), -1), ".", 1)


def sanitize_sample(name: Column) -> Column:
    return F.replace(F.trim(name), F.lit(" "), F.lit("_"))


def canonical_key(path: Column) -> Column:
    return F.translate(normalize_name(path), ".", "_")


def accession_key(path: Column) -> Column:
    """The normalised name without a trailing version of one to three digits."""
    return F.regexp_replace(normalize_name(path), r"[._][0-9]{1,3}$", "")


def has_ending(path: Column, endings: tuple[str, ...] = ENDINGS, gz: bool = True) -> Column:
    name = F.lower(path)
    name = F.regexp_replace(name, r"\.gz$", "") if gz else name
    return reduce(lambda a, b: a | b, (F.endswith(name, F.lit(e)) for e in endings))


def remove_endings(name: Column) -> Column:
    """The name without known endings at its end, dots and spaces as underscores."""
    return F.regexp_replace(F.regexp_replace(name, r"(\.(fasta|fas|fna|fsa|fa))?(\.gz)?$", ""), "[. ]", "_")


#: Endings that a tree label loses, one after the other.
LABEL_ENDINGS = (".fa", ".fasta", ".fa.gz", ".fna", ".treefile")


def normalize_label(label: Column) -> Column:
    """A tree label without a pair of quotes around it and without sequence endings, spaces as underscores."""
    bare = F.regexp_replace(F.trim(F.coalesce(label, F.lit(""))), """^(['"])(.*)\\1$""", "$2")
    for ending in LABEL_ENDINGS:
        bare = F.regexp_replace(bare, ending.replace(".", r"\.") + "$", "")
    return F.replace(bare, F.lit(" "), F.lit("_"))


def drop_reference_suffix(name: Column) -> Column:
    """The name without `.ref` at its end if it has `.ref` just once."""
    once = F.size(F.split(name, r"\.ref")) == 2
    return F.when(once, F.regexp_replace(name, r"\.ref$", "")).otherwise(name)


def parse_year(date: Column) -> Column:
    """The first four digits of the first run of digits, NO_YEAR if that run is shorter."""
    found = F.regexp_extract(F.coalesce(date, F.lit("")), "^[^0-9]*([0-9]{4})", 1)
    return F.when(found != "", found.cast("int")).otherwise(F.lit(NO_YEAR))


def parse_size(size: Column) -> Column:
    """Bytes of a size like 45k, 1m, 2g or 1c (bytes)."""
    number = F.regexp_extract(size, "^([0-9]+)", 1).try_cast("bigint")
    power = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    unit = F.lower(F.right(size, F.lit(1)))
    return reduce(lambda a, k: a.when(unit == k, number * power[k]), power, F.when(unit == "c", number)).otherwise(number)


def known_subregion(subregion: Column) -> Column:
    return ~F.coalesce(F.lower(F.trim(subregion)), F.lit("")).isin(*UNKNOWN)


def unknown_if_empty(value: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit("Unknown"))


def tie_break(sample: Column, seed: int = 42) -> Column:
    """A reproducible random order."""
    return F.md5(F.concat(sample.cast("string"), F.lit(f":{seed}")))


def sheet_name(path: Column, last: bool = False) -> Column:
    """The second, or the last, part of a file name between dots."""
    parts = F.split(F.element_at(F.split(path, "/"), -1), r"\.")
    return F.element_at(parts, -1) if last else F.get(parts, F.lit(1))


def fixed(x: Column, digits: int) -> Column:
    """A number as text with so many digits after the point, rounded by its exact binary value, ties to even.

    The digits are those of the product of the fraction and 10 ** digits, whose rounding error is computed too.
    """
    scale = 10**digits
    x = x.cast("double")
    size, whole = F.abs(x), F.floor(F.abs(x))
    f = size - whole.cast("double")
    product = f * F.lit(float(scale))
    high = f * F.lit(134217729.0) - (f * F.lit(134217729.0) - f)
    error = (high * F.lit(float(scale)) - product) + (f - high) * F.lit(float(scale))
    floor = F.floor(product)
    rest = product - floor.cast("double")
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (floor % 2 == 1))))
    total = whole * scale + floor + F.when(up, 1).otherwise(0)
    text = F.concat(F.floor(total / scale).cast("string"), F.lit("."), F.lpad((total % scale).cast("string"), digits, "0"))
    text = F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), text)
    return F.when(size < float(1 << 53) / scale, text).when(x.isNotNull(), F.format_string(f"%.{digits}f", x))


def thousands(x: Column) -> Column:
    """A whole number as text with commas between thousands."""
    return F.format_number(x.cast("bigint"), 0)


def strip_quotes(label: Column) -> Column:
    return F.replace(label, F.lit("'"), F.lit(""))


def ending(path: Column) -> Column:
    """What follows the last dot of a file name; nothing if there is no dot."""
    return F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"\.([^.]*)$", 1)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def at_most(value: Column, most: Column) -> Column:
    """A resource request, clamped."""
    return F.least(value, most)


def runtime_hours(n_samples: Column) -> Column:
    """Estimated hours of a run: a minute a sample."""
    return F.round(n_samples / 60).cast("bigint")


def mash_distance(jaccard: Column, k: int) -> Column:
    """-1/k ln(2j / (1 + j)); 1 where nothing is shared."""
    return F.when(jaccard <= 0, F.lit(1.0)).otherwise(F.abs(-F.log(2 * jaccard / (1 + jaccard)) / k))


# Names of tiers and states.
TIERS = ("Tier1_high_confidence", "Tier2_moderate_confidence", "Tier3_low_confidence_exploratory", "Tier4_no_meaningful_tree", "Tier4_singleton_or_uninterpretable")
DONE, SKIPPED, FALLBACK = "completed", "skipped_low_information", "failed_fallback_to_sanitized_alignment"
NO_TREE, EMPTY_TREE, NO_LOG = "failed_no_tree", "failed_empty_tree", "minimal_tree_no_log"


def confidence_tier(n: Column, gubbins: Column, tree: Column, sites: Column) -> Column:
    """How far a cluster's tree can be trusted."""
    best = (gubbins == DONE) & (tree == DONE) & (n >= 6) & (sites >= 10)
    fair = gubbins.isin(DONE, SKIPPED, FALLBACK) & (n >= 4) & (tree == DONE)
    out = F.when(n <= 1, F.lit(TIERS[4])).when(~F.coalesce(tree.isin(DONE, NO_LOG), F.lit(False)), F.lit(TIERS[3]))
    return out.when(best, F.lit(TIERS[0])).when(fair, F.lit(TIERS[1])).otherwise(F.lit(TIERS[2]))


def gubbins_status(skipped: Column, failed: Column, code: Column) -> Column:
    """From what a diagnostics log says; code is the exit code as text."""
    out = F.when(skipped, F.lit(SKIPPED)).when(failed, F.lit(FALLBACK)).when(code == "0", F.lit(DONE))
    return out.when(F.coalesce(code, F.lit("")).isin("", "NA"), F.lit("unknown")).otherwise(F.concat(F.lit("failed_exit_"), code))


def tree_status(tree_bytes: Column, tree_text: Column, n_sequences: Column, log_bytes: Column) -> Column:
    """From a tree file, the number of sequences and the log; null sizes are missing files."""
    out = F.when(F.coalesce(tree_bytes, F.lit(0)) == 0, F.lit(NO_TREE)).when(F.trim(tree_text) == "", F.lit(EMPTY_TREE))
    return out.when(n_sequences < 3, F.lit(SKIPPED)).when(F.coalesce(log_bytes, F.lit(0)) == 0, F.lit(NO_LOG)).otherwise(F.lit(DONE))
