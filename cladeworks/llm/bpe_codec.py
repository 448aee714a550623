"""BPE encoding and decoding by a contiguous rank array per short word.

`encode` adds the ids of every text as packed little-endian unsigned 32-bit integers, `decode` turns packed ids
back into text. Words repeat, so a worker keeps the ids of words it has met in a bounded table.

Edge cases: a null or empty text has no ids and decodes to an empty text; strings of added special tokens inside
a text become their special ids, as the library does by default; texts of any length are encoded whole; columns
`ids`, `n_tokens` or `decoded` that the input already has are replaced.
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_arrow, spread, table, worker_cache
from .merge_tables import MergeTable
from .unicode_gap import NEWER_CLASS

#: How byte-level BPE splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts with characters that the library does not know as letters or numbers.
SPLIT_OLD = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{{L}}--[{NEWER_CLASS}]]+| ?[\p{{N}}--[{NEWER_CLASS}]]+| ?(?:[^\s\p{{L}}\p{{N}}]|[{NEWER_CLASS}])+|\s+(?!\S)|\s+"
#: The same for texts within Latin blocks, where letters and numbers are known to the faster library.
LATIN = r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_²³¹¼½¾]+| ?[\d²³¹¼½¾]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
BEYOND_LATIN = "[\x1c-\x1f\u0180-\U0010ffff]"
#: Words that a worker remembers, and the longest word that it does.
WORDS_KEPT, WORD_CHARS = 300_000, 40


class Codec:
    """Encoder and decoder over one merge table."""

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        self.table = MergeTable(path)
        if self.table.has_final:
            raise ValueError("a vocabulary without word-end suffix is needed")
        self.words, self.older, self.words_kept = {}, {}, words_kept
        self.split, self.latin, self.beyond = regex.compile(SPLIT), re.compile(LATIN), re.compile(BEYOND_LATIN)
        self.newer, self.split_old = re.compile(f"[{NEWER_CLASS}]"), regex.compile(SPLIT_OLD, regex.V1)
        special = sorted(self.table.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.pieces = [b""] * (max([self.table.width - 1, *self.table.special.values()]) + 1)
        for i, (spelled, _) in self.table.spelled.items():
            self.pieces[i] = spelled
        for s, i in self.table.special.items():
            self.pieces[i] = s.encode()

    def _miss(self, word: str) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            ids = array("I", self.table.merge(self.table.symbols(word.encode())))
            packed = ids.tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()
        if len(word) <= WORD_CHARS:
            if 2 * len(self.words) >= self.words_kept:
                self.words, self.older = {}, self.words
            self.words[word] = packed
        return packed

    def splitter(self, text: str):
        if not self.beyond.search(text):
            return self.latin
        return self.split_old if self.newer.search(text) else self.split

    def encode(self, text: str | None) -> bytes:
        out, miss = [], self._miss
        for k, part in enumerate(self.cut.split(text or "") if self.cut else [text or ""]):
            if k % 2:
                out.append(self.table.special[part].to_bytes(4, "little"))
            else:
                out += [self.words.get(w) or miss(w) for w in self.splitter(part).findall(part)]
        return b"".join(out)

    def encode_plain(self, text: str) -> bytes:
        """The same where strings of special tokens are ordinary text."""
        return b"".join([self.words.get(w) or self._miss(w) for w in self.splitter(text).findall(text)])

    def decode(self, packed: bytes | None) -> str:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(packed or b"", "<u4").tolist()]).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    return worker_cache(("bpe codec", path), lambda: Codec(path))


def mapped(df: DataFrame, source: str, added: list[tuple[str, str, pa.DataType]], make, holds: tuple | None = None) -> DataFrame:
    """df without the columns to add, plus those that make(values) returns for each batch of values of `source`."""
    names = {n for n, _, _ in added}
    kept = [f for f in df.schema.fields if f.name not in names]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"`{n}` {t}" for n, t, _ in added])
    # the source goes along under a name of its own only if it is to be replaced
    own = [f.name for f in kept].index(source) if source in {f.name for f in kept} else None
    whole = df.select(*[F.col(f"`{f.name}`") for f in kept], *([F.col(f"`{source}`").alias("__source")] if own is None else []))

    def run(batches):
        for batch in batches:
            made = make(batch.column(own if own is not None else batch.num_columns - 1).to_pylist())
            arrays = [batch.column(i) for i in range(len(kept))]
            arrays += [pa.array(v, t) for v, (_, _, t) in zip(made, added)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in kept] + [n for n, _, _ in added])

    return in_arrow(whole, run, schema, holds)


def encode(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """df plus `ids` (packed little-endian unsigned 32-bit) and `n_tokens`; one narrow stage, no shuffle."""

    def make(texts):
        c = codec(tokenizer)
        ids = [c.encode(t) for t in texts]
        return ids, [len(x) // 4 for x in ids]

    return mapped(df, text, [("ids", "binary", pa.binary()), ("n_tokens", "bigint", pa.int64())], make, ("bpe codec", tokenizer))


def decode(df: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """df plus `decoded`, the text of its packed ids; special tokens are kept as their strings."""

    def make(packed):
        c = codec(tokenizer)
        return ([c.decode(p) for p in packed],)

    return mapped(df, ids, [("decoded", "string", pa.string())], make, ("bpe codec", tokenizer))


def there_and_back(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """df plus `ids`, `n_tokens` and `decoded`, in one stage of one set of workers."""

    def make(texts):
        c = codec(tokenizer)
        ids = [c.encode(t) for t in texts]
        return ids, [len(x) // 4 for x in ids], [c.decode(x) for x in ids]

    added = [("ids", "binary", pa.binary()), ("n_tokens", "bigint", pa.int64()), ("decoded", "string", pa.string())]
    return mapped(df, text, added, make, ("bpe codec", tokenizer))


def digests(df: DataFrame) -> DataFrame:
    """doc_id and the digests of ids and decoded text."""
    return df.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vocabularies import path

    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    tokenizer = path("byte_bpe_50k.json")
    return digests(there_and_back(docs, tokenizer))
