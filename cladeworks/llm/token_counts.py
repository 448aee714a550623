"""Token counts by compiled finite-state transducers.

Two deterministic transducers run in cascade, and every transition is annotated with the tokens it emits.

1. The splitter reads character classes and emits 1 where a word begins. A batch of texts is cut into chunks of
   equal length; each chunk's map (entry state -> exit state, for every entry state at once) is made column by
   column, the maps compose through a parallel prefix scan (log2 of the number of chunks rounds), and the entry
   states found this way let all chunks emit at once. A text of any length is only more chunks.
2. The merger reads the symbols of one word. After every prefix the last token of its encoding is known: it is the
   only vocabulary entry that ends there and may follow the last token before it. A state holds what later symbols
   can still ask for (the pending suffix, the last token at each of its positions, the counts relative to the
   present), so a transition's annotation is the change of the count and may be negative. Transitions are compiled
   when first taken and kept in a bounded table.

Edge cases: a null or empty text has 0 tokens; special strings inside a text count as one token each, as the library
does by default; columns `n_bytes`, `n_tokens` that the input already has are replaced.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spread, table, worker_cache
from .bpe_codec import mapped
from .merge_tables import MergeTable
from .unicode_gap import NEWER, lowered

# Character classes, and states of the splitter.
SPACE, LETTER, NUMBER, OTHER, SHORT, LONG = range(6)  # SHORT, LONG: an apostrophe before s t m d, or re ve ll
BETWEEN, IN_LETTERS, IN_OTHER, ONE_MORE, TWO_MORE = range(5)
CLASSES, STATES, CHUNK = 6, 5, 64
#: Texts are joined up to so many characters; a longer text is cut at spaces.
BLOCK_CHARS = 1 << 20
WORDS_KEPT, WORD_CHARS, TRANSITIONS_KEPT = 300_000, 40, 250_000
#: White space as Unicode lists it.
WHITE = r"\t-\r\x20\x85\xa0  -     　"


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emitted words of every state and class, flat by state * CLASSES + class."""
    after, emits = np.zeros((STATES, CLASSES), np.intp), np.zeros((STATES, CLASSES), np.uint8)
    for s in (BETWEEN, IN_LETTERS, IN_OTHER):
        for c, t in ((SPACE, BETWEEN), (LETTER, IN_LETTERS), (NUMBER, BETWEEN), (OTHER, IN_OTHER), (SHORT, ONE_MORE), (LONG, TWO_MORE)):
            after[s, c], emits[s, c] = t, c != SPACE
    emits[IN_LETTERS, LETTER] = 0
    for c in (OTHER, SHORT, LONG):  # inside a run of other characters an apostrophe is one of them
        after[IN_OTHER, c], emits[IN_OTHER, c] = IN_OTHER, 0
    after[ONE_MORE, :], after[TWO_MORE, :] = BETWEEN, ONE_MORE
    return after.ravel(), emits.ravel()


def class_table() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text, at = "".join(map(chr, points)), np.array(points)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (f"[{WHITE}]+", SPACE)):
        for m in regex.finditer(pattern, text):
            out[at[m.start() : m.end()]] = kind
    for first, last in NEWER:
        out[first : last + 1] = OTHER
    return out


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (row i: maps[0] first, maps[i] last)."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


class Merger:
    """The second transducer: tokens of one word."""

    def __init__(self, path: str):
        self.table = MergeTable(path)
        spelled = self.table.spelled
        self.inner = {s: i for i, (s, final) in spelled.items() if not final}
        self.final = {s: i for i, (s, final) in spelled.items() if final}
        if not self.table.has_final:
            self.final = self.inner
        self.prefixes = {s[:n] for s, _ in spelled.values() for n in range(1, len(s))}
        self.follows: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self):
        self.states = {(b"", (None,), (0,)): 0}
        self.keys = [(b"", (None,), (0,))]
        self.next: list[dict[int, tuple[int, int]]] = [{}]
        self.last: list[dict[int, int]] = [{}]
        self.size = 0

    def may_follow(self, a: int, b: int) -> bool:
        """Whether encoding the two tokens' symbols together gives just these two tokens."""
        found = self.follows.get((a, b))
        if found is None:
            if len(self.follows) >= TRANSITIONS_KEPT:
                self.follows.clear()
            (left, _), (right, final) = self.table.spelled[a], self.table.spelled[b]
            ids = [self.table.plain_ids[x] for x in left + right]
            if final:
                ids[-1] = self.table.final_ids[right[-1]]
            found = self.follows[a, b] = self.table.merge(ids) == [a, b]
        return found

    def _token(self, key, symbol: int, vocabulary: dict) -> tuple[int, int]:
        tail, lasts, counts = key
        for j in range(len(tail) + 1):
            t = vocabulary.get(tail[j:] + bytes([symbol]))
            if t is not None and (lasts[j] is None or self.may_follow(lasts[j], t)):
                return t, counts[j] + 1
        raise ValueError("the vocabulary does not cover every byte")

    def _compile(self, state: int, symbol: int) -> tuple[int, int]:
        key = tail, lasts, counts = self.keys[state]
        token, delta = self._token(key, symbol, self.inner)
        tail, lasts, counts = tail + bytes([symbol]), (*lasts, token), (*counts, delta)
        drop = next(j for j in range(len(tail) + 1) if tail[j:] in self.prefixes or j == len(tail))
        key = (tail[drop:], lasts[drop:], tuple(c - delta for c in counts[drop:]))
        if (at := self.states.get(key)) is None:
            at = self.states[key] = len(self.keys)
            self.keys.append(key)
            self.next.append({})
            self.last.append({})
        self.next[state][symbol] = at, delta
        self.size += 1
        return at, delta

    def count(self, word: bytes) -> int:
        if self.size >= TRANSITIONS_KEPT:
            self.reset()
        state, total = 0, 0
        for symbol in word[:-1]:
            state, delta = self.next[state].get(symbol) or self._compile(state, symbol)
            total += delta
        delta = self.last[state].get(word[-1])
        if delta is None:
            delta = self.last[state][word[-1]] = self._token(self.keys[state], word[-1], self.final)[1]
            self.size += 1
        return total + delta


class Counter:
    """Counts the tokens of texts as the vocabulary's library does, without running it."""

    def __init__(self, path: str):
        self.merger = Merger(path)
        self.classes, (self.after, self.emits) = class_table(), splitter()
        self.special = regex.compile("|".join(map(regex.escape, self.merger.table.special)) or "(?!)")
        self.words, self.older = {}, {}

    def normal(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
        return lowered(text)

    def bounds(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every word in an array of code points that ends with a space."""
        kinds = self.classes[points]
        for i in np.flatnonzero(points == 39):
            a, b = (*points[i + 1 : i + 3].tolist(), 0, 0)[:2]
            if a in (100, 109, 115, 116):
                kinds[i] = SHORT
            elif (a, b) in ((114, 101), (118, 101), (108, 108)):
                kinds[i] = LONG
        n = len(kinds)
        grid = np.full(-(-n // CHUNK) * CHUNK, SPACE, np.intp)
        grid[:n] = kinds
        columns = np.ascontiguousarray(grid.reshape(-1, CHUNK).T)
        maps = np.tile(np.arange(STATES), (columns.shape[1], 1))
        for column in columns:
            maps = self.after[maps * CLASSES + column[:, None]]
        state = np.concatenate([[BETWEEN], scan(maps)[:-1, BETWEEN]])
        marks = np.empty(columns.shape, np.uint8)
        for j, column in enumerate(columns):
            at = state * CLASSES + column
            marks[j], state = self.emits[at], self.after[at]
        begins = marks.T.ravel()[:n].astype(bool)
        cuts = np.flatnonzero(begins | (kinds == SPACE))
        mine = np.flatnonzero(begins[cuts])
        return cuts[mine], cuts[mine + 1]

    def _miss(self, word: str) -> int:
        found = self.older.get(word)
        if found is None:
            found = self.merger.count(word.encode())
        if len(word) <= WORD_CHARS:
            if 2 * len(self.words) >= WORDS_KEPT:
                self.words, self.older = {}, self.words
            self.words[word] = found
        return found

    def _block(self, text: str, owner_ends: np.ndarray, totals: np.ndarray, owners: list[int]) -> None:
        """Add the counts of joined parts; part k is owners[k]'s and ends before owner_ends[k]."""
        begin, end = self.bounds(np.frombuffer(text.encode("utf-32-le"), "<u4"))
        get, miss = self.words.get, self._miss
        counts = [get(w := text[a:b]) or miss(w) for a, b in zip(begin.tolist(), end.tolist())]
        part = np.searchsorted(owner_ends, begin, side="right")
        np.add.at(totals, np.array(owners, np.intp)[part], counts)

    def count(self, texts: list[str | None]) -> list[int]:
        totals, joined, ends, owners, size = np.zeros(len(texts), np.int64), [], [], [], 0

        def flush():
            nonlocal joined, ends, owners, size
            if joined:
                self._block(" ".join(joined) + " ", np.array(ends), totals, owners)
            joined, ends, owners, size = [], [], [], 0

        for k, text in enumerate(texts):
            at = 0
            for m in [*self.special.finditer(text or ""), None]:
                part = (text or "")[at : m.start() if m else None]
                totals[k] += m is not None
                at = m.end() if m else 0
                for piece in self._pieces(self.normal(part)):
                    joined.append(piece)
                    size += len(piece) + 1
                    ends.append(size)
                    owners.append(k)
                    if size >= BLOCK_CHARS:
                        flush()
        flush()
        return totals.tolist()

    @staticmethod
    def _pieces(text: str):
        """The text, cut at spaces when it is longer than a block."""
        while len(text) > BLOCK_CHARS and (cut := text.find(" ", BLOCK_CHARS)) >= 0:
            yield text[:cut]
            text = text[cut:]
        yield text


def counter(path: str) -> Counter:
    return worker_cache(("token counter", path), lambda: Counter(path))


def count_tokens(df: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """df plus `n_tokens`; one narrow stage, no shuffle."""
    return mapped(df, text, [("n_tokens", "bigint", pa.int64())], lambda texts: (counter(tokenizer).count(texts),), ("token counter", tokenizer))


def op3_token_counts(spark: SparkSession, sf_dir: str, limit: int = 2048) -> DataFrame:
    from .vocabularies import path

    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    docs = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    counted = count_tokens(docs, path("word_bpe_49k.json")).drop("text")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
