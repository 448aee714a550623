"""Merge tables of byte-level BPE vocabularies, read from a tokenizers .json file.

Only the file is read; the merge rules are applied by the operators of this package.
"""

from __future__ import annotations

import heapq
import json

#: No merge.
NEVER = 1 << 40


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte, as byte-level vocabularies write them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeTable:
    """base: id of (byte, final); right[a](b, NEVER): the rank of a pair of ids; made: rank -> merged id.

    spelled[id] is (bytes, final): final marks symbols that carry the word-end suffix.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"].get("end_of_word_suffix") or ""
        vocab, alphabet = model["vocab"], byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.width = max(vocab.values()) + 1
        self.has_final = bool(suffix)
        self.base = {(b, False): vocab[c] for c, b in alphabet.items() if c in vocab}
        if suffix:
            self.base |= {(b, True): vocab[c + suffix] for c, b in alphabet.items() if c + suffix in vocab}
        self.spelled = {i: (bytes([b]), final) for (b, final), i in self.base.items()}
        ranks: dict[int, dict[int, int]] = {}
        self.made: list[int] = []
        for r, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            left, right, new = vocab[a], vocab[b], vocab[a + b]
            ranks.setdefault(left, {})[right] = r
            self.made.append(new)
            if new not in self.spelled:
                self.spelled[new] = (self.spelled[left][0] + self.spelled[right][0], self.spelled[right][1])
        none: dict[int, int] = {}
        self.right = [ranks.get(i, none).get for i in range(self.width)]
        self.plain_ids = [self.base.get((b, False), -1) for b in range(256)]
        self.final_ids = [self.base.get((b, True), -1) for b in range(256)]

    def symbols(self, word: bytes) -> list[int]:
        ids = list(map(self.plain_ids.__getitem__, word))
        if self.has_final and ids:
            ids[-1] = self.final_ids[word[-1]]
        return ids

    def merge(self, ids: list[int], short: int = 192) -> list[int]:
        """Apply the merges to a list of symbols, in place for short words.

        A short word holds its parts and, contiguously, the rank of each adjacent pair: find the least rank
        (leftmost on ties), delete that boundary, refresh the two neighbouring ranks. The scan is quadratic in
        the word's length, so longer pieces take the same steps from a heap.
        """
        if len(ids) < 2:
            return ids
        if len(ids) > short:
            return self._merge_long(ids)
        right, made = self.right, self.made
        ranks = [right[a](b, NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NEVER:
                break
            i = ranks.index(least)
            new = ids[i] = made[least]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = right[new](ids[i + 1], NEVER)
            if i:
                ranks[i - 1] = right[ids[i - 1]](new, NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        right, made, n = self.right, self.made, len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := right[a](b, NEVER)) < NEVER]
        heapq.heapify(heap)
        ids = ids[:]
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := right[ids[i]](ids[k], NEVER)) < NEVER:
                    heapq.heappush(heap, (s, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (s := right[ids[h]](ids[i], NEVER)) < NEVER:
                heapq.heappush(heap, (s, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]
