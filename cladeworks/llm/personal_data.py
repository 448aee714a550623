"""Personal data: candidate generators, gradient-boosted trees over format and context, calibrated thresholds.

The base rules find e-mail addresses, IPv4 addresses, payment cards and international phone numbers; their spans
always stay. High-recall generators then propose further, overlapping spans (runs of digits inside longer runs,
national phone numbers, spelled-out addresses, IPv6, access keys, passwords and tokens). Boosted trees score each
candidate by its own format (lengths, character classes, entropy, check digits) and its context (cue words,
assignment signs, neighbouring characters). Each kind has the least threshold that reaches PRECISION on held-out
examples; of overlapping spans that pass, base spans win, then the highest score.

The trees are fitted here on examples that are made up by a fixed seed, so no labels are read.

Offsets are code points, end exclusive. Every pattern takes time linear in the text. Edge cases: a null or empty
text has no spans; columns of the input named like the added ones are replaced; repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import gbt
from .bpe_codec import mapped
from .common import spread, table

#: Kinds in the order of reports: the base kinds, then what only the trees find.
KINDS = ("email", "ip", "card", "phone", "secret")
#: Share of right spans among held-out examples that each threshold must reach.
PRECISION = 0.99
CONTEXT = 28

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """The check digit of payment cards."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def octets(s: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in s.split("."))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base rules, leftmost and non-overlapping within each kind."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = last + len(text[last:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append(("email", begin, m.end()))
        last = m.end() if m else at + 1
        at = text.find("@", last)
    out += [("ip", *m.span()) for m in _IP.finditer(text) if octets(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


#: Proposals by kind; group "s", or all, is the span.
GENERATORS = [
    ("email", re.compile(r"(?<![\w.+-])[\w.+-]{1,64} ?[\[({] ?(?:at|AT) ?[\])}] ?[\w-]{1,63}(?: ?(?:\.|[\[({] ?(?:dot|DOT) ?[\])}]) ?[A-Za-z][\w-]{1,62}){1,4}")),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{3,4}){2}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")),
    ("secret", re.compile(r"(?<![A-Za-z0-9_/+=-])(?P<s>[A-Za-z0-9_/+-]{16,}+={0,2}+)(?![A-Za-z0-9_/+=-])")),
    ("secret", re.compile(r"(?:[Pp]assw(?:or)?d|PASSWORD|[Ss]ecret|[Tt]oken|[Aa]pi[_-]?[Kk]ey|[Kk]ey)[\"']? ?[=:] ?[\"']?(?P<s>[^\s\"'<>,;]{6,}+)")),
]

#: Words that speak for a kind when they stand close before a span.
CUES = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "addr"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "secret": ("passw", "secret", "token", "key", "auth", "login", "pwd"),
}

#: What every candidate has: a digit, an @, a spelled-out one, or a cue word of secrets.
_ANY = re.compile(r"[0-9@]|[\[({] ?(?:at|AT) ?[\])}]|(?i:" + "|".join(CUES["secret"]) + ")")


def features(text: str, kind: str, begin: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    s, before, after = text[begin:end], text[max(0, begin - CONTEXT) : begin], text[end : end + 2]
    digits, near = _digits(s), before.lower()
    n, letters = len(s), [c for c in s if c.isalpha()]
    upper = sum(c.isupper() for c in letters)
    counts = np.array(list(Counter(s).values())) / n
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(s, s[1:]))
    hexa = sum(c in "0123456789abcdefABCDEF" for c in s)
    return [
        KINDS.index(kind), n, len(digits) / n, len(letters) / n, upper / max(1, len(letters)), len(digits), turns, float(-(counts * np.log2(counts)).sum()),
        hexa / n, len(set(digits)), float(kind == "card" and luhn(digits)), float(kind == "ip" and (":" in s or octets(s))),
        sum(c in " .-()" for c in s), float(s[:1] in "456"), float(s[0] == "+"), float(s[:4] in ("AKIA", "ASIA", "ghp_", "xoxb") or s[:3] in ("sk-", "pk-")),
        float(any(c in near for c in CUES[kind])), float(any(c in near for k, v in CUES.items() if k != kind for c in v)),
        float(near.rstrip(" \"'")[-1:] in tuple("=:")), float(before[-1:] in tuple("\"'")), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(before[-1:] in tuple("/.-_")), float(bool(after) and after[0] in "/.-_" and after[1:].isalnum()), float(re.search(r"[0-9] ?$", before) is not None),
    ]


def _cued(text: str, begin: int) -> bool:
    near = text[max(0, begin - CONTEXT) : begin].lower()
    return any(c in near for c in CUES["secret"])


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping proposals of all generators."""
    out = []
    for kind, pattern in GENERATORS:
        for m in pattern.finditer(text):
            begin, end = m.span("s") if "s" in pattern.groupindex else m.span()
            if kind != "secret" or any("0" <= c <= "9" for c in text[begin:end]) or _cued(text, begin):
                out.append((kind, begin, end))
    return out


def _examples(seed: int, n: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Made-up candidates in context: features, whether the span is personal data, and kind."""
    rng = np.random.default_rng(seed)
    pick = lambda *x: x[rng.integers(len(x))]
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    word = lambda: "".join(pick(*"aeiounrstlmdch") for _ in range(rng.integers(2, 10)))
    over = lambda alphabet, k: "".join(pick(*alphabet) for _ in range(k))
    low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def card(good=True, k=16):
        body = pick("4", "5", "37", "6011", num(1)) if good else num(2)
        body = (body + num(k))[: k - 1]
        check = next(str(c) for c in range(10) if luhn(body + str(c)))
        return body + (check if good else str((int(check) + int(rng.integers(1, 10))) % 10))

    def grouped(s, sep):
        return sep.join(s[i : i + 4] for i in range(0, 16, 4)) if sep else s

    def made(kind):
        good = bool(rng.integers(2))
        if kind == "card":
            return good, grouped(card(good), pick("", "", " ", "-")) if rng.random() < 0.8 else card(good, pick(13, 15, 17, 18, 19))
        if kind == "ip":
            if good:
                return good, pick(".".join(str(x) for x in rng.integers(0, 256, 4)), ":".join(f"{x:x}" for x in rng.integers(1, 65536, 8)))
            return good, ".".join(str(x) for x in rng.integers(256, 1000, 4))
        if kind == "phone":
            if good:
                return good, pick("+%s (%s) %s-%s", "+%s %s %s %s", "+%s-%s-%s-%s") % (pick("1", "33", "49"), num(3), num(3), num(4)) if rng.random() < 0.6 else f"({num(3)}) {num(3)}-{num(4)}"
            return good, pick(f"{num(3)} {num(3)} {num(4)}", f"{num(3)}.{num(3)}.{num(4)}")
        if kind == "email":
            user, host = word() + pick("", "." + num(2)), word()
            if good:
                return good, f"{user}{pick(' [at] ', '(at)', ' (at) ')}{host}{pick('.', ' [dot] ', ' (dot) ')}{pick('com', 'org', 'net', 'de')}"
            return good, f"{user} (at) {host}. {word()}"
        if good:
            return good, pick(
                "AKIA" + over(up + "234567", 16), over("0123456789abcdef", pick(18, 32, 40, 64)), "ghp_" + over(low + up + "0123456789", 36),
                over(low + up + "0123456789", pick(20, 24, 32)), "sk-" + over(low + up + "0123456789", 32), word() + num(4) + pick("!", "#", ""),
            )
        return good, pick(f"{word()}-{word()}-{num(4)}-{word()}", word() * 3 + num(1), f"{word()}_{word()}_{word()}{num(2)}", f"{word()}/{word()}/{word()}{num(4)}", "0" * 16 + num(2), num(16))

    x, y, kinds = [], [], []
    for k in range(n):
        kind = KINDS[k % len(KINDS)]
        good, s = made(kind)
        cue = rng.random()
        lead = pick(*CUES[kind]) + pick(" ", ": ", " = ", "=", ' = "') if cue < (0.5 if good else 0.0 if kind == "secret" else 0.1) else ""
        if kind == "secret" and good and len(s) < 18:  # a short password is one only where it is called so
            lead = pick("password", "passwd", "pwd token", "secret") + pick("=", ": ", " = ")
        if kind == "phone" and not good and lead:
            good = True
        noise = num(3) + " " if rng.random() < 0.1 else ""
        text = f"{word()} {word()} {noise}{lead}"
        begin = len(text)
        text += s + (" " + pick(num(16), word()) if rng.random() < 0.9 else ".")
        x.append(features(text, kind, begin, begin + len(s)))
        y.append(float(good))
        kinds.append(kind)
    for k in range(n // 20):  # without digits: passwords of several parts or cases, and ordinary words after the same cues
        good = bool(k % 2)
        s = pick(f"{word()}-{word()}-{word()}", f"{word()}_{word()}!", over(low + up, pick(12, 16, 20)), word().title() + word().title() + pick("!", "#")) if good else over("aeiounrstlmdch", 6 + k % 9) + pick("", "", ".")
        text = f"{word()} {pick('password', 'passwd', 'secret', 'token', 'key')}{pick('=', ': ', ' = ')}"
        begin = len(text)
        x.append(features(text + s + " " + word(), "secret", begin, begin + len(s)))
        y.append(float(good))
        kinds.append("secret")
    return np.array(x), np.array(y), kinds


@lru_cache
def model(seed: int = 7, examples: int = 6000) -> tuple[gbt.Trees, dict[str, float]]:
    """Trees, and the threshold of each kind: the least that reaches PRECISION on other examples."""
    x, y, _ = _examples(seed, examples)
    trees = gbt.fit(x, y, rounds=50, depth=4)
    x, y, kinds = _examples(seed + 1, examples)
    p, thresholds = trees.probability(x), {}
    for kind in KINDS:
        mine = np.array([k == kind for k in kinds])
        order = np.argsort(-p[mine], kind="stable")
        right = np.cumsum(y[mine][order]) / np.arange(1, mine.sum() + 1)
        reach = np.flatnonzero(right >= PRECISION)
        thresholds[kind] = max(0.5, float(p[mine][order][reach[-1]])) if len(reach) else 1.0
    return trees, thresholds


def find(text: str | None, trees: gbt.Trees, thresholds: dict[str, float]) -> tuple[list, list]:
    """(base spans, all spans), each sorted by kind as in KINDS, then begin."""
    if not text or not _ANY.search(text):
        return [], []
    order = lambda s: (KINDS.index(s[0]), s[1], s[2])
    base = sorted(base_spans(text), key=order)
    free = np.ones(len(text), bool)
    for _, b, e in base:
        free[b:e] = False
    proposed = [c for c in dict.fromkeys(candidates(text)) if free[c[1] : c[2]].all()]
    added: list[tuple[str, int, int]] = []
    if proposed:
        p = trees.probability(np.array([features(text, *c) for c in proposed]))
        for k in np.argsort(-p, kind="stable").tolist():
            kind, b, e = proposed[k]
            if p[k] >= thresholds[kind] and free[b:e].all():
                free[b:e] = False
                added.append(proposed[k])
    return base, sorted(base + added, key=order)


def find_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """df plus base_spans and spans: arrays of (kind, begin, end); one narrow stage."""
    kind = "array<struct<kind:string,begin:bigint,end:bigint>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
    sent = df.sparkSession.sparkContext.broadcast(model())

    def make(texts):
        found = [find(t, *sent.value) for t in texts]
        as_rows = lambda spans: [{"kind": k, "begin": b, "end": e} for k, b, e in spans]
        return [as_rows(f[0]) for f in found], [as_rows(f[1]) for f in found]

    return mapped(df, text, [("base_spans", kind, arrow), ("spans", kind, arrow)], make)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """df with every span of personal data replaced by its kind in angle brackets; a null text stays null.

    Overlapping spans are replaced as one, named by the first.
    """
    sent = df.sparkSession.sparkContext.broadcast(model())

    def clean(t):
        spans = sorted(find(t, *sent.value)[1], key=lambda s: (s[1], -s[2]))
        out, at = [], 0
        for kind, b, e in spans:
            if b >= at:
                out += [t[at:b], f"<{kind.upper()}>"]
            at = max(at, e)
        return "".join(out) + t[at:] if out else t

    fields = df.columns
    return mapped(df, text, [("__clean", "string", pa.string())], lambda texts: ([clean(t) for t in texts],)).withColumn(text, F.col("__clean")).select(*fields)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = find_personal_data(docs)
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select("doc_id", *map(count, KINDS[:4]), F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"))
