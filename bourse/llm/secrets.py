"""Secret scans (operator 3): fixed patterns, and guess-cost dynamic programming over credential-context values.

The base kinds are plain patterns. The method looks at every value that stands behind a credential word, whatever its
characters and length, and asks how many guesses an attacker needs: the cheapest way to cut the value into dictionary
words, dates, repeats, sequences, keyboard walks and brute-force spans, found by dynamic programming over positions. A
value that costs at least `GUESS_LIMIT` decimal orders of guesses and does not lie whole in one base span becomes a span
of kind ``context``; a cheap one (a placeholder, a word of prose) is left alone. The dictionary is a fixed list, then the
`DICTIONARY_WORDS` commonest words of the corpus outside credential values.

Offsets are code points, ends exclusive; a span is the whole match, key included.

Defined cases: null or empty text has no spans; texts are scanned whole; rows are judged alone, so ties and repeated
rows get equal results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.text import chunks, encoded

# Decimal orders of guesses from which a value counts as a secret: online guessing ends long before.
GUESS_LIMIT = 8.0
LEAST_VALUE = 6
REDACTED = "[SECRET]"
DICTIONARY_WORDS = 10_000
LONGEST_WORD = 24

# The base patterns and least lengths of the scan.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "context")

CONTEXT = re.compile(
    r"""(pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key)"""
    r"""["']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*["']?([^\s"'`,;<>|]+)""", re.A | re.I)
_HINTS = (b"pass", b"pwd", b"secret", b"token", b"credential", b"key")

# Words that guessers try first, commonest first.
COMMON = (
    "password 123456 qwerty admin welcome login secret letmein monkey dragon master test guest root user hello love "
    "sunshine princess football baseball iloveyou shadow superman batman trustno1 changeme default example sample "
    "dummy placeholder none null true false your here value string enter token key pass word access abc123 winter "
    "summer spring autumn january february march april june july august september october november december monday "
    "tuesday wednesday thursday friday saturday sunday the and for that this with from have not are was you all new "
    "old my me in of to is it on at by or an as be we he one two three red blue green black white house home work "
    "time day year good bad man woman boy girl dog cat star moon sun fire water"
).split()
_RANK = {word: rank for rank, word in enumerate(COMMON, 1)}
_KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_PLACE = {c: (x + y / 2, y) for y, row in enumerate(_KEYBOARD) for x, c in enumerate(row)}
_LEET = str.maketrans("@4310$57!", "aaeiossti")
_DATES = tuple(map(re.compile, (
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])",
    r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\1(?:19|20)\d\d", r"(?:19|20)\d\d")))


def _brute(c: str) -> float:
    return 1.0 if c.isdigit() else math.log10(26) if c.isalpha() and c.isascii() else math.log10(33) if c.isascii() else 3.0


def guess_cost(value: str, ranks: dict[str, int] = _RANK, limit: float = math.inf) -> float:
    """Decimal logarithm of the guesses that the cheapest segmentation of the value needs; exact below ``limit``.

    best[i] is the cost of the first i characters; each match from i to a later place offers best[i] plus its own cost
    and a factor of two for the choice of another segment. Matches are offered from every start to every end, but for
    those from a start in the same repeat, walk or sequence as an earlier one that is cheaper at every end. The unit of
    a repeat costs what its own cheapest segmentation does. A brute-force span grows by one character at a time.
    """
    n = len(value)
    lower = value.lower()
    lower = lower if len(lower) == n else value
    plain = lower.translate(_LEET)
    longest = max(map(len, ranks), default=0)
    turns = [0] * (n + 1)  # changes of direction on the keyboard before a place
    walk_end, sequence_end = [n] * n, [n] * n  # ends of the longest walk and sequence from a start
    for k in range(n - 1, -1, -1):
        here, last = _PLACE.get(lower[k]), _PLACE.get(lower[k + 1]) if k + 1 < n else None
        near = here and last and abs(here[0] - last[0]) <= 1 and abs(here[1] - last[1]) <= 1
        walk_end[k] = walk_end[k + 1] if near else k + 1
        step = ord(value[k + 1]) - ord(value[k]) if k + 1 < n else 0
        on = k + 2 < n and ord(value[k + 2]) - ord(value[k + 1]) == step
        sequence_end[k] = (sequence_end[k + 1] if on else k + 2) if abs(step) == 1 else k + 1
    for k in range(n):
        turns[k + 1] = turns[k] + (k >= 2 and walk_end[k - 2] > k and _step(lower, k) != _step(lower, k - 1))
    other = math.log10(2)
    best = [0.0] + [math.inf] * n  # ends in any segment
    open_span = math.inf  # ends in a brute-force span
    repeat_end: dict[int, int] = {}
    sources: dict[tuple, tuple[int, float]] = {}
    units: dict[str, float] = {}

    def offer(end: int, cost: float) -> None:
        if cost < best[end]:
            best[end] = cost

    for start in range(n):
        if start:
            step = _brute(value[start - 1])
            open_span = min(open_span, best[start - 1] + (other if start > 1 else 0.0)) + step
            offer(start, open_span)
        here = best[start] + (other if start else 0.0)
        if here >= limit:
            continue
        for size in range(3, min(longest, n - start) + 1):
            for text, penalty in ((lower, 0.0), (plain, 0.5)):
                rank = ranks.get(text[start : start + size])
                if rank:
                    case = 0.0 if value[start : start + size] == lower[start : start + size] else 0.5
                    offer(start + size, here + math.log10(rank + 1) + penalty + case)
        for pattern in _DATES:
            match = pattern.match(value, start)
            if match:
                offer(match.end(), here + math.log10(130) + (math.log10(365) if len(match[0]) > 4 else 0.0))
        end = walk_end[start]
        if end - start >= 4:
            old = sources.get(("walk", end))
            if not old or here < old[1] + math.log10((start + 4 - old[0]) / 4) + 0.6 * (turns[start + 2] - turns[old[0] + 2]):
                sources["walk", end] = start, here
                for to in range(start + 4, end + 1):
                    offer(to, here + math.log10(47 * (to - start)) + 0.6 * (turns[to] - turns[start + 2]))
        end = sequence_end[start]
        if end - start >= 4:
            old = sources.get(("sequence", end))
            if not old or here < old[1] + math.log10((start + 4 - old[0]) / 4):
                sources["sequence", end] = start, here
                for to in range(start + 4, end + 1):
                    offer(to, here + math.log10(62 * (to - start)))
        size, covered = 1, start  # a longer unit within a run of a shorter one is copies of it, unless it is a word
        while start + 2 * size <= n:
            if value[start] == value[start + size] and value.startswith(value[start : start + size], start + size):
                end = repeat_end.get(size, 0)
                if end < start + 2 * size:
                    end = start + 2 * size
                    while end < n and value[end] == value[end - size]:
                        end += 1
                    repeat_end[size] = end
                covered = max(covered, end)
                key = (size, end, start % size)
                old = sources.get(key)
                if not old or here < old[1] + math.log10(((start - old[0]) // size + 2) / 2):
                    sources[key] = start, here
                    unit = value[start : start + size]
                    if unit not in units:
                        units[unit] = guess_cost(unit, ranks, limit) if size > 2 else sum(map(_brute, unit))
                    for copies in range(2, (end - start) // size + 1):
                        offer(start + copies * size, here + units[unit] + math.log10(copies))
            size += 1
            if size > longest:
                size = max(size, (covered - start) // 2 + 1)
    if n:
        offer(n, min(open_span, best[n - 1] + (other if n > 1 else 0.0)) + _brute(value[n - 1]))
    return best[n]


def _step(text: str, i: int) -> tuple[float, float]:
    (x, y), (u, v) = _PLACE[text[i]], _PLACE[text[i - 1]]
    return x - u, y - v


def dictionary(docs: DataFrame) -> dict[str, int]:
    """Ranks of the fixed words, then of the commonest words of the corpus. What stands behind credential words is not
    counted: a password that many documents hold is no word for that."""
    prose = F.regexp_replace("text", "(?i)" + CONTEXT.pattern, " ")
    words = docs.select(F.explode(F.split(F.lower(prose), "[^a-z]+")).alias("word")).where(F.length("word").between(3, LONGEST_WORD))
    common = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(DICTIONARY_WORDS).select("word").toArrow()
    ranks = dict(_RANK)
    for word in common.column("word").to_pylist():
        ranks.setdefault(word, len(ranks) + 1)
    return ranks


def find(text: str, ranks: dict[str, int] = _RANK) -> list[tuple[str, int, int, int, int]]:
    """Spans (kind, start, end, value start, value end) of a text by start, then kind."""
    spans = [("assign", m.start(), m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    spans += [("access", m.start(), m.end(), m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", m.start(), m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    base = sorted((s[1], s[2]) for s in spans)
    for m in CONTEXT.finditer(text):
        inside = any(a <= m.start(2) and m.end(2) <= b for a, b in base)
        if not inside and m.end(2) - m.start(2) >= LEAST_VALUE and guess_cost(m[2], ranks, GUESS_LIMIT) >= GUESS_LIMIT:
            spans.append(("context", m.start(), m.end(), m.start(2), m.end(2)))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def may_hold(texts: list[bytes]) -> np.ndarray:
    """Which texts can have a span at all: a hint of a credential word, a run of 32 hex digits, or an access key."""
    out = np.zeros(len(texts), bool)
    digits = np.zeros(256, bool)
    digits[list(b"0123456789abcdef")] = True
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    edges = np.flatnonzero(np.diff(digits[data])) + 1
    starts, ends = edges[0::2], edges[1::2]
    bounds = np.cumsum([1, *(len(t) + 1 for t in texts)])
    out[np.searchsorted(bounds, starts[ends - starts >= 32], "right") - 1] = True
    for i, text in enumerate(texts):
        if not out[i]:
            lower = text.lower()
            out[i] = any(hint in lower for hint in _HINTS) or b"AKIA" in text
    return out


def _joined(spans: list[tuple[str, int, int, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _, _ in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_context long"


def scan(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of every document; one pass after that for the dictionary."""
    ranks = dictionary(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            texts = encoded(part.column("text"))
            rows = []
            for text, likely in zip(texts, may_hold(texts), strict=True):
                spans = find(text.decode(), ranks) if likely else []
                count = {kind: sum(s[0] == kind for s in spans) for kind in KINDS}
                base = _joined([s for s in spans if s[0] != "context"])
                rows.append((count["assign"], count["access"], count["hex"], hashlib.sha256(base.encode()).hexdigest(),
                             _joined(spans), count["context"]))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], [c.split()[0] for c in SCHEMA.split(", ")])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def redact(text: str, ranks: dict[str, int] = _RANK) -> str:
    """The text with the value of every span replaced; overlapping values are replaced once."""
    out, at = [], 0
    for start, end in sorted((s[3], s[4]) for s in find(text, ranks)):
        if end <= at:
            continue
        out += [text[at : max(start, at)], REDACTED] if start >= at else []
        at = end
    return "".join(out) + text[at:]


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with secrets replaced in ``text`` and ``n_chars`` counted anew where the text changed."""
    schema, ranks = docs.schema, dictionary(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            texts = encoded(part.column("text"))
            hit = may_hold(texts)
            old = part.column("text").to_pylist()
            new = [redact(t, ranks) if h else t for t, h in zip(old, hit, strict=True)]
            lengths = [len(t) if t != o else n for t, o, n in zip(new, old, part.column("n_chars").to_pylist(), strict=True)]
            columns = {name: part.column(name) for name in part.schema.names}
            columns |= {"text": pa.array(new, part.schema.field("text").type), "n_chars": pa.array(lengths, part.schema.field("n_chars").type)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), part.schema.names)

    return docs.mapInArrow(run, schema)
