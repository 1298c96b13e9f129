"""Secret scan: fixed patterns, and a guess-cost dynamic program over values in credential context.

The dynamic program finds the cheapest segmentation of a value into dictionary words, dates, repeats, keyboard walks
and brute-force spans; costs are log2 of the guesses that an attacker needs for a span. A value whose cheapest
segmentation still costs many guesses is a secret although no fixed pattern names its shape. The dictionary is a fixed
list of words that are frequent in passwords, and after it the most frequent words of the corpus itself, counted over
all of its texts.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmill.shared import bounded_batches

# The base patterns, in the order that breaks ties between spans with one start.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a longest run of 24 or more
KINDS = ("assign", "access", "hex", "guess")
MIN_ASSIGN, MIN_ACCESS = 6, 20

#: Credential context: a name, then at most a few separators, then the value.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?|credentials?|bearer|login|pin)"""
    r"""["']?(?:\x20*(?::=|=>|[:=])\x20*|\x20+is\x20+)(?:bearer\x20+|basic\x20+)?["'`]?([^\s"'`,;<>(){}\[\]]+)""",
    re.ASCII | re.IGNORECASE,
)
#: Values of fewer characters are no candidates, and a value is a secret from this cost on (log2 of guesses; 2**33 is about 10**10).
MIN_VALUE, MIN_BITS = 6, 33.0
#: Walks and sequences may end anywhere in their first so many characters, or where they end altogether.
MAX_SPAN = 32
#: Words that the corpus adds to the dictionary, and how long they may be.
CORPUS_WORDS, WORD_LENGTHS = 20_000, (3, 20)

# Frequent words in passwords, most frequent first (the rank is the cost), and the rows of a keyboard.
WORDS = (
    "password pass admin welcome login user root test guest master dragon monkey shadow sunshine princess football "
    "baseball superman batman letmein trustno iloveyou love hello secret changeme default example sample demo temp "
    "summer winter spring autumn monday friday january march april june july august october december server system "
    "manager service public private token access key data base mysql oracle google apple orange banana cookie summer "
    "freedom whatever computer internet the and you for with your my new old big red blue green black white"
).split()
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("4@8301!57$", "aabeoiists")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DATE = re.compile(
    r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:(?:19|20)\d\d|\d\d)",
    re.ASCII,
)


class Ranks:
    """The rank of each word of a dictionary, and the length of the longest."""

    def __init__(self, words: Iterable[str] = ()):
        self.of: dict[str, int] = {}
        for w in (*WORDS, *words):
            self.of.setdefault(w, len(self.of) + 1)
        self.longest = max(map(len, self.of))


_RANKS = Ranks()


def corpus_words(texts: DataFrame, text_col: str = "text", words: int = CORPUS_WORDS) -> list[str]:
    """The most frequent runs of the letters a-z in all texts, most frequent first: a list whose length no input changes."""
    low, high = WORD_LENGTHS
    found = texts.select(F.explode(F.split(F.lower(F.col(text_col).cast("string")), "[^a-z]+")).alias("w")).where(F.length("w").between(low, high))
    return [r["w"] for r in found.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(words).select("w").collect()]


def _neighbours() -> dict[str, set[str]]:
    at = {c: (r, k) for r, row in enumerate(ROWS) for k, c in enumerate(row)}
    return {c: {d for d, (s, m) in at.items() if d != c and abs(r - s) <= 1 and abs(k - m) <= 1} for c, (r, k) in at.items()}


_NEXT = _neighbours()
_ALPHABETS = ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26))


def _class_bits(c: str) -> float:
    """Brute force tries every character of the character's class."""
    return math.log2(next((n for test, n in _ALPHABETS if test(c)), 33))


def _runs(joined: list[bool]) -> list[int]:
    """[at]: how many characters from a place on form one run, if joined[k] says that k and k + 1 go together."""
    out = [1] * (len(joined) + 1)
    for at in range(len(joined) - 1, -1, -1):
        if joined[at]:
            out[at] = out[at + 1] + 1
    return out


def _ends(at: int, run: int, max_span: int) -> Iterator[int]:
    yield from range(at + 3, at + min(run, max_span) + 1)
    if run > max_span:
        yield at + run


def _spans(v: str, ranks: Ranks = _RANKS, max_span: int = MAX_SPAN) -> Callable[[int], Iterator[tuple[int, float]]]:
    """For a place of v the (end, cost) of all patterns that start there; every table behind it is linear in v."""
    n, low = len(v), v.translate(_LOWER)
    plain = low.translate(LEET)
    step = [ord(b) - ord(a) for a, b in pairwise(v)]
    walk = _runs([b in _NEXT.get(a, ()) for a, b in pairwise(low)])
    count = _runs([k + 1 < len(step) and abs(s) == 1 and s == step[k + 1] for k, s in enumerate(step)])
    low_step = [ord(b) - ord(a) for a, b in pairwise(low)]
    turns = [0, 0, *accumulate(a != b for a, b in pairwise(low_step))]  # up to a place

    def spans(at: int) -> Iterator[tuple[int, float]]:
        for to in range(at + 3, min(n, at + ranks.longest) + 1):
            if rank := ranks.of.get(plain[at:to]):
                word = v[at:to]
                shifts = 0 if word.islower() else 1 if word[1:].islower() or word.isupper() else to - at
                yield to, math.log2(rank) + shifts + 2 * (plain[at:to] != low[at:to])
        if m := DATE.match(v, at, min(n, at + 10)):
            yield m.end(), math.log2(366) + math.log2(120) if m.end() - at > 4 else math.log2(120)
        for to in _ends(at, walk[at], max_span):
            yield to, math.log2(len(_NEXT)) + (to - at - 1) * 0.5 + min(turns[to - 1] - turns[at + 1], 3)
        if at + 1 < n and abs(step[at]) == 1:  # abc, 321
            for to in _ends(at, count[at] + 1, max_span):
                yield to, math.log2(36) + math.log2(to - at)

    return spans


def _repeats(value: str) -> list[list[int]]:
    """[unit - 1][at]: how many characters from a place on equal the one a unit later."""
    n = len(value)
    out = []
    for unit in range(1, min(8, n // 2) + 1):
        run = [0] * (n + 1)
        for at in range(n - unit - 1, -1, -1):
            run[at] = run[at + 1] + 1 if value[at] == value[at + unit] else 0
        out.append(run)
    return out


def guess_bits(value: str, ranks: Ranks = _RANKS, max_span: int = MAX_SPAN) -> float:
    """log2 of the guesses of the cheapest segmentation of a value; linear in its length."""
    n = len(value)
    least = [0.0] + [math.inf] * n
    repeats = _repeats(value)
    spans = _spans(value, ranks, max_span)
    for at in range(n):
        here = least[at]
        least[at + 1] = min(least[at + 1], here + _class_bits(value[at]))
        for to, cost in spans(at):
            least[to] = min(least[to], here + cost + 1)
        for unit, run in enumerate(repeats, 1):  # the unit once, then how often
            if (times := 1 + run[at] // unit) > 1 and times * unit >= 3:
                cost = sum(map(_class_bits, value[at : at + unit])) + math.log2(times) + 1
                least[at + times * unit] = min(least[at + times * unit], here + cost)
    return least[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted: code points, end exclusive."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def guess_spans(text: str, min_bits: float = MIN_BITS, ranks: Ranks = _RANKS, max_span: int = MAX_SPAN) -> list[tuple[int, int, int]]:
    """The values in credential context that take at least 2**min_bits guesses."""
    if ":" not in text and "=" not in text and " is " not in text:
        return []
    return [
        (m.start(1), 3, m.end(1))
        for m in CONTEXT.finditer(text)
        if m.end(1) - m.start(1) >= MIN_VALUE and guess_bits(m[1].rstrip("."), ranks, max_span) >= min_bits
    ]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bits: float = MIN_BITS, words: int = CORPUS_WORDS, max_span: int = MAX_SPAN) -> DataFrame:
    """One row per row of docs: id, n_assign, n_access, n_hex, n_guess, base_sha256, spans.

    Every whole text is scanned where it is read; only the counts of words are shuffled, of which `words` are added to
    the dictionary (0: none). Null and empty texts have no spans; repeated
    rows are each scanned; an empty table gives no rows; other columns of docs are ignored.
    """

    bounded_batches(docs.sparkSession)
    ranks = Ranks(corpus_words(docs, text_col, words) if words else ())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                more = guess_spans(text or "", min_bits, ranks, max_span)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((*n, len(more), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + more))))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"_id {kind}, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string").withColumnRenamed("_id", id_col)


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]", min_bits: float = MIN_BITS, words: int = CORPUS_WORDS, max_span: int = MAX_SPAN) -> DataFrame:
    """docs with every span of a secret replaced in its text, all other columns as they are.

    Of overlapping spans the first is marked and the rest goes with it. Null texts stay null, empty ones empty, rows
    that repeat are each redacted, an empty table gives no rows; columns of any other name pass through.
    """
    bounded_batches(docs.sparkSession)
    ranks = Ranks(corpus_words(docs, text_col, words) if words else ())

    @F.pandas_udf("string")
    def clean(texts):
        def one(text):
            if not text:
                return text
            out, at = [], 0
            for start, _, end in sorted(base_spans(text) + guess_spans(text, min_bits, ranks, max_span)):
                if start >= at:
                    out += [text[at:start], mark]
                at = max(at, end)
            return "".join(out) + text[at:]

        return texts.map(one)

    return docs.withColumn(text_col, clean(F.col(text_col)))
