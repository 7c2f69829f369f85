"""Secrets in whole texts: fixed patterns, and credential values that are hard to guess.

The fixed patterns find assignments to credential names, access keys and long hexadecimal runs.
Beyond them, every value that stands in a credential context gets a guess cost: the cheapest
way to write it as words, dates, repeats, keyboard walks and brute-force stretches, by dynamic
programming over its positions. Each piece costs the logarithm of the guesses it needs and a
little for being a piece of its own. A brute-force stretch pays for each change between lower
case, upper case, digits and other characters, so short values of mixed characters are dear,
while unknown words of one kind (up to 9 characters, a capital in front allowed) stay cheap. Values of at least `MIN_BITS` that no fixed pattern covers
are reported as kind `guess`; placeholders such as a word with a year stay below it.

Word ranks come from all documents: a grouped count of their words, of which the most frequent
`DICTIONARY` are kept, so what is sent to the executors is bounded.

Positions are code points, ends exclusive. A null text is empty and has no secrets; repeated
rows are scanned each; an empty table gives an empty result and an empty dictionary. Very long texts
and values take time in proportion to their length. Columns other than id and text are ignored,
whatever their names.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import lean, staged, table

KINDS = ("assign", "access", "hex", "guess")
MIN_BITS = 32.0
PIECE_BITS = 2.0
BRUTE_BITS = math.log2(10)
SWITCH_BITS = PIECE_BITS + math.log2(4)  # to one of the kinds of characters
DICTIONARY = 20_000
WORD_LENGTHS = (3, 24)

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Names that announce a credential, what may stand between, and its value.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth(?:orization)?|(?:api|access|private|client|secret)[ _-]?key)"""
    r"""["']?[ \t]*(?:=>|:=|[:=])[ \t]*(?:bearer[ \t]+|basic[ \t]+)?["']?([^\s"'<>,;(){}\[\]]{6,})""", re.I | re.A)
HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "key")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")
#: Rows of a keyboard, first choices among passwords.
KEY_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
FIRST_CHOICES = ("password", "admin", "secret", "changeme", "letmein", "welcome", "example", "test", "token", "default",
                 "root", "user", "login", "qwerty", "monkey", "dragon", "master", "your", "here", "none", "null", "true")
_PLACE = {c: (r, k) for r, keys in enumerate(KEY_ROWS) for k, c in enumerate(keys)}
_DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")
_PLAIN = str.maketrans("4@301$5!7", "aaeoissit")


def _neighbours(a: str, b: str) -> bool:
    """Whether two keys touch: same row side by side, or adjacent rows with the usual half-key offset."""
    if a not in _PLACE or b not in _PLACE:
        return False
    (r1, k1), (r2, k2) = _PLACE[a], _PLACE[b]
    if r1 == r2:
        return abs(k1 - k2) == 1
    return r2 - r1 == 1 and k2 - k1 in (-1, 0) or r1 - r2 == 1 and k1 - k2 in (-1, 0)


_TOUCHING = {(a, b) for a in _PLACE for b in _PLACE if _neighbours(a, b)}


def _case_bits(word: str) -> float:
    upper = sum(c.isupper() for c in word)
    if not upper:
        return 0.0
    if upper == len(word) or upper == 1 and word[0].isupper():
        return 1.0
    return math.log2(sum(math.comb(len(word), k) for k in range(1, min(upper, len(word) - upper) + 1)) + 1)


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def _switches(value: str) -> list[float]:
    """For each character, what a brute-force stretch pays to go on to it from the one before."""
    kinds = [_kind(c) for c in value]
    out = [0.0] + [SWITCH_BITS if a != b else 0.0 for a, b in zip(kinds, kinds[1:])]
    if kinds[:2] == [1, 0]:
        out[1] = 1.0  # a capital in front
    return out


class Ranks(dict):
    """Ranks of words, and what their words begin with."""

    def __init__(self, ranks: dict[str, int]):
        super().__init__(ranks)
        self.beginnings = {w[:WORD_LENGTHS[0]] for w in ranks}


def _lower(value: str) -> str:
    """Lower case of the same length: characters whose lower case is longer stay."""
    low = value.lower()
    return low if len(low) == len(value) else "".join(x if len(x) == 1 else c for c, x in ((c, c.lower()) for c in value))


class _Walks:
    """The cheapest way to end a keyboard walk at each place, whatever its start.

    A walk from i to x costs base(i) + log2(x - i) and what its turns cost, so of two starts the
    later one is cheaper first and the earlier one may overtake it once, at a time that is known.
    Starts that are overtaken are removed when their time comes, so the latest one left is the cheapest.
    """

    TURN_BITS = math.log2(4.6)
    KEY_BITS = math.log2(47)

    def __init__(self, text: str):
        n = len(text)
        self.begin, self.turns = list(range(n)), [0] * n  # of each place: where its walk begins, turns up to it
        for k in range(1, n):
            self.turns[k] = self.turns[k - 1]
            if (text[k - 1], text[k]) in _TOUCHING:
                self.begin[k] = self.begin[k - 1]
                if k - 2 >= self.begin[k] and _step(text, k) != _step(text, k - 1):
                    self.turns[k] += 1
        self._reset()

    def _reset(self) -> None:
        self.base: dict[int, float] = {}
        self.before: dict[int, int] = {}
        self.after: dict[int, int] = {}
        self.last, self.due = None, []

    def _watch(self, i: int, j: int) -> None:
        ratio = 2.0 ** min(self.base[j] - self.base[i], 500.0)
        if ratio > 1:
            heapq.heappush(self.due, ((ratio * j - i) / (ratio - 1), i, j))

    def _drop(self, j: int) -> None:
        i, k = self.before.pop(j, None), self.after.pop(j, None)
        del self.base[j]
        if i is not None:
            self.after.pop(i, None)
        if k is not None:
            self.before.pop(k, None)
            if i is not None:
                self.before[k], self.after[i] = i, k
                self._watch(i, k)
        if self.last == j:
            self.last = i

    def ending_at(self, stop: int, best: list[float]) -> float:
        """The least cost of a prefix that ends with a walk of 3 or more keys up to `stop`; best(i) is known before."""
        start = stop - 3
        if start < 0 or self.begin[stop - 1] > start:
            return math.inf
        if self.last is not None and self.begin[stop - 1] != self.begin[self.last]:
            self._reset()
        base = best[start] - self.turns[start + 1] * self.TURN_BITS
        while self.last is not None and self.base[self.last] >= base:
            self._drop(self.last)  # dearer from now on
        self.base[start] = base
        if self.last is not None:
            self.before[start], self.after[self.last] = self.last, start
            self._watch(self.last, start)
        self.last = start
        while self.due and self.due[0][0] <= stop:
            _, i, j = heapq.heappop(self.due)
            if self.after.get(i) == j:
                self._drop(j)
        i = self.last
        return self.base[i] + PIECE_BITS + self.KEY_BITS + math.log2(stop - i) + (1 + self.turns[stop - 1]) * self.TURN_BITS


def guess_bits(value: str, ranks: dict[str, int]) -> float:
    """Log2 of the guesses for the cheapest segmentation of a value."""
    n, low = len(value), _lower(value)
    plain = low.translate(_PLAIN)
    best = [0.0] + [math.inf] * n  # cheapest cost of a prefix
    closed = best.copy()  # the same, not ending in a brute-force stretch
    brute = [math.inf] * (n + 1)  # the same, ending in an open brute-force stretch
    switch = _switches(value)
    runs, walks = _run_ends(low), _Walks(low)
    beginnings = (ranks if isinstance(ranks, Ranks) else Ranks(ranks)).beginnings
    for i in range(n):
        closed[i] = min(closed[i], walks.ending_at(i, best))
        best[i] = min(closed[i], brute[i])
        brute[i + 1] = min(brute[i] + switch[i], closed[i] + PIECE_BITS) + BRUTE_BITS
        here = best[i] + PIECE_BITS
        begins = low[i:i + WORD_LENGTHS[0]] in beginnings or plain[i:i + WORD_LENGTHS[0]] in beginnings
        for size in range(WORD_LENGTHS[0], min(WORD_LENGTHS[1], n - i) + 1) if begins else ():
            word = low[i:i + size]
            rank = ranks.get(word)
            swapped = 0.0
            if rank is None and plain[i:i + size] != word:
                rank, swapped = ranks.get(plain[i:i + size]), 2.0
            if rank is not None:
                closed[i + size] = min(closed[i + size], here + math.log2(rank) + _case_bits(value[i:i + size]) + swapped)
        if low[i].isdigit() and (m := _DATE.match(low, i)):
            cost = math.log2(120 * 365 * 4) if m.end() - i > 4 else math.log2(120)
            closed[m.end()] = min(closed[m.end()], here + cost)
        for unit, end in runs.get(i, ()):
            cost = unit * BRUTE_BITS + math.log2((end - i) / unit)
            for stop in range(i + 2 * unit, end + 1, unit):
                closed[stop] = min(closed[stop], here + cost)
    return min(closed[n], brute[n], walks.ending_at(n, best))


def _run_ends(text: str) -> dict[int, list[tuple[int, int]]]:
    """Start -> (unit, end) of stretches that repeat a unit of 1 to 4 characters over 3 or more characters."""
    found: dict[int, list[tuple[int, int]]] = {}
    for unit in range(1, 5):
        i = 0
        while i + 2 * unit <= len(text):
            end = i + unit
            while end < len(text) and text[end] == text[end - unit]:
                end += 1
            end -= (end - i) % unit
            if end - i >= max(3, 2 * unit):
                found.setdefault(i, []).append((unit, end))
                i = end
            else:
                i += 1
    return found


def _step(text: str, i: int) -> tuple[int, int]:
    (r1, k1), (r2, k2) = _PLACE[text[i - 1]], _PLACE[text[i]]
    return r2 - r1, k2 - k1


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns."""
    out = []
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def scan(text: str, ranks: dict[str, int], least: float = MIN_BITS) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all secrets of a text, in order."""
    low = text.lower()
    found = base_spans(text, low)
    if any(h in low for h in HINTS):
        taken, seen, reached = list(found), 0, -1
        for m in CONTEXT.finditer(text):
            a, b = m.span(1)
            while seen < len(taken) and taken[seen][0] < b:
                seen, reached = seen + 1, max(reached, taken[seen][2])
            if reached <= a and guess_bits(text[a:b], ranks) >= least:
                found.append((a, 3, b))
    return sorted(found)


def word_ranks(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> dict[str, int]:
    """Ranks of the most frequent words of all documents, after the fixed first choices.

    A histogram of the counts, in bins by their logarithm, first tells from which count on words can
    be among the most frequent; only those are ordered, and only the result goes to the driver.
    """
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col).cast("string")), "[^a-z]+")).alias("w"))
    words = words.where(F.length("w").between(*WORD_LENGTHS)).groupBy("w").agg(F.count("*").alias("n"))
    counted = staged(words.withColumn("bin", F.floor(F.log2("n") * 16).cast("int")), "words")
    least, held = 0, 0
    for r in sorted(counted.groupBy("bin").count().collect(), key=lambda r: -r.bin):  # about a thousand bins
        least, held = r.bin, held + r["count"]
        if held >= size:
            break
    top = staged(counted.where(F.col("bin") >= least).orderBy(F.desc("n"), "w").limit(size), "ranks")
    ranks: dict[str, int] = {}
    for word in (*FIRST_CHOICES, *(r.w for r in sorted(top.collect(), key=lambda r: (-r.n, r.w)))):
        ranks.setdefault(word, len(ranks) + 1)
    return ranks


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: dict[str, int] | None = None,
                 least: float = MIN_BITS) -> DataFrame:
    """(id, spans): array of (start, kind, end) per row, by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(Ranks(word_ranks(docs, text_col) if ranks is None else ranks))
    span = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                spans = [[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in scan(text or "", shared.value, least)]
                         for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, pa.list_(span))], names=["id", "spans"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(lean(run), "id long, spans array<struct<start: long, kind: string, end: long>>")


def op6_secret_scan(spark, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(F.col("id").alias("doc_id"), *map(number, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
