"""Secret scanning: fixed patterns, and password guess costs in credential contexts.

Three patterns find key assignments, access keys and long hexadecimal strings.  Beyond
them, any value that a credential word is given is cut into words, dates, repeats, keyboard
walks and brute-force spans so that guessing it costs least; a value that even then costs
``bits`` or more is reported as ``guess``.

A value that opens with a quote goes up to the same quote on its line (a backslash keeps a
quote inside); one without quotes, or whose quote is not closed, ends at white space, a
bracket, a quote, a comma or a semicolon.

The costs are in bits.  Words cost by their place in a public vocabulary, whose order follows
frequency; brute-force characters by the size of their class, where the letters of a span are
of 26 if all have the same case and of 52 if not; every other span one bit more.

Defined cases: a null text counts as empty and has no spans; offsets are code points of the
unchanged text, ends exclusive; repeated rows get equal results; words and repeated units may
be of any length, and a very long value takes time in proportion to it.
"""

from __future__ import annotations

import base64
import functools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
KINDS = ("assign", "access", "hex", "guess")
SPANS = "array<struct<kind:string,start:int,end:int>>"

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CONTEXT = re.compile(
    r"""(?:pass(?:word|phrase|code|wd)|pwd|secret|token|credentials?|authorization|bearer"""
    r"""|(?:api|access|private|secret|encryption|signing)[_-]?key)["']?\x20*(?::=|=>|[:=])"""
    r"""\x20*(?:(["'`])(?:bearer\x20+|basic\x20+)?((?:\\[^\n]|[^\\\n])*?)\1"""
    r"""|["']?(?:bearer\x20+|basic\x20+)?([^\s"'`<>,;(){}\[\]]+))""",
    re.ASCII | re.IGNORECASE)
#: What a text needs for any of the patterns to match.
_NEEDED = r"(?i:pass|pwd|secret|token|credential|authorization|bearer|key)|AKIA|[0-9a-f]{32}"

_KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
_LEET = str.maketrans("4@301!5$7", "aaeoiisst")
_DATE = re.compile(
    r"(?:19|20)\d\d(?:([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
    r"|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)?\d\d")


def _neighbours() -> dict[str, set[str]]:
    place = {c: (row, col) for row, keys in enumerate(_KEYBOARD) for col, c in enumerate(keys)}
    return {a: {b for b, (r, c) in place.items()
                if a != b and abs(r - place[a][0]) <= 1 and abs(c - place[a][1]) <= 1}
            for a in place}


_NEAR = _neighbours()


@functools.cache
def word_costs(path: str = VOCABULARY) -> dict[str, float]:
    """Bits of each lower-case word of three letters or more, by its rank."""
    out: dict[str, float] = {}
    with open(path, "rb") as lines:
        for rank, line in enumerate(lines):
            raw = base64.b64decode(line.split()[0])
            word = raw.decode("utf-8", "ignore").strip().lower()
            if len(word) >= 3 and word.isalpha():
                out.setdefault(word, math.log2(rank + 2))
    return out


def _class_bits(c: str, mixed: bool = False) -> float:
    """Bits of a brute-force character; ``mixed`` if its span has letters of both cases."""
    if c.isdigit():
        return math.log2(10)
    if c.isalpha():
        return (math.log2(26) if c.isascii() else math.log2(100)) + mixed
    return math.log2(33)


def _is_mixed(part: str) -> bool:
    return part.lower() != part != part.upper()


#: What a brute-force span holds: letters of one case, or of both.
_LOWER, _UPPER, _BOTH = range(3)


@functools.cache
def _beginnings(path: str) -> frozenset[str]:
    """All beginnings of words, so that a lookup ends where no word goes on."""
    return frozenset(w[:n] for w in word_costs(path) for n in range(1, len(w) + 1))


class _Starts:
    """Starts of spans of one kind, of which the cheapest is wanted at each of many ends.

    A span from ``i`` to ``j`` costs ``a + log2((j - i) / unit)``.  Of two starts the later one
    is cheaper at first, if at all, and the earlier one from some end on for good.  So a stack
    of starts, each cheaper than those below it until its time is over, gives the least cost
    at growing ends in constant time on average.
    """

    def __init__(self, unit: int, end: int):
        self.unit, self.end = unit, end
        self.stack: list[tuple[int, float]] = []

    def _cost(self, entry: tuple[int, float], j: int) -> float:
        return entry[1] + math.log2((j - entry[0]) / self.unit)

    @staticmethod
    def _overtaken(older: tuple[int, float], newer: tuple[int, float]) -> float:
        """The end from which ``older``, dearer so far, is the cheaper one."""
        power = 2.0 ** min(newer[1] - older[1], 1000.0)
        return (power * newer[0] - older[0]) / (power - 1) if power > 1 else math.inf

    def add(self, start: int, a: float, j: int) -> None:
        stack, new = self.stack, (start, a)
        while stack:
            top = stack[-1]
            if self._cost(top, j) <= self._cost(new, j):
                return
            if top[1] >= a or (len(stack) > 1
                               and self._overtaken(top, new) >= self._overtaken(stack[-2], top)):
                stack.pop()
                continue
            break
        stack.append(new)

    def least(self, j: int) -> float:
        stack = self.stack
        while len(stack) > 1 and self._cost(stack[-2], j) <= self._cost(stack[-1], j):
            stack.pop()
        return self._cost(stack[-1], j) if stack else math.inf


def _walks(keys: str) -> tuple[list[int], list[int]]:
    """For each place the end of its run of neighbouring keys, and the turns up to and at it."""
    n = len(keys)
    end, turns = [n] * n, [0] * (n + 1)
    for i in range(n - 2, -1, -1):
        end[i] = end[i + 1] if keys[i + 1] in _NEAR.get(keys[i], ()) else i + 1
    for k in range(1, n - 1):
        bends = ord(keys[k + 1]) - ord(keys[k]) != ord(keys[k]) - ord(keys[k - 1])
        turns[k] = turns[k - 1] + bends
    return end, turns


def _repeats(value: str, most: int) -> dict[int, list[tuple[int, int]]]:
    """By end, (unit, end of the repetition) of all that repeats twice just there, with units of up
    to ``most`` characters that do not repeat themselves."""
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
    n, places = len(codes), np.arange(len(codes))
    found: dict[int, list[tuple[int, int]]] = {}
    runs: dict[int, np.ndarray] = {}
    for unit in range(1, min(most, n // 2) + 1):
        differs = np.ones(n, bool)
        differs[:n - unit] = codes[:n - unit] != codes[unit:]
        # How far a place is from the next that differs from the one a unit on.
        stop = np.where(differs, places, n)
        run = np.minimum.accumulate(stop[::-1])[::-1] - places
        twice = run >= unit
        for part, own in runs.items():
            if unit % part == 0:
                twice &= own < unit - part
        if twice.any():
            runs[unit] = run
        for i in np.flatnonzero(twice).tolist():
            found.setdefault(i + 2 * unit, []).append((unit, i + int(run[i]) + unit))
    return found


def guess_bits(value: str, words: dict[str, float], bound: float = math.inf,
               beginnings: frozenset[str] | None = None) -> float:
    """Bits to guess ``value``: the least over all ways to cut it into spans.

    Exact below ``bound``; else any figure that is no smaller than it.  The time grows with the
    value's length, whatever it holds: walks and repeats of any length are met at each of their
    ends in constant time, and the search ends where all costs have passed the bound.  A repeat's
    unit is no longer than what the bound pays for, as its first round is brute force.
    """
    n = len(value)
    if beginnings is None:
        beginnings = frozenset(w[:k] for w in words for k in range(1, len(w) + 1))
    lower = value.lower()
    if len(lower) != n:  # a letter whose small form is longer
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = lower.translate(_LEET)
    keys = lower.translate(_SHIFTED)
    walk_end, turns = _walks(keys)
    cheapest = min(math.log2(10), math.log2(26))
    repeats = _repeats(value, n if bound == math.inf else int(bound / cheapest) + 1)
    open_until = walk_end + [n]  # the end of what may begin here
    for end, found in repeats.items():
        for unit, stop in found:
            open_until[end - 2 * unit] = max(open_until[end - 2 * unit], stop)
    best = [0.0] + [math.inf] * n  # after a span of another kind
    brute = [0.0, 0.0, 0.0]  # within a brute-force span, by its cases, up to here
    here = [0.0] * (n + 1)  # the least of both, and the bit of a span that follows
    walk: _Starts | None = None
    stacks: dict[tuple[int, int], _Starts] = {}
    unit_bits: dict[tuple[int, int], float] = {}
    last = 0  # the last place that a cost below the bound may still reach

    def reach(end: int, cost: float) -> None:
        nonlocal last
        if cost < best[end]:
            best[end] = cost
            if cost < bound:
                last = max(last, end)

    for i in range(n + 1):
        # What ends here: walks and repeats, from all their starts.
        if i >= 3 and walk_end[i - 3] >= i:
            if walk is None or walk.end != walk_end[i - 3]:
                walk = _Starts(1, walk_end[i - 3])
            a = here[i - 3] + math.log2(47) - 1.5 * turns[i - 3]
            walk.add(i - 3, a, i)
            reach(i, walk.least(i) + 1.5 * turns[i - 2])
        for unit, end in repeats.pop(i, ()):
            starts = stacks.get((unit, i % unit))
            if starts is None or starts.end != end:
                starts = stacks[unit, i % unit] = _Starts(unit, end)
            base = unit_bits.get((unit, end))
            if base is None:
                part = value[i - unit:i]
                base = unit_bits[unit, end] = sum(_class_bits(c, _is_mixed(part)) for c in part)
            a = here[i - 2 * unit] + base + 1
            starts.add(i - 2 * unit, a, i)
            reach(i, starts.least(i))
        least = min(best[i], *brute) if i else 0.0
        here[i] = least + 1
        if i == n:
            return least
        if least < bound:
            last = max(last, i + 1, open_until[i])
        elif i >= last:
            return least
        # What begins here: words and dates, in the value as it is and without its digits' disguise.
        for text, extra in ((lower, 0), (plain, 2)):
            j = i + 1
            while j <= n and text[i:j] in beginnings:
                cost = words.get(text[i:j])
                if cost is not None and (not extra or text[i:j] != lower[i:j]):
                    part = value[i:j]
                    reach(j, here[i] + cost + extra + (0 if part == lower[i:j] else 1 + 0.5 * (j - i) * (
                        not part.istitle() and not part.isupper())))
                j += 1
        date = _DATE.match(value, i)
        if date and date.end() - i >= 4:
            years = math.log2(130)
            reach(date.end(), here[i] + years + (math.log2(365) + 2 if date.end() - i > 4 else 0))
        # A brute-force span has no bit of its own.  It keeps its cases to its end, or else
        # one of both cases could be had at the price of many of one.
        c = value[i]
        brute = [min(best[i], brute[case]) + _class_bits(c, case == _BOTH)
                 if case == _BOTH or c == (c.lower() if case == _LOWER else c.upper()) else math.inf
                 for case in (_LOWER, _UPPER, _BOTH)]
    return 0.0


def scan(text: str, words: dict[str, float], bits: float,
         beginnings: frozenset[str] | None = None) -> list[tuple[str, int, int]]:
    """All spans, by start, then kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text)
             if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)
              if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    for m in _CONTEXT.finditer(text):
        # A quoted value is whole; behind one without quotes a sentence may end.
        value, start = (m[2], m.start(2)) if m[1] else (m[3].rstrip(".!?:#%&$*"), m.start(3))
        if value and guess_bits(value, words, bits, beginnings) >= bits:
            found.append(("guess", start, start + len(value)))
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def spans_of(texts: pa.Array, words: dict[str, float], bits: float,
             beginnings: frozenset[str] | None = None) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    maybe = pc.fill_null(pc.match_substring_regex(texts, _NEEDED), False)
    for k in pc.indices_nonzero(maybe).to_pylist():
        out[k] = [{"kind": kind, "start": a, "end": b}
                  for kind, a, b in scan(texts[k].as_py(), words, bits, beginnings)]
    return out


def find(text: Column, *, bits: float = 45.0, path: str = VOCABULARY) -> Column:
    """The spans of a text column, ``array<struct<kind, start, end>>``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(SPANS)
    def spans(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, beginnings = word_costs(path), _beginnings(path)
        for array in texts:
            array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
            yield pa.array(spans_of(array, words, bits, beginnings), kind)

    return spans(text)


def secrets(df: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
            **parameters) -> DataFrame:
    """One row per document: ``id, spans``."""
    return df.select(F.col(id_column).alias("id"),
                     find(F.col(text_column), **parameters).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
