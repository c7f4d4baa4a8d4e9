"""Secret scan: three fixed patterns, and password guess costs of values in credential contexts.

The base patterns are matched leftmost and without overlap, then filtered by length. Beyond them,
a value that follows the name of a credential (or stands as the password of a URL) is weighed:
dynamic programming finds the cheapest way to write it as a sequence of words, dates, repeats,
keyboard walks and brute-force spans, and if even that takes too many guesses for something a
person would write there, the value is a secret.

Costs are decimal logarithms of guesses; a sequence costs the sum of its segments and a charge
for each. Words may have any length the vocabulary has. Work is linear in the value's length but for
the search of repeats, which compares it with itself at every distance up to LONGEST_UNIT. Word ranks
come from a public vocabulary file (a parameter) and are broadcast; their number is that of the file.

Defined cases: null is empty; empty texts have no span and the digest of the empty string;
equal rows give equal rows; positions are code points, end exclusive; what a base span holds of a
value is not reported again; in a list of pairs (a=b;c=d) each value ends before the next name; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tallystone.llm.common import read

WORD_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MIN_COST = 8.0
MIN_VALUE = 6
SEGMENT = 0.5
REFERENCE_YEAR = 2025
#: Repeats are sought for units up to this length at all places, and for any unit over the whole value.
LONGEST_UNIT = 2048
#: Up to this length repeats inside longer repeats are kept as segments too.
SHORT_UNIT = 16

_FLAGS = re.IGNORECASE | re.ASCII
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _FLAGS)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
NAMED = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private)[_-]?key|credentials?|auth)["']?\x20*(?:=>|[:=])\x20*["']?([^\s"']+)""",
    _FLAGS,
)
IN_URL = re.compile(r"://[^\s:/@]+:([^\s/@]+)@")
#: Where the next of several pairs begins: its name and sign follow.
NEXT_PAIR = re.compile(r"[&;,](?=[A-Za-z_][A-Za-z0-9_.-]*(?:=>|[:=]))")
#: Texts without a match of this have no match of any pattern above.
ANY = r"(?i:pass|pwd|secret|token|key|credential|auth|://)|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"
KINDS = ("assign", "access", "hex", "guess")

KEY_ROWS = ("`1234567890-=", " qwertyuiop[]\\", " asdfghjkl;'", " zxcvbnm,./")
SHIFTED = ("~!@#$%^&*()_+", " QWERTYUIOP{}|", ' ASDFGHJKL:"', " ZXCVBNM<>?")
_KEYS = {c: (x, y) for rows in (KEY_ROWS, SHIFTED) for y, row in enumerate(rows) for x, c in enumerate(row) if c != " "}
LEET = {"4": "a", "@": "a", "8": "b", "3": "e", "6": "g", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t", "2": "z"}
_DATE = re.compile(r"(?=((\d{1,4})([-/._])(\d{1,2})\3(\d{1,4})))")
_DIGITS = re.compile(r"\d+")


def load_ranks(path: str = WORD_FILE) -> dict[str, int]:
    """Word -> rank, by the order of merges in a vocabulary file: common words come early."""
    ranks: dict[str, int] = {}
    with open(path, "rb") as lines:
        for line in lines:
            word = base64.b64decode(line.split()[0]).decode("utf-8", "ignore").strip().lower()
            if len(word) >= 3 and word.isalpha():
                ranks.setdefault(word, len(ranks) + 1)
    return ranks


def _char_cost(c: str) -> float:
    return 1.0 if c.isdigit() else math.log10(26) if c.isalpha() else math.log10(33)


def _case_cost(word: str) -> float:
    upper = sum(c.isupper() for c in word)
    lower = sum(c.islower() for c in word)
    if not upper:
        return 0.0
    if not lower or word[1:].islower() or word[:-1].islower():
        return math.log10(2)
    return math.log10(sum(math.comb(upper + lower, i) for i in range(1, min(upper, lower) + 1)))


def _year_cost(year: int) -> float:
    return math.log10(max(abs(year - REFERENCE_YEAR), 20))


def _date_cost(parts: tuple[str, str, str]) -> float | None:
    """Cheapest reading of three numbers as a date, or None."""
    costs = []
    for y, m, d in ((0, 1, 2), (2, 1, 0), (2, 0, 1)):
        if len(parts[y]) not in (2, 4) or not (1 <= len(parts[m]) <= 2 and 1 <= len(parts[d]) <= 2):
            continue
        year = int(parts[y]) + (0 if len(parts[y]) == 4 else 2000 if int(parts[y]) <= REFERENCE_YEAR % 100 else 1900)
        if 1000 <= year <= 2100 and 1 <= int(parts[m]) <= 12 and 1 <= int(parts[d]) <= 31:
            costs.append(math.log10(365) + _year_cost(year))
    return min(costs, default=None)


def _period(value: str) -> int:
    """The shortest unit that the whole value repeats, by its prefix function."""
    border = [0] * len(value)
    k = 0
    for i in range(1, len(value)):
        while k and value[i] != value[k]:
            k = border[k - 1]
        k += value[i] == value[k]
        border[i] = k
    return len(value) - k


class GuessCost:
    """Cheapest segmentation of a value."""

    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=0)

    def _words(self, value: str):
        low = value.lower()
        if len(low) != len(value):  # a letter whose lower case is longer
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        plain = "".join(LEET.get(c, c) for c in low)
        for i in range(len(value)):
            for j in range(i + 3, min(len(value), i + self.longest) + 1):
                best = None
                rank = self.ranks.get(low[i:j])
                if rank:
                    best = math.log10(rank)
                else:
                    rank = self.ranks.get(plain[i:j])
                    if rank:
                        best = math.log10(rank) + math.log10(2) * sum(a != b for a, b in zip(low[i:j], plain[i:j], strict=True))
                rank = self.ranks.get(low[i:j][::-1])
                if rank and (best is None or math.log10(2 * rank) < best):
                    best = math.log10(2 * rank)
                if best is not None:
                    yield i, j, best + _case_cost(value[i:j]), "word"

    def _dates(self, value: str):
        for m in _DATE.finditer(value):
            cost = _date_cost((m[2], m[4], m[5]))
            if cost is not None:
                yield m.start(), m.start() + len(m[1]), cost + math.log10(4), "date"
        for run in _DIGITS.finditer(value):
            digits, at = run[0], run.start()
            if not digits.isascii():
                continue
            for i in range(len(digits)):
                year = digits[i : i + 4]
                if len(year) == 4 and 1900 <= int(year) <= 2100:
                    yield at + i, at + i + 4, _year_cost(int(year)), "date"
                for size, cuts in ((6, ((2, 4),)), (8, ((4, 6), (2, 4)))):
                    part = digits[i : i + size]
                    if len(part) == size:
                        costs = [c for a, b in cuts if (c := _date_cost((part[:a], part[a:b], part[b:]))) is not None]
                        if costs:
                            yield at + i, at + i + size, min(costs), "date"

    def _walks(self, value: str):
        i = 0
        while i < len(value) - 2:
            j, turns, before = i + 1, 0, None
            while j < len(value):
                a, b = _KEYS.get(value[j - 1]), _KEYS.get(value[j])
                step = None
                if a and b and a != b and abs(a[0] - b[0]) <= 1 and abs(a[1] - b[1]) <= 1:
                    step = (b[0] - a[0], b[1] - a[1])
                elif value[j - 1].isalnum() and value[j].isalnum() and abs(ord(value[j]) - ord(value[j - 1])) == 1:
                    step = (ord(value[j]) - ord(value[j - 1]), 9)
                if step is None:
                    break
                turns += step != before
                before = step
                j += 1
            if j - i >= 3:
                yield i, j, math.log10(47) + math.log10(j - i) + turns * math.log10(6) + _case_cost(value[i:j]), "walk"
            i = max(i + 1, j - 1)

    def _repeats(self, value: str):
        codes = np.array([ord(c) for c in value], np.uint32)
        held: list[tuple[int, int]] = []
        for unit in range(1, min(LONGEST_UNIT, len(value) // 2) + 1):
            same = np.flatnonzero(np.diff(codes[unit:] == codes[:-unit], prepend=False, append=False))
            # A stretch of equal characters at that distance, at least a unit long, is a repeat.
            for i, j in zip(same[::2].tolist(), (same[1::2] + unit).tolist(), strict=True):
                times = (j - i) // unit
                if times < 2 or times * unit < 3 or (unit > SHORT_UNIT and any(a <= i and j <= b for a, b in held)):
                    continue
                held.append((i, j))
                inner, _ = self._cheapest(value[i : i + unit], False)
                yield i, i + times * unit, inner + math.log10(times), "repeat"
        if len(value) > 2 * LONGEST_UNIT:
            unit = _period(value)
            if LONGEST_UNIT < unit <= len(value) // 2:
                inner, _ = self._cheapest(value[:unit], False)
                times = len(value) // unit
                yield 0, times * unit, inner + math.log10(times), "repeat"

    def segments(self, value: str, repeats: bool = True):
        """All (start, end, cost, kind) that may be part of a segmentation, but for brute force."""
        yield from self._words(value)
        yield from self._dates(value)
        yield from self._walks(value)
        if repeats:
            yield from self._repeats(value)

    def _cheapest(self, value: str, repeats: bool) -> tuple[float, list[tuple[int, int, str]]]:
        ends: dict[int, list[tuple[int, float, str]]] = {}
        for i, j, cost, kind in self.segments(value, repeats):
            ends.setdefault(j, []).append((i, cost, kind))
        best, back = [0.0], [(0, "")]
        brute, brute_from = math.inf, 0
        for j in range(1, len(value) + 1):
            if best[j - 1] + SEGMENT < brute:
                brute, brute_from = best[j - 1] + SEGMENT, j - 1
            brute += _char_cost(value[j - 1])
            cost, came = brute, (brute_from, "brute")
            for i, c, kind in ends.get(j, ()):
                if best[i] + SEGMENT + c < cost:
                    cost, came = best[i] + SEGMENT + c, (i, kind)
            best.append(cost)
            back.append(came)
        path, at = [], len(value)
        while at:
            path.append((back[at][0], at, back[at][1]))
            at = back[at][0]
        return best[-1], path[::-1]

    def cost(self, value: str) -> float:
        return self._cheapest(value, True)[0]

    def path(self, value: str) -> list[tuple[int, int, str]]:
        return self._cheapest(value, True)[1]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Matches of the fixed patterns, by start and then by kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _outside(start: int, end: int, covered: list[tuple[int, int]]):
    """What of a span is left beside merged, sorted spans."""
    k = max(0, bisect_right(covered, (start, math.inf)) - 1)
    while k < len(covered) and covered[k][0] < end:
        a, b = covered[k]
        if b > start:
            if start < a:
                yield start, a
            start = b
        k += 1
    if start < end:
        yield start, end


def guess_spans(text: str, costs: GuessCost, base: list[tuple[int, int, str]], min_cost: float = MIN_COST, min_value: int = MIN_VALUE) -> list[tuple[int, int, str]]:
    """Values in credential contexts that cost at least min_cost.

    A value ends where the next pair of a list of pairs begins, and what base spans hold of it is
    theirs: the rest is weighed, and the search goes on behind the value.
    """
    covered: list[tuple[int, int]] = []
    for a, b, _ in base:
        if covered and a <= covered[-1][1]:
            covered[-1] = (covered[-1][0], max(b, covered[-1][1]))
        else:
            covered.append((a, b))
    found = set()
    for pattern in (NAMED, IN_URL):
        at = 0
        while m := pattern.search(text, at):
            start, end = m.span(1)
            if pattern is NAMED and (cut := NEXT_PAIR.search(text, start, end)):
                end = cut.start()
            at = max(end, start)
            for a, b in _outside(start, end, covered):
                value = text[a:b].rstrip(".,;:!?)]}>")
                if len(value) >= min_value and costs.cost(value) >= min_cost:
                    found.add((a, a + len(value), "guess"))
    return sorted(found)


def _told(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", word_file: str = WORD_FILE, min_cost: float = MIN_COST, min_value: int = MIN_VALUE) -> DataFrame:
    """Per document: counts of each kind, digest of the base spans, and all spans."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(word_file))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        costs = GuessCost(ranks.value)
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n = batch.num_rows
            counts = {k: [0] * n for k in KINDS}
            digests, spans = [nothing] * n, [""] * n
            likely = pc.fill_null(pc.match_substring_regex(batch.column(1), ANY), False)
            rows = pc.indices_nonzero(likely).to_pylist()
            for i in rows:
                text = batch.column(1)[i].as_py()
                base = base_spans(text)
                more = guess_spans(text, costs, base, min_cost, min_value)
                for _, _, k in [*base, *more]:
                    counts[k][i] += 1
                digests[i] = hashlib.sha256(_told(base).encode()).hexdigest()
                spans[i] = _told(sorted([*base, *more], key=lambda s: (s[0], KINDS.index(s[2]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=[id_column, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return docs.select(id_column, text_column).mapInArrow(run, f"{id_column} {kind}, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents", "doc_id", "text"))
