"""Long texts in pieces, and words named by numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

from tallystone.llm.common import mix

PIECE = 1 << 20
BASE, LENGTH = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def pieces(flat: bytes, blanks: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text in pieces of about that size, cut right after one of the given separators."""
    if len(flat) <= size:
        yield flat
        return
    at = 0
    while at < len(flat):
        end = min(len(flat), at + size)
        if end < len(flat):
            cut = max(flat.rfind(bytes([b]), at, end) for b in blanks)
            if cut < 0:
                after = [x for x in (flat.find(bytes([b]), end) for b in blanks) if x >= 0]
                cut = min(after, default=len(flat) - 1)
            end = cut + 1
        yield flat[at:end]
        at = end


#: Words longer than this are named by a digest, shorter ones by a polynomial.
LONG_WORD = 64


def word_spans(flat: bytes, line: int, blank: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """(offset, starts, ends, line numbers, piece) of the words between blanks and line ends."""
    offset = lines = 0
    for piece in pieces(flat, bytes([line, blank])):
        raw = np.frombuffer(piece, np.uint8)
        ends_line = raw == line
        edges = np.flatnonzero(np.diff(~ends_line & (raw != blank), prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        before = np.cumsum(ends_line)
        yield offset, starts, ends, lines + before[starts] if len(starts) else starts, piece
        offset += len(piece)
        lines += int(before[-1]) if len(before) else 0


def named(flat: bytes, line: int, blank: int, seed: int, salt: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(names, line numbers, starts, ends) of all words: a 64-bit number for each, by seed and salt.

    Different words may get the same number, if rarely; whoever needs more must check.
    """
    base = (BASE * (2 * seed + 1)) % (1 << 64)
    salted = np.frombuffer(hashlib.blake2b(salt, digest_size=8, key=bytes([seed])).digest(), np.uint64)[0]
    names, lines, firsts, lasts = [], [], [], []
    for offset, starts, ends, at, piece in word_spans(flat, line, blank):
        if not len(starts):
            continue
        lengths = ends - starts
        if len(piece) <= PIECE:
            raw = np.frombuffer(piece, np.uint8).astype(np.uint64) + np.uint64(1)
            sums = np.zeros(len(piece) + 1, np.uint64)
            with np.errstate(over="ignore"):
                np.cumsum(raw * powers(base)[: len(piece)], out=sums[1:])
                word = (sums[ends] - sums[starts]) * powers(pow(base, -1, 1 << 64))[starts]
                word = mix((word + lengths.astype(np.uint64) * np.uint64(LENGTH)) ^ salted)
            long = np.flatnonzero(lengths > LONG_WORD)
        else:  # one word that is longer than a piece
            word, long = np.empty(len(starts), np.uint64), np.arange(len(starts))
        for i in long.tolist():
            digest = hashlib.blake2b(piece[starts[i] : ends[i]], digest_size=8, key=bytes([seed]), salt=salted.tobytes())
            word[i] = np.frombuffer(digest.digest(), np.uint64)[0]
        names.append(word)
        lines.append(at)
        firsts.append(starts + offset)
        lasts.append(ends + offset)
    if not names:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return np.concatenate(names), np.concatenate(lines), np.concatenate(firsts), np.concatenate(lasts)


_powers: dict[int, np.ndarray] = {}


def powers(base: int) -> np.ndarray:
    if base not in _powers:
        steps = np.full(PIECE + 1, base, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _powers[base] = np.multiply.accumulate(steps)
    return _powers[base]
