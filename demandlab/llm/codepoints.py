"""Classes of code points for the pre-token splitters, by Unicode category.

``kind`` tells blanks, letters, numbers and other signs apart, ``low`` is the
lower case. Two sets are left to the tokenizer's library, which then gets the
whole stretch between blanks: ``unassigned`` (no category here; a newer library
may know one) and ``wild`` (those, and whatever a normaliser may change or join
with its neighbours: combining marks, singletons, second halves of compositions,
lower cases of more than one code point).
"""

from __future__ import annotations

import functools
import unicodedata
from typing import NamedTuple

import numpy as np

from demandlab.llm.textcols import U64, runs

BLANK, LETTER, DIGIT, OTHER = 0, 1, 2, 3
ALL = 0x110000
PLANES = 0x32000  # letters, numbers and blanks lie below; what lies above is left to the library
#: The property White_Space, and the vowels and finals of Hangul that compose by rule.
BLANKS = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
JAMO = [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]


class Tables(NamedTuple):
    kind: np.ndarray
    low: np.ndarray
    unassigned: np.ndarray
    wild: np.ndarray
    symbol: np.ndarray


@functools.cache
def tables() -> Tables:
    """Built once in each process (less than half a second)."""
    kind, low = np.full(ALL, OTHER, np.uint8), np.arange(ALL, dtype=np.uint32)
    unassigned, wild = np.ones(ALL, bool), np.ones(ALL, bool)
    second = set(JAMO)
    for c in range(PLANES):
        char = chr(c)
        category = unicodedata.category(char)
        if category in ("Cn", "Cs"):
            continue
        unassigned[c] = False
        kind[c] = LETTER if category[0] == "L" else DIGIT if category[0] == "N" else OTHER
        lower = char.lower()
        if len(lower) == 1:
            low[c] = ord(lower)
            wild[c] = unicodedata.combining(char) != 0 or not unicodedata.is_normalized("NFC", char)
        parts = unicodedata.decomposition(char).split()
        if len(parts) == 2 and parts[0][0] != "<":
            second.add(int(parts[1], 16))
    kind[BLANKS] = BLANK
    wild[sorted(second)] = True
    symbol = np.random.default_rng(7).integers(1, 2**63, ALL, dtype=np.int64).astype(U64)
    return Tables(kind, low, unassigned, wild, symbol)


def code_points(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a slice and their row offsets."""
    cp = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    if len(lead) != len(cp):
        raise ValueError("text is not UTF-8")
    return cp, np.searchsorted(lead, offs)


def inside_stretches(solid: np.ndarray, wild: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Positions, the first one apart, of the stretches of ``solid`` code points that hold a ``wild`` one."""
    starts, ends = runs(solid, offs)
    count = np.concatenate([[0], np.cumsum(wild)])
    has = count[ends] > count[starts]
    step = np.zeros(len(solid) + 1, np.int8)
    step[starts[has] + 1] += 1
    step[ends[has]] -= 1
    return np.cumsum(step[:-1], dtype=np.int8) > 0


def holds(wild: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which spans hold a ``wild`` code point."""
    count = np.concatenate([[0], np.cumsum(wild)])
    return count[ends] > count[starts]
