"""Repair of role / fault sequences by dynamic programming over a Re-Pair grammar.

A row is one letter: its role's initial (s, u, a, or x for any other) in one of
three states, fine ``suax``, truncated ``1234`` or to be deleted ``SUAX``. The
repaired roles must read ``(s?(ua)+)?``, an automaton with four states: nothing
yet, after s, after u, after a (the first and last may end). A letter is a
4 x 4 matrix over (cost, audit) with min-plus products: costs add, audits are
joined, the cheaper entry wins and at equal cost the audit that comes first in
ASCII. That order survives joining, because two audits over the same rows with
equal costs never begin one another (they would differ by inserts alone).

A grammar is a list of two-character texts; rule i defines the symbol
``symbol(i)`` as two earlier symbols, so its matrix is the product of theirs.
Audits are ropes: text or a pair of ropes, shared by all rules above them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

LETTERS = "suax1234SUAX"
STATES = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

Rope = str | tuple
Matrix = list  # of rows of (cost, rope) or None


def pieces(*ropes: Rope) -> Iterator[str]:
    """The texts of ropes, in order."""
    stack = list(reversed(ropes))
    while stack:
        r = stack.pop()
        if isinstance(r, tuple):
            stack += (r[1], r[0])
        elif r:
            yield r


def flat(rope: Rope) -> str:
    return "".join(pieces(rope))


def joined(a: Rope, b: Rope) -> Rope:
    if not a or not b:
        return a or b
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= 64 else (a, b)


def first(a: Rope, b: Rope) -> bool:
    """Whether a comes before b in ASCII order; what both share at the front is passed over whole."""
    while isinstance(a, tuple) and isinstance(b, tuple) and (a[0] is b[0] or a[1] is b[1]):
        # neither side of a tie begins the other, so equal ends don't matter
        a, b = (a[1], b[1]) if a[0] is b[0] else (a[0], b[0])
    one, two = pieces(a), pieces(b)
    x, y = next(one, ""), next(two, "")
    while x and y:
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:] or next(one, ""), y[n:] or next(two, "")
    return not x and bool(y)


def better(a, b):
    """The cheaper of two entries, at equal cost the one whose audit comes first."""
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return a if a[1] is b[1] or not first(b[1], a[1]) else b


def product(A: Matrix, B: Matrix) -> Matrix:
    out = [[None] * 4 for _ in STATES]
    for i in STATES:
        for k in STATES:
            if (p := A[i][k]) is None:
                continue
            for j in STATES:
                if (q := B[k][j]) is not None:
                    out[i][j] = better(out[i][j], (p[0] + q[0], joined(p[1], q[1])))
    return out


def _steps(edges: dict) -> Matrix:
    return [[edges.get((i, j)) for j in STATES] for i in STATES]


MOVES = {(0, 1): "s", (0, 2): "u", (1, 2): "u", (2, 3): "a", (3, 2): "u"}
_one = _steps({(i, i): (0, "") for i in STATES} | {e: (INSERT, "I") for e, c in MOVES.items() if c != "s"})
#: Any inserts between two rows (more than two never pay).
INSERTS = product(_one, _one)


def letter_matrix(c: str) -> Matrix:
    """One row's edits, then any inserts."""
    at = LETTERS.index(c)
    role, extra = "suax"[at % 4], TRUNCATED if 4 <= at < 8 else 0
    out = {(i, i): (DELETE, "D") for i in STATES}
    if at < 8:
        for e, made in MOVES.items():
            if made == role:
                out[e] = KEEP + extra, "K"
            elif made != "s":
                out[e] = REROLE + extra, "R"
    return product(_steps(out), INSERTS)


def symbol(rule: int) -> str:
    return chr(0xE000 + rule)


def matrices(rules: Sequence[str]) -> dict[str, Matrix]:
    """By symbol, bottom-up: each rule's matrix once, from those of its two symbols."""
    out = {c: letter_matrix(c) for c in LETTERS}
    for i, pair in enumerate(rules):
        out[symbol(i)] = product(out[pair[0]], out[pair[1]])
    return out


def compressed(letters: str, rules: Sequence[str]) -> str:
    """The letters with each rule's pair replaced by its symbol, rule after rule, left to right."""
    for i, pair in enumerate(rules):
        if len(letters) < 2:
            break
        letters = letters.replace(pair, symbol(i))
    return letters


def pair_counts(seq: str, into: dict[str, int]) -> None:
    """Add the pairs of neighbours that could be replaced: a run of one symbol holds every second of its pairs."""
    last = None
    for a, b in zip(seq, seq[1:], strict=False):
        pair = a + b
        last = None if pair == last and a == b else pair
        if last:
            into[pair] = into.get(pair, 0) + 1


def repair(seq: str, table: dict[str, Matrix]) -> tuple[int, str]:
    """Least cost and audit of a sequence of symbols; long ones are multiplied pairwise, so that ties are compared over short spans."""
    parts = [table[c] for c in seq]
    while len(parts) > 16:
        parts = [product(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    state = [INSERTS[0], *[[None] * 4] * 3]
    for m in parts:
        state = product(state, m)
    best = better(state[0][0], state[0][3])
    return best[0], flat(best[1])
