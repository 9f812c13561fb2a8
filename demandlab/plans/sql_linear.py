"""DuckDB SQL that solves linear systems, for the oracles of estimators with many covariates."""

from __future__ import annotations

from collections.abc import Sequence


def system(name: str, source: str, rows: Sequence[str], cols: Sequence[str], key: str = "0", unit: int | None = None) -> str:
    """CTE ``name0(k, i, j, v)``: sums of rows[i] * cols[j] for each key; ``unit`` adds a unit vector as the last column."""
    n = len(cols) + (unit is not None)
    cells = [f"sum({r} * {c})" for r in rows for c in cols]
    if unit is not None:
        cells = [x for i in range(len(rows)) for x in (*cells[i * len(cols):(i + 1) * len(cols)], f"{1.0 if i == unit else 0.0}")]
    return f"""{name}0 AS MATERIALIZED (
  SELECT k, CAST((p - 1) // {n} AS INTEGER) AS i, CAST((p - 1) % {n} AS INTEGER) AS j, CAST(l[p] AS DOUBLE) AS v
  FROM (SELECT {key} AS k, [{', '.join(cells)}] AS l FROM {source} GROUP BY ALL), (SELECT unnest(range(1, {n * len(rows) + 1})) AS p))"""


def solved(name: str, size: int) -> str:
    """Gauss-Jordan steps from ``name0`` on; the last CTE, ``name``, holds (k, i, j, v) with the solutions in the columns from ``size`` on."""
    steps = []
    for p in range(size):
        to = f"{name}{p + 1}" if p < size - 1 else name
        steps.append(f"""{to} AS MATERIALIZED (
  SELECT a.k, a.i, a.j, CASE WHEN a.i = {p} THEN a.v / d.v ELSE a.v - f.v * r.v / d.v END AS v
  FROM {name}{p} a JOIN {name}{p} d ON d.k = a.k AND d.i = {p} AND d.j = {p} JOIN {name}{p} r ON r.k = a.k AND r.i = {p} AND r.j = a.j
  JOIN {name}{p} f ON f.k = a.k AND f.i = a.i AND f.j = {p})""")
    return ",\n".join(steps)


def vector(name: str, column: int) -> str:
    """Subquery (k, b): one solution of each key as a list."""
    return f"(SELECT k, list(v ORDER BY i) AS b FROM {name} WHERE j = {column} GROUP BY k)"


def normal_p(t: str) -> str:
    """Two-sided normal p-value, from a rational approximation of erfc (error below 2e-7)."""
    x, u = f"abs({t}) / sqrt(2.0)", f"(1.0 / (1.0 + 0.5 * abs({t}) / sqrt(2.0)))"
    # fixed values: coefficients of the published Chebyshev fit
    poly = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]
    body = str(poly[-1])
    for c in reversed(poly[:-1]):
        body = f"({c} + {u} * {body})"
    return f"({u} * exp(-({x}) * ({x}) + {body}))"
