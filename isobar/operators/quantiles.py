"""Exact order statistics without gathering a column.

Spark's exact percentiles keep every distinct value of a group in one task.
Here a mergeable sketch only proposes a bracket; exact counts verify and narrow
it, and the final exact pick sees at most ``exact_rows`` values over all
columns and ranks together.  A table known to be that small needs one pass.
Either way the results are exact and the same.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT_ROWS = 1_000_000
ACCURACY = 10_000


@dataclass
class _Target:
    """The ``rank``-th smallest (0-based) of the ``rows`` values inside a bracket."""

    column: str
    rank: int
    rows: int
    above: float | None = None
    below: float | None = None
    answer: float | None = None

    def sql(self) -> str:
        """The value if it lies strictly inside the bracket, else NULL."""
        value = f"nanvl(cast(`{self.column}` as double), null)"
        tests = []
        if self.above is not None:
            tests.append(f"{value} > double('{self.above!r}')")
        if self.below is not None:
            tests.append(f"{value} < double('{self.below!r}')")
        return f"case when {' and '.join(tests)} then {value} end" if tests else value


def _select_exact(df: DataFrame, targets: list[_Target]) -> None:
    # (rank + 1/2) / rows names exactly this rank under the discrete rule.
    picks = [
        F.expr(f"percentile_disc({(t.rank + 0.5) / t.rows!r}D) within group (order by {t.sql()})") for t in targets
    ]
    for t, value in zip(targets, df.agg(*picks).first()):
        t.answer = value


def _around(share: float, margin: float) -> list[float]:
    return [max(share - margin, 0.0), share, min(share + margin, 1.0)]


def _sketched(df: DataFrame, columns: list[str], probs: list[float], accuracy: int) -> tuple[dict[str, int], dict[str, list[float]]]:
    """Count of every column and proposed values around its quantiles, one sketch per column, in one pass."""
    asked = sorted({q for p in probs for q in _around(p, 2.0 / accuracy)})
    facts = []
    for c in columns:
        value = F.expr(_Target(c, 0, 0).sql())
        facts += [F.count(value), F.percentile_approx(value, asked, accuracy)]
    found = df.agg(*facts).first()
    return dict(zip(columns, found[::2])), {c: sorted(set(v or [])) for c, v in zip(columns, found[1::2])}


def _proposals(df: DataFrame, targets: list[_Target], accuracy: int) -> list[list[float]]:
    sketches = [
        F.percentile_approx(F.expr(t.sql()), _around((t.rank + 0.5) / t.rows, 2.0 / accuracy), accuracy) for t in targets
    ]
    return [sorted(set(row)) for row in df.agg(*sketches).first()]


def _narrow(df: DataFrame, targets: list[_Target], proposals: list[list[float]]) -> None:
    """Count exactly around the proposed values and close the brackets accordingly; each value of a column is counted once."""
    wanted = sorted({(t.column, t.above, t.below, p) for t, points in zip(targets, proposals) for p in points}, key=str)
    counts: list[Column] = []
    for column, above, below, p in wanted:
        value = F.expr(_Target(column, 0, 0, above, below).sql())
        counts += [F.count_if(value < p), F.count_if(value == p)]
    row = df.agg(*counts).first()
    found = {key: (row[2 * k], row[2 * k + 1]) for k, key in enumerate(wanted)}
    for t, points in zip(targets, proposals):
        start = (t.column, t.above, t.below)
        above, smaller, below, larger_from = t.above, 0, t.below, t.rows
        for p in points:
            less, equal = found[(*start, p)]
            if less <= t.rank < less + equal:
                t.answer = p
            elif t.rank >= less + equal:
                above, smaller = p, less + equal
            elif less < larger_from:
                below, larger_from = p, less
        t.above, t.below = above, below
        t.rank, t.rows = t.rank - smaller, larger_from - smaller


def _ranks(n: int, probs: list[float]) -> list[int]:
    return sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))})


def order_statistics(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    *,
    exact_rows: int = EXACT_ROWS,
    accuracy: int = ACCURACY,
) -> tuple[dict[str, int], dict[tuple[str, int], float]]:
    """Count per column, and ``{(column, rank): value}`` for the 0-based ranks next to the quantiles."""
    rows, proposed = _sketched(df, columns, probs, accuracy)
    targets = [_Target(c, r, n) for c, n in rows.items() if n for r in _ranks(n, probs)]
    proposals = [proposed[t.column] for t in targets]
    while open_ := [t for t in targets if t.answer is None]:
        if sum(t.rows for t in open_) <= exact_rows:
            _select_exact(df, open_)
            break
        wide = [(t, p) for t, p in zip(targets, proposals) if t.answer is None and t.rows > 1]
        _narrow(df, [t for t, _ in wide], [p for _, p in wide])
        left = [t for t in targets if t.answer is None]
        if left and sum(t.rows for t in left) > exact_rows:
            again = iter(_proposals(df, left, accuracy))
            proposals = [next(again) if t.answer is None else [] for t in targets]
    # A rank keeps its first number in the answer, whatever the bracket did to it.
    named = [(c, r) for c, n in rows.items() if n for r in _ranks(n, probs)]
    return rows, {key: t.answer for key, t in zip(named, targets)}


def _sorted_at_once(df: DataFrame, columns: list[str], probs: list[float]) -> tuple[dict[str, int], dict[tuple[str, int], float]]:
    """The same from one pass that sorts the columns' values; for tables known to be small."""
    facts = []
    for c in columns:
        values = F.sort_array(F.collect_list(F.expr(_Target(c, 0, 0).sql())))
        n = F.size(values)
        ends = [F.get(values, f((n - 1) * F.lit(p)).cast("int")) for p in probs for f in (F.floor, F.ceil)]
        facts += [n.cast("long"), F.when(n > 0, F.array(*ends))]
    found = df.agg(*facts).first()
    rows, out = dict(zip(columns, found[::2])), {}
    for c, ends in zip(columns, found[1::2]):
        for k, p in enumerate(probs if ends else []):
            at = p * (rows[c] - 1)
            out[c, math.floor(at)], out[c, math.ceil(at)] = ends[2 * k], ends[2 * k + 1]
    return rows, out


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    *,
    exact_rows: int = EXACT_ROWS,
    accuracy: int = ACCURACY,
    at_most: int | None = None,
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each column over the whole table.

    Returns driver scalars, so callers use them as literals and filters on them
    reach the scan.  Missing and NaN values are ignored; an all-missing column
    gives None.  ``at_most`` is a bound of the rows, where one is known.
    """
    if not columns:
        return {}
    df = df.select(*columns)
    if at_most is not None and at_most * len(columns) <= exact_rows:
        rows, values = _sorted_at_once(df, columns, probs)
    else:
        rows, values = order_statistics(df, columns, probs, exact_rows=exact_rows, accuracy=accuracy)
    out: dict[str, list[float | None]] = {}
    for c, n in rows.items():
        out[c] = []
        for p in probs:
            if not n:
                out[c].append(None)
                continue
            at = p * (n - 1)
            low, high = values[c, math.floor(at)], values[c, math.ceil(at)]
            part = at - math.floor(at)
            # Interpolate from the nearer end, the usual numerically stable form.
            out[c].append(low + (high - low) * part if part < 0.5 else high - (high - low) * (1 - part))
    return out
