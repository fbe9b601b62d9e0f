"""Exact order statistics (e.g. the interpolated median) at scale.

``F.median``/``percentile`` buffer every value of a group in one task, so
they are not used on unbounded columns.  Instead each pass narrows a value
bracket around the wanted ranks: ``percentile_approx`` (a mergeable sketch)
proposes bounds, one counting pass checks how many values fall below, on
and between them, and the loop continues on the open interval until it
holds few enough values to sort in one task.  Heavy ties are handled: a
rank that lands on a bound's own value is answered by that value.  All
columns advance together, one aggregation per pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, nan_to_null

ACCURACY = 10_000
FINAL_VALUES = 100_000


@dataclass
class _State:
    ranks: list[int]  # 1-based ranks among non-missing values, ascending
    lo: float | None = None  # exclusive open-interval bounds (None = unbounded)
    hi: float | None = None
    below: int = 0  # values <= lo (i.e. ranked before the open interval)
    inside: int = 0
    answers: dict[int, float] = field(default_factory=dict)

    def pending(self) -> list[int]:
        return [r for r in self.ranks if r not in self.answers]


def _in_open(x, state: _State):
    cond = x.isNotNull()
    if state.lo is not None:
        cond = cond & (x > F.lit(state.lo))
    if state.hi is not None:
        cond = cond & (x < F.lit(state.hi))
    return cond


def kth_values(
    df: DataFrame, ranks: dict[str, list[int]], counts: dict[str, int] | None = None, final_values: int = FINAL_VALUES
) -> dict[str, dict[int, float]]:
    """Exact value at each 1-based rank (ascending, NaN and NULL skipped).

    ``counts`` (non-missing values per column) saves the counting pass when
    the caller already has them.
    """
    values = df.select(*[nan_to_null(col(c)).alias(c) for c in ranks])
    states = {c: _State(ranks=sorted(set(r))) for c, r in ranks.items()}
    if counts is None:
        row = values.agg(*[F.count(F.col(c)).alias(c) for c in ranks]).first()
        counts = {c: int(row[c]) for c in ranks}
    for c, state in states.items():
        state.inside = int(counts[c])
        bad = [r for r in state.ranks if not 1 <= r <= state.inside]
        if bad:
            raise ValueError(f"rank out of range for {c}: {bad}")
    while True:
        active = {c: s for c, s in states.items() if s.pending()}
        if not active:
            return {c: s.answers for c, s in states.items()}
        small = {c: s for c, s in active.items() if s.inside <= final_values}
        if small:
            _finish(values, small)
        large = {c: s for c, s in active.items() if s.inside > final_values}
        if large:
            _narrow(values, large)


def _finish(values: DataFrame, states: dict[str, _State]) -> None:
    """Sort the (bounded) open interval of each column in one task, which
    picks the wanted values; only they reach the driver."""
    sorted_values = [F.sort_array(F.collect_list(F.when(_in_open(F.col(c), s), F.col(c)))).alias(f"v_{i}") for i, (c, s) in enumerate(states.items())]
    wanted = [(i, s, r) for i, s in enumerate(states.values()) for r in s.pending()]
    row = values.agg(*sorted_values).select(*[F.col(f"v_{i}")[r - s.below - 1] for i, s, r in wanted]).first()
    for value, (_, s, r) in zip(row, wanted):
        s.answers[r] = float(value)


def _narrow(values: DataFrame, states: dict[str, _State]) -> None:
    delta = 2.0 / ACCURACY
    aggs = []
    for c, s in states.items():
        pending = s.pending()
        lo_f = max(0.0, (pending[0] - s.below) / s.inside - delta)
        hi_f = min(1.0, (pending[-1] - s.below) / s.inside + delta)
        x = F.when(_in_open(F.col(c), s), F.col(c))
        aggs.append(F.percentile_approx(x, [lo_f, hi_f], ACCURACY).alias(c))
    bounds = values.agg(*aggs).first()
    count_aggs = []
    for c, s in states.items():
        lo, hi = bounds[c]
        x = F.col(c)
        inside = _in_open(x, s)
        count_aggs += [
            F.count_if(inside & (x < F.lit(lo))).alias(f"{c}__below"),
            F.count_if(inside & (x == F.lit(lo))).alias(f"{c}__eq_lo"),
            F.count_if(inside & (x > F.lit(lo)) & (x < F.lit(hi))).alias(f"{c}__mid"),
            F.count_if(inside & (x == F.lit(hi)) & F.lit(hi != lo)).alias(f"{c}__eq_hi"),
        ]
    counts = values.agg(*count_aggs).first()
    for c, s in states.items():
        lo, hi = bounds[c]
        below = s.below + counts[f"{c}__below"]
        eq_lo, mid, eq_hi = counts[f"{c}__eq_lo"], counts[f"{c}__mid"], counts[f"{c}__eq_hi"]
        pending = s.pending()
        for r in pending:
            if below < r <= below + eq_lo:
                s.answers[r] = float(lo)
            elif hi != lo and below + eq_lo + mid < r <= below + eq_lo + mid + eq_hi:
                s.answers[r] = float(hi)
        rest = s.pending()
        if not rest:
            continue
        upto_lo, upto_mid = below + eq_lo, below + eq_lo + mid
        upto_hi = upto_mid + eq_hi
        total = s.below + s.inside
        if all(upto_lo < r <= upto_mid for r in rest):
            s.lo, s.hi, s.below, s.inside = lo, hi, upto_lo, mid
        # The sketch missed a rank (outside its guarantee): keep the part of
        # the old interval that still holds every pending rank.
        elif all(r <= below for r in rest):
            s.hi, s.inside = lo, below - s.below
        elif all(r > upto_hi for r in rest):
            s.lo, s.below, s.inside = hi, upto_hi, total - upto_hi
        elif all(r > upto_lo for r in rest):
            s.lo, s.below, s.inside = lo, upto_lo, total - upto_lo
        elif all(r <= upto_mid for r in rest):
            s.hi, s.inside = hi, upto_mid - s.below
        else:
            raise RuntimeError("pending ranks straddle the sketch bounds")


def exact_medians(
    df: DataFrame, columns: list[str] | tuple[str, ...], counts: dict[str, int] | None = None, final_values: int = FINAL_VALUES
) -> dict[str, float | None]:
    """Interpolated median of each column over non-missing values."""
    if counts is None:
        row = df.agg(*[F.count(nan_to_null(col(c))).alias(c) for c in columns]).first()
        counts = {c: int(row[c]) for c in columns}
    ranks = {}
    for c in columns:
        n = int(counts[c])
        if n:
            ranks[c] = [(n + 1) // 2, n // 2 + 1]
    found = kth_values(df, ranks, {c: counts[c] for c in ranks}, final_values) if ranks else {}
    out: dict[str, float | None] = {}
    for c in columns:
        if c not in found:
            out[c] = None
            continue
        a, b = (found[c][r] for r in ranks[c])
        out[c] = (a + b) / 2.0
    return out
