"""Exact medians of columns with any number of distinct values.

``median`` holds every distinct value with its count in one buffer. Here the
middle rows are cornered in rounds. A round takes two bounds around them from
a quantile sketch of fixed size, and counts exactly the rows below, on and
between the bounds. A middle row on a bound is found; otherwise it lies
strictly between them, and only those rows go to the next round. Between the
bounds are a few thousandths of the rows at most, ties or not, so some three
rounds are enough for 10^9 rows. Once ``LAST_ROWS`` rows are left, these are
sorted by the driver. All columns share the passes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accuracy of the sketch (its buffer is some such number of values).
ACCURACY = 2_000
LAST_ROWS = 4_096


class _Search:
    """Ranks of one column still sought, counted within the rows strictly
    between ``low`` and ``high`` (None: no bound)."""

    def __init__(self, name: str, rows: int):
        self.name, self.rows = name, rows
        self.low = self.high = None
        middle = {(rows - 1) // 2, rows // 2} if rows else set()
        self.sought = {k: k for k in middle}  # rank of all -> rank within
        self.found: dict[int, float] = {}

    @property
    def value(self) -> Column:
        return F.col(f"`{self.name}`").cast("double")

    def inside(self) -> Column:
        v = self.value
        within = v.isNotNull()
        if self.low is not None:
            within &= v > F.lit(self.low)
        if self.high is not None:
            within &= v < F.lit(self.high)
        return within

    def quantiles(self, accuracy: int) -> Column:
        margin = 2 / accuracy
        p = [max(0.0, min(self.sought.values()) / self.rows - margin), min(1.0, (max(self.sought.values()) + 1) / self.rows + margin)]
        return F.percentile_approx(F.when(self.inside(), self.value), p, accuracy)

    def counts(self, low: float, high: float) -> list[Column]:
        v, within = self.value, self.inside()
        low, high = F.lit(low), F.lit(high)
        return [F.count_if(within & (v < low)), F.count_if(within & (v == low)), F.count_if(within & (v > low) & (v < high)),
                F.count_if(within & (v == high))]

    def narrow(self, low: float, high: float, below: int, on_low: int, between: int, on_high: int) -> None:
        on_high = 0 if low == high else on_high
        parts = [("below", 0, below), (low, below, on_low), ("between", below + on_low, between),
                 (high, below + on_low + between, on_high)]
        end = below + on_low + between + on_high
        parts.append(("above", end, self.rows - end))
        sought, self.sought = self.sought, {}
        for k, at in sought.items():
            part, start, size = next(p for p in parts if p[1] <= at < p[1] + p[2])
            if isinstance(part, str):
                # bounds are values of rows, so neighbours lie in one part or on a bound
                self.sought[k], self.rows, side = at - start, size, part
            else:
                self.found[k] = part
        if not self.sought:
            return
        if side in ("between", "above"):
            self.low = high if side == "above" else low
        if side in ("between", "below"):
            self.high = low if side == "below" else high

    def result(self) -> float | None:
        values = list(self.found.values())
        return sum(values) / len(values) if values else None


def exact_medians(df: DataFrame, cols: list[str], accuracy: int = ACCURACY, last_rows: int = LAST_ROWS) -> dict[str, float | None]:
    """The exact median of each numeric column, nulls left out, None without
    values; of an even number of rows the mean of the middle two. NaN counts
    as greater than all, as in Spark's order."""
    first = df.agg(*[F.count(F.col(f"`{c}`")) for c in cols]).first()
    searches = [_Search(c, n) for c, n in zip(cols, first)]
    while wide := [s for s in searches if s.sought and s.rows > last_rows]:
        bounds = df.agg(*[s.quantiles(accuracy) for s in wide]).first()
        counts = iter(df.agg(*[c for s, b in zip(wide, bounds) for c in s.counts(*b)]).first())
        for s, (low, high) in zip(wide, bounds):
            s.narrow(low, high, *[next(counts) for _ in range(4)])
    for s in searches:
        if s.sought:  # last_rows rows at most
            rows = sorted((r[0] for r in df.where(s.inside()).select(s.value).collect()), key=lambda v: (math.isnan(v), v))
            s.found.update({k: rows[at] for k, at in s.sought.items()})
    return {s.name: s.result() for s in searches}
