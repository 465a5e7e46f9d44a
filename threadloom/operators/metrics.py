"""Row counts of pipeline steps, measured while the data flows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F


@dataclass
class StepMetrics:
    """Counts rows at named points of a plan without an extra pass.

    ``counted(df, name)`` returns the frame with an observation attached; the
    counts are available once an action has run the plan.  An observation is a
    barrier for filter push-down, so attach one only where a count is wanted.
    """

    _points: dict[str, Observation] = field(default_factory=dict)

    def counted(self, df: DataFrame, name: str) -> DataFrame:
        point = Observation(name)
        self._points[name] = point
        return df.observe(point, F.count(F.lit(1)).alias("rows"))

    def rows(self) -> dict[str, int]:
        """Rows seen at every point; waits for the action to finish."""
        return {name: point.get["rows"] for name, point in self._points.items()}

    def removed(self) -> dict[str, int]:
        """Rows each point lost against the point before it."""
        seen = list(self.rows().items())
        return {name: before - now for (_, before), (name, now) in zip(seen, seen[1:])}
