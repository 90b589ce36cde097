"""Quality metrics of the inputs, observed while the reports are made.

Nothing is read for them: ``Watch`` attaches observed aggregates to rows that a
write of the refresh passes over anyway, and ``counts`` returns them after it. The
survey and the evaluations are observed within their date range but before
their other filters (so that rows without a team are seen; the date range still
reaches the scan), the training status after it was grouped by agent and day.

``StopRule`` bounds the share of bad rows; the refresh checks it before any page
is published and raises ``QualityError``, with all counts, if it is broken.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.scores import to_number
from ..operators.filters import non_blank


class QualityError(RuntimeError):
    pass


def _checks(bad: Mapping[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in bad.items()]]


def survey_checks() -> list[Column]:
    target = F.col("target_text")
    return _checks({"null_teams": F.col("team").isNull(), "null_scores": F.col("score").isNull(), "null_processes": F.col("process").isNull(),
                    "unreadable_targets": target.isNotNull() & to_number(target).isNull(), "blank_drivers": ~non_blank(F.col("driver"))})


def qa_checks() -> list[Column]:
    return _checks({"null_teams": F.col("team").isNull(), "null_totals": F.col("qa_total").isNull(), "null_sentences": F.col("sentence").isNull()})


def status_checks() -> list[Column]:
    """Of status rows grouped by agent and day (``agents.status_days``)."""
    return _checks({"duplicate_days": F.col("n") > 1})


class Watch:
    """Observations of one run, by source."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def over(self, rows: DataFrame, source: str, checks: list[Column]) -> DataFrame:
        self._seen[source] = Observation(source)
        return rows.observe(self._seen[source], *checks)

    def counts(self) -> dict[str, dict[str, int]]:
        """source -> metric -> count; waits for the writes that pass over the rows."""
        return {source: {k: int(v) for k, v in seen.get.items()} for source, seen in self._seen.items()}


@dataclass(frozen=True)
class StopRule:
    """Largest share of a source's rows per metric, e.g. {"survey.null_teams": 0.01}."""

    limits: Mapping[str, float] = field(default_factory=dict)

    def check(self, counts: Mapping[str, Mapping[str, int]]) -> None:
        broken = []
        for name, limit in self.limits.items():
            source, metric = name.split(".")
            found = counts[source]
            if found[metric] > limit * found["rows"]:
                broken.append(f"{name}: {found[metric]} of {found['rows']} rows, at most {limit:.1%}")
        if broken:
            raise QualityError("; ".join(broken) + f" (all counts: {dict(counts)})")
