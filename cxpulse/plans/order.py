"""Presentation order of each report (a final sort for display or export,
never applied inside the reports themselves)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# report -> (column, ascending) keys; key columns after the first follow so
# ties sort the same way on every run.
ORDER = {
    "net_score_monthly": (("team", True),),
    "score_weekly": (("week", True), ("team", True)),
    "score_by_process": (("team", True), ("enc", False), ("process", True)),
    "qa_by_channel": (("team", True), ("channel", True)),
    "training_share": (("team", True),),
    "behaviour_counts": (("team", True), ("low_count", False), ("sentence", True), ("moment", True)),
    "flag_matrix": (("team", True), ("total", False), ("flag_type", True), ("flag", True)),
    "driver_detail": (("team", True), ("process", True), ("enc", False), ("driver", True)),
    "agent_detail": (("team", True), ("nps", False), ("agent", True), ("channel", True)),
    "critical_process_report": (("team", True),),
}


def _key(name: str, ascending: bool) -> Column:
    c = F.col(name)
    return c.asc_nulls_first() if ascending else c.desc_nulls_last()


def presented(df: DataFrame, report: str) -> DataFrame:
    """``df`` sorted for presentation (a global sort: use on report outputs,
    which are small)."""
    return df.orderBy(*[_key(c, asc) for c, asc in ORDER[report]])
