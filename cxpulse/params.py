"""Run parameters shared by the reports.

Nothing organisation-specific lives in code: team lists, segment, office,
reason names, value lists and defaults are all arguments. ``as_of`` is a
plain date bound as a literal, so every date predicate is constant-folded
and pushed to the scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed value: the default net-score target used when a process or driver has
# no usable target.
DEFAULT_TARGET = 69.5
# The zone in which a day begins and the form of a printed date.
ZONE_OFFSET_HOURS = -5.0
DATE_FORMAT = "dd/MM/yyyy"


def month_start(as_of: dt.date) -> dt.date:
    return as_of.replace(day=1)


def next_month_start(as_of: dt.date) -> dt.date:
    first = month_start(as_of)
    return (first.replace(year=first.year + 1, month=1) if first.month == 12
            else first.replace(month=first.month + 1))


def today_in_zone(offset_hours: float = ZONE_OFFSET_HOURS, now: dt.datetime | None = None) -> dt.date:
    """Default ``as_of``: today's date at a fixed UTC offset, taken once per run."""
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(dt.timezone(dt.timedelta(hours=offset_hours))).date()


@dataclass(frozen=True)
class Scope:
    """Who and when a refresh reports on.

    ``teams`` is the bound list parameter (pushed to the scan as ``In``).
    ``segment`` and ``office`` narrow the survey facts; ``as_of`` fixes the
    month (month-to-date for survey and QA facts, the closed calendar month
    for agent time).
    """

    teams: tuple[str, ...]
    as_of: dt.date
    segment: str
    office: str

    def __post_init__(self):
        object.__setattr__(self, "teams", tuple(self.teams))
        if not self.teams:
            raise ValueError("teams must not be empty")

    @property
    def month_start(self) -> dt.date:
        return month_start(self.as_of)

    @property
    def next_month_start(self) -> dt.date:
        return next_month_start(self.as_of)

    def with_as_of(self, as_of: dt.date) -> "Scope":
        return Scope(self.teams, as_of, self.segment, self.office)


@dataclass(frozen=True)
class QaOptions:
    """Filters and value folding for the QA evaluation reports."""

    reason: str
    metric_type: str
    # label -> raw values folded to it; unlisted values pass through (channels)
    channel_map: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # label -> raw values; unlisted values become NULL (moments)
    moment_map: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # answers that count as a low rating
    low_values: tuple[str, ...] = ()


@dataclass(frozen=True)
class FlagOptions:
    reason: str
    flag_true_text: str = "true"


@dataclass(frozen=True)
class AgentTimeOptions:
    """Agent-time reports: role filter, time buckets and the training bucket."""

    role: str
    buckets: tuple[str, ...]
    training_bucket: str
    # agent-days with this status do not count
    excluded_status: str
    # several status rows of one agent-day count once instead of once each
    dedupe_status: bool = False
    # drop agent time of agents outside the segment where it is read (a filter made
    # from the survey's agents), not only in the join
    prefilter_agents: bool = False

    def __post_init__(self):
        object.__setattr__(self, "buckets", tuple(self.buckets))
        if self.training_bucket not in self.buckets:
            raise ValueError("training_bucket must be one of buckets")
