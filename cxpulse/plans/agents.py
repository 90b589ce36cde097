"""Agent-time reports: training share per team (R5) and per-agent detail.

Agent time is filtered to the closed calendar month of ``as_of`` (a range
pushed to the scan), the agent role and the teams, before any join; both sides
of every join are aggregated first, so no raw row is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.dates import as_date
from ..functions.folding import fold
from ..operators.filters import in_list, month_rows, null_or_not
from ..operators.keyed import keyed_map
from ..operators.keyfilter import filtered
from ..params import DEFAULT_TARGET, AgentTimeOptions, Scope
from .survey import measured


def _bucket_cols(opts: AgentTimeOptions) -> list[str]:
    return [f"{b}_s" for b in opts.buckets]


def _logged(opts: AgentTimeOptions) -> Column:
    return scores.sum_of_sums(_bucket_cols(opts))


def _training(opts: AgentTimeOptions) -> Column:
    return F.sum(f"{opts.training_bucket}_s")


def _of_agents(agent_time: DataFrame, scope: Scope, opts: AgentTimeOptions) -> DataFrame:
    return agent_time.where((F.col("role") == F.lit(opts.role)) & in_list(F.col("team"), scope.teams))


def _agent_month(agent_time: DataFrame, scope: Scope, opts: AgentTimeOptions) -> DataFrame:
    return _of_agents(month_rows(agent_time, "work_date", scope), scope, opts)


def time_days(agent_time: DataFrame, scope: Scope, opts: AgentTimeOptions) -> DataFrame:
    """Seconds per team, agent, day and bucket (of all days given)."""
    return (_of_agents(agent_time, scope, opts).groupBy("team", "agent", as_date(F.col("work_date")).alias("day"))
            .agg(*[F.sum(c).alias(c) for c in _bucket_cols(opts)]))


def status_days(training_status: DataFrame, opts: AgentTimeOptions) -> DataFrame:
    """Per agent and day the status rows, and how many of them are kept."""
    return (training_status.where(F.col("agent").isNotNull()).groupBy("agent", as_date(F.col("work_date")).alias("day"))
            .agg(F.count_if(null_or_not(F.col("status"), opts.excluded_status)).alias("kept"), F.count(F.lit(1)).alias("n")))


def segment_agents(survey: DataFrame, scope: Scope) -> DataFrame:
    """Distinct agents of the scope's segment and office in the survey, any
    date or channel: the right side of a semi-join (partial DISTINCT before
    the shuffle)."""
    return _of_segment(survey, scope).select("agent").distinct()


def segment_agent_days(survey: DataFrame, scope: Scope) -> DataFrame:
    """The same by day (``plans.state`` keeps it)."""
    return _of_segment(survey, scope).select(as_date(F.col("response_date")).alias("day"), "agent").distinct()


def _of_segment(survey: DataFrame, scope: Scope) -> DataFrame:
    return survey.where(
        in_list(F.col("team"), scope.teams)
        & (F.col("segment") == F.lit(scope.segment))
        & (F.col("office") == F.lit(scope.office)))


def training_share(agent_time: DataFrame | None, training_status: DataFrame | None, survey: DataFrame | None,
                   scope: Scope, opts: AgentTimeOptions, time_rows: DataFrame | None = None,
                   status_rows: DataFrame | None = None, agents: DataFrame | None = None) -> DataFrame:
    """Per team, distinct agents, training share of logged time (2 dp),
    training hours and logged hours (2 dp).

    A day of agent time counts once per status row of that day that is not the
    excluded one, and once if the day has no status row; with
    ``opts.dedupe_status`` once if any status row is kept. So status is reduced to
    one row per agent and day holding that factor, time to one row per team,
    agent and day, and the join multiplies. Only agents of the survey's segment
    count: with ``opts.prefilter_agents`` a runtime filter of theirs is applied
    where agent time is read. A bucket that is NULL throughout a team makes its
    logged time NULL.

    ``time_rows`` (``time_days``), ``status_rows`` (``status_days``) and ``agents``
    (distinct agent), all of the month, take the place of the facts if given.
    """
    cols = _bucket_cols(opts)
    agents = segment_agents(survey, scope) if agents is None else agents
    if time_rows is None:
        month = month_rows(agent_time, "work_date", scope)
        time_rows = time_days(filtered(month, "agent", agents, "agent") if opts.prefilter_agents else month, scope, opts)
    time = time_rows.join(agents, "agent", "left_semi")
    status = status_days(month_rows(training_status, "work_date", scope), opts) if status_rows is None else status_rows
    factor = F.least("kept", F.lit(1)) if opts.dedupe_status else F.col("kept")
    status = status.select("agent", "day", factor.alias("factor"))
    joined = time.join(status, ["agent", "day"], "left").withColumn("factor", F.coalesce("factor", F.lit(1))).where("factor > 0")
    logged, training = scores.sum_of_sums([F.col(c) * F.col("factor") for c in cols]), F.sum(F.col(f"{opts.training_bucket}_s") * F.col("factor"))
    return (joined.groupBy("team")
            .agg(F.countDistinct("agent").alias("agents"),
                 F.round(scores.safe_ratio(training, logged) * F.lit(100.0), 2).alias("pct"),
                 F.round(training / F.lit(3600.0), 2).alias("h_train"),
                 F.round(logged / F.lit(3600.0), 2).alias("h_logged")))


def training_share_by_key(share: DataFrame) -> DataFrame:
    """R5 as one map ``{team: {pct, h_train, h_logged, agents}}`` (the shape
    the page reads)."""
    return keyed_map(share, "team", ["pct", "h_train", "h_logged", "agents"], "by_team")


def agent_detail(survey: DataFrame, agent_time: DataFrame, scope: Scope,
                 opts: AgentTimeOptions, channel_map: dict,
                 default_target: float = DEFAULT_TARGET, time_scope: Scope | None = None) -> DataFrame:
    """Per team, agent and folded channel, answers, net score and target
    (default when missing), with the agent's training share (1 dp) and
    training hours (1 dp) of the month (``time_scope``'s, by default the same), 0
    when the agent has no time rows.

    Both sides are aggregated before the join (Catalyst does not push
    aggregates through joins), so the join is between two small tables
    keyed by (team, agent)."""
    channel = fold(F.col("channel"), channel_map, keep_others=True)
    by_agent = (measured(survey, scope).groupBy(F.col("team"), F.col("agent"), channel.alias("channel"))
                .agg(scores.n_rows().alias("enc"), scores.net_score().alias("nps"), scores.target_pct().alias("target")))
    logged, training = _logged(opts), _training(opts)
    time = (_agent_month(agent_time, time_scope or scope, opts)
            .groupBy("team", "agent")
            .agg(F.round(scores.safe_ratio(training, logged) * F.lit(100.0), 1).alias("pct_train"),
                 F.round(training / F.lit(3600.0), 1).alias("h_train")))
    joined = by_agent.join(time, ["team", "agent"], "left")
    return joined.select(
        "team", "agent", "channel", "enc", "nps",
        F.coalesce(F.col("target"), F.lit(float(default_target))).alias("target"),
        F.coalesce(F.col("pct_train"), F.lit(0.0)).alias("pct_train"),
        F.coalesce(F.col("h_train"), F.lit(0.0)).alias("h_train"))
