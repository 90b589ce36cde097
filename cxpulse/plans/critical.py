"""The per-team "critical process" report (R10) and its flat stages.

Inputs are the already aggregated reports: ``by_process`` (R3),
``drivers`` (R8) and ``behaviours`` (R6), so every step here works on rows
bounded by the teams x processes x drivers dimension, never on facts:

* R10a ``critical_process``: one process per team, below-target first
  (a zero target counts as missing), then most answers, then lowest score.
* R10b ``top_drivers``: the critical process's drivers (NULL process
  matches NULL), below-target band first by answers and gap size, then the
  rest by answers; top ``k``.
* R10c ``top_behaviours``: behaviours with low ratings, top ``k`` by count,
  labelled from the catalogue, with the team's largest case count.
* ``driver_coaching``: per top driver, the error text and gap sentence of
  the team's top behaviour and the activity of the i-th behaviour (clamped
  to the last one), with defaults when the team has none.
* ``critical_process_report``: the nested row per team.

Top-k uses ``row_number() <= k`` (Spark's WindowGroupLimit). Ties are
broken by the name columns so results do not depend on partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import target_or_default
from ..functions.text import render
from ..operators.keyed import sorted_array
from ..operators.lookup import pick_clamped
from ..operators.topk import first_per_key, top_k
from ..operators.totals import with_totals
from ..params import DEFAULT_TARGET
from ..sources.catalog import conform_catalog


@dataclass(frozen=True)
class CoachingTexts:
    """Sentence templates of the caller; ``{name}`` fields are filled per row.

    ``process`` has team, process, enc, nps, target, pct, gap; ``drivers`` (by
    rank, the last for all further ranks) num, driver, cohorts, enc, nps, target,
    gap; ``error`` and ``behaviour`` label; ``insights`` (by the number of listed
    behaviours, the last for all further numbers) label1, label2, count1, count2.
    ``priorities`` go by rank like ``drivers``. The library has no texts of its own.
    """

    process: str
    drivers: tuple[str, ...]
    error: str
    behaviour: str
    no_behaviour: str
    insights: tuple[str, ...]
    priorities: tuple[str, ...]
    default_activity: dict


def _by_number(number: Column, values: list[Column]) -> Column:
    """``values[number]``, the last one for larger numbers."""
    out = values[-1]
    for k in range(len(values) - 2, -1, -1):
        out = F.when(number <= k, values[k]).otherwise(out)
    return out


def _default_activity(texts: CoachingTexts) -> Column:
    a = texts.default_activity
    return F.struct(
        F.lit(a["title"]).alias("title"), F.lit(a["duration"]).alias("duration"),
        F.lit(a["objective"]).alias("objective"), F.lit(a["how"]).alias("how"),
        F.lit(a["materials"]).alias("materials"),
        F.array(*[F.lit(t) for t in a["tags"]]).cast("array<string>").alias("tags"))


def critical_process(by_process: DataFrame, texts: CoachingTexts,
                     default_target: float = DEFAULT_TARGET) -> DataFrame:
    """One row per team of ``by_process``: team, process, enc, nps,
    target (effective), pct, gap, process_desc."""
    tgt = target_or_default(F.col("target"), default_target, zero_is_missing=True)
    rows = by_process.withColumn("eff_target", tgt)
    below = F.col("nps") < F.col("eff_target")
    order = [below.desc(), F.col("enc").desc(), F.col("nps").asc(),
             F.col("process").asc_nulls_first()]
    picked = first_per_key(rows, ["team"], order)
    gap = F.round(F.col("nps") - F.col("eff_target"), 1)
    out = picked.select("team", "process", "enc", "nps",
                        F.col("eff_target").alias("target"), "pct", gap.alias("gap"))
    fields = {c: F.col(c) for c in ("team", "enc", "nps", "target", "pct", "gap")}
    desc = render(texts.process, {**fields, "process": F.coalesce("process", F.lit("-"))})
    return out.withColumn("process_desc", desc)


def ranked_drivers(drivers: DataFrame, texts: CoachingTexts, default_target: float = DEFAULT_TARGET,
                   k: int = 3, min_n: int = 3) -> DataFrame:
    """Top ``k`` drivers of *every* (team, process), with display columns.

    Only ``k`` rows per (team, process) and task are shuffled for the ranking;
    restricting to the critical process afterwards gives the same rows as
    filtering first."""
    d = drivers.withColumn("eff_target", F.coalesce(F.col("target"), F.lit(float(default_target))))
    below = (F.col("nps_score") < F.col("eff_target")) & (F.col("enc") >= min_n)
    gap_size = F.when(below, F.col("eff_target") - F.col("nps_score"))
    order = [below.desc(), F.col("enc").desc(), gap_size.desc_nulls_last(),
             F.col("driver").asc()]
    ranked = top_k(d, ["team", "process"], order, k, rank_col="num")
    gap_pp = F.round(F.col("nps_score") - F.col("eff_target"), 1)
    out = ranked.select(
        "team", "process", "num", "driver",
        _by_number(F.col("num") - 1, [F.lit(x) for x in texts.priorities]).alias("priority"),
        F.concat(F.lit("p"), F.col("num").cast("string")).alias("pclass"),
        "nps_score", F.col("eff_target").alias("target"),
        F.bround(gap_pp, 0).cast("int").alias("gap"),
        gap_pp.alias("gap_pp"),
        F.coalesce(F.col("cohorts"), F.lit(0)).cast("bigint").alias("cohorts"),
        F.col("enc").alias("incoming"))
    values = {"num": F.col("num"), "driver": F.col("driver"), "cohorts": F.col("cohorts"), "enc": F.col("incoming"),
              "nps": F.col("nps_score"), "target": F.col("target"), "gap": F.col("gap_pp")}
    return out.withColumn("why", _by_number(F.col("num") - 1, [render(t, values) for t in texts.drivers]))


def top_drivers(drivers: DataFrame, critical: DataFrame, texts: CoachingTexts,
                default_target: float = DEFAULT_TARGET, k: int = 3, min_n: int = 3) -> DataFrame:
    """Up to ``k`` drivers of each team's critical process (a NULL
    process matches a NULL process), with the team totals over them.
    """
    crit = critical.select(F.col("team").alias("c_team"), F.col("process").alias("c_process"))
    ranked = ranked_drivers(drivers, texts, default_target, k, min_n)
    out = (ranked.join(crit, (ranked["team"] == crit["c_team"])
                       & ranked["process"].eqNullSafe(crit["c_process"]), "inner")
           .drop("c_team", "c_process"))
    # One critical process per team, so (team, process) groups are the team
    # groups; partitioning by both reuses the ranking's partitioning (no shuffle).
    team = Window.partitionBy("team", "process")
    return (out.withColumn("incoming_total", F.sum("incoming").over(team))
            .withColumn("cohorts_max", F.max("cohorts").over(team)))


def top_behaviours(behaviours: DataFrame, catalog: DataFrame, texts: CoachingTexts,
                   k: int = 5) -> DataFrame:
    """Per team, up to ``k`` behaviours with low ratings, by count.

    ``max_cases`` is the largest case count over *all* the team's rows
    (taken before the low-count filter). The catalogue join is left to the
    optimizer (a small dimension: broadcast by measured size). The windows by team
    below the ranking see at most ``k`` rows of a team."""
    team = Window.partitionBy("team")
    b = with_totals(behaviours, ["team"], {"max_cases": (F.max, "total_cases")})
    b = b.where(F.col("low_count") > 0)
    order = [F.col("low_count").desc(), F.col("sentence").asc(), F.col("moment").asc_nulls_first()]
    ranked = top_k(b, ["team"], order, k, rank_col="rank")
    cat = conform_catalog(catalog)
    j = ranked.join(cat, "sentence", "left")
    j = j.withColumn("label", F.coalesce(F.col("label"), F.col("sentence")))
    n = F.count(F.lit(1)).over(team)
    pick = lambda c, r: F.max(F.when(F.col("rank") == r, F.col(c))).over(team)
    fields = {"label1": pick("label", 1), "label2": pick("label", 2), "count1": pick("low_count", 1), "count2": pick("low_count", 2)}
    insight = _by_number(n, [render(t, fields) for t in texts.insights])
    return j.select("team", "rank", "sentence", "moment", "label", "low_count", "max_cases",
                    "error_text", "activity", insight.alias("insight"))


def behaviour_lists(behaviours_top: DataFrame) -> DataFrame:
    """One row per team: ``behs``, the team's top behaviours in rank order
    (at most k per team, so the collected array is bounded)."""
    return (behaviours_top.groupBy("team")
            .agg(sorted_array([F.col("rank"), F.col("sentence"), F.col("label"),
                               F.col("low_count"), F.col("max_cases"), F.col("error_text"),
                               F.col("activity")]).alias("behs"),
                 F.first("insight").alias("insight")))


def coaching(num: Column, behs: Column, texts: CoachingTexts) -> dict[str, Column]:
    """Per-driver coaching fields from the driver's rank ``num`` (1-based)
    and the team's behaviour array: the error text and gap sentence of the
    top behaviour, and the activity of behaviour ``min(num, n)``; defaults
    when the team has no behaviour. An empty sentence names no behaviour."""
    arr = F.coalesce(behs, F.array())
    top = F.get(arr, 0)
    has = F.coalesce(top["sentence"], F.lit("")) != ""
    top_label = F.coalesce(top["label"], F.lit(""))
    chosen = pick_clamped(arr, num - 1)
    return {
        "error": F.coalesce(top["error_text"], render(texts.error, {"label": top_label})),
        "behaviour_gap": F.when(has, render(texts.behaviour, {"label": top_label}))
        .otherwise(F.lit(texts.no_behaviour)),
        "activity": F.coalesce(chosen["activity"], _default_activity(texts)),
    }


def driver_coaching(drivers_top: DataFrame, behaviours_top: DataFrame,
                    texts: CoachingTexts) -> DataFrame:
    """``drivers_top`` plus, per driver, the coaching fields (see
    ``coaching``)."""
    behs = behaviour_lists(behaviours_top).select("team", "behs")
    d = drivers_top.join(behs, "team", "left")
    c = coaching(F.col("num"), F.col("behs"), texts)
    return (d.withColumn("error", c["error"]).withColumn("behaviour_gap", c["behaviour_gap"])
            .withColumn("activity", c["activity"]).drop("behs"))


def flat_coaching(coaching: DataFrame) -> DataFrame:
    """``driver_coaching`` with the activity struct spread into columns."""
    a = F.col("activity")
    return coaching.select(
        "team", "num", "driver", "error", "behaviour_gap",
        F.col("num").alias("activity_num"),
        a["title"].alias("activity_title"), a["duration"].alias("activity_duration"),
        a["objective"].alias("activity_objective"), a["how"].alias("activity_how"),
        a["materials"].alias("activity_materials"),
        F.array_join(a["tags"], "|").alias("activity_tags"))


def critical_process_report(by_process: DataFrame, drivers: DataFrame, behaviours: DataFrame,
                            catalog: DataFrame, texts: CoachingTexts,
                            default_target: float = DEFAULT_TARGET, k_drivers: int = 3,
                            k_behaviours: int = 5, min_n: int = 3) -> DataFrame:
    """One nested row per team present in ``by_process``.

    team, process, process_desc, incoming_total, cohorts, nps, gap_total,
    drivers: array<struct<num, name, priority, pclass, gap, cohorts,
    incoming, why, error, behaviour_gap, activity<num, title, duration,
    objective, how, materials, tags>>>, behaviour_gaps:
    array<struct<label, val, max>>, behaviour_insight.
    Teams without drivers or behaviours get empty arrays and defaults.

    Each input is used once: drivers are ranked and collected per (team,
    process) and matched to the critical process by a null-safe join; the
    behaviours are collected per team and the coaching fields are computed
    with higher-order functions on the joined arrays (all bounded: k per
    key).
    """
    crit = critical_process(by_process, texts, default_target)
    ranked = ranked_drivers(drivers, texts, default_target, k_drivers, min_n)
    driver_arr = (ranked.groupBy("team", "process").agg(sorted_array([
        F.col("num"), F.col("driver").alias("name"), F.col("priority"), F.col("pclass"),
        F.col("gap"), F.col("cohorts"), F.col("incoming"), F.col("why")]).alias("drivers"))
        .withColumnRenamed("team", "d_team").withColumnRenamed("process", "d_process"))
    behs = behaviour_lists(top_behaviours(behaviours, catalog, texts, k_behaviours))
    rep = (crit.join(driver_arr, (crit["team"] == driver_arr["d_team"])
                     & crit["process"].eqNullSafe(driver_arr["d_process"]), "left")
           .drop("d_team", "d_process")
           .join(behs, "team", "left"))
    empty_drivers = F.array().cast(driver_arr.schema["drivers"].dataType)

    def full(x: Column) -> Column:
        c = coaching(x["num"], F.col("behs"), texts)
        act = c["activity"]
        return F.struct(
            x["num"].alias("num"), x["name"].alias("name"), x["priority"].alias("priority"),
            x["pclass"].alias("pclass"), x["gap"].alias("gap"), x["cohorts"].alias("cohorts"),
            x["incoming"].alias("incoming"), x["why"].alias("why"), c["error"].alias("error"),
            c["behaviour_gap"].alias("behaviour_gap"),
            F.struct(x["num"].alias("num"), act["title"].alias("title"),
                     act["duration"].alias("duration"), act["objective"].alias("objective"),
                     act["how"].alias("how"), act["materials"].alias("materials"),
                     act["tags"].alias("tags")).alias("activity"))

    drivers_col = F.transform(F.coalesce(F.col("drivers"), empty_drivers), full)
    gaps = F.transform(F.coalesce(F.col("behs"), F.array()),
                       lambda g: F.struct(g["label"].alias("label"), g["low_count"].alias("val"),
                                          g["max_cases"].alias("max")))
    return (rep.withColumn("drivers", drivers_col).select(
        "team", "process", "process_desc",
        F.coalesce(F.aggregate(F.col("drivers"), F.lit(0).cast("bigint"),
                               lambda acc, x: acc + x["incoming"]), F.lit(0)).alias("incoming_total"),
        F.coalesce(F.array_max(F.transform(F.col("drivers"), lambda x: x["cohorts"])),
                   F.lit(0).cast("bigint")).alias("cohorts"),
        F.col("nps"), F.col("gap").alias("gap_total"),
        "drivers", gaps.alias("behaviour_gaps"),
        F.coalesce(F.col("insight"), F.lit(texts.insights[0])).alias("behaviour_insight")))
