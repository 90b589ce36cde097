"""Test adapters: derive the logical input tables from the driver's
synthetic Parquet tables (``events``, ``orders``, ``lineitem``, ``pages``).

The values are invented for these tests. The rules are noisy on purpose, so that
every branch occurs: a team whose drivers are all blank (spaces, tabs, no-break
spaces), a team without behaviours, one with a single behaviour, one whose top
behaviour has an empty name, a NULL critical process, a team with no process
below target, junk targets, duplicate status rows and duplicate catalogue codes.
Dates stay in each source's own range, so filters reach the scans; ``aligned``
moves a source onto the survey's month for the refresh, which has one date.
The DuckDB oracle builds the same tables in SQL (``testbed/oracle.py``).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import AgentTimeOptions, FlagOptions, QaOptions, Scope
from ..plans.critical import CoachingTexts
from ..sources.catalog import catalog_from_rows

# Fixed values of the testbed.
TEAMS = ("click", "purchase", "signup", "view")
AS_OF = dt.date(2024, 1, 17)
WEEKLY_AS_OF = dt.date(2024, 2, 10)
QA_AS_OF = dt.date(1997, 3, 20)
TIME_AS_OF = dt.date(1996, 12, 10)
SEGMENT = "new"
OFFICE = "north"
CHANNELS = ("web", "web classic", "phone", "desk", "kiosk", "post")
MOMENTS = ("hello", "hi", "ask", "show", "bye", "misc", "")
BUCKETS = ("talk", "write", "pause", "class", "idle")
QA = QaOptions(
    reason="audit",
    metric_type="core",
    channel_map={"online": ("web", "web classic"), "voice": ("phone", "desk")},
    moment_map={"start": ("hello", "hi"), "middle": ("ask", "show"), "end": ("bye",)},
    low_values=("bad", "weak"),
)
AGENT_CHANNEL_MAP = {"screen": ("web", "web classic", "kiosk")}
FLAGS = FlagOptions(reason="audit")
AGENT_TIME = AgentTimeOptions(role="agent", buckets=BUCKETS, training_bucket="class", excluded_status="course")
TEXTS = CoachingTexts(
    process="{process} at {nps} of {target} ({gap}), {enc} answers = {pct}",
    drivers=("{driver} {nps}/{target}", "{num} {driver}: {gap}, n={enc}, groups={cohorts}"),
    error="see {label}",
    behaviour="[{label}]",
    no_behaviour="-",
    insights=("none", "{label1} x{count1}", "{label1} x{count1}, {label2} x{count2}"),
    priorities=("now", "soon", "later"),
    default_activity={"title": "open", "duration": "0", "objective": "to do", "how": "ask", "materials": "none", "tags": []},
)

# Days that move a source onto the survey's month (aligned inputs only).
QA_SHIFT, FLAG_SHIFT, TIME_SHIFT = 9803, 9131, 9892


def scope(as_of: dt.date = AS_OF) -> Scope:
    return Scope(teams=TEAMS, as_of=as_of, segment=SEGMENT, office=OFFICE)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _cycle(expr: str, labels: tuple[str, ...]) -> str:
    """SQL for labels[expr % len(labels)]."""
    whens = " ".join(f"when {i} then '{label}'" for i, label in enumerate(labels[:-1]))
    return f"case {expr} % {len(labels)} {whens} else '{labels[-1]}' end"


def _date(column: str, shift: int) -> str:
    return f"date_add(to_date({column}), {shift})" if shift else column


_TEAMS5 = ("click", "purchase", "signup", "view", "error")

# The adapters are Spark SQL expressions (``selectExpr``): one round trip per
# table to build the plan, the same plan as the Column API.


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _table(spark, sf_dir, "events").selectExpr(
        "*", "cast(regexp_extract(props, '([0-9]+)', 1) as int) as k")
    return ev.selectExpr(
        "event_type as team",
        "user_id as agent",
        "ts as response_date",
        f"{_cycle('user_id', CHANNELS)} as channel",
        "case when event_type = 'signup' then case when k % 5 < 3 then null else 'P9' end "
        "when k % 12 = 11 then null else concat('P', cast(k % 6 as string)) end as process",
        "case when event_type = 'view' then case k % 4 when 0 then ' ' when 1 then '\t ' when 2 then '\u00a0' else null end "
        "when k = 99 then null when k % 20 = 0 then ' \t' "
        "else concat('C', cast(k % 20 as string), '_', "
        "cast(case when event_id % 3 = 0 then event_id % 64 else event_id % 2 end as string)) end "
        "as driver",
        "case when event_id % 50 = 1 then null "
        "when event_type = 'purchase' then case when value < 5 then 0.0d else 100.0d end "
        "when value < (case when k % 6 in (3, 4) then 10 else 20 end) then -100.0d "
        "when value < 60 then 0.0d else 100.0d end as score",
        "case event_id % 11 when 0 then 'n/a' when 1 then '0.35d' when 2 then '1f' when 3 then '0x1p3' "
        "when 4 then 'Infinity' when 5 then 'NaN' when 6 then '' "
        "else case when k % 6 = 5 then 'n/a' when k % 6 in (3, 4) then '0' else ' 0.35 ' end end as target_text",
        "case when user_id % 3 = 0 then 'old' else 'new' end as segment",
        "event_id % 10 <> 0 as on_target_channel",
        "case when user_id % 11 = 0 then 'south' else 'north' end as office",
        "user_id % 9 as training_id",
    )


def qa_eval(spark: SparkSession, sf_dir: str, aligned: bool = False) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        f"{_cycle('o_custkey', _TEAMS5)} as team",
        f"{_cycle('o_orderkey', CHANNELS)} as channel",
        "case when o_orderstatus = 'P' then 'spot' else 'audit' end as reason",
        "case when o_orderkey % 9 = 0 then 'extra' else 'core' end as metric_type",
        f"{_date('o_orderdate', QA_SHIFT * aligned)} as assigned_date",
        "(o_orderkey % 101) / 100.0d as qa_total",
        "case o_custkey % 5 when 2 then null when 1 then 'S3' else "
        "case when o_custkey % 13 = 12 then null when o_custkey % 5 = 3 and o_custkey % 13 < 6 then '' "
        "else concat('S', cast(o_custkey % 13 as string)) end end as sentence",
        f"case when o_custkey % 5 = 1 then 'hello' else {_cycle('o_custkey', MOMENTS)} end as moment",
        "case o_orderpriority when '1-URGENT' then 'bad' when '2-HIGH' then 'weak' else 'fine' end as sentence_value",
    )


def qa_flags(spark: SparkSession, sf_dir: str, aligned: bool = False) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        f"{_cycle('l_suppkey', _TEAMS5)} as team",
        "l_returnflag as flag_type",
        "concat('F', cast(l_linenumber as string)) as flag",
        "case when l_linestatus = 'F' then true when l_quantity < 10 then null else false end "
        "as is_valid",
        "l_tax < 0.05 as not_dup",
        "case when l_partkey % 4 = 0 then 'spot' else 'audit' end as reason",
        f"{_cycle('l_partkey', ('TRUE', 'true', 'false'))} as picklist_value",
        "case when l_discount > 0.08 then 1 else 0 end as inappropriate",
        f"{_date('l_shipdate', FLAG_SHIFT * aligned)} as reference_date",
    )


# Seconds per unit of quantity for each bucket; ``idle`` is NULL on some lines.
BUCKET_FACTORS = (3, 5, 2, 7, 1)


def agent_time(spark: SparkSession, sf_dir: str, aligned: bool = False) -> DataFrame:
    buckets = [f"cast({'case when l_linenumber = 2 then null else l_quantity end' if b == 'idle' else 'l_quantity'} * {f} as bigint) as {b}_s"
               for b, f in zip(BUCKETS, BUCKET_FACTORS)]
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey as agent",
        f"{_date('l_shipdate', TIME_SHIFT * aligned)} as work_date",
        "case when l_linenumber = 7 then 'lead' else 'agent' end as role",
        f"{_cycle('l_suppkey', _TEAMS5)} as team",
        *buckets,
    )


def training_status(spark: SparkSession, sf_dir: str, aligned: bool = False) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_custkey % 20 as agent",
        f"{_date('o_orderdate', TIME_SHIFT * aligned)} as work_date",
        "case o_orderpriority when '1-URGENT' then 'course' when '5-LOW' then null "
        "else 'done' end as status",
    )


def catalog(spark: SparkSession) -> DataFrame:
    """Test catalogue: S0..S9 labelled (S10, S11 fall back to the code); error
    texts and activities only for S0..S4; S0 and S1 come twice."""
    rows = [{"sentence": "S0", "label": "a0"}, {"sentence": "S1", "label": "b1"}]
    for i in range(10):
        row = {"sentence": f"S{i}", "label": f"b{i}"}
        if i < 5:
            row["error_text"] = f"e{i}"
            row["activity"] = {"title": f"t{i}", "duration": f"{i}", "objective": f"o{i}", "how": f"h{i}",
                               "materials": f"m{i}", "tags": [f"x{i}", "y"] if i % 2 == 0 else [f"x{i}"]}
        rows.append(row)
    return catalog_from_rows(spark, rows)


# Fixed values of the testbed pages: stamp element ids and refresh time.
STAMP_IDS = ("refreshStamp", "headerStamp")
STAMP_STYLE_ID = "stampCss"
REFRESHED_AT = dt.datetime(2024, 1, 17, 16, 5)


def block(slot, inner: str) -> str:
    return f"// __{slot.marker}_START__\n{inner}\n// __{slot.marker}_END__"


def stamps(badge: str, header: str, style: str) -> str:
    """Stamp elements, two style blocks with the id, one without, and an element
    whose end tag is another's."""
    return (f'<p><span class="badge" id="refreshStamp">{badge}</span> <strong id="headerStamp">{header}</strong></p>'
            f'<style id="stampCss">.badge::after {{ content: "{style}"; }}</style><style>.x::after {{ content: "x"; }}</style>'
            f'<style media="print" id="stampCss">.a {{ content: "{style}"; }} .b {{ content:"{style}"; }}</style>'
            '<strong id="refreshStamp">crossed</span>')


def page_slots(slots) -> tuple[str, ...]:
    """What is appended to a page, by ``page_id % 5``: marker blocks, older
    declarations for half of the slots, nothing, or one block inside another, the
    outer one's slot first or last."""
    blocks = "".join(f"<script>\n{block(s, f'const {s.var} = [];')}\n</script>" for s in slots)
    decls = "".join(f'<script>const {s.var} = JSON.parse(atob("b2xk"));</script>' for s in slots[: len(slots) // 2])
    nested = block(slots[0], block(slots[1], "old"))
    overwritten = block(slots[1], block(slots[0], "old"))
    old = stamps("never", "-", "old")
    return blocks + old, decls + old, "", nested, overwritten


def pages_with_slots(spark: SparkSession, sf_dir: str, slots) -> DataFrame:
    p = _table(spark, sf_dir, "pages")
    added = F.element_at(F.array(*[F.lit(x) for x in page_slots(slots)]), (F.col("page_id") % 5 + 1).cast("int"))
    return p.select("page_id", "url", F.concat(F.col("html"), added).alias("html"))
