"""Independent SQL oracle (DuckDB dialect) for every registered report query.

The driver runs these texts on DuckDB with the raw tables registered as
views. Each text first derives the logical inputs with the testbed rules
(as CTEs) and then states the report in plain SQL, written from the report
definitions, not from the Spark code.

Rounding: Spark rounds a DOUBLE half-up on its shortest decimal text;
DuckDB rounds the binary value. ``rnd`` rounds the decimal text in DuckDB
too, so both agree on every value (``round(1.005, 2)`` is 1.01 in both).
Averages are exact decimal sums divided once.
"""

from __future__ import annotations

import datetime as dt

from . import adapters as tb


def _cycle(expr: str, labels) -> str:
    whens = " ".join(f"when {i} then '{x}'" for i, x in enumerate(labels))
    return f"case {expr} % {len(labels)} {whens} end"


# The testbed adapter rules, one SQL text per logical input table.
SURVEY = f"""
select event_type team, user_id agent, cast(ts as date) response_date, {_cycle('user_id', tb.CHANNELS)} channel,
  case when event_type='signup' then case when k%5<3 then null else 'P9' end
       when k%12=11 then null else concat('P',cast(k%6 as varchar)) end process,
  case when event_type='view' then case k%4 when 0 then ' ' when 1 then chr(9)||' ' when 2 then chr(160) else null end
       when k=99 then null when k%20=0 then ' '||chr(9)
       else concat('C',cast(k%20 as varchar),'_',cast(case when event_id%3=0 then event_id%64 else event_id%2 end as varchar)) end driver,
  case when event_id%50=1 then null when event_type='purchase' then case when value<5 then 0e0 else 100e0 end
       when value<(case when k%6 in (3,4) then 10 else 20 end) then -100e0 when value<60 then 0e0 else 100e0 end score,
  case event_id%11 when 0 then 'n/a' when 1 then '0.35d' when 2 then '1f' when 3 then '0x1p3' when 4 then 'Infinity' when 5 then 'NaN' when 6 then ''
       else case when k%6=5 then 'n/a' when k%6 in (3,4) then '0' else ' 0.35 ' end end target_text,
  case when user_id%3=0 then 'old' else 'new' end segment,
  event_id%10<>0 on_target_channel,
  case when user_id%11=0 then 'south' else 'north' end office,
  user_id%9 training_id
from (select *, cast(regexp_extract(props,'([0-9]+)',1) as int) k from events)
"""

_TEAM5 = "case {} % 5 when 0 then 'click' when 1 then 'purchase' when 2 then 'signup' when 3 then 'view' else 'error' end"


def _qa_eval(aligned: bool) -> str:
    return f"""
select {_TEAM5.format('o_custkey')} team, {_cycle('o_orderkey', tb.CHANNELS)} channel,
  case o_orderstatus when 'P' then 'spot' else 'audit' end reason,
  case when o_orderkey%9=0 then 'extra' else 'core' end metric_type,
  cast(o_orderdate as date) + {tb.QA_SHIFT * aligned} assigned_date,
  (o_orderkey%101)/100e0 qa_total,
  case o_custkey%5 when 2 then null when 1 then 'S3' else case when o_custkey%13=12 then null
    when o_custkey%5=3 and o_custkey%13<6 then '' else concat('S',cast(o_custkey%13 as varchar)) end end sentence,
  case when o_custkey%5=1 then 'hello' else {_cycle('o_custkey', tb.MOMENTS)} end moment,
  case o_orderpriority when '1-URGENT' then 'bad' when '2-HIGH' then 'weak' else 'fine' end sentence_value
from orders
"""


QA_FLAGS = f"""
select {_TEAM5.format('l_suppkey')} team,
  l_returnflag flag_type, concat('F',cast(l_linenumber as varchar)) flag,
  case when l_linestatus='F' then true when l_quantity<10 then null else false end is_valid,
  l_tax<0.05 not_dup,
  case when l_partkey%4=0 then 'spot' else 'audit' end reason,
  case l_partkey%3 when 0 then 'TRUE' when 1 then 'true' else 'false' end picklist_value,
  case when l_discount>0.08 then 1 else 0 end inappropriate,
  cast(l_shipdate as date) reference_date
from lineitem
"""


def _agent_time(aligned: bool) -> str:
    return f"""
select l_suppkey agent, cast(l_shipdate as date) + {tb.TIME_SHIFT * aligned} work_date,
  case when l_linenumber=7 then 'lead' else 'agent' end role, {_TEAM5.format('l_suppkey')} team,
  cast(l_quantity*3 as bigint) talk_s, cast(l_quantity*5 as bigint) write_s, cast(l_quantity*2 as bigint) pause_s,
  cast(l_quantity*7 as bigint) class_s, case when l_linenumber=2 then null else cast(l_quantity as bigint) end idle_s
from lineitem
"""


def _training_status(aligned: bool) -> str:
    return f"""
select o_custkey%20 agent, cast(o_orderdate as date) + {tb.TIME_SHIFT * aligned} work_date,
  case o_orderpriority when '1-URGENT' then 'course' when '5-LOW' then null else 'done' end status
from orders
"""


def _catalog_values() -> str:
    rows = ["('S0', 'a0', null, null, null, null, null, null, null)", "('S1', 'b1', null, null, null, null, null, null, null)"]
    for i in range(10):
        if i < 5:
            tags = f"['x{i}', 'y']" if i % 2 == 0 else f"['x{i}']"
            rows.append(f"('S{i}', 'b{i}', 'e{i}', 't{i}', '{i}', 'o{i}', 'h{i}', 'm{i}', {tags})")
        else:
            rows.append(f"('S{i}', 'b{i}', null, null, null, null, null, null, null)")
    every = ("select * from (values " + ", ".join(rows) + ") as c(sentence, label, error_text, "
             "a_title, a_duration, a_objective, a_how, a_materials, a_tags)")
    # one row per sentence: the smallest label, of those a row without error text
    return f"select * exclude (k) from (select *, row_number() over (partition by sentence order by label, error_text nulls first) as k from ({every})) where k = 1"


def cif(cond: str) -> str:
    """COUNTIF as BIGINT (DuckDB's count_if is HUGEINT)."""
    return f"cast(count_if({cond}) as bigint)"


def rnd(expr: str, digits: int) -> str:
    return f"round(cast(cast(({expr}) as varchar) as decimal(38,18)), {digits})::double"


def mean(column: str) -> str:
    return f"(cast(sum(cast({column} as decimal(28,10))) as double) / nullif(count({column}), 0))"


def _with(inputs: list[str], body: str, aligned: bool = False) -> str:
    texts = {"survey": SURVEY, "qa_eval": _qa_eval(aligned), "qa_flags": QA_FLAGS, "agent_time": _agent_time(aligned),
             "training_status": _training_status(aligned), "catalog": _catalog_values()}
    ctes = ",\n".join(f"{name} as ({texts[name]})" for name in inputs)
    return f"with {ctes},\n{body}"


_TEAMS = ", ".join(f"'{t}'" for t in tb.TEAMS)


def _base(since: str) -> str:
    return (f"team in ({_TEAMS}) and segment = '{tb.SEGMENT}' and on_target_channel = true "
            f"and office = '{tb.OFFICE}' and response_date >= date '{since}'")


def _month(as_of: dt.date) -> str:
    return as_of.replace(day=1).isoformat()


def _after(as_of: dt.date) -> str:
    return (as_of.replace(day=1) + dt.timedelta(days=32)).replace(day=1).isoformat()


MONTH = _month(tb.AS_OF)
_NUMBER = r"^[ \t\r\n]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n]*$"
_TNUM = f"case when regexp_matches(target_text, '{_NUMBER}') and not isinf(try_cast(trim(target_text) as double)) then try_cast(trim(target_text) as double) end"
_NET = "(count_if(score > 0) - count_if(score < 0)) * 100e0 / count(*)"
_FILLED = r"regexp_matches(driver, '[^\t\n\x{B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]')"

R1 = f"""
r1 as (
  select team, count(*) as enc, {cif('score > 0')} as pro, {cif('score = 0')} as neu,
    {cif('score < 0')} as det, {rnd(_NET, 1)} as nps_score
  from survey where {_base(MONTH)}
  group by team)"""


def _r2(as_of: dt.date) -> str:
    since = (as_of.replace(day=1) - dt.timedelta(weeks=4)).isoformat()
    return f"""
r2 as (
  select strftime(date_trunc('week', response_date), '%Y-%m-%d') as week, team,
    count(*) as enc, {rnd(mean('score'), 1)} as avg_score
  from survey where {_base(since)}
  group by 1, 2)"""


R3 = f"""
p as (
  select team, process, count(*) as enc, {rnd(_NET, 1)} as nps, {rnd(mean('tnum') + ' * 100e0', 1)} as target
  from (select *, {_TNUM} as tnum from survey where {_base(MONTH)})
  group by team, process),
r3 as (select team, process, enc, nps, target, {rnd('enc * 100e0 / sum(enc) over (partition by team)', 1)} as pct from p)"""

R8 = f"""
g8 as (
  select team, process, driver, count(*) as enc, {rnd(_NET, 1)} as nps_score,
    {rnd(mean('tnum') + ' * 100e0', 1)} as target, count(distinct training_id) as cohorts
  from (select *, {_TNUM} as tnum from survey where {_base(MONTH)} and driver is not null and {_FILLED})
  group by team, process, driver
  having count(*) >= 3),
r8 as (select *, {rnd('enc * 100e0 / sum(enc) over (partition by team, process)', 1)} as pct_in_proc from g8)"""


def _qa_rows(as_of: dt.date) -> str:
    return (f"team in ({_TEAMS}) and reason = 'audit' and metric_type = 'core' and assigned_date >= date '{_month(as_of)}'")


def _r4(as_of: dt.date) -> str:
    return f"""
r4 as (
  select team,
    case when channel in ('web', 'web classic') then 'online'
         when channel in ('phone', 'desk') then 'voice' else channel end as channel,
    count(*) as total, {rnd(mean('qa_total') + ' * 100e0', 1)} as pct, {rnd(mean('qa_total') + ' * 2e0', 2)} as grade
  from qa_eval where {_qa_rows(as_of)}
  group by 1, 2)"""


def _r6(as_of: dt.date) -> str:
    return f"""
r6 as (
  select team, sentence,
    case when moment in ('hello', 'hi') then 'start' when moment in ('ask', 'show') then 'middle'
         when moment = 'bye' then 'end' else null end as moment,
    count(*) as total_cases, {cif("sentence_value in ('bad', 'weak')")} as low_count
  from qa_eval where {_qa_rows(as_of)} and sentence is not null
  group by 1, 2, 3)"""


FLAG_MATRIX = _with(["qa_flags"], f"""
r as (
  select team, flag_type, flag, count(*) as total
  from qa_flags
  where is_valid is true and not_dup is true and reason = 'audit'
    and lower(cast(picklist_value as varchar)) = 'true' and inappropriate = 0
    and reference_date >= date '{_month(tb.TIME_AS_OF)}' and team in ({_TEAMS})
  group by 1, 2, 3)
select * from r""")

_BUCKETS = [f"{b}_s" for b in tb.BUCKETS]
_LOGGED = " + ".join(f"sum(a.{c})" for c in _BUCKETS)


def _r5(as_of: dt.date) -> str:
    return f"""
r5 as (
  select a.team, count(distinct a.agent) as agents,
    {rnd(f'sum(a.class_s) / nullif({_LOGGED}, 0) * 100e0', 2)} as pct,
    {rnd('sum(a.class_s) / 3600e0', 2)} as h_train,
    {rnd(f'({_LOGGED}) / 3600e0', 2)} as h_logged
  from agent_time a
  left join training_status b on a.agent = b.agent and a.work_date = b.work_date
  where a.work_date >= date '{_month(as_of)}' and a.work_date < date '{_after(as_of)}'
    and a.role = 'agent' and (b.status is null or b.status <> 'course')
    and a.team in ({_TEAMS})
    and a.agent in (select distinct agent from survey where team in ({_TEAMS})
                    and segment = '{tb.SEGMENT}' and office = '{tb.OFFICE}')
  group by a.team)"""


TRAINING_SHARE = _with(["survey", "agent_time", "training_status"], _r5(tb.TIME_AS_OF) + "\nselect * from r5")

AGENT_DETAIL = _with(["survey", "agent_time"], f"""
n as (
  select team, agent,
    case when channel in ('web', 'web classic', 'kiosk') then 'screen' else channel end as channel,
    count(*) as enc, {rnd(_NET, 1)} as nps, {rnd(mean('tnum') + ' * 100e0', 1)} as target
  from (select *, {_TNUM} as tnum from survey where {_base(MONTH)})
  group by 1, 2, 3),
t as (
  select a.team, a.agent,
    {rnd(f'sum(a.class_s) / nullif({_LOGGED}, 0) * 100e0', 1)} as pct_train,
    {rnd('sum(a.class_s) / 3600e0', 1)} as h_train
  from agent_time a
  where a.work_date >= date '{_month(tb.TIME_AS_OF)}' and a.work_date < date '{_after(tb.TIME_AS_OF)}'
    and a.role = 'agent' and a.team in ({_TEAMS})
  group by 1, 2)
select n.team, n.agent, n.channel, n.enc, n.nps, coalesce(n.target, 69.5e0) as target,
  coalesce(t.pct_train, 0e0) as pct_train, coalesce(t.h_train, 0e0) as h_train
from n left join t on n.team = t.team and n.agent = t.agent""")

# --- R10 stages -------------------------------------------------------------

CRIT = R3 + f""",
c0 as (select *, coalesce(nullif(target, 0e0), 69.5e0) as eff from r3),
c1 as (
  select *, row_number() over (partition by team
    order by (nps < eff) desc, enc desc, nps asc, process asc nulls first) as rn
  from c0),
crit0 as (
  select team, process, enc, nps, eff as target, pct, {rnd('nps - eff', 1)} as gap
  from c1 where rn = 1),
crit as (
  select *, concat(coalesce(process, '-'), ' at ', nps, ' of ', target, ' (', gap, '), ', enc, ' answers = ', pct) as process_desc from crit0)"""

DRIVERS = f"""{R8},
d1 as (
  select r8.*, coalesce(r8.target, 69.5e0) as eff,
    (r8.nps_score < coalesce(r8.target, 69.5e0) and r8.enc >= 3) as below
  from r8 join crit on r8.team = crit.team and r8.process is not distinct from crit.process),
d2 as (
  select *, row_number() over (partition by team order by below desc, enc desc,
    case when below then eff - nps_score end desc nulls last, driver asc) as rn
  from d1),
tops0 as (
  select team, process, cast(rn as integer) as num, driver,
    case rn when 1 then 'now' when 2 then 'soon' else 'later' end as priority,
    'p' || cast(rn as varchar) as pclass, nps_score, eff as target,
    cast(round_even({rnd('nps_score - eff', 1)}, 0) as integer) as gap,
    {rnd('nps_score - eff', 1)} as gap_pp, cohorts, enc as incoming
  from d2 where rn <= 3),
tops as (
  select *, case num when 1 then concat(driver, ' ', nps_score, '/', target)
    else concat(num, ' ', driver, ': ', gap_pp, ', n=', incoming, ', groups=', cohorts) end as why from tops0)"""

BEHAVIOURS = """
b1 as (select *, max(total_cases) over (partition by team) as max_cases from r6),
b2 as (
  select *, row_number() over (partition by team
    order by low_count desc, sentence asc, moment asc nulls first) as rn
  from b1 where low_count > 0),
tb as (
  select b2.team, cast(b2.rn as integer) as rank, b2.sentence, b2.moment,
    coalesce(c.label, b2.sentence) as label, b2.low_count, b2.max_cases,
    c.error_text, c.a_title, c.a_duration, c.a_objective, c.a_how, c.a_materials, c.a_tags
  from b2 left join catalog c on b2.sentence = c.sentence
  where b2.rn <= 5),
ti0 as (
  select team, count(*) as n,
    max(case when rank = 1 then label end) as l1, max(case when rank = 2 then label end) as l2,
    max(case when rank = 1 then low_count end) as v1, max(case when rank = 2 then low_count end) as v2,
    string_agg(concat(label, ':', low_count, ':', max_cases), '|' order by rank) as gaps
  from tb group by team),
ti as (
  select *, case when n >= 2 then concat(l1, ' x', v1, ', ', l2, ' x', v2) else concat(l1, ' x', v1) end as insight from ti0)"""

COACH = """
coach as (
  select d.*, coalesce(t1.error_text, concat('see ', coalesce(t1.label, ''))) as error,
    case when coalesce(t1.sentence, '') <> '' then concat('[', t1.label, ']') else '-' end as behaviour_gap,
    d.num as activity_num,
    case when ch.a_title is not null then ch.a_title else 'open' end as activity_title,
    case when ch.a_title is not null then ch.a_duration else '0' end as activity_duration,
    case when ch.a_title is not null then ch.a_objective else 'to do' end as activity_objective,
    case when ch.a_title is not null then ch.a_how else 'ask' end as activity_how,
    case when ch.a_title is not null then ch.a_materials else 'none' end as activity_materials,
    case when ch.a_title is not null then array_to_string(ch.a_tags, '|') else '' end as activity_tags
  from tops d
  left join ti on ti.team = d.team
  left join tb t1 on t1.team = d.team and t1.rank = 1
  left join tb ch on ch.team = d.team and ch.rank = least(d.num, ti.n)),
team_tot as (
  select team, cast(sum(incoming) as bigint) as incoming_total, max(cohorts) as cohorts from tops group by team)"""


def _r10(as_of: dt.date) -> str:
    return ",".join([CRIT, DRIVERS, _r6(as_of), BEHAVIOURS, COACH])


_TEAM_FIELDS = """c.team, c.process, c.process_desc, coalesce(tt.incoming_total, 0) as incoming_total, coalesce(tt.cohorts, 0) as cohorts,
  c.nps, c.gap as gap_total, coalesce(ti.insight, 'none') as behaviour_insight, coalesce(ti.gaps, '') as behaviour_gaps"""
_TEAM_JOINS = "crit c left join team_tot tt on tt.team = c.team left join ti on ti.team = c.team"
_SURVEY_QA = ["survey", "qa_eval", "catalog"]

TOP_DRIVERS = _with(["survey"], CRIT + "," + DRIVERS + """
select *, cast(sum(incoming) over (partition by team) as bigint) as incoming_total,
  max(cohorts) over (partition by team) as cohorts_max
from tops""")

TOP_BEHAVIOURS = _with(["qa_eval", "catalog"], _r6(tb.QA_AS_OF) + "," + BEHAVIOURS + """
select tb.team, tb.rank, tb.sentence, tb.moment, tb.label, tb.low_count, tb.max_cases, ti.insight
from tb join ti on tb.team = ti.team""")

DRIVER_COACHING = _with(_SURVEY_QA, _r10(tb.QA_AS_OF) + """
select team, num, driver, error, behaviour_gap, activity_num, activity_title, activity_duration, activity_objective,
  activity_how, activity_materials, activity_tags from coach""")

CRITICAL_PROCESS_REPORT = _with(_SURVEY_QA, _r10(tb.QA_AS_OF) + f"""
select {_TEAM_FIELDS}, d.num, d.driver, d.priority, d.pclass, d.gap, d.cohorts as driver_cohorts, d.incoming, d.why, d.error,
  d.behaviour_gap, d.activity_num, d.activity_title, d.activity_duration, d.activity_objective, d.activity_how,
  d.activity_materials, d.activity_tags
from {_TEAM_JOINS} left join coach d on d.team = c.team""")

CRITICAL_REPORT_DRIVERS = _with(_SURVEY_QA, _r10(tb.QA_AS_OF) + f"""
select c.team, c.process, coalesce(tt.incoming_total, 0) as incoming_total, c.nps, cast(coalesce(ti.n, 0) as integer) as n_gaps,
  d.num, d.driver, d.gap, d.incoming
from {_TEAM_JOINS} left join coach d on d.team = c.team""")

# --- payloads and pages -----------------------------------------------------


def _cells(name: str, item: str, source: str, fields: list[str]) -> str:
    return " union all ".join(f"select '{name}' as name, cast({item} as varchar) as item, '{f}' as field, cast({f} as varchar) as value from {source}" for f in fields)


def _numbered(source: str, order: str) -> str:
    return f"(select *, row_number() over (order by {order}) - 1 as i from {source})"


_ALL_INPUTS = ["survey", "qa_eval", "catalog", "agent_time", "training_status"]
_ALL_REPORTS = ",".join([R1, _r2(tb.AS_OF), _r4(tb.AS_OF), _r5(tb.AS_OF), _r10(tb.AS_OF)])
_DRIVER_VALUE = ", ".join(f"cast({x} as varchar)" for x in
                          "driver priority pclass gap cohorts incoming why error behaviour_gap activity_num activity_title activity_duration activity_objective "
                          "activity_how activity_materials activity_tags".split())

REPORT_PAYLOAD = _with(_ALL_INPUTS, _ALL_REPORTS + f""",
team_fields as (select {_TEAM_FIELDS} from {_TEAM_JOINS})
{_cells('NET_SCORE_MONTHLY', 'i', _numbered('r1', 'team'), ['team', 'enc', 'pro', 'neu', 'det', 'nps_score'])} union all
{_cells('SCORE_WEEKLY', 'i', _numbered('r2', 'week, team'), ['week', 'team', 'enc', 'avg_score'])} union all
{_cells('SCORE_BY_PROCESS', 'i', _numbered('r3', 'team, enc desc, process nulls first'), ['team', 'process', 'enc', 'nps', 'target', 'pct'])} union all
{_cells('QA_BY_CHANNEL', 'i', _numbered('r4', 'team, channel'), ['team', 'channel', 'total', 'pct', 'grade'])} union all
{_cells('TRAINING_SHARE', 'team', 'r5', ['agents', 'pct', 'h_train', 'h_logged'])} union all
{_cells('CRITICAL_PROCESS', 'team', 'team_fields', ['process', 'process_desc', 'incoming_total', 'cohorts', 'nps', 'gap_total', 'behaviour_insight', 'behaviour_gaps'])} union all
select 'CRITICAL_PROCESS' as name, team as item, concat('driver ', num) as field, concat_ws('~', {_DRIVER_VALUE}) as value from coach""", aligned=True)

_SLOTS = [("NET_SCORE_MONTHLY", "monthly"), ("SCORE_WEEKLY", "weekly"), ("SCORE_BY_PROCESS", "byProcess"),
          ("QA_BY_CHANNEL", "qaByChannel"), ("TRAINING_SHARE", "trainingShare"), ("CRITICAL_PROCESS", "criticalProcess")]
_STAMP = "17/01/2024 11:05h"


def _block(marker: str, inner: str) -> str:
    return f"// __{marker}_START__\n{inner}\n// __{marker}_END__"


def _expected_tails() -> list[str]:
    """What a published page ends in, payload lines reduced to <variable>."""
    stamp = tb.stamps(_STAMP, _STAMP, _STAMP)
    blocks = "".join(f"<script>\n{_block(m, f'<{v}>')}\n</script>" for m, v in _SLOTS)
    decls = "".join(f"<script><{v}></script>" for _, v in _SLOTS[:3])
    return [blocks + stamp, decls + stamp, "", _block(_SLOTS[0][0], f"<{_SLOTS[0][1]}>"), _block(_SLOTS[1][0], f"<{_SLOTS[1][1]}>")]


def _names(done: list[str]) -> str:
    return ",".join(done)


_MARKERS = [m for m, _ in _SLOTS]
_INJECTED = [_MARKERS, _MARKERS[:3], [], _MARKERS[:1], _MARKERS[1:2]]
_sql = lambda text: "'" + text.replace("'", "''") + "'"
_by_kind = lambda texts: "case page_id % 5 " + " ".join(f"when {k} then {_sql(t)}" for k, t in enumerate(texts)) + " end"
_SIZES = ["r1", "r2", "r3", "r4", "r5", "crit"]

PUBLISH_PAGES = _with(_ALL_INPUTS, _ALL_REPORTS + f""",
s as (select {', '.join(f'(select count(*)::integer from {r}) as s{k}' for k, r in enumerate(_SIZES))})
select page_id, {_by_kind([_names(d) for d in _INJECTED])} as injected,
  {_by_kind([_names([m for m in _MARKERS if m not in d]) for d in _INJECTED])} as missing, '{_STAMP}' as refreshed_at,
  {', '.join(f"case when page_id % 5 in ({', '.join(str(i) for i, d in enumerate(_INJECTED) if m in d)}) then s{k} else 0 end as n_{v}" for k, (m, v) in enumerate(_SLOTS))},
  md5(concat(html, {_by_kind(_expected_tails())})) as rest
from pages, s""", aligned=True)

_twice = f"{_STAMP}|{_STAMP}"
PAGE_STAMPS = f"""
select page_id, {_by_kind([f'{_STAMP}|crossed', f'{_STAMP}|crossed', '', '', ''])} as badge, {_by_kind([_STAMP, _STAMP, '', '', ''])} as header,
  {_by_kind([f'{_STAMP}|x', f'{_STAMP}|x', '', '', ''])} as styles, {_by_kind([_twice, _twice, '', '', ''])} as second
from pages"""

# --- rows as lines, kept and stored measures, quality ------------------------


def _lines(name: str, source: str, fields: list[str], place: str = "") -> str:
    cells = ", ".join(f"coalesce(cast({f} as varchar), '~')" for f in fields)
    return f"select '{name}' as report, {place}concat_ws('|', {cells}) as line from {source}"


_FIELDS = {
    "net_score_monthly": ("r1", ["team", "enc", "pro", "neu", "det", "nps_score"]),
    "score_weekly": ("r2", ["week", "team", "enc", "avg_score"]),
    "score_by_process": ("r3", ["team", "process", "enc", "nps", "target", "pct"]),
    "driver_detail": ("r8", ["team", "process", "driver", "enc", "nps_score", "target", "cohorts", "pct_in_proc"]),
    "qa_by_channel": ("r4", ["team", "channel", "total", "pct", "grade"]),
    "behaviour_counts": ("r6", ["team", "sentence", "moment", "total_cases", "low_count"]),
}
_all_lines = lambda *names: " union all ".join(_lines(n, *_FIELDS[n]) for n in names)

KEPT_SURVEY_REPORTS = _with(["survey"], ",".join([R1, _r2(tb.AS_OF), R3, R8]) + "\n" + _all_lines("net_score_monthly", "score_weekly", "score_by_process", "driver_detail"))

REPORT_ROWS = _with(["survey", "qa_eval"], ",".join([R1, _r2(tb.AS_OF), R3, R8, _r4(tb.QA_AS_OF), _r6(tb.QA_AS_OF)]) + "\n" + _all_lines(*_FIELDS))

PRESENTED_ORDER = _with(["survey", "qa_eval"], ",".join([R3, R8, _r6(tb.QA_AS_OF)]) + "\n" + " union all ".join(
    _lines(name, f"(select *, row_number() over (order by {order}) - 1 as i from {_FIELDS[name][0]})", _FIELDS[name][1], "cast(i as integer) as place, ")
    for name, order in (("score_by_process", "team nulls first, enc desc, process nulls first"),
                        ("driver_detail", "team nulls first, process nulls first, enc desc, driver nulls first"),
                        ("behaviour_counts", "team nulls first, low_count desc, sentence nulls first, moment nulls first"))))


def _metric(source: str, metric: str, cond: str, rows: str) -> str:
    return f"select '{source}' as source, '{metric}' as metric, cast(count(*) filter (where {cond}) as bigint) as n from {rows}"


_PERIOD = f"survey where response_date >= date '{(tb.AS_OF.replace(day=1) - dt.timedelta(weeks=4)).isoformat()}'"
_QA_PERIOD = f"qa_eval where assigned_date >= date '{MONTH}'"
_STATUS_DAYS = (f"(select count(*) as n from training_status where agent is not null and work_date >= date '{MONTH}' "
                f"and work_date < date '{_after(tb.AS_OF)}' group by agent, work_date)")
QUALITY_METRICS = _with(["survey", "qa_eval", "training_status"], f"""
t as (select *, {_TNUM} as tnum from {_PERIOD})
""" + " union all ".join([
    _metric("survey", "rows", "true", "t"), _metric("survey", "null_teams", "team is null", "t"), _metric("survey", "null_scores", "score is null", "t"),
    _metric("survey", "null_processes", "process is null", "t"), _metric("survey", "unreadable_targets", "target_text is not null and tnum is null", "t"),
    _metric("survey", "blank_drivers", f"driver is null or not {_FILLED}", "t"),
    _metric("qa_eval", "rows", "true", _QA_PERIOD), _metric("qa_eval", "null_teams", "team is null", _QA_PERIOD),
    _metric("qa_eval", "null_totals", "qa_total is null", _QA_PERIOD), _metric("qa_eval", "null_sentences", "sentence is null", _QA_PERIOD),
    _metric("training_status", "rows", "true", _STATUS_DAYS), _metric("training_status", "duplicate_days", "n > 1", _STATUS_DAYS)]), aligned=True)

LOCAL_DAYS = """
select cast(ts - interval 5 hour as date) as day, event_type as team, count(*) as n from events group by 1, 2"""

PAYLOAD_TYPES = """
select o_orderstatus as status, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total,
  strftime(max(cast(o_orderdate as date)), '%Y-%m-%d') as last
from orders group by 1"""

PUBLISHED_PAGES_CHECK = _with(["survey"], R1 + "," + R3 + """,
s as (
  select (select count(*) from r1)::integer as m_rows, (select cast(sum(enc) as bigint) from r1) as m_enc,
         (select count(*) from r3)::integer as p_rows, (select cast(sum(enc) as bigint) from r3) as p_enc)
select page_id,
  case when page_id % 5 in (0, 1, 3) then m_rows else 0 end as monthly_rows,
  case when page_id % 5 in (0, 1, 3) then m_enc else 0 end as monthly_enc,
  case when page_id % 5 < 2 then p_rows else 0 end as process_rows,
  case when page_id % 5 < 2 then p_enc else 0 end as process_enc
from pages, s""")


def all_sql() -> dict[str, str]:
    return {
        "net_score_monthly": _with(["survey"], R1 + "\nselect * from r1"),
        "score_weekly": _with(["survey"], _r2(tb.WEEKLY_AS_OF) + "\nselect * from r2"),
        "score_by_process": _with(["survey"], R3 + "\nselect * from r3"),
        "qa_by_channel": _with(["qa_eval"], _r4(tb.QA_AS_OF) + "\nselect * from r4"),
        "training_share": TRAINING_SHARE,
        "training_share_by_key": _with(["survey", "agent_time", "training_status"], _r5(tb.TIME_AS_OF) + "\nselect team, pct, h_train, h_logged, agents from r5"),
        "behaviour_counts": _with(["qa_eval"], _r6(tb.QA_AS_OF) + "\nselect * from r6"),
        "flag_matrix": FLAG_MATRIX,
        "driver_detail": _with(["survey"], R8 + "\nselect * from r8"),
        "agent_detail": AGENT_DETAIL,
        "critical_process": _with(["survey"], CRIT + "\nselect * from crit"),
        "top_drivers": TOP_DRIVERS,
        "top_behaviours": TOP_BEHAVIOURS,
        "driver_coaching": DRIVER_COACHING,
        "critical_process_report": CRITICAL_PROCESS_REPORT,
        "report_payload": REPORT_PAYLOAD,
        "publish_pages": PUBLISH_PAGES,
        "page_stamps": PAGE_STAMPS,
        "critical_report_drivers": CRITICAL_REPORT_DRIVERS,
        "payload_monthly_rows": _with(["survey"], R1 + "\nselect * from r1"),
        "payload_types": PAYLOAD_TYPES,
        "published_pages_check": PUBLISHED_PAGES_CHECK,
        "driver_detail_sketched": _with(["survey"], R8 + "\nselect * from r8"),
        "kept_survey_reports": KEPT_SURVEY_REPORTS,
        "kept_training_share": TRAINING_SHARE,
        "score_weekly_stream": _with(["survey"], _r2(tb.WEEKLY_AS_OF) + "\nselect * from r2"),
        "report_rows": REPORT_ROWS,
        "presented_order": PRESENTED_ORDER,
        "quality_metrics": QUALITY_METRICS,
        "training_share_bucketed": TRAINING_SHARE,
        "agent_detail_bucketed": AGENT_DETAIL,
        "local_days": LOCAL_DAYS,
    }
