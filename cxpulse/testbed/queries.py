"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
built from the driver's tables through the testbed adapters. Nested and text
outputs are flattened to rows, so that every value has an oracle."""

from __future__ import annotations

import datetime as dt
import functools
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import zone_date
from ..plans import agents as ag
from ..plans import critical as cr
from ..plans import layout, qa, stream
from ..plans import refresh as rf
from ..plans import survey as sv
from ..plans.order import presented
from ..plans.publish import PayloadSpec, StampSpec, as_payload, payloads, publish_pages, read_report_rows, write_report_rows
from ..plans.quality import Watch
from ..plans.state import State
from ..session import shared_folder, written
from . import adapters as tb

Query = Callable[[SparkSession, str], DataFrame]


def net_score_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.net_score_monthly(tb.survey(spark, sf_dir), tb.scope())


def score_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.score_weekly(tb.survey(spark, sf_dir), tb.scope(tb.WEEKLY_AS_OF))


def score_by_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.score_by_process(tb.survey(spark, sf_dir), tb.scope())


def driver_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sv.driver_detail(tb.survey(spark, sf_dir), tb.scope())


def qa_by_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.qa_by_channel(tb.qa_eval(spark, sf_dir), tb.scope(tb.QA_AS_OF), tb.QA)


def behaviour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.behaviour_counts(tb.qa_eval(spark, sf_dir), tb.scope(tb.QA_AS_OF), tb.QA)


def flag_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.flag_matrix(tb.qa_flags(spark, sf_dir), tb.scope(tb.TIME_AS_OF), tb.FLAGS)


def training_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.training_share(tb.agent_time(spark, sf_dir), tb.training_status(spark, sf_dir),
                             tb.survey(spark, sf_dir), tb.scope(tb.TIME_AS_OF), tb.AGENT_TIME)


def training_share_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed map form, exploded back to rows for the oracle."""
    m = ag.training_share_by_key(training_share(spark, sf_dir))
    e = m.select(F.explode("by_team").alias("team", "v"))
    return e.select("team", "v.pct", "v.h_train", "v.h_logged", "v.agents")


def agent_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.agent_detail(tb.survey(spark, sf_dir), tb.agent_time(spark, sf_dir), tb.scope(),
                           tb.AGENT_TIME, tb.AGENT_CHANNEL_MAP, time_scope=tb.scope(tb.TIME_AS_OF))


def _r10_inputs(spark: SparkSession, sf_dir: str):
    """R3 and R8 from one survey summary (one scan), and R6."""
    sc = tb.scope()
    rows = sv.measured(tb.survey(spark, sf_dir), sc).groupBy(*sv.SUMMARY_KEYS).agg(*sv.scores.combined())
    behaviours = qa.behaviour_counts(tb.qa_eval(spark, sf_dir), tb.scope(tb.QA_AS_OF), tb.QA)
    return sv.score_by_process(None, sc, rows=rows), sv.driver_detail(None, sc, rows=rows), behaviours


def critical_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cr.critical_process(score_by_process(spark, sf_dir), tb.TEXTS)


def top_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_process, drivers, _ = _r10_inputs(spark, sf_dir)
    return cr.top_drivers(drivers, cr.critical_process(by_process, tb.TEXTS), tb.TEXTS)


def top_behaviours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cr.top_behaviours(behaviour_counts(spark, sf_dir), tb.catalog(spark), tb.TEXTS).drop("error_text", "activity")


def driver_coaching(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_process, drivers, behaviours = _r10_inputs(spark, sf_dir)
    tops = cr.top_drivers(drivers, cr.critical_process(by_process, tb.TEXTS), tb.TEXTS)
    behs = cr.top_behaviours(behaviours, tb.catalog(spark), tb.TEXTS)
    return cr.flat_coaching(cr.driver_coaching(tops, behs, tb.TEXTS))


def nested_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_process, drivers, behaviours = _r10_inputs(spark, sf_dir)
    return cr.critical_process_report(by_process, drivers, behaviours, tb.catalog(spark), tb.TEXTS)


def _gaps(gaps: Column) -> Column:
    return F.array_join(F.transform(gaps, lambda g: F.concat_ws(":", g["label"], g["val"], g["max"])), "|")


def _driver_fields(d: str) -> list[Column]:
    a = f"{d}.activity"
    return [F.col(f"{d}.num").alias("num"), F.col(f"{d}.name").alias("driver"), F.col(f"{d}.priority").alias("priority"),
            F.col(f"{d}.pclass").alias("pclass"), F.col(f"{d}.gap").alias("gap"), F.col(f"{d}.cohorts").alias("driver_cohorts"),
            F.col(f"{d}.incoming").alias("incoming"), F.col(f"{d}.why").alias("why"), F.col(f"{d}.error").alias("error"),
            F.col(f"{d}.behaviour_gap").alias("behaviour_gap"), F.col(f"{a}.num").alias("activity_num"),
            *[F.col(f"{a}.{x}").alias(f"activity_{x}") for x in ("title", "duration", "objective", "how", "materials")],
            F.array_join(F.col(f"{a}.tags"), "|").alias("activity_tags")]


def critical_process_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R10, every leaf: one row per (team, driver) with the team's fields and
    its behaviour gaps as text; a team without drivers keeps one row."""
    d = nested_report(spark, sf_dir).select("*", F.explode_outer("drivers").alias("d"))
    return d.select("team", "process", "process_desc", "incoming_total", "cohorts", "nps", "gap_total",
                    "behaviour_insight", _gaps(F.col("behaviour_gaps")).alias("behaviour_gaps"), *_driver_fields("d"))


def critical_report_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R10 without the activity's own fields: what a driver list shows."""
    d = nested_report(spark, sf_dir).select("*", F.explode_outer("drivers").alias("d"))
    return d.select("team", "process", "incoming_total", "nps", F.size("behaviour_gaps").alias("n_gaps"),
                    F.col("d.num").alias("num"), F.col("d.name").alias("driver"), F.col("d.gap").alias("gap"),
                    F.col("d.incoming").alias("incoming"))


def inputs(spark: SparkSession, sf_dir: str) -> rf.Inputs:
    """All sources on the survey's month."""
    return rf.Inputs(tb.survey(spark, sf_dir), tb.qa_eval(spark, sf_dir, True), tb.qa_flags(spark, sf_dir, True),
                     tb.agent_time(spark, sf_dir, True), tb.training_status(spark, sf_dir, True), tb.catalog(spark))


def options() -> rf.Options:
    return rf.Options(tb.scope(), tb.QA, tb.FLAGS, tb.AGENT_TIME, tb.AGENT_CHANNEL_MAP, tb.TEXTS)


def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six page payloads (name, var, n, json, b64, js), written once."""
    inp, opt = inputs(spark, sf_dir), options()
    reports = rf.build_reports(inp, opt, *rf.summaries(inp, opt))
    done = written(payloads(rf.payload_reports(reports), rf.DEFAULT_PAYLOADS), "payloads")
    _PAYLOADS[_version(spark, sf_dir)] = done
    return done


# payload tables written by this session, by the version of their input files
_PAYLOADS: dict[tuple, DataFrame] = {}


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """The session, and name, size and time of every input file."""
    found = [spark.sparkContext.applicationId]
    for name in ("events", "orders", "lineitem"):
        path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, f"{name}.parquet"))
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    return tuple(found)


def shared_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload table of these inputs: pages are published from the one that
    was written last, it is made only if there is none."""
    return _PAYLOADS.get(_version(spark, sf_dir)) or payload_rows(spark, sf_dir)


_ROWS = "array<map<string,string>>"
_KEYED = "map<string,map<string,string>>"
_CRITICAL = ("map<string,struct<process:string,process_desc:string,incoming_total:bigint,cohorts:bigint,nps:double,gap_total:double,"
             "drivers:array<struct<num:int,name:string,priority:string,pclass:string,gap:int,cohorts:bigint,incoming:bigint,why:string,error:string,"
             "behaviour_gap:string,activity:struct<num:int,title:string,duration:string,objective:string,how:string,materials:string,tags:array<string>>>>,"
             "behaviour_gaps:array<struct<label:string,val:bigint,max:bigint>>,behaviour_insight:string>>")


def report_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R11 decoded: every payload's base64 text read back into cells (name, item,
    field, value); ``item`` is the row's place, or its key."""
    p = payload_rows(spark, sf_dir).select("name", F.decode(F.unbase64("b64"), "UTF-8").alias("text"))
    keyed = F.col("name").isin("TRAINING_SHARE", "CRITICAL_PROCESS")
    listed = p.where(~keyed).select("name", F.posexplode(F.from_json("text", _ROWS)).alias("item", "row"))
    shares = p.where("name = 'TRAINING_SHARE'").select("name", F.explode(F.from_json("text", _KEYED)).alias("item", "row"))
    cells = [df.select("name", F.col("item").cast("string").alias("item"), F.explode("row").alias("field", "value")) for df in (listed, shares)]
    c = p.where("name = 'CRITICAL_PROCESS'").select("name", F.explode(F.from_json("text", _CRITICAL)).alias("item", "r"))
    team = {x: F.col(f"r.{x}").cast("string") for x in ("process", "process_desc", "incoming_total", "cohorts", "nps", "gap_total", "behaviour_insight")}
    team["behaviour_gaps"] = _gaps(F.col("r.behaviour_gaps"))
    cells.append(c.select("name", "item", F.explode(F.create_map(*[y for k, v in team.items() for y in (F.lit(k), v)])).alias("field", "value")))
    d = c.select("name", "item", F.explode("r.drivers").alias("d")).select("name", "item", *_driver_fields("d"))
    rest = [x for x in d.columns if x not in ("name", "item", "num")]
    cells.append(d.select("name", "item", F.concat(F.lit("driver "), F.col("num").cast("string")).alias("field"),
                          F.concat_ws("~", *[F.col(x).cast("string") for x in rest]).alias("value")))
    out = cells[0]
    for df in cells[1:]:
        out = out.unionByName(df)
    return out


STAMP = StampSpec(element_ids=tb.STAMP_IDS, style_id=tb.STAMP_STYLE_ID, suffix=" 11:05h")


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's pages with payloads injected and the stamp written."""
    slots = [s.slot for s in rf.DEFAULT_PAYLOADS]
    return publish_pages(tb.pages_with_slots(spark, sf_dir, slots), shared_payloads(spark, sf_dir),
                         rf.DEFAULT_PAYLOADS, tb.REFRESHED_AT, STAMP)


def _embedded(var: str, schema: str) -> Column:
    b64 = F.regexp_extract(F.col("html"), rf'const {var} = JSON\.parse\(atob\("([A-Za-z0-9+/=]*)"\)\);', 1)
    return F.from_json(F.decode(F.unbase64(b64), "UTF-8"), schema)


_LINE = r'const (\w+) = JSON\.parse\(atob\("[A-Za-z0-9+/=]*"\)\);'


def publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page what was injected and what is missing, the entries in each
    slot's embedded payload, and a hash of the page with each payload line
    reduced to its variable (all the rest, stamps included, must be as before)."""
    pages = published(spark, sf_dir)
    sizes = [F.coalesce(F.size(_embedded(s.var, _KEYED if s.key else _ROWS) if s.name != "CRITICAL_PROCESS" else _embedded(s.var, _CRITICAL)), F.lit(0)).alias(f"n_{s.var}")
             for s in rf.DEFAULT_PAYLOADS]
    return pages.select("page_id", F.array_join("injected", ",").alias("injected"), F.array_join("missing", ",").alias("missing"), "refreshed_at",
                        *sizes, F.md5(F.regexp_replace("html", _LINE, "<$1>")).alias("rest"))


def page_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamp's places in each page: element texts and style contents."""
    pages = published(spark, sf_dir)
    every = lambda pattern: F.array_join(F.regexp_extract_all("html", F.lit(pattern), F.lit(1)), "|")
    return pages.select("page_id", every(r'id="refreshStamp">([^<]*)<').alias("badge"), every(r'<strong id="headerStamp">([^<]*)<').alias("header"),
                        every(r'::after \{ content: "([^"]*)"').alias("styles"), every(r'\.[ab] \{ content: ?"([^"]*)"').alias("second"))


_MONTHLY_ROWS = "array<struct<team:string,enc:bigint,pro:bigint,neu:bigint,det:bigint,nps_score:double>>"
_PROCESS_ROWS = "array<struct<team:string,process:string,enc:bigint,nps:double,target:double,pct:double>>"


def payload_monthly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R11 round trip: the monthly payload decoded back into R1's rows."""
    p = as_payload(net_score_monthly(spark, sf_dir), rf.DEFAULT_PAYLOADS[0])
    rows = p.select(F.explode(F.from_json(F.decode(F.unbase64("b64"), "UTF-8"), _MONTHLY_ROWS)).alias("r"))
    return rows.select("r.team", "r.enc", "r.pro", "r.neu", "r.det", "r.nps_score")


def payload_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DECIMAL and DATE columns in a payload: totals and last days by status."""
    rows = tb._table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"), F.max(F.to_date("o_orderdate")).alias("last"))
    p = as_payload(rows, PayloadSpec("TYPES", "types", (("status", True),)))
    decoded = F.from_json(F.decode(F.unbase64("b64"), "UTF-8"), "array<struct<status:string,total:double,last:string>>")
    return p.select(F.explode(decoded).alias("r")).select("r.status", "r.total", "r.last")


def published_pages_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R12 round trip: per page, the monthly and by-process payloads decoded
    from the published HTML and summarised (0 where nothing was published).
    No filter follows the publishing step, so nothing is pushed through it."""
    pages = published(spark, sf_dir)
    monthly, by_process = _embedded("monthly", _MONTHLY_ROWS), _embedded("byProcess", _PROCESS_ROWS)
    enc = lambda arr: F.coalesce(F.aggregate(arr, F.lit(0).cast("bigint"), lambda a, x: a + x["enc"]), F.lit(0).cast("bigint"))
    rows = lambda arr: F.coalesce(F.size(arr), F.lit(0))
    return pages.select("page_id", rows(monthly).alias("monthly_rows"), enc(monthly).alias("monthly_enc"),
                        rows(by_process).alias("process_rows"), enc(by_process).alias("process_enc"))


def _lines(df: DataFrame, name: str, *more: str) -> DataFrame:
    """(report, line): a row's values as one text, ``~`` for NULL."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns if c not in more]
    return df.select(F.lit(name).alias("report"), *more, F.concat_ws("|", *cells).alias("line"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def _folder(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"cxpulse-{name}-{uuid.uuid4().hex}")


def driver_detail_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8 from a summary without cohorts: their distinct counts are merged sketches."""
    rows = written(sv.summary(tb.survey(spark, sf_dir), tb.scope(), sketch_k=12), "sketched-summary")
    return sv.driver_detail(None, tb.scope(), rows=rows)


def _state(spark: SparkSession, as_of) -> State:
    return State(spark, _folder(spark, "state"), tb.scope(as_of), tb.QA, tb.FLAGS, tb.AGENT_TIME)


def _all_days(df: DataFrame, column: str) -> list[dt.date]:
    first, last = df.agg(F.min(F.to_date(column)), F.max(F.to_date(column))).first()
    return [first + dt.timedelta(days=k) for k in range((last - first).days + 1)] if first else []


def kept_survey_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1, R2, R3 and R8 from day measures kept between refreshes: the first
    refresh takes all days but the last, the second one only that."""
    inp, sc = rf.Inputs(tb.survey(spark, sf_dir), None, None, None, None, None), tb.scope()
    state, days = _state(spark, tb.AS_OF), _all_days(inp.survey, "response_date")
    state.replace(inp, days[:-1], ["survey"])
    state.replace(inp, days[-1:], ["survey"])
    rows = sv.of_days(state.rows("survey"), sc)
    return _union([_lines(report(None, sc, rows=rows), report.__name__) for report in (sv.net_score_monthly, sv.score_weekly, sv.score_by_process, sv.driver_detail)])


def kept_training_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 from kept days of agent time, status and the survey's agents."""
    sc = tb.scope(tb.TIME_AS_OF)
    inp = rf.Inputs(tb.survey(spark, sf_dir), None, None, tb.agent_time(spark, sf_dir), tb.training_status(spark, sf_dir), None)
    state, month = _state(spark, tb.TIME_AS_OF), [sc.month_start + dt.timedelta(days=k) for k in range((sc.next_month_start - sc.month_start).days)]
    state.replace(inp, _all_days(inp.survey, "response_date"), ["agents"])
    state.replace(inp, month[:-1], ["time", "status"])
    state.replace(inp, month[-1:], ["time", "status"])
    whole = (sc.month_start, sc.next_month_start)
    return ag.training_share(None, None, None, sc, tb.AGENT_TIME, state.rows("time", *whole), state.rows("status", *whole), state.rows("agents").select("agent").distinct())


def score_weekly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 from the stream: files arrive in two parts, in the order of time; each
    run takes in what is new."""
    survey, sc, folder = tb.survey(spark, sf_dir), tb.scope(tb.WEEKLY_AS_OF), _folder(spark, "stream")
    days = _all_days(survey, "response_date")
    bound = F.lit(days[len(days) // 2] if days else None).cast("date")
    arrived = os.path.join(folder, "arrived")
    for part in (F.to_date("response_date") < bound, F.to_date("response_date") >= bound):
        survey.where(part).write.mode("append").parquet(arrived)
        stream.start(spark.readStream.schema(survey.schema).parquet(arrived), sc, folder, "2 days").awaitTermination()
    return sv.score_weekly(None, sc, rows=stream.rows(spark, folder, spark.read.schema(survey.schema).parquet(arrived), sc))


def _flat_reports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    sc, survey, qa_eval = tb.scope(), tb.survey(spark, sf_dir), tb.qa_eval(spark, sf_dir)
    rows, qa_sc = written(sv.summary(survey, sc), "survey-summary"), tb.scope(tb.QA_AS_OF)
    out = {report.__name__: report(None, sc, rows=rows) for report in (sv.net_score_monthly, sv.score_weekly, sv.score_by_process, sv.driver_detail)}
    return out | {report.__name__: report(qa_eval, qa_sc, tb.QA) for report in (qa.qa_by_channel, qa.behaviour_counts)}


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six reports written as JSON texts into one table by report (one of them
    twice, the second time alone), read back row by row."""
    reports, folder = _flat_reports(spark, sf_dir), _folder(spark, "rows")
    write_report_rows(reports | {"score_weekly": reports["score_weekly"].limit(0)}, folder)
    write_report_rows({"score_weekly": reports["score_weekly"]}, folder)
    return _union([_lines(read_report_rows(spark, folder, name), name) for name in reports])


def presented_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: each row of three reports with its place in presentation order. The
    places are counted after the sort's partitions were put together in their order."""
    reports = _flat_reports(spark, sf_dir)
    placed = [(name, presented(reports[name], name).coalesce(1).withColumn("place", F.monotonically_increasing_id().cast("int")))
              for name in ("score_by_process", "driver_detail", "behaviour_counts")]
    return _union([_lines(df, name, "place") for name, df in placed])


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics observed while the summaries and R5 are made."""
    inp, opt, watch = inputs(spark, sf_dir), options(), Watch()
    rf.summaries(inp, opt, watch)
    written(ag.training_share(inp.agent_time, None, inp.survey, opt.scope, opt.agent_time, status_rows=rf.month_status(inp, opt, watch)), "training-share")
    found = [(source, metric, n) for source, c in watch.counts().items() for metric, n in c.items()]
    return spark.createDataFrame(found, "source string, metric string, n long")


def _by_agent(spark: SparkSession, sf_dir: str, *sources: str) -> list[DataFrame]:
    folder, buckets = _folder(spark, "by-agent"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    return [layout.save(getattr(tb, s)(spark, sf_dir), s, folder, buckets) for s in sources]


def training_share_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 from tables stored by agent."""
    tables = _by_agent(spark, sf_dir, "agent_time", "training_status", "survey")
    with layout.co_located(spark):
        return written(ag.training_share(*tables, tb.scope(tb.TIME_AS_OF), tb.AGENT_TIME), "training-share")


def agent_detail_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R9 from tables stored by agent."""
    survey, time = _by_agent(spark, sf_dir, "survey", "agent_time")
    with layout.co_located(spark):
        return written(ag.agent_detail(survey, time, tb.scope(), tb.AGENT_TIME, tb.AGENT_CHANNEL_MAP, time_scope=tb.scope(tb.TIME_AS_OF)), "agent-detail")


def local_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-d4 over a column: events per date in the reports' zone."""
    events = tb._table(spark, sf_dir, "events")
    return events.groupBy(zone_date(F.col("ts")).alias("day"), F.col("event_type").alias("team")).agg(F.count(F.lit(1)).alias("n"))


def all_queries() -> dict[str, Query]:
    return {
        "net_score_monthly": net_score_monthly,
        "score_weekly": score_weekly,
        "score_by_process": score_by_process,
        "qa_by_channel": qa_by_channel,
        "training_share": training_share,
        "training_share_by_key": training_share_by_key,
        "behaviour_counts": behaviour_counts,
        "flag_matrix": flag_matrix,
        "driver_detail": driver_detail,
        "agent_detail": agent_detail,
        "critical_process": critical_process,
        "top_drivers": top_drivers,
        "top_behaviours": top_behaviours,
        "driver_coaching": driver_coaching,
        "critical_process_report": critical_process_report,
        "report_payload": report_payload,
        "publish_pages": publish,
        "page_stamps": page_stamps,
        "critical_report_drivers": critical_report_drivers,
        "payload_monthly_rows": payload_monthly_rows,
        "payload_types": payload_types,
        "published_pages_check": published_pages_check,
        "driver_detail_sketched": driver_detail_sketched,
        "kept_survey_reports": kept_survey_reports,
        "kept_training_share": kept_training_share,
        "score_weekly_stream": score_weekly_stream,
        "report_rows": report_rows,
        "presented_order": presented_order,
        "quality_metrics": quality_metrics,
        "training_share_bucketed": training_share_bucketed,
        "agent_detail_bucketed": agent_detail_bucketed,
        "local_days": local_days,
    }
