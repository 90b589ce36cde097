"""URL filter: fixed host/path rules, and association rules mined by FP-growth.

Fixed rules (``RULES``) fit a host and all its subdomains when the url's path
starts with the rule's; the longest wins. Urls that no fixed rule fits get the
verdict of mined rules: token combinations of labelled urls, mined by Spark's
FP-growth, of which those implying a label with enough confidence and support
stay. Tokens of the same urls are mined as one item. A rule is dropped when it
without one of its items implies the same label at least as surely. Rules match by
an inverted index: a rule is posted under its rarest item only, and a posting
counts when the url holds the rule's other items.
The matched rule of highest confidence decides (ties: support, more tokens,
block before allow, text); a url that no rule fits gets the majority label.

``labels`` are rows (url, label). The registered query labels urls by the
fixed rules, because the ``labels`` table says nothing about urls: on check_l
quality is 0.88 for hosts named like casino or spam and 0.86 for others.
Everything is a DataFrame or SQL function, or Spark's own FPGrowth.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from cxpulse.llm.common import materialise, table

#: (verdict, host, path), as given
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + F.lit(3), F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column) -> Column:
    """struct(rule, verdict) of the longest fitting rule, else null."""
    fits = []
    for verdict, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        hit = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        fits.append(F.when(hit, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits)


def tokens(url: Column) -> Column:
    """Distinct tokens of a url: scheme, host labels, path
    segments by place, file extension, query keys, fragment; numbers as ``#``."""
    host, path = host_path(url)
    url = F.coalesce(url, F.lit(""))
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    shape = lambda s: F.regexp_replace(s, r"[0-9]+", "#")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.filter(F.split(query, "&"), lambda s: s != "")
    return F.array_distinct(F.concat(
        F.array(F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(url, r"^([^:]*)://", 1)))),
        F.transform(labels, lambda s: F.concat(F.lit("host:"), s)),
        F.transform(segments, lambda s, i: F.concat(F.lit("path"), i.cast("string"), F.lit(":"), shape(s))),
        F.transform(keys, lambda s: F.concat(F.lit("query:"), F.regexp_extract(s, r"^([^=]*)", 1))),
        F.array(F.concat(F.lit("slash:"), path.endswith("/").cast("string")), F.concat(F.lit("fragment:"), F.contains(url, F.lit("#")).cast("string"))),
    ))


def merged_tokens(rows: DataFrame, least: float) -> DataFrame:
    """(item, members) of the tokens that at least ``least`` rows (id, tokens)
    hold: tokens of exactly the same rows are one item, named after the smallest
    of them. Same rows: the same number and two equal 64-bit sums of row hashes.

    There are at most (tokens of all rows) / ``least`` such tokens: their number
    depends on the support asked for, not on the number of urls."""
    spread = rows.select("id", F.explode("tokens").alias("token"))
    held = spread.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(F.lit("a"), "id")).alias("x"), F.bit_xor(F.xxhash64(F.lit("b"), "id")).alias("y"))
    same = held.filter(F.col("n") >= least).groupBy("n", "x", "y").agg(F.array_sort(F.collect_list("token")).alias("members"))
    return same.select(F.col("members")[0].alias("item"), "members")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (rule_id, items, groups, label, confidence, support, n) from rows (url, label).

    Transactions are a url's tokens and its label as one more item. Tokens that
    always occur together are mined as one item (a path of thirty segments is
    one item, not 2 ** 30 sets); ``groups`` has the tokens of each item of a rule,
    any one of which may stand for it. Support and confidence bound the rules, not
    their length. No labels, no rules.
    """
    if labelled.isEmpty():
        none = "items array<string>, label string, confidence double, support double, n int, rule_id long, groups array<array<string>>"
        return labelled.sparkSession.createDataFrame([], none)
    rows = labelled.filter("label IS NOT NULL").select(F.monotonically_increasing_id().alias("id"), tokens(F.col("url")).alias("tokens"), "label")
    rows = materialise(rows, "labelled-urls")
    merged = materialise(merged_tokens(rows, min_support * rows.count() - 1e-9), "url-items")
    names = merged.select(F.explode("members").alias("token"), "item")
    spread = rows.select("id", "label", F.explode("tokens").alias("token"))
    # every url has a scheme, slash and fragment token, so none is lost here
    baskets = spread.join(names, "token", "left").groupBy("id", "label").agg(F.collect_set("item").alias("held"))
    baskets = materialise(baskets.select(F.concat("held", F.array(F.concat(F.lit("label="), F.col("label")))).alias("items")), "baskets")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.filter((F.size("consequent") == 1) & F.col("consequent")[0].startswith("label="))
    rules = rules.filter("NOT exists(antecedent, x -> x LIKE 'label=%')")
    rules = materialise(rules.select(
        F.array_sort("antecedent").alias("items"), F.expr("substring(consequent[0], 7)").alias("label"),
        "confidence", "support", F.size("antecedent").alias("n")).withColumn("rule_id", F.xxhash64("items", "label")), "rules")
    # a rule is redundant if it without one of its items is as sure
    parts = rules.filter("n > 1").select("rule_id", "label", "confidence", F.explode("items").alias("out"), "items").select(
        "rule_id", "label", "confidence", F.array_except("items", F.array("out")).alias("part"))
    short = rules.select(F.col("items").alias("part"), F.col("label"), F.col("confidence").alias("c"))
    redundant = parts.join(short, ["part", "label"]).filter("c >= confidence").select("rule_id").distinct()
    kept = rules.join(redundant, "rule_id", "left_anti")
    groups = kept.select("rule_id", F.explode("items").alias("item")).join(merged, "item")
    groups = groups.groupBy("rule_id").agg(F.array_sort(F.collect_list("members")).alias("groups"))
    return materialise(kept.join(groups, "rule_id"), "pruned-rules")


def index(rules: DataFrame) -> DataFrame:
    """Postings (token, rule_id, items, groups, label, confidence, support, n): each
    rule under the tokens of its rarest group (the one that the fewest rules hold;
    ties by text)."""
    spread = rules.select("rule_id", F.explode("groups").alias("group"))
    held = spread.groupBy("group").agg(F.count("*").alias("rules"))
    rarest = spread.join(held, "group").groupBy("rule_id").agg(F.min(F.struct("rules", "group"))["group"].alias("group"))
    return rules.join(rarest.select("rule_id", F.explode("group").alias("token")), "rule_id")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(items_id, label) of the deciding rule for rows (items_id, tokens): a rule
    fits if the url holds a token of each of its groups."""
    postings = materialise(index(rules), "rule-index")
    spread = sets.select("items_id", F.explode("tokens").alias("token"))
    hits = spread.join(postings, "token").drop("token", "items")
    hits = hits.join(sets, "items_id").filter(F.forall("groups", lambda g: F.arrays_overlap(g, F.col("tokens"))))
    order = F.struct(F.col("confidence"), F.col("support"), F.col("n"), (F.col("label") == "block").cast("int"), F.col("rule_id"))
    return hits.groupBy("items_id").agg(F.max_by("label", order).alias("label"))


def judge(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    A null or empty url has empty host and path and takes the majority label;
    without any labelled url that is ``allow``. Rows repeating a page are judged
    alike; an empty table gives an empty result; further columns are ignored.
    Urls are matched once per distinct token set, so a host with very many
    pages costs as many matches as it has kinds of urls.
    """
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("fit", fixed_rule(F.col("host"), F.col("path")))
    rows = materialise(rows.select("page_id", "url", "host", "path", "fit.rule", "fit.verdict"), "urls")
    labelled = rows.filter("verdict IS NOT NULL").select("url", F.col("verdict").alias("label"))
    rules = mine(labelled)
    top = labelled.groupBy("label").count().orderBy(F.desc("count"), "label").first()
    majority = top["label"] if top else "allow"
    kind = F.xxhash64(F.array_sort(tokens(F.col("url"))))
    open_rows = rows.filter("verdict IS NULL").withColumn("items_id", kind)
    kinds = open_rows.select("items_id", tokens(F.col("url")).alias("tokens")).dropDuplicates(["items_id"])
    decided = match(kinds, rules)
    judged = open_rows.join(decided, "items_id", "left").withColumn("verdict", F.coalesce("label", F.lit(majority)))
    out = ["page_id", "host", "path", "rule", "verdict"]
    return rows.filter("verdict IS NOT NULL").select(*out).unionByName(judged.select(*out))


def op4_url_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
