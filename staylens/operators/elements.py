"""Element rows of stored pages, and element rules as a table joined to them.

All of it is built-in Spark.  A page becomes rows of its tags in document order; start and end
tags are matched by running counts per tag name, so that an element left open disturbs no
other kind of element; an element's parent is the last one before it that is one level up.
Rules are rows too, one for each test of a selector, and meet the elements by tag and attribute.
No step holds more than one page's rows of a tag or level in order, and no step pairs all
elements of a page with one another.

Selectors of one or two parts are supported, joined by a blank or ``>``, with ``[a]``, ``[a=v]``,
``[a*=v]``, ``:not([..])`` and a class; these are all that links need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from staylens.functions.markup import _compile, unescaped, without_code
from staylens.functions.rules import LINK_RULES, Rule
from staylens.functions.workspace import stored
from staylens.operators.links import fallback_elements

TAG = r"""(?is)</?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
NAME = r"(?is)^</?([a-z][^\s/>]*)"
VALUE = r"""(?is)(?<![\w-]){}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
# --- fixed values: elements without an end tag
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
PAGE_END = (1 << 31) - 1
TASK_CHARS = 8_000_000  # of pages whose tags one task holds in order, about
TEXT = "#text"  # the tag of texts, where they are rows too
RULES = "rule_no int, step int, tag string, attr string, op string, value string, wanted boolean, n_tests int, direct boolean, n_steps int"


def dealt(rows: DataFrame, keys: Sequence[str], total: int | None, most: int) -> DataFrame:
    """Rows dealt out by ``keys`` to tasks of about ``most`` of a ``total``, so that none grows with the input."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-(total or 0) // most))
    return rows.repartition(tasks, *keys)


def page_tags(views: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """``keys``, ``pos``, ``tag``, ``closing``, ``markup``: the tags of each page in order; comments and code hold none."""
    found = views.select(*keys, F.posexplode(F.regexp_extract_all(without_code(F.col(html)), F.lit(TAG), 0)).alias("pos", "markup"))
    return found.select(
        *keys, "pos", F.lower(F.regexp_extract("markup", NAME, 1)).alias("tag"), F.col("markup").startswith("</").alias("closing"), "markup"
    )


def elements(tags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Start tags with ``end``, the place where the element ends, and ``parent``, the place of its parent (NULL at the top).

    An element ends at its end tag; one that is left open ends where the next of its name at
    that level starts or at the end of the page; elements that have no end tag, and texts, end where they start.
    """
    void = F.col("tag").isin(*VOID, TEXT)
    kept = tags.where(~(void & F.col("closing")))
    step = F.when(void, 0).when(F.col("closing"), -1).otherwise(1)
    count = F.sum(step).over(W.partitionBy(*keys, "tag").orderBy("pos").rowsBetween(W.unboundedPreceding, 0))
    level = count + F.when(F.col("closing"), 1).otherwise(0)
    # a start tag and the next tag of its name at its level belong together
    mate = F.lead("pos").over(W.partitionBy(*keys, "tag", "level").orderBy("pos"))
    matched = kept.withColumn("level", level).withColumn("end", F.when(void, F.col("pos")).otherwise(F.coalesce(mate, F.lit(PAGE_END))))
    opened = matched.where(~F.col("closing")).drop("level", "closing")
    # depth: elements begun before and not ended yet; at one place ends come before starts
    start = F.struct(F.col("pos").alias("at"), F.when(void, 0).otherwise(1).alias("change"), "tag", "markup", "end")
    none = [F.lit(None).cast(opened.schema[c].dataType).alias(c) for c in ("tag", "markup", "end")]
    end = F.struct(F.col("end").alias("at"), F.lit(-1).alias("change"), *none)
    events = F.when(~void & (F.col("end") < PAGE_END), F.array(start, end)).otherwise(F.array(start))
    order = W.partitionBy(*keys).orderBy("at", "change").rowsBetween(W.unboundedPreceding, -1)
    depth = F.coalesce(F.sum("change").over(order), F.lit(0))
    nested = opened.select(*keys, F.inline(events)).withColumn("depth", depth).where("markup is not null").withColumnRenamed("at", "pos").drop("change")
    # an element at its own depth, looking for a parent, and one deeper, as a parent if it can be one
    placed = nested.select("*", F.explode(F.when(void, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))).alias("deeper")).withColumn("at_depth", F.col("depth") + F.col("deeper"))
    before = W.partitionBy(*keys, "at_depth").orderBy("pos", "deeper").rowsBetween(W.unboundedPreceding, -1)
    parent = F.max(F.when(F.col("deeper") == 1, F.col("pos"))).over(before)
    return placed.withColumn("parent", parent).where("deeper = 0").drop("deeper", "at_depth")


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """One row per test of each rule: ``rule_no`` counts from 1 in the order in which rules are tried."""
    rows = []
    for number, rule in enumerate(rules, 1):
        steps = _compile(rule.css)
        if not 1 <= len(steps) <= 2 or rule.own_text or any(nth for _, _, nth, _ in steps):
            raise ValueError(f"rules of one or two parts are supported, without counting and text: {rule.css}")
        for k, (tag, tests, _, direct) in enumerate(steps):
            for name, op, value, wanted in tests or [("", "", None, True)]:
                rows.append((number, k, tag, name, op, value, wanted, max(len(tests), 1), direct, len(steps)))
    return spark.createDataFrame(rows, RULES)


def rule_hits(found: DataFrame, rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, ``rule_no``, ``pos``, ``markup`` of the elements that each rule selects.

    ``found`` is read twice: give it a stored table.
    """
    names = [r["attr"] for r in rules.select("attr").where("attr <> ''").distinct().orderBy("attr").collect()]

    def value(name: str):
        held = F.regexp_like("markup", F.lit(VALUE.format(name)))
        parts = F.concat(*(F.regexp_extract("markup", VALUE.format(name), k) for k in (1, 2, 3)))
        return F.struct(F.lit(name).alias("attr"), F.when(held, unescaped(parts)).alias("held"))

    every = F.struct(F.lit("").alias("attr"), F.lit("").alias("held"))  # for parts that test a tag alone
    asked = F.broadcast(rules.select("rule_no", "step", F.col("tag").alias("wanted_tag"), F.col("attr").alias("wanted_attr"), "op", "value", "wanted", "n_tests", "direct", "n_steps"))  # rows a user has written
    given = found.select(*keys, "pos", "end", "parent", "tag", F.inline(F.array(*map(value, names), every)))
    here = (F.col("tag") == F.coalesce("wanted_tag", "tag")) & (F.col("attr") == F.col("wanted_attr"))
    holds = (
        F.when(F.col("op") == "=", F.col("held") == F.col("value"))
        .when(F.col("op") == "*=", F.contains("held", "value"))
        .when(F.col("op") == "~=", F.array_contains(F.split("held", r"\s+"), F.col("value")))
        .otherwise(F.col("held").isNotNull())
    )
    met = given.join(asked, here).where(F.coalesce(holds, F.lit(False)) == F.col("wanted"))
    fitting = met.groupBy(*keys, "pos", "rule_no", "step").agg(
        F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("end", "parent", "n_tests", "n_steps")), F.max("direct").alias("direct")
    )
    fitting = stored(fitting.where("n = n_tests").drop("n", "n_tests"), "rule-parts")  # read by each kind of rule
    last = fitting.where("step = n_steps - 1")
    single = last.where("n_steps = 1").select(*keys, "rule_no", "pos")
    outer = fitting.where("step = 0 and n_steps = 2")
    child = last.where("n_steps = 2 and direct").join(
        outer.select(*keys, "rule_no", F.col("pos").alias("parent")), [*keys, "rule_no", "parent"], "left_semi"
    )
    # inside another element: one of those that began before ends later
    both = last.where("n_steps = 2 and not direct").select(*keys, "rule_no", "pos", F.lit(None).cast("int").alias("reach"))
    both = both.unionByName(outer.select(*keys, "rule_no", "pos", F.col("end").alias("reach")))
    so_far = W.partitionBy(*keys, "rule_no").orderBy("pos").rangeBetween(W.unboundedPreceding, -1)
    inside = both.withColumn("covered", F.max("reach").over(so_far)).where("reach is null and covered > pos")
    hits = single.unionByName(child.select(*keys, "rule_no", "pos")).unionByName(inside.select(*keys, "rule_no", "pos"))
    ends = {r["tag"] for r in rules.where("step = n_steps - 1").select("tag").distinct().collect()}
    last_tags = F.lit(True) if None in ends else F.col("tag").isin(*ends)
    return hits.join(found.where(last_tags).select(*keys, "pos", "markup"), [*keys, "pos"])


def rule_links(views: DataFrame, keys: Sequence[str], rules: Sequence[Rule] = LINK_RULES) -> DataFrame:
    """Views ``(keys.., html)`` -> ``keys``, ``rule_no``, ``pos`` (from 0), ``href`` of the first rule with any match.

    As ``links.harvest_links``, without leaving the JVM: all links of the winning rule are given,
    usable or not; a match without ``href`` has the href NULL.
    """
    chars = views.agg(F.sum(F.char_length("html").cast("bigint"))).first()[0]
    found = stored(elements(dealt(page_tags(views, keys), keys, chars, TASK_CHARS), keys), "elements")
    hits = stored(rule_hits(found, rule_table(views.sparkSession, rules), keys), "rule-hits")
    won = fallback_elements(hits, keys)
    place = F.row_number().over(W.partitionBy(*keys).orderBy("pos")) - 1
    pattern = VALUE.format("href")
    href = unescaped(F.concat(*(F.regexp_extract("markup", pattern, k) for k in (1, 2, 3))))
    return won.select(*keys, "rule_no", place.alias("pos"), F.when(F.regexp_like("markup", F.lit(pattern)), href).alias("href"))
