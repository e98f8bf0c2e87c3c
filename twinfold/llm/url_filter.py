"""URL verdicts by rules and, where no rule fits, by a tree of path templates. DataFrame functions alone.

Rules name a host and a path prefix; they fit the host and its subdomains, and the longest wins. The
URLs that rules decide are the labels of the method. Per host, paths become templates in three steps, level
by level from the root: segments that look variable (numbers, hexadecimal, dates, identifiers) turn into
wildcards; a position with many different children in few rows each turns into a wildcard as a whole; and
branches with enough labels are put in the order of their blocked share, where those that stand side by side
and don't differ (two-proportion test) become one. A branch with few labels or none can't be told alike to
any other, so it stays by itself. A template is rejected when the blocked share of its labelled URLs, smoothed
towards the share of all hosts, reaches a threshold on enough labels; without labels of its own it is allowed.

All steps aggregate (host, template) counts, which Spark combines before each shuffle, so that a host
with a third of all rows costs no more than its templates.

Cases: a null URL, or one without "://", has an empty host and path and is allowed unless a rule fits;
repeated rows are judged each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.llm.shared import LOWER, UPPER, stored

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Tasks that share the URLs of one template.
SALTS = 8

Rule = tuple[str, str, str]


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def match_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest fitting rule (action, host, path); nulls where none fits."""
    name, verdict = [], []
    for action, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name.append(F.when(fits, F.lit(rule_host + rule_path)))
        verdict.append(F.when(fits, F.lit(action)))
    none = F.lit(None).cast("string")
    return F.coalesce(*name, none), F.coalesce(*verdict, none)


def segment_shape(segment: Column) -> Column:
    """A path segment with its variable parts as wildcards."""
    for pattern, sign in (
        (r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "{uuid}"),
        (r"[0-9]{4}-[0-9]{2}-[0-9]{2}", "{date}"),
        *[(r"(^|[^0-9A-Za-z])[0-9a-fA-F]{12,}($|[^0-9A-Za-z])", "$1{hex}$2")] * 2,  # again, for those that share a sign between them
        (r"[0-9]+", "{n}"),
    ):
        segment = F.regexp_replace(segment, pattern, sign)
    return segment


def _steps(nodes: DataFrame, max_children: int, min_share: float, z: float, min_labels: int) -> DataFrame:
    """host, template, child, step: what the children (host, template, child, l, b, n) of each node add to its template."""
    node = ["host", "template"]
    parents = nodes.groupBy(*node).agg(F.sum("n").alias("pn"), F.count(F.lit(1)).alias("kids"))
    variable = (F.col("kids") > max_children) & (F.col("kids") >= min_share * F.col("pn"))
    known = nodes.join(parents, node).withColumn("variable", variable)
    share = F.col("b") / F.col("l")
    order = Window.partitionBy(*node).orderBy(share, "child")
    l0, b0 = F.lag("l").over(order), F.lag("b").over(order)
    pooled = (F.col("b") + b0) / (F.col("l") + l0)
    differs = l0.isNull() | (F.abs(share - b0 / l0) > z * F.sqrt(pooled * (1 - pooled) * (1 / F.col("l") + 1 / l0)))
    alike = known.filter((F.col("l") >= min_labels) & (F.col("child") != "") & ~F.col("variable")).withColumn("first", differs.cast("int"))
    alike = alike.withColumn("cluster", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    members = Window.partitionBy(*node, "cluster")
    merged = F.when(F.count(F.lit(1)).over(members) > 1, F.concat(F.lit("/{like "), F.min("child").over(members), F.lit("}")))
    joint = alike.select(*node, "child", merged.alias("merged"))
    step = F.when(F.col("child") == "", "").when(F.col("variable"), "/*").otherwise(F.coalesce("merged", F.concat(F.lit("/"), F.col("child"))))
    return known.join(joint, [*node, "child"], "left").select(*node, "child", step.alias("step"))


def path_templates(leaves: DataFrame, depth: int, max_children: int, min_share: float, z: float, min_labels: int) -> DataFrame:
    """host, shapes (array), labelled, blocked, rows -> also template (string), after both tree steps.

    Children of one node share the template that their parents got. Each level is stored: it feeds the next
    one twice.
    """
    tree = leaves.withColumn("template", F.lit(""))
    for level in range(1, depth + 1):
        tree = tree.withColumn("child", F.coalesce(F.get("shapes", F.lit(level - 1)), F.lit("")))
        nodes = stored(tree.groupBy("host", "template", "child").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"), F.sum("rows").alias("n")), "url-nodes")
        named = _steps(nodes, max_children, min_share, z, min_labels)
        tree = stored(tree.join(named, ["host", "template", "child"]).withColumn("template", F.concat("template", "step")).drop("child", "step"), "url-tree")
    return tree


def judge_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", id_col: str = "page_id", depth: int = 4, max_children: int = 50, min_share: float = 0.5, z: float = 2.58, prior: float = 5.0, min_labels: int = 5, reject_at: float = 0.8) -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict, template, purity.

    Deeper segments than depth take part in the template as one. prior is the weight, in labels, of the
    share of blocked URLs among all labels. The verdict is the rule's, or that of the template.
    """
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    deep = F.when(F.size(parts) > depth, F.concat(F.slice(parts, 1, depth - 1), F.array(F.array_join(F.slice(parts, F.lit(depth), F.size(parts)), "/")))).otherwise(parts)
    urls = urls.withColumns({"rule": rule, "ruled": verdict, "shapes": F.transform(deep, segment_shape)})
    labelled, blocked = F.count("ruled"), F.count_if(F.col("ruled") == "block")
    leaves = stored(urls.groupBy("host", "shapes").agg(labelled.alias("labelled"), blocked.alias("blocked"), F.count(F.lit(1)).alias("rows")), "url-leaves")
    tree = path_templates(leaves, depth, max_children, min_share, z, min_labels)
    total = tree.agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")).first()
    share = (total["blocked"] or 0) / max(total["labelled"] or 0, 1)
    templates = tree.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    purity = (F.col("blocked") + F.lit(prior * share)) / (F.col("labelled") + F.lit(prior))
    judged = templates.select("host", "template", purity.alias("purity"), ((purity >= reject_at) & (F.col("labelled") >= min_labels)).alias("rejected"))
    verdicts = tree.join(judged, ["host", "template"]).select("host", "shapes", "template", "purity", "rejected")
    final = F.coalesce("ruled", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    salted = urls.withColumn("salt", F.pmod(F.xxhash64("id", "path"), F.lit(SALTS)))
    return salted.join(verdicts.withColumn("salt", F.explode(salts)), ["host", "shapes", "salt"]).select("id", "host", "path", "rule", final.alias("verdict"), "template", "purity")
