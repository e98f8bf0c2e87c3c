"""Queries M: curation applied to the derived membership."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinfold.operators import curate as M
from twinfold.plans.register import Registry
from twinfold.sources.scratch import stored

R = Registry()
_NEXT = "(SELECT coalesce(max(group_id), 0) + 1 FROM members)"


def _pick(c, group: int, every: int):
    """Some members of one group: a person's selection, as a table."""
    return c.small("members").filter((F.col("group_id") == group) & (F.conv(F.substring("photo_id", 1, 6), 16, 10).cast("int") % every == 0)).select("photo_id")


_PICK = "group_id = {g} AND ('0x' || substr(photo_id, 1, 6))::INT % {e} = 0"


def _log(c):
    return c.spark.createDataFrame([], M.LOG)


R.add("m1_split", lambda c: M.split(c.small("members"), _log(c), 10, _pick(c, 10, 2))[0], f"SELECT photo_id, CASE WHEN {_PICK.format(g=10, e=2)} THEN {_NEXT} ELSE group_id END AS group_id FROM members", "members")
R.add("m1_split_log", lambda c: M.split(c.small("members"), _log(c), 10, _pick(c, 10, 2))[1].select("action_id", "action_type", "source_group_id", F.array_join("photo_ids", ",").alias("ids"), "new_group_id"), f"SELECT CAST(1 AS BIGINT) AS action_id, 'split' AS action_type, CAST(10 AS BIGINT) AS source_group_id, string_agg(photo_id, ',' ORDER BY photo_id) AS ids, {_NEXT} AS new_group_id FROM members WHERE {_PICK.format(g=10, e=2)}", "members")
R.add("m2_split_composite", lambda c: M.split_composite(c.small("members"), 20, _pick(c, 20, 2)), f"""SELECT photo_id, CASE WHEN {_PICK.format(g=20, e=2)} THEN {_NEXT} ELSE group_id END AS group_id FROM members CROSS JOIN (SELECT count(*) AS n, count(*) FILTER ({_PICK.format(g=20, e=2)}) AS gone FROM members WHERE group_id = 20)
    WHERE group_id <> 20 OR NOT (({_PICK.format(g=20, e=2)} AND gone = 1) OR (NOT ({_PICK.format(g=20, e=2)}) AND n - gone = 1))""", "members")
R.add("m3_merge", lambda c: M.merge_entities(c.small("members"), [1, 2, 4], [])[0], "SELECT photo_id, CASE WHEN group_id IN (1, 2, 4) THEN (SELECT group_id FROM members WHERE group_id IN (1, 2, 4) GROUP BY 1 ORDER BY count(*) DESC, group_id LIMIT 1) ELSE group_id END AS group_id FROM members", "members")
R.add("m4_merge_pairwise", lambda c: M.merge_pairwise(c.small("members"), [(1, 2), (2, 4), (5, 7)]).groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("photos")), "SELECT count(DISTINCT CASE WHEN group_id IN (1, 2, 4) THEN 1 WHEN group_id IN (5, 7) THEN 5 ELSE group_id END) AS groups, count(*) AS photos FROM members", "members")
R.add(
    "m5_reject",
    lambda c: M.reject(c.small("rejections"), _log(c), 10, _pick(c, 10, 2))[0],
    f"SELECT photo_id, group_id, rule_name FROM rejections UNION ALL SELECT photo_id, CAST(10 AS BIGINT), 'MANUAL' FROM members WHERE {_PICK.format(g=10, e=2)} AND photo_id NOT IN (SELECT photo_id FROM rejections)", "members", "rejections",
)


def _undone(c):
    groups, log = M.split(c.small("members"), _log(c), 10, _pick(c, 10, 2))
    return M.undo(groups, c.small("rejections"), log)[0]


def _history(c):
    """Two splits of group 10 and one of group 20, as it was after the first."""
    groups, log = M.split(c.small("members"), _log(c), 10, _pick(c, 10, 2))
    groups, log = M.split(stored(groups, "groups"), stored(log, "log"), 20, _pick(c, 20, 2))
    groups, log = M.split(stored(groups, "groups"), stored(log, "log"), 10, _pick(c, 10, 1))
    return M.as_of(M.membership_history(stored(groups, "groups"), stored(log, "log")), 1)


R.add("m6_as_of", _history, f"SELECT photo_id, CASE WHEN {_PICK.format(g=10, e=2)} THEN {_NEXT} ELSE group_id END AS group_id FROM members", "members")
R.add("m6_undo", _undone, "SELECT photo_id, group_id FROM members", "members")
R.add(
    "m7_delete_junk",
    lambda c: M.delete_junk(c.small("junk"), c.small("members"), c.small("rejections"), c.spark.sql("SELECT CAST(NULL AS STRING) AS photo_id, x AS group_id FROM VALUES (3L), (5L) AS t(x)")),
    "SELECT photo_id, group_id FROM junk UNION ALL SELECT photo_id, group_id FROM members WHERE group_id IN (3, 5) AND photo_id NOT IN (SELECT photo_id FROM rejections) AND photo_id NOT IN (SELECT photo_id FROM junk)", "junk", "members", "rejections",
)
R.add("m8_discard_pairs", lambda c: M.discard_pairs(c.small("second"), 100), "SELECT photo_id, group_id FROM second WHERE group_id < 100 OR group_id NOT IN (SELECT group_id FROM second GROUP BY 1 HAVING count(*) = 2)", "second")
R.add(
    "m9_m10_upsert",
    lambda c: M.upsert(c.small("decisions"), c.small("decisions").filter("rule_name = 'WEB_ASSET'").withColumn("decision", F.lit("separate")), "photo_id"),
    "SELECT photo_id, CASE WHEN rule_name = 'WEB_ASSET' THEN 'separate' ELSE decision END AS decision, rule_name FROM decisions", "decisions",
)
R.add("m9_insert_new", lambda c: M.insert_new(c.small("junk"), c.small("members"), "photo_id"), "SELECT photo_id, group_id FROM junk UNION ALL SELECT photo_id, group_id FROM members WHERE photo_id NOT IN (SELECT photo_id FROM junk)", "junk", "members")
R.add(
    "m11_toggle",
    lambda c: M.toggle(c.bare.filter("L % 2 = 0").selectExpr("'complete' AS kind", "CAST(L % 90 AS STRING) AS cell").distinct(), c.bare.filter("L % 3 = 0").selectExpr("'complete' AS kind", "CAST(L % 90 AS STRING) AS cell").distinct()),
    "SELECT 'complete' AS kind, CAST(L % 90 AS STRING) AS cell FROM photos WHERE L % 2 = 0 OR L % 3 = 0 GROUP BY 2 HAVING bool_or(L % 2 = 0) <> bool_or(L % 3 = 0)", "photos",
)
R.add("m12_keep_selection", lambda c: M.keep_selection(c.small("members"), 10, _pick(c, 10, 2)), f"SELECT photo_id, group_id FROM members WHERE group_id = 10 AND NOT ({_PICK.format(g=10, e=2)})", "members")
R.add("m14_new_columns", lambda c: M.with_new_columns(c.small("members"), rejected=False), "SELECT photo_id, group_id, false AS rejected FROM members", "members")

QUERIES, ORACLES = R.queries, R.oracles
