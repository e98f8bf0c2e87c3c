"""Curation as functions from tables to tables: split, merge, reject, undo, marks. Nothing is changed in place.

Membership tables are (photo_id, group_id); the action log is (action_id, action_type, source_group_id,
photo_ids, new_group_id). Selections of photos are tables with a column photo_id, of any size, or lists of ids;
they are joined, and never pass through the driver. The log lists an action's photos in one row, as published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Selection = DataFrame | list[str]

LOG = "action_id long, action_type string, source_group_id long, photo_ids array<string>, new_group_id long"


def next_group_id(groups: DataFrame) -> int:
    return groups.agg((F.coalesce(F.max("group_id"), F.lit(0)) + 1).cast("long").alias("n")).first()["n"]


def selection(table: DataFrame, picked: Selection) -> DataFrame:
    """photo_id, once each."""
    if not isinstance(picked, DataFrame):
        picked = table.sparkSession.createDataFrame([(p,) for p in picked], "photo_id string")
    return picked.select("photo_id").distinct()


def flagged(groups: DataFrame, picked: Selection) -> DataFrame:
    """groups plus chosen: whether the selection holds the photo."""
    marks = selection(groups, picked).withColumn("chosen", F.lit(True))
    return groups.join(marks, "photo_id", "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))


def logged(log: DataFrame, action: str, source: int, picked: Selection, new: int | None = None) -> DataFrame:
    """The log with one action more. A list keeps its order, a table is listed by id."""
    turn = log.agg((F.coalesce(F.max("action_id"), F.lit(0)) + 1).alias("action_id"))
    if isinstance(picked, DataFrame):
        row = turn.withColumn("__one", F.lit(1)).join(picked.agg(F.array_sort(F.collect_set("photo_id")).alias("photo_ids")).withColumn("__one", F.lit(1)), "__one")
    else:
        row = turn.withColumn("photo_ids", F.array(*map(F.lit, picked)).cast("array<string>"))
    return log.unionByName(row.select("action_id", F.lit(action).alias("action_type"), F.lit(source).cast("long").alias("source_group_id"), "photo_ids", F.lit(new).cast("long").alias("new_group_id")))


def split(groups: DataFrame, log: DataFrame, group_id: int, picked: Selection) -> tuple[DataFrame, DataFrame]:
    """The photos chosen move from their group to a new one."""
    new = next_group_id(groups)
    moved = F.col("chosen") & (F.col("group_id") == group_id)
    return flagged(groups, picked).select("photo_id", F.when(moved, F.lit(new)).otherwise(F.col("group_id")).alias("group_id")), logged(log, "split", group_id, picked, new)


def split_composite(groups: DataFrame, group_id: int, picked: Selection) -> DataFrame:
    """Move photos out of a composite group: one alone loses its membership, and so does a remainder of one.

    Taking all members of the group is an error.
    """
    marked = flagged(groups, picked)
    here = F.col("group_id") == group_id
    size = marked.filter(here).agg(F.count(F.lit(1)).alias("n"), F.count_if("chosen").alias("out")).first()
    if size["out"] >= size["n"]:
        raise ValueError("a split must leave part of the group")
    new = next_group_id(groups)
    left = marked.filter(~here | F.col("chosen")) if size["n"] - size["out"] == 1 else marked
    if size["out"] == 1:
        return left.filter(~(here & F.col("chosen"))).select("photo_id", "group_id")
    return left.select("photo_id", F.when(here & F.col("chosen"), F.lit(new)).otherwise(F.col("group_id")).alias("group_id"))


def merge_entities(groups: DataFrame, group_ids: list[int], photo_ids: list[str]) -> tuple[DataFrame, int]:
    """Groups and single photos become one: the largest group (the first of several), or a new one."""
    sizes = {r["group_id"]: r["n"] for r in groups.filter(F.col("group_id").isin(group_ids)).groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).collect()} if group_ids else {}
    target = max(group_ids, key=lambda g: (sizes.get(g, 0), -group_ids.index(g))) if sizes else next_group_id(groups)
    moved = groups.withColumn("group_id", F.when(F.col("group_id").isin(group_ids), F.lit(target)).otherwise(F.col("group_id"))) if group_ids else groups
    if photo_ids:
        singles = groups.sparkSession.createDataFrame([(p, target) for p in photo_ids], groups.schema)
        moved = moved.join(singles.select("photo_id"), "photo_id", "left_anti").unionByName(singles)
    return moved, target


def merge_pairwise(groups: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
    """Merge pairs of groups in order; the larger keeps its number, the first on a tie; later pairs follow."""
    wanted = sorted({g for p in pairs for g in p})
    sizes = {r["group_id"]: r["n"] for r in groups.filter(F.col("group_id").isin(wanted)).groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    forward: dict[int, int] = {}

    def current(g: int) -> int:
        while g in forward:
            g = forward[g]
        return g

    for one, two in pairs:
        a, b = current(one), current(two)
        if a != b:
            keep, gone = (a, b) if sizes.get(a, 0) >= sizes.get(b, 0) else (b, a)
            forward[gone] = keep
            sizes[keep] = sizes.get(keep, 0) + sizes.pop(gone, 0)
    moves = [(g, current(g)) for g in forward]
    if not moves:
        return groups
    table = F.create_map(*[F.lit(x).cast(groups.schema["group_id"].dataType) for m in moves for x in m])
    return groups.withColumn("group_id", F.coalesce(F.try_element_at(table, F.col("group_id")), F.col("group_id")))


def reject(rejections: DataFrame, log: DataFrame, group_id: int, picked: Selection) -> tuple[DataFrame, DataFrame]:
    """Rejections (photo_id, group_id, rule_name) with the photos added; those that are there stay as they are.

    The published form leaves out the group and so stores nothing; this one stores it.
    """
    fresh = selection(rejections, picked).select("photo_id", F.lit(group_id).cast(rejections.schema["group_id"].dataType).alias("group_id"), F.lit("MANUAL").alias("rule_name"))
    return rejections.unionByName(fresh.join(rejections, "photo_id", "left_anti")), logged(log, "reject", group_id, picked)


def undo(groups: DataFrame, rejections: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Take the last action back: split photos return, rejected ones are accepted again."""
    last = log.orderBy(F.desc("action_id")).select("action_id", "action_type", "source_group_id", "new_group_id").first()
    if last is None:
        return groups, rejections, log
    mine = F.col("action_id") == last["action_id"]
    picked, rest = log.filter(mine).select(F.explode("photo_ids").alias("photo_id")), log.filter(~mine)
    if last["action_type"] == "split":
        back = F.col("chosen") & (F.col("group_id") == last["new_group_id"])
        return flagged(groups, picked).select("photo_id", F.when(back, F.lit(last["source_group_id"])).otherwise(F.col("group_id")).alias("group_id")), rejections, rest
    return groups, flagged(rejections, picked).filter(~(F.col("chosen") & (F.col("rule_name") == "MANUAL"))).drop("chosen"), rest


def membership_history(groups: DataFrame, log: DataFrame) -> DataFrame:
    """photo_id, group_id, from_action, to_action: where each photo of groups was, from one action on up to another (null: still).

    Taken from the present state and the log: going back over a photo's splits, the last first, one that led to where
    it is brought it from its source. A photo that a split lists, but that wasn't in its source, didn't move.
    """
    events = log.filter("action_type = 'split'").select(F.explode("photo_ids").alias("photo_id"), F.struct("action_id", "source_group_id", "new_group_id").alias("e")).distinct()
    listed = events.groupBy("photo_id").agg(F.sort_array(F.collect_list("e"), asc=False).alias("events"))
    kind = groups.schema["group_id"].dataType
    start = F.struct(F.col("group_id").alias("at"), F.lit(None).cast("long").alias("until"), F.array().cast(f"array<struct<group_id:{kind.simpleString()},from_action:bigint,to_action:bigint>>").alias("found"))

    def back(state, e):
        moved = state["at"] == e["new_group_id"]
        piece = F.struct(state["at"].alias("group_id"), e["action_id"].alias("from_action"), state["until"].alias("to_action"))
        return F.struct(F.when(moved, e["source_group_id"]).otherwise(state["at"]).cast(kind).alias("at"), F.when(moved, e["action_id"]).otherwise(state["until"]).alias("until"), F.when(moved, F.array_append(state["found"], piece)).otherwise(state["found"]).alias("found"))

    none = F.array().cast("array<struct<action_id:bigint,source_group_id:bigint,new_group_id:bigint>>")
    whole = groups.join(listed, "photo_id", "left").withColumn("h", F.aggregate(F.coalesce("events", none), start, back))
    first = F.struct(F.col("h.at").alias("group_id"), F.lit(0).cast("long").alias("from_action"), F.col("h.until").alias("to_action"))
    return whole.select("photo_id", F.explode(F.array_append("h.found", first)).alias("x")).select("photo_id", "x.*")


def rejection_history(rejections: DataFrame, log: DataFrame) -> DataFrame:
    """rejections plus from_action: the action that first listed a photo rejected by hand; 0 for those that no action did."""
    listed = log.filter("action_type = 'reject'").select(F.explode("photo_ids").alias("photo_id"), "action_id").groupBy("photo_id").agg(F.min("action_id").alias("from_action"))
    found = rejections.join(listed, "photo_id", "left")
    return found.withColumn("from_action", F.coalesce(F.when(F.col("rule_name") == "MANUAL", F.col("from_action")), F.lit(0).cast("long"))).withColumn("to_action", F.lit(None).cast("long"))


def as_of(history: DataFrame, action_id: int) -> DataFrame:
    """What held after an action (0: before the first)."""
    return history.filter((F.col("from_action") <= action_id) & (F.col("to_action").isNull() | (F.col("to_action") > action_id))).drop("from_action", "to_action")


def upsert(table: DataFrame, rows: DataFrame, *key: str) -> DataFrame:
    """table with rows put in place of those with the same key."""
    return table.join(rows.select(*key), list(key), "left_anti").unionByName(rows)


def insert_new(table: DataFrame, rows: DataFrame, *key: str) -> DataFrame:
    """table with those rows whose key it lacks; of rows with one key, the first in the order of all columns."""
    order = Window.partitionBy(*key).orderBy(*[c for c in rows.columns if c not in key] or key)
    first = rows.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")
    return table.unionByName(first.join(table.select(*key), list(key), "left_anti"))


def delete_junk(junk: DataFrame, groups: DataFrame, rejections: DataFrame, picked: DataFrame) -> DataFrame:
    """junk (photo_id, group_id) with picked entities added: whole groups without rejected members, or single photos."""
    whole = groups.join(picked.filter("group_id is not null").select("group_id"), "group_id", "left_semi").join(rejections.select("photo_id"), "photo_id", "left_anti").select("photo_id", "group_id")
    single = picked.filter("group_id is null").select("photo_id", "group_id")
    return insert_new(junk, whole.unionByName(single), "photo_id")


def discard_pairs(groups: DataFrame, first_group: int = 0) -> DataFrame:
    """Without the groups of exactly two members numbered from first_group."""
    pairs = groups.filter(F.col("group_id") >= first_group).groupBy("group_id").agg(F.count(F.lit(1)).alias("n")).filter("n = 2")
    return groups.join(pairs, "group_id", "left_anti").select("photo_id", "group_id")


def toggle(cells: DataFrame, picked: DataFrame) -> DataFrame:
    """Symmetric difference of two tables of (kind, cell)."""
    return cells.join(picked, ["kind", "cell"], "left_anti").unionByName(picked.join(cells, ["kind", "cell"], "left_anti"))


def keep_selection(groups: DataFrame, group_id: int, keep: Selection) -> DataFrame:
    """photo_id, group_id of the members of a group that aren't in keep; foreign ids are an error."""
    members = groups.filter(F.col("group_id") == group_id)
    foreign = [r["photo_id"] for r in selection(groups, keep).join(members, "photo_id", "left_anti").take(3)]
    if foreign:
        raise ValueError(f"not in the group: {foreign}")
    return members.join(selection(groups, keep), "photo_id", "left_anti").select("photo_id", "group_id")


def with_new_columns(table: DataFrame, **defaults: object) -> DataFrame:
    """Schema migration: columns that are missing, with their defaults."""
    return table.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in table.columns})
