"""The prefix trie of conversations, by burst tries.

A conversation is a sequence of turn ids, 128-bit digests of role and text; texts stay behind, their sizes go
along. Equal sequences are one. All sequences start as one container under the trie's root. A container with
too many turns bursts: what all its sequences share becomes the head, and the next turn id of each says in
which of the head's containers its suffix goes. A turn id that fills a container by itself makes that one
burst further down. The number of passes follows from the logarithm of the size and from where large groups
part, not from how much they share.

Containers that are small enough are sorted and swept: in the order of sequences, the nodes of the last
sequence that the next doesn't share are complete. What is held is one path. Nodes below the container's
head are final; for the head the sweep leaves a weighted sequence with the container's sums. These heads, one
for each container, make a trie of their own, which is built the same way, until one container, the root's,
is left. So the nodes that millions of sequences share are summed over tasks.

The conversations that end at a node are digested from a stream sorted by sequence and identifier: the
digest of one list is sequential by definition, and takes no memory.

Cases: turns are ordered by turn (null first), equal ones by the digest of role and text; null role or text is empty; rows without
conv_id belong to no conversation; a conversation may come out without turns and ends at the root; repeated
rows are turns of their own; a conversation's turns are one row of 24 bytes each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinfold.llm.shared import stored

#: Turns that a container may hold, containers that a head may have, and rows of a broadcast table.
CONTAINER_TURNS, SLOTS, BROADCAST_ROWS = 200_000, 64, 50_000
TURN = "struct<turn:binary,bytes:long>"


def turn_rows(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, place (from 1), turn, bytes: each conversation's turns in order."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("conv"), F.col(turn_col).alias("n"), F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).substr(1, 16).alias("turn"), F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv").orderBy(F.col("n").asc_nulls_first(), "turn")
    return rows.select("conv", F.row_number().over(order).alias("place"), "turn", "bytes")


def sequences(turns: DataFrame) -> DataFrame:
    """conv, turns: each conversation's turns as one array."""
    listed = F.array_sort(F.collect_list(F.struct("place", "turn", "bytes")))
    return turns.groupBy("conv").agg(F.transform(listed, lambda x: F.struct(x["turn"], x["bytes"])).alias("turns"))


def distinct_sequences(lists: DataFrame) -> DataFrame:
    """turns, n (conversations), low (the smallest) and ends (digest of all, in order) of each distinct sequence of lists (conv, turns)."""
    key = F.unhex(F.sha2(F.array_join(F.transform("turns", lambda x: F.hex(x["turn"])), ","), 256))
    keyed = stored(lists.select("conv", "turns", key.alias("sequence")), "sequences")
    schema = "sequence binary, ends string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for sequence, conv in zip(batch.column("sequence").to_pylist(), batch.column("conv").to_pylist()):
                if sequence == held:
                    state.update(b",%d" % conv)
                    continue
                if held is not None:
                    done.append((held, state.hexdigest()))
                held, state = sequence, hashlib.sha256(b"%d" % conv)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], names=["sequence", "ends"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["sequence", "ends"])

    ends = keyed.select("sequence", "conv").repartition("sequence").sortWithinPartitions("sequence", "conv").mapInArrow(digest, schema)
    counted = keyed.groupBy("sequence").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("low"))
    # One conversation of each sequence has its turns; long arrays don't take part in the counting.
    one = counted.join(ends, "sequence").join(keyed.select(F.col("conv").alias("low"), F.col("sequence").alias("__s"), "turns"), "low").filter("sequence = __s")
    return one.select("turns", "n", "low", "ends")


def burst(rows: DataFrame, limit: int = CONTAINER_TURNS, slots: int = SLOTS) -> DataFrame:
    """rows (turns, load and others) with box, its container, and depth, that of the container's head (-1: all of the trie).

    rows have distinct sequences.
    """
    rows = stored(rows.withColumn("box", F.lit("")).withColumn("depth", F.lit(-1)), "containers")
    turn = 0
    while True:
        load = F.size("turns") + 1
        big = stored(rows.groupBy("box").agg(F.sum(load).alias("load"), F.count(F.lit(1)).alias("n")).filter((F.col("load") > limit) & (F.col("n") > 1)).select("box"), "large-containers")
        few = big.limit(BROADCAST_ROWS + 1).count()
        if not few:
            return rows
        side = F.broadcast(big) if few <= BROADCAST_ROWS else big
        bounds = rows.join(side, "box", "left_semi").groupBy("box").agg(F.min("turns").alias("lo"), F.max("turns").alias("hi"))
        same = F.transform(F.arrays_zip("lo", "hi"), lambda x: F.coalesce(x["lo"]["turn"] == x["hi"]["turn"], F.lit(False)))
        shared = F.when(F.array_position(same, F.lit(False)) > 0, F.array_position(same, F.lit(False)) - 1).otherwise(F.size(same)).cast("int")
        heads = stored(bounds.select("box", shared.alias("head")), "heads")
        parted = rows.join(F.broadcast(heads) if few <= BROADCAST_ROWS else heads, "box", "left")
        following = F.get("turns", F.col("head"))["turn"]
        slot = F.pmod(F.xxhash64(following, F.lit(turn)), F.lit(slots)).cast("string")
        box = F.when(F.col("head").isNotNull(), F.concat("box", F.lit("/"), slot)).otherwise(F.col("box"))
        rows = stored(parted.withColumn("box", box).withColumn("depth", F.coalesce("head", "depth")).drop("head"), "containers")
        turn += 1


class Sweep:
    """Turns sorted weighted sequences of one container into nodes, and its head's sums."""

    def __init__(self, depth: int):
        self.depth = depth
        #: Of each open node: turn, bytes, key, [n, low, leaves, saved, children, ends].
        self.path: list[list] = [[b"", 0, b"", None]]
        self.path[0][3] = self.empty()
        self.done: list[tuple] = []

    @staticmethod
    def empty() -> list:
        return [0, None, 0, 0, 0, None]

    def close(self, upto: int) -> None:
        """Complete the nodes deeper than upto."""
        while len(self.path) > upto + 1:
            at = len(self.path) - 1
            _, size, key, (n, low, leaves, saved, children, ends) = self.path.pop()
            leaves, saved = leaves or 1, saved + (n - 1) * size
            above = self.path[-1]
            self.done.append((key, above[2], at, low, n, children, leaves, saved, ends))
            sums = above[3]
            sums[0] += n
            sums[1] = low if sums[1] is None else min(low, sums[1])
            sums[2] += leaves
            sums[3] += saved
            sums[4] += 1

    def add(self, turns: list[dict], n: int, low: int, leaves: int, saved: int, children: int, ends: str | None) -> None:
        shared, most = 0, min(len(turns), len(self.path) - 1)
        while shared < most and turns[shared]["turn"] == self.path[shared + 1][0]:
            shared += 1
        self.close(max(shared, self.depth))
        for x in turns[len(self.path) - 1 :]:
            self.path.append([x["turn"], x["bytes"], hashlib.sha256(self.path[-1][2] + x["turn"]).digest()[:16], self.empty()])
        sums = self.path[len(turns)][3]
        sums[0] += n
        sums[1] = low if sums[1] is None else min(low, sums[1])
        sums[2] += leaves
        sums[3] += saved
        sums[4] += children
        sums[5] = ends if ends is not None else sums[5]

    def end(self) -> tuple | None:
        """Close what is left. The head as a weighted sequence, None where the root itself is complete."""
        self.close(max(self.depth, 0))
        n, low, leaves, saved, children, ends = self.path[-1][3]
        if self.depth < 0:
            self.done.append((b"", None, 0, low, n, children, leaves or 1, saved, ends))
            return None
        return [{"turn": x[0], "bytes": x[1]} for x in self.path[1:]], n, low, leaves, saved, children, ends


NODE = "key binary, parent binary, depth long, low long, n long, children long, leaves long, saved long, ends string"
_TURNS = pa.list_(pa.struct([("turn", pa.binary()), ("bytes", pa.int64())]))
_SWEPT = pa.schema([("key", pa.binary()), ("parent", pa.binary()), *[(c, pa.int64()) for c in ("depth", "low", "n", "children", "leaves", "saved")], ("ends", pa.string()), ("turns", _TURNS)])


def swept(rows: DataFrame) -> DataFrame:
    """Nodes (turns is null), and heads of containers with their turns, of rows with box and depth."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, state = None, None
        out: list[dict] = []

        def take(end: bool) -> None:
            head = state.end() if end else None
            out.extend(dict(zip(_SWEPT.names, (*x, None))) for x in state.done)
            state.done.clear()
            if head:
                turns, n, low, leaves, saved, children, ends = head
                out.append({"n": n, "low": low, "leaves": leaves, "saved": saved, "children": children, "ends": ends, "turns": turns})

        for batch in batches:
            for row in batch.to_pylist():
                if row["box"] != box:
                    if state:
                        take(True)
                    box, state = row["box"], Sweep(row["depth"])
                state.add(*(row[c] for c in ("turns", "n", "low", "leaves", "saved", "children", "ends")))
                if len(state.done) > 5000:
                    take(False)
                if len(out) > 5000:
                    yield pa.RecordBatch.from_pylist(out, schema=_SWEPT)
                    out.clear()
        if state:
            take(True)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_SWEPT)

    schema = f"{NODE}, turns array<{TURN}>"
    fields = ["box", "depth", "turns", "n", "low", "leaves", "saved", "children", "ends"]
    return rows.select(*fields).repartition("box").sortWithinPartitions("box", "turns").mapInArrow(sweep, schema)


def trie_nodes(lists: DataFrame, limit: int = CONTAINER_TURNS, slots: int = SLOTS) -> DataFrame:
    """The trie of lists (conv, turns): a row (NODE) for each node.

    low is the smallest member; n counts members, children and leaves (childless nodes) the tree below; saved
    sums (n - 1) * bytes of the last turn over the subtree; ends is null where no conversation ends. The root's
    parent is null.
    """
    zero = F.lit(0).cast("long")
    left = distinct_sequences(lists).select("turns", "n", "low", zero.alias("leaves"), zero.alias("saved"), zero.alias("children"), "ends")
    nodes = None
    while True:
        found = stored(swept(burst(left, limit, slots)), "swept")
        final = found.filter("turns is null").drop("turns")
        nodes = final if nodes is None else nodes.unionByName(final)
        heads = found.filter("turns is not null")
        if heads.isEmpty():
            return nodes
        sums = [F.sum(c).alias(c) for c in ("n", "leaves", "saved", "children")]
        left = heads.groupBy("turns").agg(*sums, F.min("low").alias("low"), F.max("ends").alias("ends"))


def with_parents(nodes: DataFrame) -> DataFrame:
    """nodes plus parent_low: the parent's smallest member (the root's: null)."""
    fixed = stored(nodes, "trie-nodes")
    parents = fixed.select(F.col("key").alias("parent"), F.col("low").alias("parent_low"))
    return fixed.join(parents, "parent", "left")


def rebuilt(turns: DataFrame, head: Column, base: Column, most: int) -> DataFrame:
    """conv, turns of every conversation: the first head turns of conversation base (none if absent), then its own from there on.

    head and base are expressions of conv; head is at most most.
    """
    own = stored(sequences(turns), "conversations")
    heads = own.select(F.col("conv").alias("base"), F.slice("turns", 1, most).alias("first"))
    rows = own.withColumn("base", base).withColumn("head", head.cast("int")).join(heads, "base", "left")
    none = F.array().cast(f"array<{TURN}>")
    tail = F.when(F.size("turns") > F.col("head"), F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns") - F.col("head"), F.lit(0)))).otherwise(none)
    return rows.select("conv", F.concat(F.slice(F.coalesce("first", none), F.lit(1), F.col("head")), tail).alias("turns"))
