"""Near-duplicate groups by SetSketch registers, banding, a joint estimate and verification.

A document's set is its distinct word shingles, as 64-bit hashes. Register i of its sketch is the
exponentially spaced, truncated minimum of an exponential hash over the set: floor(1 - log_b min), as in
SetSketch, so sketches merge by maximum and equal registers are about as likely as the sets are similar.
Bands of registers are hashed into buckets; pairs out of one bucket are estimated by maximum likelihood
from how many registers are larger, smaller and equal, given the set sizes; what may reach the threshold is
verified on the full sets, with integers.

Documents with equal sets, by a digest of 128 bits, are one class and meet the buckets once; a class goes by a
64-bit key, and classes that share one are given others. Only the connected components are
wanted, so a bucket never emits all its pairs. The member of a bucket that meets most others in all its
buckets is its hub; the buckets of one hub are its star. First each member is compared with its hubs
alone, and components are formed. Two members of one bucket that are still apart are members of one star of
which at least one, a stray, is outside the hub's component: so the strays of each star are then compared
with all its members, as a query set against rows, in blocks of bounded bytes; first by estimate, then on
full sets. Nothing is capped or dropped: the losses are those of banding (at similarity 0.8 a pair shares no
band with probability 3e-6), of the estimate's margin of five standard errors and, among strays, of a first
look at the share of equal registers, which is about the similarity and may lie a further EQUAL_MARGIN (two and
a half standard errors) below.

Full sets travel only for documents in candidate pairs, once per hub and once per block: a star of k members
with s strays sends k sets once for each part of its strays and s sets once for each part of its members. A hub
with many members is dealt out over several groups with a copy of its own set in each. A filter of the
documents wanted, of bounded size, keeps the texts of all others out of the shuffle.

Cases: null text is empty; a text without words has no set and is linked with nothing; one with fewer
words than a shingle is one shingle; documents of any length are taken whole; repeated rows are equal
classes; null identifiers never name a component unless all are null; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.exact_dedup import digest_filter, may_hold
from twinfold.llm.shared import free_name, let_go, stored
from twinfold.operators.components import connected_components, relabel

BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
BASE, RATE = 1.02, 20.0
#: Members that meet one copy of their hub's set, and how many hubs (or buckets), those with most rows, are broadcast with their figures.
STAR, HEAVY = 200, 1000
#: Bytes of sets, and the most classes, on either side of a block.
BLOCK_BYTES, BLOCK_ROWS = 4_000_000, 1024
#: How far the share of equal registers of two strays may lie below the floor of the estimate.
EQUAL_MARGIN = 0.1
_P = np.uint64(0x9E3779B97F4A7C15)
_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


_SEEDS = mixed(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * _P)
_XOR, _MUL = _SEEDS[:REGISTERS, None], _SEEDS[REGISTERS:, None] | np.uint64(1)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; A-Z are lower-cased first."""
    import xxhash

    words = (text or "").encode().lower().split()  # on bytes: ASCII case and white space only
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(width, len(words))
    rolled = hashes[: len(words) - n + 1].copy()
    for k in range(1, n):
        rolled = rolled * _P + hashes[k : len(words) - n + 1 + k]
    return np.unique(mixed(rolled + np.uint64(n)))


def registers(items: np.ndarray) -> np.ndarray:
    """The SetSketch of a set that isn't empty."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    for at in range(0, len(items), 4096):
        values = (items[None, at : at + 4096] ^ _XOR) * _MUL
        np.minimum(least, values.min(axis=1), out=least)
    uniform = (least.astype(np.float64) + 1.0) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)) + 1024, 0, 65535).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One bucket number per band."""
    parts = regs.astype(np.uint64).reshape(BANDS, ROWS)
    key = mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * _P)
    for k in range(ROWS):
        key = mixed(key + parts[:, k] * _P)
    return key.view(np.int64)


def class_digest(items: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit digests of a set: the key that its class goes by, and the check."""
    data = hashlib.blake2b(items.tobytes(), digest_size=16).digest()
    return int.from_bytes(data[:8], "little", signed=True), int.from_bytes(data[8:], "little", signed=True)


def joint_estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, steps: int = 30) -> np.ndarray:
    """Maximum-likelihood similarity of pairs from their registers (rows of a and b) and set sizes.

    The likelihood is concave in the similarity, so its derivative is bisected between 0 and the most
    that the sizes allow.
    """
    more, less = (a > b).sum(axis=1).astype(float), (a < b).sum(axis=1).astype(float)
    equal = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    c = (BASE - 1) / BASE
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * c) / np.log(BASE)
    dp = lambda x: c / (1 - np.clip(x, 0, 1) * c) / np.log(BASE)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(steps):
        j = (low + high) / 2
        x, y = u - v * j, v - u * j
        px, py = np.maximum(p(x), 1e-12), np.maximum(p(y), 1e-12)
        slope = -more * v * dp(x) / px - less * u * dp(y) / py + equal * (v * dp(x) + u * dp(y)) / np.maximum(1 - px - py, 1e-12)
        low, high = np.where(slope > 0, j, low), np.where(slope > 0, high, j)
    return (low + high) / 2


def check_column(width: int) -> Callable[[Column], Column]:
    """A function of a column of texts: the check of each one's set, null for an empty set."""
    from pyspark.sql.functions import pandas_udf

    def checks(texts: pd.Series) -> pd.Series:
        sets = [shingle_set(t, width) for t in texts]
        return pd.Series([class_digest(x)[1] if len(x) else None for x in sets], dtype="Int64")

    return pandas_udf(checks, "long")


def sketch_documents(docs: DataFrame, id_col: str, text_col: str, width: int, key_bits: int) -> DataFrame:
    """id, n (set size), class_key, check, bands, regs; all but the first two are null for empty sets."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n long, class_key long, check long, bands array<long>, regs binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            sizes, keys, checks, bands, regs = [], [], [], [], []
            for x in batch.column("text"):
                items = shingle_set(x.as_py(), width)
                sizes.append(len(items))
                if len(items):
                    r = registers(items)
                    key, check = class_digest(items)
                    keys.append(key if key_bits == 64 else key & (1 << key_bits) - 1)
                    checks.append(check)
                    bands.append(band_keys(r))
                    regs.append(r.tobytes())
                else:
                    keys.append(None)
                    checks.append(None)
                    bands.append(None)
                    regs.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(checks, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(regs, pa.binary())], names=["id", "n", "class_key", "check", "bands", "regs"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def keyed_apart(sketches: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with class keys that no two classes share."""
    turn = 0
    while not classes.groupBy("class_key").count().filter("count > 1").isEmpty():
        turn += 1
        other = F.when(F.col("class_key").isNotNull(), F.xxhash64("class_key", "check", F.lit(turn)))
        sketches, classes = sketches.withColumn("class_key", other), stored(classes.withColumn("class_key", other), "classes")
    return sketches, classes


def wanted_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """text and the columns of wanted (rep, ...) for the rows of docs that have its identifiers."""
    asked = stored(wanted, "wanted")
    passed = may_hold(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), stored(digest_filter(asked.select(F.col("rep").alias("digest"))), "wanted-filter"), "id").filter("may_hold")
    return passed.join(asked, F.col("id").eqNullSafe(F.col("rep"))).drop("id", "may_hold")


def with_hub(rows: DataFrame, per_hub: DataFrame, hub: str, weight: str, how: str = "inner") -> DataFrame:
    """rows with the columns of per_hub (one row per hub; weight: how many of rows have it).

    The HEAVY hubs of most rows are broadcast, so their rows stay where they are; of any other hub there are
    at most 1 / HEAVY of all rows, which meet in one task.
    """
    figures = stored(per_hub, "per-hub")
    heavy = F.broadcast(figures.orderBy(F.desc(weight), hub).limit(HEAVY))
    rest = rows.join(heavy.select(hub), hub, "left_anti").join(figures, hub, how)
    return rows.join(heavy, hub).unionByName(rest)


def likely(pairs: DataFrame, classes: DataFrame, floor: float, percent: int) -> DataFrame:
    """The pairs (a: member, b: hub) whose sizes allow the similarity and whose joint estimate reaches floor.

    A hub with many members is met by them in several parts.
    """
    side = lambda s: classes.select(F.col("class_key").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))
    large = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("members")).select("b", "members", F.ceil(F.col("members") / STAR).cast("int").alias("parts")).filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    dealt = with_hub(pairs, large, "b", "members", "left").withColumn("part", F.pmod(F.xxhash64("a"), parts).cast("int")).drop("parts")
    hubs = pairs.select("b").distinct().join(side("b"), "b").join(large, "b", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    full = dealt.join(hubs, ["b", "part"]).join(side("a"), "a").select("a", "b", "n_a", "n_b", "regs_a", "regs_b")
    full = full.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            if batch.num_rows:
                regs = [np.frombuffer(b"".join(batch.column(f"regs_{s}").to_pylist()), np.uint16).reshape(-1, REGISTERS) for s in "ab"]
                estimate = joint_estimate(*regs, *(batch.column(f"n_{s}").to_numpy().astype(float) for s in "ab"))
                yield batch.select(["a", "b"]).filter(pa.array(estimate >= floor))

    return full.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """The pairs (a: member, b: hub) whose full sets are similar enough, as edges (src, dst).

    Each class in a pair sends its set to the groups (hub, part) that it takes part in; a group streams
    through one task, the hub's set first.
    """
    counts = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("members"))
    parts = counts.withColumn("parts", F.ceil(F.col("members") / STAR).cast("int"))
    to_hub = with_hub(pairs, parts, "b", "members").select(F.col("a").alias("class_key"), F.col("b").alias("hub"), F.pmod(F.xxhash64("a"), "parts").cast("int").alias("part"))
    own = parts.select(F.col("b").alias("class_key"), F.col("b").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = to_hub.unionByName(own).groupBy("class_key").agg(F.collect_list(F.struct("hub", "part")).alias("groups"))
    wanted = wanted.join(classes.select("class_key", "check", "rep"), "class_key").select("rep", "class_key", "check", "groups")
    texts = wanted_texts(docs, wanted, id_col, text_col).select("text", "class_key", "check", "groups")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        schema = pa.schema([("hub", pa.int64()), ("part", pa.int32()), ("member", pa.bool_()), ("class_key", pa.int64()), ("items", pa.binary())])
        for batch in batches:
            rows, room = [], 0
            for text, key, check, groups in zip(batch.column("text"), batch.column("class_key").to_pylist(), batch.column("check").to_pylist(), batch.column("groups").to_pylist()):
                items = shingle_set(text.as_py(), width)
                if not len(items) or class_digest(items)[1] != check:
                    continue  # another row with the same identifier
                data = items.tobytes()
                for g in groups:
                    rows.append({"hub": g["hub"], "part": g["part"], "member": g["hub"] != key, "class_key": key, "items": data})
                    room += len(data)
                    if room > 16_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, room = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hub, items = None, np.empty(0, np.uint64)
        for batch in batches:
            src, dst = [], []
            for at, member, key, data in zip(batch.column("hub").to_pylist(), batch.column("member").to_pylist(), batch.column("class_key").to_pylist(), batch.column("items")):
                if not member:
                    hub, items = at, np.frombuffer(data.as_py(), np.uint64)
                elif at == hub:
                    mine = np.frombuffer(data.as_py(), np.uint64)
                    shared = len(np.intersect1d(items, mine, assume_unique=True))
                    if 100 * shared >= percent * (len(items) + len(mine) - shared):
                        src.append(key)
                        dst.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    sent = texts.mapInArrow(send, "hub long, part int, member boolean, class_key long, items binary")
    return sent.repartition("hub", "part").sortWithinPartitions("hub", "part", "member").mapInArrow(compare, "src long, dst long")


def star_table(buckets: DataFrame) -> DataFrame:
    """hub, class_key: who shares a bucket with which hub (bucket, class_key); hubs are members of their stars."""
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    degrees = with_hub(buckets, sizes, "bucket", "size").groupBy("class_key").agg(F.sum("size").alias("degree"))
    ranked = stored(buckets.join(degrees, "class_key").select("bucket", "class_key", "degree"), "ranked")
    hubs = ranked.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("degree", F.col("class_key").alias("hub"))).alias("x")).select("bucket", "size", "x.hub")
    return with_hub(ranked, hubs, "bucket", "size").select("hub", "class_key").distinct()


def verified_strays(star: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int, percent: int, floor: float) -> DataFrame:
    """Edges (src, dst) between the strays of each star and its members, in blocks.

    star: hub, class_key, component, stray. Each block (hub, i, j) holds the j-th part of the strays and the
    i-th part of the members.
    """
    size = classes.select(F.col("class_key").alias("hub"), F.col("n").alias("hub_n"))
    room = F.greatest(F.lit(8), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("hub_n")))))
    counts = star.groupBy("hub").agg(F.count(F.lit(1)).alias("k"), F.count_if("stray").alias("s")).filter("s > 0").join(size, "hub")
    blocks = counts.select("hub", "k", F.ceil(F.col("k") / room).cast("int").alias("rows"), F.ceil(F.col("s") / room).cast("int").alias("queries"))
    dealt = with_hub(star, blocks, "hub", "k").withColumn("h", F.xxhash64("class_key"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda n: F.array(F.pmod("h", n).cast("int"))
    as_row = dealt.select("class_key", "hub", "component", "stray", F.lit(1).alias("role"), own("rows").alias("i"), upto("queries").alias("j"))
    as_query = dealt.filter("stray").select("class_key", "hub", "component", "stray", F.lit(0).alias("role"), upto("rows").alias("i"), own("queries").alias("j"))
    wanted = as_row.unionByName(as_query).groupBy("class_key").agg(F.collect_list(F.struct("hub", "component", "stray", "role", "i", "j")).alias("groups"))
    wanted = wanted.join(classes.select("class_key", "check", "rep", "regs"), "class_key")
    texts = wanted_texts(docs, wanted, id_col, text_col).select("text", "class_key", "check", "regs", "groups")
    schema = pa.schema([("hub", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("role", pa.int32()), ("class_key", pa.int64()), ("component", pa.int64()), ("stray", pa.bool_()), ("regs", pa.binary()), ("items", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            rows, bytes_held = [], 0
            for text, key, check, regs, groups in zip(*(batch.column(c) for c in ("text", "class_key", "check", "regs", "groups"))):
                items = shingle_set(text.as_py(), width)
                if not len(items) or class_digest(items)[1] != check.as_py():
                    continue  # another row with the same identifier
                data = items.tobytes()
                for g in groups.as_py():
                    for i in g["i"]:
                        for j in g["j"]:
                            rows.append({"hub": g["hub"], "i": i, "j": j, "role": g["role"], "class_key": key.as_py(), "component": g["component"], "stray": g["stray"], "regs": regs.as_py(), "items": data})
                            bytes_held += len(data)
                            if bytes_held > 16_000_000:
                                yield pa.RecordBatch.from_pylist(rows, schema)
                                rows, bytes_held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        block, queries, matrix = None, [], None
        for batch in batches:
            src, dst = [], []
            for row in batch.to_pylist():
                if (row["hub"], row["i"], row["j"]) != block:
                    block, queries, matrix = (row["hub"], row["i"], row["j"]), [], None
                items, regs = np.frombuffer(row["items"], np.uint64), np.frombuffer(row["regs"], np.uint16)
                if row["role"] == 0:
                    queries.append((row["class_key"], row["component"], items, regs))
                    continue
                if not queries:
                    continue
                if matrix is None:
                    matrix = (np.stack([q[3] for q in queries]), np.array([len(q[2]) for q in queries], float), np.array([q[0] for q in queries]), np.array([q[1] for q in queries]))
                n = len(items)
                ok = (matrix[3] != row["component"]) & (100 * np.minimum(matrix[1], n) >= percent * np.maximum(matrix[1], n))
                if row["stray"]:
                    ok &= matrix[2] < row["class_key"]  # two strays meet once
                at = np.flatnonzero(ok)
                at = at[(matrix[0][at] == regs).mean(axis=1) >= floor - EQUAL_MARGIN] if len(at) else at
                if len(at):
                    near = joint_estimate(matrix[0][at], np.broadcast_to(regs, (len(at), REGISTERS)), matrix[1][at], np.full(len(at), float(n))) >= floor
                    for k in at[near]:
                        shared = len(np.intersect1d(queries[k][2], items, assume_unique=True))
                        if 100 * shared >= percent * (len(queries[k][2]) + n - shared):
                            src.append(queries[k][0])
                            dst.append(row["class_key"])
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    sent = texts.mapInArrow(send, "hub long, i int, j int, role int, class_key long, component long, stray boolean, regs binary, items binary")
    return sent.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j", "role").mapInArrow(compare, "src long, dst long")


def class_components(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, key_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(sketches, classes): a row per row of docs (id, n, class_key), and one per class (class_key, check, rep, component, component_id)."""
    sketches = stored(sketch_documents(docs, id_col, text_col, width, key_bits), "sketches")
    classes = stored(sketches.filter("n > 0").groupBy("class_key", "check").agg(F.min("id").alias("rep"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"), F.any_value("regs").alias("regs")), "classes")
    sketches, classes = keyed_apart(sketches, classes)
    spread = classes.select("class_key", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").count().filter("count > 1").select("bucket")
    star = stored(star_table(stored(spread.join(shared, "bucket"), "buckets")), "stars")
    similarity = percent / 100
    floor = max(0.0, similarity - 5 * (similarity * (1 - similarity) / REGISTERS) ** 0.5)
    to_hub = star.filter("hub <> class_key").select(F.col("class_key").alias("a"), F.col("hub").alias("b"))
    near_hub = stored(likely(to_hub, classes, floor, percent), "likely-pairs")
    edges = stored(verified(near_hub, docs, classes, id_col, text_col, width, percent), "links")
    labels = connected_components(edges)
    placed = relabel(relabel(star.withColumn("component", F.col("class_key")).withColumn("main", F.col("hub")), "component", labels), "main", labels)
    strays = stored(placed.select("hub", "class_key", "component", (F.col("component") != F.col("main")).alias("stray")), "placed")
    more = stored(verified_strays(strays, docs, classes, id_col, text_col, width, percent, floor), "stray-links")
    if not more.isEmpty():
        labels = connected_components(edges.unionByName(more))
    named = relabel(classes.select("class_key", "check", "rep").withColumn("component", F.col("class_key")), "component", labels)
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    return sketches.select("id", "n", "class_key"), named.join(smallest, "component")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, key_bits: int = 64) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (the smallest identifier reachable), kept.

    Two documents are linked when 100 x shared shingles >= percent x shingles of either. key_bits is the width of
    the classes' keys, fewer for tests.
    """
    sketches, classes = class_components(docs, id_col, text_col, width, percent, key_bits)
    return _marked(sketches, classes)


def _marked(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    out = sketches.select("id", F.col("n").alias("n_shingles"), "class_key").join(classes.select("class_key", "component_id"), "class_key", "left")
    component = F.when(F.col("class_key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each near-duplicate group; its columns are unchanged.

    Rows without words are groups of their own. Where rows share an identifier, the sets of their texts tell them
    apart: of a group's rows with its smallest identifier one stays, whatever its other columns.
    """
    sketches, classes = class_components(docs, id_col, text_col, width, percent)
    classes = stored(classes, "class-components")
    again = stored(sketches.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"), "repeated-ids")
    mark, kept = free_name(docs, "kept_id"), _marked(sketches, classes).filter("kept").select("id")
    same = lambda ids: docs[id_col].eqNullSafe(ids[mark])
    few = again.isEmpty()
    kept = (kept if few else kept.join(again.select(F.col("id").alias("__id")), F.col("id").eqNullSafe(F.col("__id")), "left_anti")).select(F.col("id").alias(mark)).distinct()
    sure = docs.join(kept, same(kept), "left_semi")
    if few:
        return sure
    # The class of each group that has its smallest identifier.
    first = classes.groupBy("component").agg(F.min_by(F.struct("check", "rep"), F.struct(F.col("rep").isNull(), "rep", "check")).alias("x"))
    first = first.select(F.col("component").alias("__component"), F.col("x.check").alias("__check"), F.col("x.rep").alias("__rep"))
    ids = again.select(F.col("id").alias(mark))
    rows = docs.join(ids, same(ids), "left_semi")
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("__id"), check_column(width)(F.col(text_col)).alias("__own"))
    bare = rows.filter("__own is null").select("row.*")
    met = rows.join(first, (F.col("__own") == F.col("__check")) & F.col("__id").eqNullSafe(F.col("__rep")))
    one = met.groupBy("__component").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return sure.unionAll(bare).unionAll(one.select("row.*"))
