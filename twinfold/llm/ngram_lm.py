"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, scored by
workers that map the arrays into memory.

Counting is one Spark job. Each task counts the bigrams of its texts and sends packed counts to the shard
of the bigram's hash, so that no word's bigrams lie all in one. A shard merges them, sorts its bigrams by
hash and writes hashes and counts. For the words of its bigrams it sends on how often each occurs, after
how many distinct words, and how many bigrams that it begins occur once, twice and more often, to the shard of
the word, which sums and writes these. What comes to the driver are eleven totals. Counts are 32 bits wide where
all of an array fit, else 64.

Scoring is a map: a task maps shards and looks up the sorted hashes of a few thousand texts at a
time. A shard's arrays lie in one file, and a worker has a bounded number of them open. They lie in the folder
that driver and executors share, which must be mounted as a file system
for that; they are written under another name and renamed, so a repeated task does no harm.

The order is two: on text with as many new words as the check's, distinct trigrams are three quarters of
all, and their counts and arrays alone would take more disk than the inputs several times over.

Words, first words of bigrams and bigrams are 64-bit hashes: counts of a first word and its total have one key.

Cases: null text is empty and has one token, its end; a null identifier counts as the empty text's and
trains; no training text gives every token probability 1 / (V + 1) with V = 0; long texts are whole;
repeated rows count and are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.llm.near_dedup import mixed
from twinfold.llm.shared import new_path

_P = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text whose bigrams one shard holds, so that a shard fits in one task whatever the input.
SHARD_BYTES = 64_000_000
#: Tokens that a task counts before it combines, and that it scores at a time.
COUNT_AT, SCORE_AT = 4_000_000, 1_000_000


def word_hashes(text: str | None) -> list[int]:
    """Hashes of the words, A-Z in lower case, and of the end."""
    import xxhash

    words = (text or "").encode().lower().split()  # on bytes: ASCII case and white space only
    words.append(b" end")
    return list(map(xxhash.xxh3_64_intdigest, words))


def start_hash() -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b" start")


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous words, words, ends of texts) of all texts, one after the other."""
    lists = [word_hashes(x.as_py()) for x in texts]
    ends = np.cumsum([len(x) for x in lists])
    words = np.fromiter((h for x in lists for h in x), np.uint64, int(ends[-1]) if lists else 0)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    if lists:
        before[np.concatenate([[0], ends[:-1]])] = start_hash()
    return before, words, ends


def bigram_hash(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(first * _P + word)


def summed(keys: np.ndarray, *columns: np.ndarray, apart: bool = True) -> tuple[np.ndarray, ...]:
    """Rows with equal keys in one: sorted keys, first of each other column, then sum of the last."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    kept = [c[order][first] for c in columns[:-1]] if apart else [np.add.reduceat(c[order], first) if len(keys) else c for c in columns[:-1]]
    total = np.add.reduceat(columns[-1][order], first) if len(keys) else columns[-1]
    return keys[first], *kept, total


def mounted(path: str) -> str:
    """The path of a shared folder as the operating system knows it."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"workers map the model into memory: {path} must be mounted, with spark.checkpoint.dir naming the mount")
    return path


def narrow(array: np.ndarray) -> np.ndarray:
    """Counts in 32 bits where all fit."""
    return array.astype(np.uint32) if not len(array) or array.max() < 2**32 else array.astype(np.int64)


def save(folder: str, name: str, *arrays: np.ndarray) -> None:
    """One file: the number of arrays, then the bytes of an item and the items of each, then the arrays, which start at multiples of 8."""
    part = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as file:
        file.write(np.array([len(arrays), *(x for a in arrays for x in (a.itemsize, len(a)))], np.int64).tobytes())
        for a in arrays:
            file.write(a.tobytes() + bytes(-a.nbytes % 8))
    os.replace(part, f"{folder}/{name}.bin")


def mapped(path: str) -> list[np.ndarray] | None:
    """The arrays of a file, mapped; hashes (the first) unsigned, counts by their width. None where there is no file."""
    if not os.path.exists(path):
        return None
    whole = np.memmap(path, np.uint8, "r")
    n = int(whole[:8].view(np.int64)[0])
    heads = whole[8 : 8 + 16 * n].view(np.int64).reshape(n, 2).tolist()
    at, out = 8 + 16 * n, []
    for k, (width, count) in enumerate(heads):
        out.append(whole[at : at + width * count].view(np.uint64 if k == 0 else {4: np.uint32, 8: np.int64}[width]))
        at += width * count + -width * count % 8
    return out


def packed(*arrays: np.ndarray) -> bytes:
    return len(arrays[0]).to_bytes(8, "little") + b"".join(a.tobytes() for a in arrays)


def unpacked(data: bytes, *types: type) -> list[np.ndarray]:
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for t in types:
        out.append(np.frombuffer(data, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def blobs(shards: np.ndarray, count: int, *arrays: np.ndarray) -> pa.RecordBatch:
    """One row (shard, blob) for each shard that has entries."""
    order = np.argsort(shards, kind="stable")
    bounds = np.searchsorted(shards[order], np.arange(count + 1))
    rows = [(s, packed(*(a[order[bounds[s] : bounds[s + 1]]] for a in arrays))) for s in range(count) if bounds[s] < bounds[s + 1]]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "data"])


def by_shard(batches: Iterator[pa.RecordBatch]) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for batch in batches:
        for s, data in zip(batch.column("shard").to_pylist(), batch.column("data")):
            out.setdefault(s, []).append(data.as_py())
    return out


#: Files that a worker has open at most, and tokens of one task after which a count is sent, so that 32 bits hold it.
MOST_OPEN, SEND_AT = 48, 1 << 31
TOTALS = ("n1", "n2", "n3", "n4", "a1", "a2", "a3", "a4", "predecessors", "tokens", "words")


def train(texts: DataFrame, folder: str, shards: int) -> dict[str, int]:
    """Count texts (text) and write the model's arrays below folder. Returns the totals."""

    def sent(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return blobs((part[0] % np.uint64(shards)).astype(np.int32), shards, part[1], part[2], part[3].astype(np.uint32))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        room = tokens = 0

        def merged() -> tuple[np.ndarray, ...]:
            first, word, n = (np.concatenate(x) for x in zip(*held))
            return summed(bigram_hash(first, word), first, word, n)

        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                first, word, _ = flat(batch.column("text").slice(at, 2000))
                held.append((first, word, np.ones(len(word), np.int64)))
                room += len(word)
                tokens += len(word)
                if room > COUNT_AT:
                    part = merged()
                    held[:], room = [part[1:]], 0
                    if len(part[0]) > COUNT_AT or tokens > SEND_AT:
                        yield sent(part)
                        held.clear()
                        tokens = 0
        if held:
            yield sent(merged())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = mounted(folder)
        os.makedirs(where, exist_ok=True)
        for shard, parts in sorted(by_shard(batches).items()):
            first, word, n = (np.concatenate(x) for x in zip(*(unpacked(p, np.uint64, np.uint64, np.uint32) for p in parts)))
            hashes, first, word, n = summed(bigram_hash(first, word), first, word, n.astype(np.int64))
            save(where, f"bigrams-{shard}", hashes, narrow(n))
            begun = summed(first, *(np.int64(x) for x in (n == 1, n == 2, n > 2)), apart=False)
            ended = summed(word, n, np.ones(len(n), np.int64), apart=False)
            none = [np.zeros(len(x[0]), np.int64) for x in (ended, begun)]
            keys, *stats = summed(np.concatenate([begun[0], ended[0]]), *(np.concatenate([x, none[0]]) for x in begun[1:]), *(np.concatenate([none[1], x]) for x in ended[1:]), apart=False)
            # Of a shard's bigrams a word begins or ends fewer than 2^32; how often it occurs may be more.
            yield blobs((keys % np.uint64(shards)).astype(np.int32), shards, keys, *(stats[k].astype(np.uint32) for k in (0, 1, 2, 4)), stats[3])
            totals = [int((n == k).sum()) for k in (1, 2, 3, 4)] + [0] * 4 + [len(n), int(n.sum()), 0]
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([packed(np.array(totals, np.int64))], pa.binary())], names=["shard", "data"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = mounted(folder)
        totals = np.zeros(len(TOTALS), np.int64)
        for shard, parts in sorted(by_shard(batches).items()):
            if shard < 0:
                totals += sum(unpacked(p, np.int64)[0] for p in parts)
                continue
            columns = [np.concatenate(x) for x in zip(*(unpacked(p, np.uint64, *[np.uint32] * 4, np.int64) for p in parts))]
            keys, *kinds, before, tokens = summed(columns[0], *(c.astype(np.int64) for c in columns[1:]), apart=False)
            save(where, f"words-{shard}", keys, *(narrow(x) for x in (tokens, before, *kinds)))
            totals[4:8] += [int((before == k).sum()) for k in (1, 2, 3, 4)]
            totals[10] += int((tokens > 0).sum())
        yield pa.RecordBatch.from_arrays([pa.array([int(t)], pa.int64()) for t in totals], names=list(TOTALS))

    schema = "shard int, data binary"
    counted = texts.select("text").mapInArrow(count, schema).repartition(shards, "shard").mapInArrow(merge, schema)
    found = counted.repartition(shards, "shard").mapInArrow(words, ", ".join(f"{t} long" for t in TOTALS))
    row = found.agg(*(F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TOTALS)).first()
    return {t: int(row[t]) for t in TOTALS}


def discounts(counts: list[int]) -> list[float]:
    """For 1, 2, 3 and more, from the numbers of n-grams that occur once to four times.

    None is below a tenth, so that every context leaves something to words that it wasn't seen with.
    """
    if min(counts) <= 0:
        return [0.5, 1.0, 1.5]
    y = counts[0] / (counts[0] + 2 * counts[1])
    return [min(max(k - (k + 1) * y * counts[k] / counts[k - 1], 0.1), float(k)) for k in (1, 2, 3)]


class MappedModel:
    """The model's arrays, mapped when they are needed, a bounded number of files at a time."""

    def __init__(self, folder: str, shards: int, totals: dict[str, int]):
        self.folder, self.shards, self.t = mounted(folder), shards, totals
        self.d2 = np.array([0.0, *discounts([totals[f"n{k}"] for k in (1, 2, 3, 4)])])
        self.d1 = np.array([0.0, *discounts([totals[f"a{k}"] for k in (1, 2, 3, 4)])])
        self.open: dict[str, list[np.ndarray] | None] = {}

    def arrays(self, name: str) -> list[np.ndarray] | None:
        if name not in self.open:
            if len(self.open) >= MOST_OPEN:
                del self.open[next(iter(self.open))]  # the oldest; with its last array goes the mapping
            self.open[name] = mapped(f"{self.folder}/{name}.bin")
        return self.open[name]

    def look_up(self, keys: np.ndarray, index: str, columns: int) -> list[np.ndarray]:
        """The values stored for keys, columns of them; zeros where there are none."""
        out = [np.zeros(len(keys), np.int64) for _ in range(columns)]
        shards = (keys % np.uint64(self.shards)).astype(np.int64)
        order = np.lexsort((keys, shards))
        bounds = np.searchsorted(shards[order], np.arange(self.shards + 1))
        for s in range(self.shards):
            mine = order[bounds[s] : bounds[s + 1]]
            table = self.arrays(f"{index}-{s}") if len(mine) else None
            if table is None or not len(table[0]):
                continue
            at = np.minimum(np.searchsorted(table[0], keys[mine]), len(table[0]) - 1)
            hit = table[0][at] == keys[mine]
            for o, v in zip(out, table[1:]):
                o[mine[hit]] = v[at[hit]]
        return out

    def score(self, before: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token: its training count, base log10 and the model's log10 probability."""
        t = self.t
        known, inverse = np.unique(words, return_inverse=True)
        count, continued = (x[inverse] for x in self.look_up(known, "words", 2))
        base = np.log10((count + 0.5) / (t["tokens"] + 0.5 * (t["words"] + 1)))
        firsts, at = np.unique(before, return_inverse=True)
        total, _, *kinds = self.look_up(firsts, "words", 5)
        kinds = np.stack(kinds, axis=1)
        total = np.where(firsts == np.uint64(start_hash()), self.texts(), total)
        pairs, back = np.unique(bigram_hash(before, words), return_inverse=True)
        seen = self.look_up(pairs, "bigrams", 1)[0][back]
        uniform = 1 / (t["words"] + 1)
        if not t["predecessors"]:
            return count, base, np.full(len(words), np.log10(uniform))
        ends = [t["a1"], t["a2"], t["words"] - t["a1"] - t["a2"]]
        lower = np.maximum(continued - self.d1[np.minimum(continued, 3)], 0) / t["predecessors"] + float(self.d1[1:] @ ends) / t["predecessors"] * uniform
        left = np.where(total > 0, (kinds @ self.d2[1:]) / np.maximum(total, 1), 1.0)
        left = np.where(kinds.sum(axis=1) > 0, np.minimum(left, 1.0), 1.0)[at]
        upper = np.maximum(seen - self.d2[np.minimum(seen, 3)], 0) / np.maximum(total, 1)[at]
        return count, base, np.log10(upper + left * lower)

    def texts(self) -> int:
        """How many texts were trained on: each has one end."""
        import xxhash

        end = np.array([xxhash.xxh3_64_intdigest(b" end")], np.uint64)
        return int(self.look_up(end, "words", 1)[0][0])


@functools.lru_cache(maxsize=1)
def worker_model(folder: str, shards: int, totals: tuple[tuple[str, int], ...]) -> MappedModel:
    return MappedModel(folder, shards, dict(totals))


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Train on the rows that aren't held out and score all.

    One row per row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score. shards
    defaults to what the size of the texts asks for, and at least the session's number of shuffle partitions.
    """
    spark = docs.sparkSession
    if shards is None:
        size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0)).alias("n")).first()["n"]
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    folder = new_path(spark, "bigram-model")
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    totals = train(rows.filter(~F.col("held_out")), folder, shards)
    key = tuple(sorted(totals.items()))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(folder, shards, key)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                size, upto = 0, at
                while upto < batch.num_rows and (size < 6 * SCORE_AT or upto == at) and upto - at < 5000:
                    size += len(batch.column("text")[upto].as_py() or "")
                    upto += 1
                part = batch.slice(at, upto - at)
                at = upto
                before, words, ends = flat(part.column("text"))
                count, base, score = model.score(before, words)
                starts = np.concatenate([[0], ends[:-1]])
                sums = [np.add.reduceat(x, starts) for x in ((count > 0).astype(np.int64), base, score)]
                tokens = np.diff(np.concatenate([[0], ends]))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), pa.array(tokens, pa.int64()), pa.array(sums[0], pa.int64()), pa.array(np.full(len(tokens), totals["tokens"]), pa.int64()), pa.array(sums[1], pa.float64()), pa.array(sums[2], pa.float64())], names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(run, schema)
