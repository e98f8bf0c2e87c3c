"""All pairs of rows as arrays: blocks of rows meet in tiles, and tasks count or pick pairs there.

A row belongs to one of B blocks by the hash of its key and is sent to the B tiles (i, j) its block takes part in, once each.
A tile is two blocks as columns of numbers, so a pair costs a few machine words and no row is ever made of it unless
it is asked for. Tasks hold one tile at a time and stream what they find.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinfold.sources.scratch import stored

#: The most rows of a block, and rows and columns of the piece of a tile that is looked at at once.
BLOCK_ROWS, PIECE = 131_072, (16, 4096)
#: Rows of a batch of results, and the most bins and pairs of a count that has no bounds beforehand.
BATCH, BINS, BUFFER = 100_000, 1 << 24, 1 << 22
#: The flag of one group, and the share (one in so many) of a tile's pairs up to which those with it are counted apart.
SAME, MATES = "same_primary_group", 16
#: Values of a distance by the number of 64-bit words, and of the flag of one group.
WORD_VALUES, WIDE_WORDS = 65, 4

Visit = Callable[[pa.Table, "pa.Table | None"], Iterator[pa.RecordBatch]]


def blocks_for(rows: int, cores: int) -> int:
    """Enough blocks that none is too large and that there are many tiles for each core."""
    return max(math.ceil(rows / BLOCK_ROWS), math.ceil(math.sqrt(16 * cores)), 1)


def settled(visit: Visit) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """visit for each tile of batches that are sorted by __tile and __second: its first and its second side.

    A tile of a block with itself has null in __second throughout and gives no second side.
    """

    def tables(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = pa.Table.from_batches(held)
        second = tile["__second"]
        rows = tile.drop_columns(["__tile", "__second"])
        if second.null_count:
            yield from visit(rows, None)
            return
        first = int(np.searchsorted(second.to_numpy(), 1))
        if 0 < first < len(rows):
            yield from visit(rows.slice(0, first), rows.slice(first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            tiles = batch.column("__tile").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(tiles)) + 1).tolist(), len(tiles)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if held and tiles[a] != last:
                    yield from tables(held)
                    held = []
                last = tiles[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from tables(held)

    return run


def tiles(rows: DataFrame, key: str, blocks: int) -> DataFrame:
    """rows once per tile that they take part in, with __tile, and __second as settled takes it."""
    own, other = F.pmod(F.xxhash64(key), F.lit(blocks)), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    spread = rows.withColumn("__own", own.cast("int")).withColumn("__other", other)
    tile = F.least("__own", "__other").cast("long") * blocks + F.greatest("__own", "__other")
    side = F.when(F.col("__own") != F.col("__other"), (F.col("__own") > F.col("__other")).cast("int"))
    return spread.withColumn("__tile", tile).withColumn("__second", side).drop("__own", "__other")


def tile_codes(blocks: int) -> list[int]:
    """__tile of the tiles of so many blocks."""
    return [i * blocks + j for i in range(blocks) for j in range(i, blocks)]


def met(spread: DataFrame, visit: Visit, schema: str, tasks: int) -> DataFrame:
    """What visit gives for the tiles of spread."""
    return spread.repartition(tasks, "__tile").sortWithinPartitions("__tile", "__second").mapInArrow(settled(visit), schema)


def met_singly(spread: DataFrame, visit: Visit, schema: str, codes: list[int]) -> DataFrame:
    """What visit gives for the tiles of these codes, of which spread has no others: each is a task of its own."""
    place = F.array_position(F.lit(codes), F.col("__tile")) - 1
    return spread.repartitionById(len(codes), place.cast("int")).sortWithinPartitions("__tile", "__second").mapInArrow(settled(visit), schema)


def meet(rows: DataFrame, key: str, visit: Visit, schema: str, blocks: int | None = None) -> DataFrame:
    """What visit gives for all tiles of rows, which are stored first. Each pair of rows lies in one tile, once."""
    rows = stored(rows, "block-rows")
    if blocks is None:
        blocks = blocks_for(rows.count(), rows.sparkSession.sparkContext.defaultParallelism)
    return met_singly(tiles(rows, key, blocks), visit, schema, tile_codes(blocks))


def pieces(n: int, m: int | None) -> Iterator[tuple[slice, slice, np.ndarray | None]]:
    """Pieces (rows, columns, mask) of an n x m table; without m, of the part of an n x n table above its diagonal."""
    high, wide = PIECE
    for a in range(0, n, high):
        rows = slice(a, min(a + high, n))
        start = 0
        if m is None:
            yield rows, rows, np.triu(np.ones((rows.stop - a,) * 2, bool), 1)
            start = rows.stop
        for b in range(start, n if m is None else m, wide):
            yield rows, slice(b, min(b + wide, n if m is None else m)), None


def words(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().view(np.uint64)


class Tile:
    """The distances of a tile's pairs, piece by piece, by name of the columns that make them."""

    def __init__(self, a: pa.Table, b: pa.Table | None):
        self.a, self.b, self.whole = a, a if b is None else b, b is not None
        self._words: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self._alike: dict[str, str] = {}
        self._piece: tuple[slice, slice] | None = None
        self._apart: dict[str, np.ndarray] = {}
        self._groups: tuple[np.ndarray, np.ndarray] | None = None

    def pieces(self) -> Iterator[tuple[slice, slice, np.ndarray | None]]:
        return pieces(len(self.a), len(self.b) if self.whole else None)

    def column(self, name: str) -> str:
        """The first column looked at that has the same words; distances by both are the same."""
        if name not in self._alike:
            x, y = words(self.a, name), words(self.b, name)
            known = next((k for k, (u, v) in self._words.items() if np.array_equal(u, x) and np.array_equal(v, y)), None)
            if known is None:
                self._words[name] = x, y
            self._alike[name] = known or name
        return self._alike[name]

    def apart(self, name: str, rows: slice, columns: slice) -> np.ndarray:
        """Distances by one column. They are kept while a piece is looked at, so they must not be written to."""
        name = self.column(name)
        if self._piece != (rows, columns):
            self._piece, self._apart = (rows, columns), {}
        if name not in self._apart:
            x, y = self._words[name]
            self._apart[name] = np.bitwise_count(x[rows, None] ^ y[None, columns])
        return self._apart[name]

    def sum_apart(self, times: dict[str, int], rows: slice, columns: slice) -> np.ndarray:
        """The sum of distances by columns, each so many times."""
        out = np.zeros((1, 1), np.uint16)
        for name, n in times.items():
            far = self.apart(name, rows, columns)
            out = out + (far if n == 1 else np.multiply(far, n, dtype=np.uint16))
        return out

    def times(self, count: int = WIDE_WORDS) -> dict[str, int]:
        """The columns that a wide distance is the sum of, and how often each counts."""
        return Counter(self.column(f"w{k}") for k in range(count))

    def wide(self, rows: slice, columns: slice, count: int = WIDE_WORDS) -> np.ndarray:
        return self.sum_apart(self.times(count), rows, columns)

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Both sides' groups as numbers; -1 and -2 where there is none."""
        if self._groups is None:
            both = pa.chunked_array([*self.a["group_id"].chunks, *self.b["group_id"].chunks]).combine_chunks()
            codes = both.dictionary_encode().indices.fill_null(-1).to_numpy()
            one, two = codes[: len(self.a)], codes[len(self.a) :]
            self._groups = one, np.where(two < 0, -2, two)
        return self._groups

    def mates(self) -> tuple[int, Iterator[tuple[np.ndarray, np.ndarray]]]:
        """How many pairs have one group, and their (rows, columns), about BATCH at a time."""
        one, two = self.groups()
        order = np.argsort(two, kind="stable")
        ordered = two[order]
        at = order if not self.whole else np.arange(len(one))
        low, high = np.searchsorted(ordered, one[at]), np.searchsorted(ordered, one[at], "right")
        if not self.whole:  # of a row, those that come after it
            low = np.where(high > low, np.arange(len(at)) + 1, low)
            low, high = np.where(one[at] < 0, 0, low), np.where(one[at] < 0, 0, high)
        sizes = high - low
        ends = np.cumsum(sizes)

        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            a = 0
            while a < len(at):
                b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH, "right")))
                n = sizes[a:b]
                if n.any():
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    yield np.repeat(at[a:b], n), order[np.repeat(low[a:b], n) + step]
                a = b

        return int(sizes.sum()), found()

    def field_at(self, name: str, x: np.ndarray, y: np.ndarray, count: int = WIDE_WORDS) -> np.ndarray:
        """The distances of single pairs."""
        names = [f"w{k}" for k in range(count)] if name == "phash16_dist" else [name.removesuffix("_dist")]
        return sum(at_pairs(self, n, x, y).astype(np.int64) for n in names)

    def same(self, rows: slice, columns: slice) -> np.ndarray:
        """1 where both have a group, and the same one."""
        one, two = self.groups()
        return (one[rows, None] == two[None, columns]).view(np.uint8)

    def field(self, name: str, rows: slice, columns: slice, count: int = WIDE_WORDS) -> np.ndarray:
        """The column of a pair table."""
        if name == "same_primary_group":
            return self.same(rows, columns)
        return self.wide(rows, columns, count) if name == "phash16_dist" else self.apart(name.removesuffix("_dist"), rows, columns)


def values_of(field: str, count: int = WIDE_WORDS) -> int:
    return {"same_primary_group": 2, "phash16_dist": 64 * count + 1}.get(field, WORD_VALUES)


def sent(schema: pa.Schema, columns: list) -> Iterator[pa.RecordBatch]:
    """Columns as batches."""
    table = pa.Table.from_arrays([pa.array(c, f.type) if isinstance(c, np.ndarray) else c for c, f in zip(columns, schema)], schema=schema)
    yield from table.to_batches(max_chunksize=BATCH)


def _few(tile: Tile, fields: list[str], sizes: list[int], count: int) -> np.ndarray:
    """pairs by key, where keys are few: below 256 two of them are counted at once."""
    bins = math.prod(sizes)
    kind, reach = (np.uint8, 65_536) if bins <= 256 else (np.uint16, bins)
    total, held, at = np.zeros(reach, np.int64), np.empty(1 << 18, kind), 0
    single = np.zeros(bins, np.int64)
    for rows, columns, mask in tile.pieces():
        key = tile.field(fields[0], rows, columns, count).astype(kind)
        for f, n in zip(fields[1:], sizes[1:]):
            key *= kind(n)
            key += tile.field(f, rows, columns, count).astype(kind, copy=False)
        flat = key.ravel() if mask is None else key[mask]
        if at + len(flat) > len(held) - 1:
            single += _binned(held[:at], total, bins)
            at = 0
        held[at : at + len(flat)] = flat
        at += len(flat)
    single += _binned(held[:at], total, bins)
    if kind is np.uint8:
        both = total.reshape(256, 256)
        return single + both.sum(0)[:bins] + both.sum(1)[:bins]
    return single + total


def _binned(held: np.ndarray, total: np.ndarray, bins: int) -> np.ndarray:
    """Count held into total, in twos where it is bytes; the odd one out comes back."""
    odd = np.zeros(bins, np.int64)
    if held.dtype == np.uint8:
        if len(held) % 2:
            odd[held[-1]] += 1
        held = held[: len(held) // 2 * 2].view(np.uint16)
    found = np.bincount(held)
    total[: len(found)] += found
    return odd


def _many(tile: Tile, fields: list[str], count: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """(values by field, pairs) where possible keys are many: a table over the values seen so far.

    Of a wide distance only what the other fields don't tell is part of a key.
    """
    wide, others = fields.index("phash16_dist") if "phash16_dist" in fields else None, {}
    rest: dict[str, int] = {}
    if wide is not None:
        rest = dict(tile.times(count))
        others = {k: rest.pop(tile.column(f.removesuffix("_dist"))) for k, f in enumerate(fields) if f not in ("phash16_dist", SAME) and tile.column(f.removesuffix("_dist")) in rest}
    held = [np.empty(BUFFER, np.uint16 if values_of(f, count) > 256 else np.uint8) for f in fields]
    low, high, table, at = [1 << 20] * len(fields), [-1] * len(fields), None, 0

    def values(keys: np.ndarray) -> list[np.ndarray]:
        out = []
        for a, b in zip(low[::-1], high[::-1]):
            keys, value = np.divmod(keys, b - a + 1)
            out.append(value + a)
        out.reverse()
        for k, n in others.items():
            out[wide] = out[wide] + n * out[k]
        return out

    def given(counts: np.ndarray):
        keys = np.flatnonzero(counts)
        return values(keys), counts[keys]

    def flush(at: int):
        nonlocal low, high, table
        seen = [(int(h[:at].min()), int(h[:at].max())) for h in held]
        if any(a < x or b > y for (a, b), x, y in zip(seen, low, high)):
            least, most = [min(a, x) for (a, _), x in zip(seen, low)], [max(b, y) for (_, b), y in zip(seen, high)]
            shape = [b - a + 1 for a, b in zip(least, most)]
            grown = np.zeros(shape, np.int64) if math.prod(shape) <= BINS else None
            if table is not None and grown is None:
                yield given(table)
            elif table is not None:
                grown[tuple(slice(a - x, b - x + 1) for a, b, x in zip(low, high, least))] = table.reshape([b - a + 1 for a, b in zip(low, high)])
            low, high, table = least, most, None if grown is None else grown.ravel()
        key = np.empty(at, np.int64)
        for s in range(0, at, 1 << 15):
            e = min(s + (1 << 15), at)
            part = np.zeros(e - s, np.uint32 if table is not None else np.int64)
            for h, a, b in zip(held, low, high):
                part *= b - a + 1
                part += h[s:e]
                part -= a
            key[s:e] = part
        if table is None:
            keys, counts = np.unique(key, return_counts=True)
            yield values(keys), counts
        else:
            found = np.bincount(key)
            table[: len(found)] += found

    for rows, columns, mask in tile.pieces():
        size = int(mask.sum()) if mask is not None else (rows.stop - rows.start) * (columns.stop - columns.start)
        if at + size > BUFFER:
            yield from flush(at)
            at = 0
        for k, (h, f) in enumerate(zip(held, fields)):
            v = tile.field(f, rows, columns, count) if k != wide else np.broadcast_to(tile.sum_apart(rest, rows, columns), (rows.stop - rows.start, columns.stop - columns.start))
            if mask is None:
                h[at : at + size].reshape(v.shape)[:] = v
            else:
                h[at : at + size] = v[mask]
        at += size
    if at:
        yield from flush(at)
    if table is not None:
        yield given(table)


def counting(fields: list[str], count: int = WIDE_WORDS) -> tuple[Visit, str]:
    """The visit that counts a tile's pairs by fields, and its schema (fields and pairs).

    Rows of one key must be summed; a row may take pairs off, and keys whose sum is 0 have none.
    """
    schema = pa.schema([*((f, pa.int32()) for f in fields), ("pairs", pa.int64())])
    sizes = [values_of(f, count) for f in fields]

    def counted(tile: Tile, fields: list[str], sizes: list[int]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        if math.prod(sizes) > 65_536:
            yield from _many(tile, fields, count)
            return
        n = _few(tile, fields, sizes, count)
        keys = np.flatnonzero(n)
        yield list(np.unravel_index(keys, sizes)), n[keys]

    def visit(a: pa.Table, b: pa.Table | None) -> Iterator[pa.RecordBatch]:
        tile = Tile(a, b)
        given = lambda values, n: sent(schema, [*(np.broadcast_to(v, len(n)).astype(np.int32) for v in values), n])
        plain = [f for f in fields if f != SAME]
        few, mates = tile.mates() if SAME in fields and plain else (0, iter(()))
        if len(plain) == len(fields) or not plain or few > len(tile.a) * len(tile.b) // MATES:
            for values, n in counted(tile, fields, sizes):
                yield from given(values, n)
            return
        # All pairs count as pairs across groups; the few inside one are then counted by themselves, and taken off.
        flagged = lambda values, flag: [flag if f == SAME else next(values) for f in fields]
        for values, n in counted(tile, plain, [values_of(f, count) for f in plain]):
            yield from given(flagged(iter(values), 0), n)
        for x, y in mates:
            key = np.ravel_multi_index([tile.field_at(f, x, y, count) for f in plain], [values_of(f, count) for f in plain])
            keys, n = np.unique(key, return_counts=True)
            values = np.unravel_index(keys, [values_of(f, count) for f in plain])
            yield from given(flagged(iter(values), 1), n)
            yield from given(flagged(iter(values), 0), -n)

    return visit, ", ".join([*(f"{f} int" for f in fields), "pairs long"])


def needed(fields: list[str], count: int = WIDE_WORDS) -> list[str]:
    """The columns of spread photos that make the fields of a pair table."""
    made = {"same_primary_group": ["group_id"], "phash16_dist": [f"w{k}" for k in range(count)]}
    return [c for f in fields for c in made.get(f, [f.removesuffix("_dist")])]


def pair_counts(rows: DataFrame, fields: list[str], key: str = "id", blocks: int | None = None, count: int = WIDE_WORDS) -> DataFrame:
    """fields, pairs: all pairs of rows, counted by columns of the pair table, without writing any pair.

    rows need key and the columns that the fields are made of; rows where a hash is null make no pair.
    """
    columns = needed(fields, count)
    slim = rows.select(F.xxhash64(key).alias("__key"), *numbers(columns)).dropna(subset=[c for c in columns if c != "group_id"])
    visit, schema = counting(fields, count)
    return meet(slim, "__key", visit, schema, blocks).groupBy(*fields).agg(F.sum("pairs").alias("pairs")).filter("pairs > 0")


def numbers(columns: list[str]) -> list[Column]:
    """Hashes as 64-bit numbers; groups stay as they are."""
    return [F.col(c) if c == "group_id" else F.col(c).cast("long") for c in dict.fromkeys(columns)]


def hits(tile: Tile, test: Callable[[Tile, slice, slice], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of the pairs that pass the test, up to a buffer full at a time."""
    found, size = [], 0
    for rows, columns, mask in tile.pieces():
        passed = test(tile, rows, columns)
        if mask is not None:
            passed = passed & mask
        x, y = np.nonzero(passed)
        if len(x):
            found.append((x + rows.start, y + columns.start))
            size += len(x)
        if size > BATCH:
            yield np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])
            found, size = [], 0
    if found:
        yield np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def at_pairs(tile: Tile, name: str, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The distance by one hash of single pairs."""
    return np.bitwise_count(words(tile.a, name)[x] ^ words(tile.b, name)[y])


def pairs_in_limits(photos: DataFrame, low: list[int], high: list[int], blocks: int | None = None, count: int = WIDE_WORDS) -> DataFrame:
    """photo_id_1, photo_id_2, phash16_dist, colorhash_dist of the pairs whose wide distance lies in the limits of their short one.

    low and high are by colorhash_dist, 0 to 64; photos have their words spread, and those without a hash make no pair.
    """
    columns = needed(["phash16_dist", "colorhash_dist"], count)
    rows = photos.select("id", *numbers(columns)).dropna(subset=columns)
    least, most = np.array(low), np.array(high)
    top, bottom = int(most.max()), int(least.min())
    ids = {x.name: x.dataType.simpleString() for x in rows.schema}["id"]
    schema = f"a_id {ids}, b_id {ids}, phash16_dist int, colorhash_dist int"

    def visit(a: pa.Table, b: pa.Table | None) -> Iterator[pa.RecordBatch]:
        tile = Tile(a, b)

        def near(t: Tile, rows: slice, columns: slice) -> np.ndarray:
            wide = t.wide(rows, columns, count)
            return (wide <= top) & (wide >= bottom)

        shape = pa.schema([("a_id", a["id"].type), ("b_id", a["id"].type), ("phash16_dist", pa.int32()), ("colorhash_dist", pa.int32())])
        for x, y in hits(tile, near):
            short = at_pairs(tile, "colorhash", x, y).astype(np.int32)
            wide = sum((at_pairs(tile, f"w{k}", x, y).astype(np.int32) for k in range(1, count)), at_pairs(tile, "w0", x, y).astype(np.int32))
            keep = (wide >= least[short]) & (wide <= most[short])
            x, y = x[keep], y[keep]
            yield from sent(shape, [tile.a["id"].take(pa.array(x)), tile.b["id"].take(pa.array(y)), wide[keep], short[keep]])

    found = meet(rows, "id", visit, schema, blocks)
    return found.select(F.least("a_id", "b_id").alias("photo_id_1"), F.greatest("a_id", "b_id").alias("photo_id_2"), "phash16_dist", "colorhash_dist")


def ranked(a: pa.Table, b: pa.Table | None) -> tuple[np.ndarray, np.ndarray, int]:
    """The places of both sides' ids in the order of all ids of a tile, and how many there are."""
    ids = a["id"] if b is None else pa.chunked_array([*a["id"].chunks, *b["id"].chunks])
    place = np.empty(len(ids), np.int64)
    place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    return (place, place, len(ids)) if b is None else (place[: len(a)], place[len(a) :], len(ids))


def nearest_pairs(photos: DataFrame, p: int, c: int, reach: int = 0, limit: int = 24, blocks: int | None = None, count: int = WIDE_WORDS) -> DataFrame:
    """photo_id_1, photo_id_2, off: the pairs nearest to the cell (p, c) of wide and short distance, by off and ids.

    Each tile gives its first ones; rows without a hash make no pair.
    """
    columns = needed(["phash16_dist", "colorhash_dist"], count)
    rows = photos.select("id", *numbers(columns)).dropna(subset=columns)
    ids = {x.name: x.dataType.simpleString() for x in rows.schema}["id"]

    def visit(a: pa.Table, b: pa.Table | None) -> Iterator[pa.RecordBatch]:
        tile = Tile(a, b)
        one, two, n = ranked(a, b)
        best: list[np.ndarray] = [np.zeros((4, 0), np.int64)]
        bound = [reach]

        def near(t: Tile, rows: slice, columns: slice) -> np.ndarray:
            off = np.abs(t.wide(rows, columns, count).astype(np.int16) - p)
            off += np.abs(t.apart("colorhash", rows, columns).astype(np.int16) - c)
            return off <= bound[0]

        for x, y in hits(tile, near):
            wide = sum((at_pairs(tile, f"w{k}", x, y).astype(np.int64) for k in range(1, count)), at_pairs(tile, "w0", x, y).astype(np.int64))
            off = np.abs(wide - p) + np.abs(at_pairs(tile, "colorhash", x, y).astype(np.int64) - c)
            both = np.concatenate([best[0], np.stack([off, np.minimum(one[x], two[y]) * n + np.maximum(one[x], two[y]), x, y])], axis=1)
            best[0] = both[:, np.lexsort((both[1], both[0]))[:limit]]
            if best[0].shape[1] == limit:
                bound[0] = int(best[0][0, -1])
        off, _, x, y = best[0]
        shape = pa.schema([("a_id", a["id"].type), ("b_id", a["id"].type), ("off", pa.int32())])
        yield from sent(shape, [tile.a["id"].take(pa.array(x)), tile.b["id"].take(pa.array(y)), off.astype(np.int32)])

    found = meet(rows, "id", visit, f"a_id {ids}, b_id {ids}, off int", blocks)
    return found.select(F.least("a_id", "b_id").alias("photo_id_1"), F.greatest("a_id", "b_id").alias("photo_id_2"), "off").orderBy("off", "photo_id_1", "photo_id_2").limit(limit)


def group_links(members: DataFrame, column: str, most: int, blocks: int | None = None) -> DataFrame:
    """g1 < g2, bridges: how many pairs across two groups are at most so far apart by one hash.

    members: id, group_id, the hash. Rows without group or hash make no pair.
    """
    rows = members.select("id", "group_id", F.col(column).cast("long").alias(column)).dropna()
    kind = {x.name: x.dataType.simpleString() for x in rows.schema}["group_id"]
    slim = rows.select(F.xxhash64("id").alias("__key"), "group_id", column)

    def visit(a: pa.Table, b: pa.Table | None) -> Iterator[pa.RecordBatch]:
        both = pa.chunked_array([*a["group_id"].chunks, *(a if b is None else b)["group_id"].chunks]).combine_chunks().dictionary_encode()
        codes = both.indices.to_numpy()
        one, two = codes[: len(a)], codes[len(a) :]
        shape = pa.schema([("x", both.dictionary.type), ("y", both.dictionary.type), ("bridges", pa.int64())])
        order, other = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        x, y = words(a, column)[order], words(a if b is None else b, column)[other]
        one, two = one[order], two[other]
        starts = np.flatnonzero(np.diff(two, prepend=-1))
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def given() -> Iterator[pa.RecordBatch]:
            u, v, n = (np.concatenate(c) for c in zip(*held))
            yield from sent(shape, [both.dictionary.take(pa.array(u)), both.dictionary.take(pa.array(v)), n])

        # Rows of a group follow each other: of these, links are added up by column, and then by the columns' groups.
        cuts = [*np.flatnonzero(np.diff(one, prepend=-1)).tolist(), len(one)]
        for s, e in zip(cuts, cuts[1:]):
            first = int(np.searchsorted(two, one[s], "right")) if b is None else 0
            links = np.zeros(len(two), np.int64)
            for c in range(first, len(two), PIECE[1]):
                there = y[None, c : c + PIECE[1]]
                for r in range(s, e, PIECE[0]):
                    near = np.bitwise_count(x[r : min(r + PIECE[0], e), None] ^ there) <= most
                    links[c : c + PIECE[1]] += np.add.reduce(near.view(np.uint8), axis=0, dtype=np.uint8)
            n = np.add.reduceat(links, starts)
            n[two[starts] == one[s]] = 0
            some = np.flatnonzero(n)
            held.append((np.full(len(some), one[s]), two[starts][some], n[some]))
            size += len(some)
            if size > BATCH:
                yield from given()
                held, size = [], 0
        if size:
            yield from given()

    found = meet(slim, "__key", visit, f"x {kind}, y {kind}, bridges long", blocks)
    return found.groupBy(F.least("x", "y").alias("g1"), F.greatest("x", "y").alias("g2")).agg(F.sum("bridges").alias("bridges"))
