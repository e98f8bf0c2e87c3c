"""Periodic runs of words, found by block convolution at dyadic scales.

A run is a maximal stretch of words with smallest period q and at least four periods. Words are numbers;
texts lie one after the other. At scale s the texts are cut into blocks of s words, and the squared
differences of each block with every place of the following window, at distances s to 2s - 1, come from one
exact convolution: an integer transform modulo a prime, of which all blocks of a chunk are columns. A
difference of zero is an occurrence. A run of period q in [s, 2s) holds two neighbouring blocks that both
occur again at distance q, so such pairs alone seed extensions: the text is compared with itself moved by q,
word by word, and what is periodic long enough, with no shorter period inside it, is a run. Sums are taken
modulo the prime, so a zero may be chance; the comparison of words decides.

Scales go up; a seed inside a run that is known and whose period divides the seed's distance is spent.
What is held at a time is a slice of some megabytes of texts, or one text.

Cases: null or empty text has no words, no runs and an empty collapsed text; texts of any length are whole (up
to 2^28 words, the length of the transform); a null identifier stays null; repeated rows give a row each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A prime of the form k * 2^27 + 1, and a generator of its units.
PRIME, GENERATOR = 2013265921, 31
_P = np.uint64(PRIME)
#: Cells of a chunk's transform, and bytes of text in a slice.
CELLS, SLICE_BYTES = 1 << 17, 4_000_000


@functools.lru_cache(maxsize=64)
def roots(half: int, inverse: bool = False) -> np.ndarray:
    """The first half of the powers of a root of unity of order 2 * half, as a column."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out = np.ones(half, np.uint64)
    have = 1
    while have < half:
        out[have : 2 * have] = out[:have] * np.uint64(pow(root, have, PRIME)) % _P
        have *= 2
    return out[:, None]


@functools.lru_cache(maxsize=64)
def negated(size: int) -> np.ndarray:
    """Where, in the transform's order, the index -k stands for the index k of each place."""
    place = np.zeros(size, np.int64)
    for bit in range(size.bit_length() - 1):
        place |= ((np.arange(size) >> bit) & 1) << (size.bit_length() - 2 - bit)
    return place[-place % size]  # reversing the bits is its own inverse


def forward(v: np.ndarray) -> None:
    """The transform of each column, in place, indices with their bits reversed."""
    size, half = len(v), len(v) // 2
    while half:
        x = v.reshape(size // (2 * half), 2, half, -1)
        a, b = x[:, 0], x[:, 1]
        apart = a + (_P - b)
        a += b
        np.minimum(a, a - _P, out=a)  # below zero wraps around to a large number
        np.remainder(np.multiply(apart, roots(half), out=apart), _P, out=b)
        half //= 2


def backward(v: np.ndarray) -> None:
    """The inverse of forward, times the number of rows."""
    size, half = len(v), 1
    while half < size:
        x = v.reshape(size // (2 * half), 2, half, -1)
        a, b = x[:, 0], x[:, 1]
        t = np.remainder(b * roots(half, True), _P)
        np.add(a, _P - t, out=b)
        np.minimum(b, b - _P, out=b)
        a += t
        np.minimum(a, a - _P, out=a)
        half *= 2


def occurrences(blocks: np.ndarray) -> np.ndarray:
    """For blocks (row by row; the last two only serve as windows): [d, k] is true where block k occurs at distance size + d.

    The sum of squared differences is that of the squares less twice the product sum, all modulo the prime.
    """
    count, size = len(blocks) - 2, blocks.shape[1]
    v = np.zeros((2 * size, len(blocks)), np.uint64)
    v[:size] = blocks.T
    forward(v)
    window = v[:, 1:-1].copy()  # the second block stands size places later: a factor of -1 at odd indices
    window[:size] += v[:size, 2:]
    window[size:] += _P - v[size:, 2:]
    product = window % _P * v[negated(2 * size), :count] % _P
    backward(product)
    product = product[:size] * np.uint64(pow(2 * size, -1, PRIME)) % _P
    squares = blocks.astype(np.uint64) ** 2 % _P
    upto = np.concatenate([[0], np.cumsum(squares)]).astype(np.uint64)
    whole = upto[size::size][:count] - upto[0:-1:size][:count]
    at = upto[:-1].reshape(blocks.shape)
    moved = at[2:] - at[1:-1]
    return (whole[None, :] + moved.T) % _P == 2 * product % _P


def seeds(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of blocks that occur at a distance of [size, 2 * size) together with the block behind them."""
    count = len(words) // size
    padded = np.zeros((count + 3) * size, np.int64)
    padded[: len(words)] = words
    blocks = padded.reshape(-1, size)
    step = max(4, CELLS // (2 * size))
    places, distances = [], []
    for k in range(0, count, step):
        last = min(k + step, count)
        hit = occurrences(blocks[k : last + 3])  # one more, for the last one's neighbour
        d, b = np.nonzero(hit[:, :-1] & hit[:, 1:])
        places.append((b + k) * size)
        distances.append(d + size)
    return (np.concatenate(places), np.concatenate(distances)) if places else (np.empty(0, np.int64),) * 2


@functools.lru_cache(maxsize=4096)
def prime_factors(n: int) -> tuple[int, ...]:
    out, k = [], 2
    while k * k <= n:
        if n % k == 0:
            out.append(k)
            while n % k == 0:
                n //= k
        k += 1
    return (*out, n) if n > 1 else tuple(out)


def stretches(words: np.ndarray, period: int, least: int) -> list[tuple[int, int]]:
    """(start, length) of the maximal stretches with that smallest period and at least that length."""
    same = np.zeros(len(words) - period + 2, np.int8)
    same[1:-1] = words[:-period] == words[period:]
    edges = np.flatnonzero(same[1:] != same[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2] + period
    out = []
    for start, length in zip(starts[lengths >= least].tolist(), lengths[lengths >= least].tolist()):
        unit = words[start : start + period]
        if not any(np.array_equal(unit[period // f :], unit[: -(period // f)]) for f in prime_factors(period)):
            out.append((start, length))
    return out


def spent(places: np.ndarray, distances: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which seeds (in the order of places) lie, for a whole distance, in a known run (start, end, period) whose period divides it."""
    out = np.zeros(len(places), bool)
    low, high = np.searchsorted(places, runs[:, 0]), np.searchsorted(places, runs[:, 1])
    n = high - low
    of = np.repeat(np.arange(len(runs)), n)
    seed = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[of]
    hit = (distances[seed] % runs[of, 2] == 0) & (places[seed] + distances[seed] <= runs[of, 1])
    out[seed[hit]] = True
    return out


def runs_of(words: np.ndarray, lengths: np.ndarray, least: int = 6, times: int = 4) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of every run; words of all texts, from 1 up, longest text first."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    found: list[tuple[int, int, int, int]] = []
    known = np.empty((0, 3), np.int64)
    size = 1
    while len(lengths) and lengths[0] >= times * size:
        live = int(np.searchsorted(-lengths, -times * size, side="right"))
        place, distance = seeds(words[: ends[live - 1]], size)
        text = np.searchsorted(ends, place, side="right")
        inside = place + 2 * size + distance <= ends[np.minimum(text, len(ends) - 1)]
        place, distance, text = place[inside], distance[inside], text[inside]
        order = np.argsort(place, kind="stable")
        place, distance, text = place[order], distance[order], text[order]
        left = ~spent(place, distance, known)
        fresh = []
        for t, q in np.unique(np.stack([text[left], distance[left]], axis=1), axis=0).tolist():
            for start, length in stretches(words[begins[t] : ends[t]], q, max(least, times * q)):
                found.append((t, start, length, q))
                fresh.append((begins[t] + start, begins[t] + start + length, q))
        if fresh:
            known = np.concatenate([known, np.array(fresh, np.int64)])
        size *= 2
    return found


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, one after the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, offsets = lists.flatten(), np.asarray(lists.offsets)
    some = np.asarray(pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False), bool)
    upto = np.concatenate([[0], np.cumsum(some)])
    return flat.filter(pa.array(some)), np.diff(upto[offsets - offsets[0]])


def collapsed_texts(texts: pa.Array, least: int = 6, times: int = 4) -> tuple[list[list[tuple[int, int, int]]], pa.Array]:
    """Each text's runs (start, length, period) in order, and its words, joined by a space, without those that only repeat a run's first period."""
    words, lengths = split_words(texts)
    order = np.argsort(-lengths, kind="stable")
    begins = np.cumsum(lengths) - lengths
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    sorted_lengths = lengths[order]
    shift = np.repeat(begins[order] - (np.cumsum(sorted_lengths) - sorted_lengths), sorted_lengths)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    change = np.zeros(len(words) + 1, np.int64)
    for t, start, length, period in runs_of(numbers[np.arange(len(numbers)) + shift], sorted_lengths, least, times):
        k = int(order[t])
        runs[k].append((start, length, period))
        change[begins[k] + start + period] += 1
        change[begins[k] + start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    upto = np.concatenate([[0], np.cumsum(kept)])
    bounds = upto[np.concatenate([begins, [len(words)]])] if len(lengths) else np.zeros(1, np.int64)
    lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words.filter(pa.array(kept)).cast(pa.large_string()))
    for x in runs:
        x.sort(key=lambda r: (r[0], r[2]))
    return runs, pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """One row per row of docs: id, runs (start, length, period, by start, then period), collapsed.

    A run has at least `least` words and `times` periods. collapsed has the words, joined by one space, of
    which no run says that they repeat what stands a period before.
    """
    if times < 4:
        raise ValueError("two neighbouring blocks lie in a run of four periods or more")
    item = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, side="right")))
                part = batch.slice(at, upto - at)
                at = upto
                runs, texts = collapsed_texts(part.column("text"), least, times)
                rows = pa.array([[dict(zip(("start", "length", "period"), r)) for r in x] for x in runs], pa.list_(item))
                yield pa.RecordBatch.from_arrays([part.column("id"), rows, texts.cast(pa.string())], names=["id", "runs", "collapsed"])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
