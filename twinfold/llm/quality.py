"""Quality rules on repetition coverage.

Words are numbered within their text, and hashes of several n-gram lengths roll over the numbers in
numpy: each length follows from the one below by one multiplication and addition. A word is covered at
length n when it lies in an n-gram that occurs at least twice; coverage weighs words by their characters.
Lines are covered when they repeat an earlier line. A text fails when a coverage exceeds its limit, when
it has too few words, when too many of its words lie in repeated 3-word windows, or when it is mostly
symbols or its words have an implausible mean length.

Texts are taken one by one, whole, in room linear in the text; nothing is shuffled.

Cases: null counts as empty text, which fails for its few words; repeated rows are judged each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.llm.shared import let_go

SYMBOLS = b"#*$%&|<>"
#: Largest shares of characters inside repeated n-grams of each length, and inside repeated lines.
COVERAGE_LIMITS = {4: 0.55, 6: 0.45, 8: 0.40, 10: 0.35}
LINE_LIMIT = 0.35
MIN_WORDS, REPEAT_PERCENT = 50, 50
SYMBOL_LIMIT, MEAN_LENGTH = 0.15, (2.0, 14.0)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def in_repeats(keys: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which of the words lie in a window of n words whose key occurs at least twice."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(words + 1, np.int32)
    starts = np.flatnonzero(twice)
    edges[starts] += 1
    np.subtract.at(edges, starts + n, 1)
    return np.cumsum(edges[:-1]) > 0


def windows_exactly(ids: np.ndarray, distinct: int) -> np.ndarray:
    """Keys of the 3-word windows; equal keys are equal windows."""
    if distinct < 1 << 21:
        return (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    pairs = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)[1]  # distinct < 2^31: no text is as long
    return pairs[:-1] * distinct + ids[2:]


def measure(text: str) -> dict:
    """The counts of the contract and the coverages of one text."""
    data = text.encode()
    words = data.split()  # on ASCII white space
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    spaces = len(data) - len(data.translate(None, b" \t\n\r\x0b\x0c"))
    chars = len(text) - spaces
    seen: set[bytes] = set()
    dup_lines = dup_line_chars = 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            if line in seen:
                dup_lines += 1
                dup_line_chars += len(line.decode())
            else:
                seen.add(line)
    out = {"n_words": len(words), "word_chars": chars, "n_symbols": len(data) - len(data.translate(None, SYMBOLS)), "n_dup_lines": dup_lines, "n_repeat_words": 0, "line_coverage": dup_line_chars / max(1, len(text))}
    out |= {f"coverage_{n}": 0.0 for n in COVERAGE_LIMITS}
    if len(words) < 3:
        return out
    exact = windows_exactly(ids, len(number))
    covered = in_repeats(exact, 3, len(words))
    out["n_repeat_words"] = int(covered.sum())
    if not covered.any():
        return out  # a repeated longer window would hold a repeated window of three
    lengths = np.fromiter((len(w.decode()) for w in number), np.int64, len(number))[ids]
    keys = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    keys ^= keys >> np.uint64(31)
    rolled, total = keys, max(1, int(lengths.sum()))
    for n in range(2, max(COVERAGE_LIMITS) + 1):
        if len(words) < n:
            break
        rolled = rolled[:-1] * _STEP + keys[n - 1 :]
        if n in COVERAGE_LIMITS:
            inside = in_repeats(rolled, n, len(words))
            out[f"coverage_{n}"] = float(lengths[inside].sum() / total)
            if not inside.any():
                break
    return out


def verdict(m: dict) -> tuple[bool, bool, str | None]:
    """(base_failed, kept, reason)."""
    few, repeats = m["n_words"] < MIN_WORDS, 100 * m["n_repeat_words"] > REPEAT_PERCENT * m["n_words"]
    reasons = [("few_words", few), ("repeated_windows", repeats), ("repeated_lines", m["line_coverage"] > LINE_LIMIT)]
    reasons += [(f"coverage_{n}", m[f"coverage_{n}"] > limit) for n, limit in COVERAGE_LIMITS.items()]
    reasons += [("symbols", m["n_symbols"] > SYMBOL_LIMIT * max(1, m["word_chars"])), ("word_length", m["n_words"] > 0 and not MEAN_LENGTH[0] <= m["word_chars"] / m["n_words"] <= MEAN_LENGTH[1])]
    first = next((name for name, hit in reasons if hit), None)
    return few or repeats, first is None, first


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["line_coverage", *(f"coverage_{n}" for n in COVERAGE_LIMITS)]


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, the counts, base_failed, kept, reason and the coverages."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, " + "".join(f"{c} long, " for c in COLUMNS) + "base_failed boolean, kept boolean, reason string, " + ", ".join(f"{c} double" for c in SHARES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            found = [measure(x.as_py() or "") for x in batch.column("text")]
            judged = [verdict(m) for m in found]
            columns = [batch.column("id"), *(pa.array([m[c] for m in found], pa.int64()) for c in COLUMNS)]
            columns += [pa.array([j[k] for j in judged], kind) for k, kind in enumerate((pa.bool_(), pa.bool_(), pa.string()))]
            columns += [pa.array([m[c] for m in found], pa.float64()) for c in SHARES]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *COLUMNS, "base_failed", "kept", "reason", *SHARES])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def keep_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the rows whose text fails; its columns are unchanged."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            yield batch.filter(pa.array([verdict(measure(x.as_py() or ""))[1] for x in batch.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
