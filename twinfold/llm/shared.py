"""What the training-data operators share: scratch tables, words, ASCII lower case, what a worker keeps."""

from __future__ import annotations

import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.sources.scratch import new_path, scratch_dir, stored

__all__ = ["LOWER", "UPPER", "WORD", "free_name", "kept_tables", "let_go", "lower_az", "new_path", "read_table", "scratch_dir", "stored"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word, everywhere in this subpackage: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def lower_az(text: Column) -> Column:
    """text with A-Z in lower case and nothing else changed; ASCII texts take the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def free_name(table: DataFrame, name: str) -> str:
    """name, lengthened until no column of the table has it, whatever the case."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What this Python worker keeps from one task to the next, by the names of its makers.
_KEPT: dict[tuple, object] = {}


def kept_tables(key: tuple, make: Callable[[], object]) -> object:
    """What make returns, once for all tasks of a worker that ask for the key one after the other; one key's at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Frees what tasks of other operators have left in this worker: workers outlive the stages."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
