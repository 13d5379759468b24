"""Helpers the operators share: scratch tables, words as bytes, batches of bounded size."""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count
from types import ModuleType
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tallywake.session import shared_folder, stored  # noqa: F401  for the operators

T = TypeVar("T")

# White space of the word pattern [^\x20\x09-\x0D]+, as a class of a regular expression.
SPACE = r"[ \t-\r]"


def shuffle_parts(spark: SparkSession) -> int:
    """Partitions of a shuffle as set by spark.sql.shuffle.partitions, which is sized to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_of(doc_id: str, divisor: int) -> Column:
    """crc32(doc_id as text) mod divisor; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(divisor)).cast("int")


def of_process(key: tuple, make: Callable[[], T]) -> T:
    """What `make` gives, made once in a worker process and kept for the tasks after, which get this module anew."""
    kept = sys.modules.setdefault("tallywake_kept", ModuleType("tallywake_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def unused(name: str, names: list[str]) -> str:
    """`name`, or with a number where the names have it already (in any case)."""
    taken = {n.lower() for n in names}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(len(names) + 1))) if n.lower() not in taken)


def words_of(text: bytes | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of a text in UTF-8, A-Z in lower case. bytes.split and bytes.lower are just that."""
    return text.lower().split() if text else []


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes, not decoded."""
    column = batch.column(name)
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def sliced(batches: Iterable[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `most` bytes of the column, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


class Numbers:
    """Numbers for words as they come: 0, 1, 2, ..."""

    def __init__(self) -> None:
        self.of: defaultdict[bytes, int] = defaultdict(count().__next__)

    def __call__(self, words: list[bytes]) -> Iterator[int]:
        return map(self.of.__getitem__, words)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """XXH64 of every word, by number."""
        return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.of), np.uint64, len(self.of))
