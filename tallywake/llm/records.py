"""Token ids as length-delimited binary records with a separate offset index.

A data file is a run of records, all numbers little-endian:

    length u64 | masked checksum of those 8 bytes u32 | payload | masked checksum of the payload u32

The payload is the ids, as u16 where all ids of the vocabulary fit (which halves the files), else as u32; the index says which.
A checksum is CRC-32 (zlib), masked as rotate-right-15 plus 0xA282EAD8, so that
checksums of data that holds checksums stay useful. The index is a Parquet table with one row per record: key, data
file, byte offset of the record, part and place in the order of keys. It names the file that the successful attempt
of a task wrote; files of failed attempts are never read. Records can be read in any order by their offsets.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallywake.llm.common import shared_folder, shuffle_parts
from tallywake.llm.tokens import encoded

MASK = 0xA282EAD8  # fixed value of the masking


def masked(data: bytes) -> int:
    value = zlib.crc32(data)
    return ((value >> 15 | value << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def unframe(read, at: int) -> bytes:
    """The payload of the record at an offset; `read(at, n)` gives bytes. Raises ValueError on any damage."""
    head = read(at, 12)
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError(f"damaged length at {at}")
    n = struct.unpack("<Q", head[:8])[0]
    body = read(at + 12, n + 4)
    if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked(body[:n]):
        raise ValueError(f"damaged record at {at}")
    return body[:n]


def id_width(vocab: str, end: int) -> int:
    """Bytes that an id of the vocabulary takes."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(vocab).get_vocab(with_added_tokens=True).values(), default=0) < 1 << 16 > end else 4


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if ":" in path else f"file://{path}")


def write(docs: DataFrame, folder: str, vocab: str, key: str = "doc_id", text: str = "text", end: int = 2) -> DataFrame:
    """Write the records below `folder` in ascending order of `key` and return the stored index.

    Index: key, file, offset (bytes), part, place (ids before it in its part), n_ids, width (bytes of an id). Null texts are empty texts, a
    null key comes first, rows of equal key go by the hash of the text. An empty table gives an empty index.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    # By range, so that parts and the rows in them are in order of the key.
    dealt = rows.repartitionByRange(shuffle_parts(docs.sparkSession), "key", "tie").sortWithinPartitions("key", "tie")
    schema = StructType([StructField("key", rows.schema["key"].dataType)]).add("file", "string")
    for name in ("offset", "part", "place", "n_ids", "width"):
        schema.add(StructField(name, LongType()))
    width = id_width(vocab, end)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/data/part-{part:06d}-{uuid.uuid4().hex}.rec"
        disk, local = _place(path)
        disk.create_dir(local.rsplit("/", 1)[0], recursive=True)
        at = place = 0
        with disk.open_output_stream(local) as out:
            for batch, ids in encoded(batches, "text", vocab, end):
                offsets, places, sizes = [], [], []
                for own in ids:
                    record = frame(own.astype(f"<u{width}").tobytes())
                    offsets.append(at), places.append(place), sizes.append(len(own))
                    out.write(record)
                    at, place = at + len(record), place + len(own)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array([path] * n, pa.string()), *(pa.array(c, pa.int64()) for c in (
                        offsets, [part] * n, places, sizes, [width] * n))], schema.names)

    index = f"{folder}/index"
    dealt.mapInArrow(step, schema).write.parquet(index)
    return docs.sparkSession.read.schema(schema).parquet(index)


def _read(index: DataFrame, columns: list[tuple[str, str, pa.DataType]], give: Callable[[bytes], tuple]) -> DataFrame:
    """The columns of the index and what `give` makes of the ids (as u32, whatever the file has) of each record, which is read
    at its offset and checked."""
    schema = StructType([*index.schema.fields])
    for name, kind, _ in columns:
        schema.add(name, kind)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch, found = whole.slice(lo, 256), []
                for path, at, width in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "width"))):
                    if path != name:
                        disk, local = _place(path)
                        name, source = path, disk.open_input_file(local)
                    payload = unframe(lambda start, n: source.read_at(n, start), at)
                    found.append(give(np.frombuffer(payload, f"<u{width}").astype("<u4").tobytes()))
                more = [pa.array([f[i] for f in found], kind) for i, (_, _, kind) in enumerate(columns)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], schema.names)

    return index.mapInArrow(step, schema)


def read(index: DataFrame) -> DataFrame:
    """The columns of the index and `ids` of every record, binary, as u32."""
    return _read(index, [("ids", "binary", pa.binary())], lambda ids: (ids,))


def checksums(index: DataFrame) -> DataFrame:
    """The columns of the index, `n_tokens` and `ids_crc32` (CRC-32 of the ids as u32) of every record, from the files."""
    columns = [("n_tokens", "long", pa.int64()), ("ids_crc32", "long", pa.int64())]
    return _read(index, columns, lambda ids: (len(ids) // 4, zlib.crc32(ids)))


def starts(index: DataFrame) -> DataFrame:
    """The index with `start`: ids of all records before it. Only one row per part, not per record, is ordered."""
    totals = {r["part"]: r["n"] for r in index.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before = np.cumsum([0, *(totals[p] for p in sorted(totals))]).tolist()
    rows = list(zip(sorted(totals), before))
    parts = index.sparkSession.createDataFrame(rows, "part bigint, before bigint")
    return index.join(parts, "part").withColumn("start", F.col("before") + F.col("place")).drop("before")


def token_file(docs: DataFrame, vocab: str, end: int = 2) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files read back."""
    index = starts(write(docs, shared_folder(docs.sparkSession, "records"), vocab, end=end))
    return checksums(index).select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")
