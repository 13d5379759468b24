"""Secrets in texts: fixed patterns, and strings that stay novel to a primed compressor.

A candidate is a run of token characters after a word such as "key" or "token". Its novelty is the bytes it adds to a zstandard
frame primed with a dictionary: identifiers of code, then the text around it. What is made of known parts adds little; what
adds nearly as many bytes as it has is reported. The identifiers are learnt from the table itself: the most frequent words of
its lines that look like code, up to the size of the dictionary.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tallywake.llm.common import column_bytes, unused

# The three kinds of the base, in their order.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "novel")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.:~!@%-]{8,}")
CONTEXT = re.compile(r"key|token|secret|passw|auth|credential|bearer|private|pwd", re.IGNORECASE | re.ASCII)
# Characters between a context word and the candidate at most, on both sides that prime the compressor, and the bytes of the
# dictionary.
NEAR, AROUND, DICTIONARY = 40, 512, 1 << 14
# A line looks like code if it has two signs of these.
SIGNS = b"{}();=<>[]"
NO_SIGNS = bytes(set(range(256)) - set(SIGNS))
IDENTIFIER = re.compile(rb"[A-Za-z_][A-Za-z0-9_]{2,40}")


def code_lines(body: bytes) -> list[bytes]:
    """The lines that look like code; one pass over the text, however long its lines are."""
    if len(body.translate(None, NO_SIGNS)) < 2:
        return []
    return [line for line in body.split(b"\n") if len(line.translate(None, NO_SIGNS)) >= 2]


def identifiers(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> bytes:
    """The most frequent identifiers of the code-like lines of all texts, the most frequent last, up to `size` bytes.

    Each task adds up what it reads; the driver gets as many rows as fit. Words with digits in them are no identifiers here: they
    are what secrets look like. Ties go by the word; an empty table or one without code gives none.
    """
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[bytes] = Counter()

        def taken() -> pa.RecordBatch:
            rows = list(sums.items())
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

        for batch in batches:
            for body in column_bytes(batch, "text"):
                for line in code_lines(body or b""):
                    sums.update(w for w in IDENTIFIER.findall(line) if w.translate(None, b"0123456789") == w)
            if len(sums) > 1 << 18:
                yield taken()
        yield taken()

    counted = docs.select(F.col(text).alias("text")).mapInArrow(step, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    kept, left = [], size
    for row in counted.where("n > 1").orderBy(F.desc("n"), "word").limit(size // 4).collect():
        left -= len(row["word"]) + 1
        if left < 0:
            break
        kept.append(row["word"])
    return " ".join(reversed(kept)).encode()


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the patterns, leftmost and not overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found)


def novelty(text: str, start: int, end: int, known: bytes, around: int = AROUND) -> float:
    """Bytes that the whole candidate adds per byte of it, given identifiers and what is around it."""
    import zstandard

    near = (text[end:end + around] + "\n" + text[max(0, start - around):start]).encode("utf-8", "replace")
    primed = zstandard.ZstdCompressionDict(b"\n".join((known, near)).rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    params = zstandard.ZstdCompressionParameters.from_level(3, write_content_size=0, write_checksum=0, write_dict_id=0)
    lead, own = near[-64:], text[start:end].encode()

    def size(data: bytes) -> int:
        return len(zstandard.ZstdCompressor(dict_data=primed, compression_params=params).compress(data))

    return (size(lead + own) - size(lead)) / len(own)


def _mixed(own: str) -> bool:
    """Whether digits and letters change over as often as they hardly do in a word with a number to it."""
    kinds = [c.isdigit() for c in own if c.isalnum()]
    return sum(a != b for a, b in zip(kinds, kinds[1:])) >= 4


def novel(text: str, least: float, base_spans: list[tuple[int, int, int]], known: bytes, near: int = NEAR,
          around: int = AROUND) -> list[tuple[int, int, int]]:
    """Further spans: candidates of mixed digits and letters, after a context word, that do not compress. Those that touch a base
    span add nothing. One pass over the text for words and one for candidates."""
    ends = [hit.end() for hit in CONTEXT.finditer(text)]
    if not ends:
        return []
    found, at = [], 0
    spans = sorted((s, e) for s, _, e in base_spans)
    reach = 0  # the furthest end of the base spans that start before the candidate's end
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(spans) and spans[at][0] < end:
            reach = max(reach, spans[at][1])
            at += 1
        # The last context word that ends at the candidate's start or before.
        i = bisect_right(ends, start) - 1
        if i < 0 or start - ends[i] > near or reach > start:
            continue
        if _mixed(m.group()) and novelty(text, start, end, known, around) >= least:
            found.append((start, 3, end))
    return found


def scan(docs: DataFrame, text: str = "text", least_novelty: float = 0.7, known: bytes | None = None, near: int = NEAR,
         around: int = AROUND) -> DataFrame:
    """The columns of `docs` and `secrets` (a column of this name is replaced): an array of (kind, start, end), by start, then
    kind.

    Places are code points, ends exclusive. `known` are identifiers; left out, they are learnt from the texts. Null and empty
    texts have no secrets, repeated rows the same, an empty table gives an empty one. No text is shuffled.
    """
    names = [c for c in docs.columns if c != "secrets"]
    body_column = unused("_text", names)
    words = identifiers(docs, text) if known is None else known
    source = docs.select(*names, F.col(text).alias(body_column))
    schema = StructType([*source.schema.fields[:-1]]).add(
        "secrets", ArrayType(StructType().add("kind", "string").add("start", "long").add("end", "long")))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for body in batch.column(body_column).to_pylist():
                fixed = base(body) if body else []
                spans = sorted(fixed + novel(body, least_novelty, fixed, words, near, around)) if body else []
                rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(rows, kind)], schema.names)

    return source.mapInArrow(step, schema)
