"""Benchmark passages in documents, by one Aho-Corasick automaton over windows of the items' words.

Texts are normalised to their words (A-Z in lower case, ASCII digits and letters and all beyond ASCII), one space
between, and scanned once; word numbers map a match to the words and to characters of the original.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywake.llm.common import column_bytes, unused

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
# Bytes of item text that one automaton takes. More items are dealt to several, each applied to all documents.
AUTOMATON_BYTES = 16 << 20


def windows(text: bytes | None, width: int) -> set[bytes]:
    """Every run of `width` words, spaces around and between; a shorter text is one window, one without words none."""
    words = WORD.findall(text.lower()) if text else []
    return {b" %s " % b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def automaton(items: list[tuple[str, bytes | None]], width: int):
    import ahocorasick

    found: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows(text, width):
            found.setdefault(window, set()).add(item)
    built = ahocorasick.Automaton()
    for window, names in found.items():
        # One character for each byte, so that places count bytes.
        built.add_word(window.decode("latin-1"), (window.count(b" ") - 1, tuple(names)))
    built.make_automaton()
    return built if found else None


def scan(built, text: bytes | None) -> tuple[int, np.ndarray, set[str]]:
    """(words, which of them are hit, items) of a text."""
    words = WORD.findall(text.lower()) if text else []
    steps, items = np.zeros(len(words) + 1, np.int64), set()
    if words and built is not None:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # place of the space after a word
        for at, (n, names) in built.iter((b" %s " % b" ".join(words)).decode("latin-1")):
            last = int(np.searchsorted(ends, at))
            steps[last + 1 - n] += 1
            steps[last + 1] -= 1
            items.update(names)
    return len(words), np.cumsum(steps)[:-1] > 0, items


def spans(text: bytes, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as character ranges of the original text."""
    edges = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    places = [m.span() for m in WORD.finditer(text.lower())]
    chars = np.r_[0, np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)]
    return [{"start": int(chars[places[a][0]]), "end": int(chars[places[b - 1][1]])} for a, b in zip(edges[::2], edges[1::2])]


def find(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
         width: int = 10) -> DataFrame:
    """The columns of `docs` and `leak` (a column of this name is replaced): n_words, hit_words (their numbers), items (sorted
    strings), spans.

    No shuffle. Null and empty texts have no words, repeated rows are alike, empty tables give no rows or no hits. An item with a null id counts as the item ''. Rows with equal item ids are
    one item. Items beyond AUTOMATON_BYTES go to further automata, so no limit is set on the benchmark.
    """
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text"))
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // AUTOMATON_BYTES + 1
    leak = "struct<n_words:bigint,hit_words:array<int>,items:array<string>,spans:array<struct<start:bigint,end:bigint>>>"
    names = [c for c in docs.columns if c != "leak"]
    body = unused("_text", names)
    found = docs.select(*names, F.lit(None).cast(leak).alias("leak"), F.col(text).alias(body))
    schema = StructType(found.schema.fields)
    for part in range(parts):
        own = named.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part) if parts > 1 else named
        rows = [(r["item"], r["text"].encode() if r["text"] is not None else None) for r in own.toLocalIterator()]
        found = found.mapInArrow(_step(docs.sparkSession.sparkContext.broadcast(rows), width, body), schema)
    return found.drop(body)


def _step(items, width: int, body: str):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = automaton(items.value, width)
        for batch in batches:
            rows = []
            for text, before in zip(column_bytes(batch, body), batch.column("leak").to_pylist()):
                n, hit, names = scan(built, text)
                if before:
                    hit[before["hit_words"]] = True
                    names |= set(before["items"])
                rows.append({"n_words": n, "hit_words": np.flatnonzero(hit).tolist(), "items": sorted(names),
                             "spans": spans(text, hit) if hit.any() else []})
            at = batch.schema.get_field_index("leak")
            yield batch.set_column(at, batch.schema.field(at), pa.array(rows, batch.schema.field(at).type))
    return step


def clean(docs: DataFrame, items: DataFrame, text: str = "text", width: int = 10) -> DataFrame:
    """The documents in which no window of an item occurs, with their columns."""
    found = find(docs.withColumn("_row", F.struct(*docs.columns)).select("_row", F.col(text).alias("text")), items, width=width)
    return found.where(F.size("leak.hit_words") == 0).select("_row.*")
