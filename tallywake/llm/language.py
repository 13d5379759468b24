"""Language identification by hyperdimensional profiles.

Each character has a random vector of +1 and -1, a function of its code point. An n-gram is bound by multiplying the
vectors of its letters, each permuted (rotated) by its place; a text is the bundle (sum) of its n-grams. A language's
prototype is the bundle of its training texts; a text goes to the prototype of the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywake.llm.common import of_process, sliced, unused

DIMENSIONS = 1024
GRAM = 3
# Bound n-gram vectors a process keeps; it starts anew beyond that, which changes no result.
CACHE = 1 << 15
# Texts whose n-grams are counted together, up to so many n-grams, and columns of the table of counts.
TOGETHER, GRAMS, WIDE = 64, 1 << 20, 4096
# All but letters (Unicode category L).
OTHER = regex.compile(r"\P{L}+")
# Code points fit in so many bits, and three of them in a long.
BITS = 21


class Space:
    """Letter and n-gram vectors."""

    def __init__(self, dimensions: int, gram: int, seed: int = 7) -> None:
        if gram * BITS > 63:
            raise ValueError("n-grams have three letters at most")
        self.dimensions, self.gram, self.seed = dimensions, gram, seed
        self.letters: dict[int, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[int, int] = {}
        self.bound = np.zeros((1024, self.dimensions), np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            bits = np.random.default_rng((self.seed, code)).integers(0, 2, self.dimensions, np.int8)
            self.letters[code] = bits * np.int8(2) - np.int8(1)
        return self.letters[code]

    def _add(self, code: int) -> int:
        row = self.rows[code] = len(self.rows)
        if row == len(self.bound):
            self.bound = np.concatenate([self.bound, np.zeros_like(self.bound)])
        letters = [code >> BITS * (self.gram - 1 - i) & (1 << BITS) - 1 for i in range(self.gram)]
        self.bound[row] = np.prod([np.roll(self.letter(c), i) for i, c in enumerate(letters)], axis=0, dtype=np.int8)
        return row

    def grams(self, text: str | None) -> np.ndarray:
        """The n-grams of a text, in lower case with a space for what is no letter, as numbers; none without letters."""
        plain = OTHER.sub(" ", text.lower()).strip() if text else ""
        if not plain:
            return np.zeros(0, np.int64)
        codes = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        n = len(codes) - self.gram + 1
        return sum(codes[i:i + n] << BITS * (self.gram - 1 - i) for i in range(self.gram)) if n > 0 else codes[:0]

    def bundles(self, texts: list[np.ndarray]) -> np.ndarray:
        """A row for each list of n-grams: the sum of their vectors, counts and all, as whole numbers in float64."""
        of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        wholes, which = np.unique(np.concatenate([*texts, np.zeros(0, np.int64)]), return_inverse=True)
        total = np.zeros((len(texts), self.dimensions))
        for lo in range(0, len(wholes), WIDE):
            if len(self.rows) > CACHE:
                self._clear()
            known, part = self.rows, wholes[lo:lo + WIDE]
            rows = [known[c] if c in known else self._add(c) for c in part.tolist()]
            here = (which >= lo) & (which < lo + WIDE)
            counts = np.bincount(of[here] * len(part) + which[here] - lo, minlength=len(texts) * len(part)).reshape(len(texts), -1)
            # Sums of whole numbers are exact in float32 below 2 ** 24.
            exact = np.float32 if counts.sum(axis=1).max(initial=0) < 1 << 24 else np.float64
            total += counts.astype(exact) @ self.bound[rows].astype(exact, copy=False)
        return total


def _space(dimensions: int, gram: int) -> Space:
    return of_process(("space", dimensions, gram), lambda: Space(dimensions, gram))


def _lots(texts: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    lot: list[np.ndarray] = []
    for codes in texts:
        if lot and (len(lot) == TOGETHER or sum(map(len, lot)) + len(codes) > GRAMS):
            yield lot
            lot = []
        lot.append(codes)
    if lot:
        yield lot


def prototypes(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The bundle of every language of the documents. Rows with null text or language teach nothing, repeated rows again;
    an empty table has no language.

    Tasks count the n-grams of a language over what they read and bundle them once, the partial bundles are added on Spark;
    the driver gets one vector per language, as the tasks that predict do after it.
    """
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = _space(dimensions, gram), {}
        for batch in sliced(batches, "text"):
            met: dict[str, list[np.ndarray]] = {}
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                met.setdefault(name, []).append(space.grams(body))
            for name, codes in met.items():
                found = space.bundles([np.concatenate(codes)])[0].astype(np.int64)
                sums[name] = sums[name] + found if name in sums else found
        for name, total in sums.items():
            if total.any():
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([total.tolist()], pa.list_(pa.int64()))], ["lang", "sums"])

    parts = rows.mapInArrow(step, "lang string, sums array<bigint>").select("lang", F.posexplode("sums").alias("at", "n"))
    added = parts.groupBy("lang", "at").agg(F.sum("n").alias("n")).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("at", "n"))).alias("sums"))
    return {r["lang"]: np.array([s["n"] for s in r["sums"]], np.float64) for r in added.collect()}


def predict(docs: DataFrame, known: dict[str, np.ndarray], text: str = "text", dimensions: int = DIMENSIONS, gram: int = GRAM) -> DataFrame:
    """The columns of `docs` and `lang_pred`, `score` (cosine, 0 to 1; columns of these names are replaced).

    `und` with score 0 where the text is null or has no letter, or no language is known. Ties go by name, repeated rows
    are alike, an empty table gives an empty one. No shuffle.
    """
    names = sorted(known)
    table = np.stack([known[n] / (np.linalg.norm(known[n]) or 1.0) for n in names]) if names else np.zeros((0, dimensions))
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    own = unused("_text", keep)
    source = docs.select(*keep, F.col(text).alias(own))
    schema = StructType([*source.schema.fields[:-1]]).add("lang_pred", "string").add("score", "double")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = _space(dimensions, gram)
        for batch in sliced(batches, own):
            labels, scores = [], []
            for lot in _lots(space.grams(body) for body in batch.column(own).to_pylist()):
                found = space.bundles(lot if names else [])
                cosines = found @ table.T / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1.0)
                for i, codes in enumerate(lot):
                    best = int(np.argmax(cosines[i])) if names and len(codes) else -1
                    labels.append(names[best] if best >= 0 else "und")
                    scores.append(float(np.clip(cosines[i, best], 0.0, 1.0)) if best >= 0 else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(labels, pa.string()), pa.array(scores, pa.float64())], schema.names)

    return source.mapInArrow(step, schema)
