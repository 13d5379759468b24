"""Spelling variants: words one code point apart, found exactly by pairs of trie nodes.

The prefixes of all words are the nodes of a trie, their suffixes those of the trie of the reversed words; both are
numbered. A word that skips its position i is the pair (prefix node before i, suffix node after i): two words of equal
pairs differ in that position alone. A word with a gap at i is the pair (prefix node, suffix node) that meet there: it
equals the skipping pair of a word with one code point more. So near words are found by joining pairs of whole numbers.

Of a run of equal letters only the first is skipped when looking for gaps, so no two words meet twice. The members of
a pair differ in one code point, so there are at most as many as there are letters: groups are small by construction,
and each is reduced to a count and the best partner of each member, never to all pairs of its members.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from tallywake.llm.common import column_bytes, shuffle_parts, sliced, stored

# Fixed value: letters of a word, in UTF-8 after A-Z went to lower case: a-z and U+00C0 to U+00FF.
RUN = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
BROKEN = 199  # one run in so many loses a code point
LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
GAP, FIRST, LATER = 0, 1, 2  # how a word comes to a pair: with a gap, skipping the first of a run of letters, a later one


def broken(run: bytes, key: int) -> bytes:
    """The run without its code point number key % length (from 0)."""
    letters = run.decode()
    at = key % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def counted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", broken_one_in: int = BROKEN) -> DataFrame:
    """(word, n): every run of letters of the texts with A-Z in lower case, and how often it comes in all of them.

    Where `broken_one_in` divides crc32 of "<doc_id>:<run>" the run is taken without one code point (typing errors
    that are the same at each run of the job). Null texts have no words; a null id counts as an empty one.
    """
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[bytes] = Counter()

        def taken() -> pa.RecordBatch:
            rows = list(sums.items())
            sums.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows], pa.binary()).cast(pa.string()), pa.array([n for _, n in rows], pa.int64())], ["word", "n"])

        for batch in sliced(batches, "text"):
            for own, body in zip(batch.column("id").to_pylist(), column_bytes(batch, "text")):
                before = zlib.crc32(f"{own}:".encode() if own is not None else b":")
                for run, n in Counter(RUN.findall((body or b"").lower())).items():
                    key = zlib.crc32(run, before)
                    sums[broken(run, key) if key % broken_one_in == 0 else run] += n
            if len(sums) > 1 << 18:
                yield taken()
        yield taken()

    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(step, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _common(a: str, b: str) -> int:
    """How many code points two words share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _number(words: Iterator[str], new: Iterator[int]) -> Iterator[list[int]]:
    """The nodes of each word of a sorted list, root left out, numbered as they are first met."""
    last, nodes = "", []
    for word in words:
        same = _common(last, word)
        nodes = nodes[:same] + [next(new) for _ in range(len(word) - same)]
        last = word
        yield nodes


def numbered(words: DataFrame, word: str, nodes: str, rank: str) -> DataFrame:
    """The columns of `words`, `rank` and `nodes`: whole numbers that rise with the word, and the numbers of the trie
    nodes on the way to it, from the root (0).

    Words (each once, not null) are dealt by range and sorted, and a task numbers what a word does not share with the one
    before it. Prefixes that words on both sides of a border of ranges share belong to no range: they are numbered
    first, from the two words at each border. Only those, two a task, go to the driver.
    """
    parts = shuffle_parts(words.sparkSession)
    dealt = stored(words.repartitionByRange(parts, word).withColumn("_part", F.spark_partition_id()), "words-by-range")
    ends = dealt.groupBy("_part").agg(F.min(word).alias("lo"), F.max(word).alias("hi")).orderBy("_part").collect()
    shared = [b["lo"][:_common(a["hi"], b["lo"])] for a, b in zip(ends, ends[1:])]
    known: dict[str, list[int]] = dict(zip(shared, _number(iter(shared), iter(range(-1, -1 - sum(map(len, shared)), -1)))))
    # For each range: the nodes of the borders on its left and right, the longer of the two first.
    border = {r["_part"]: sorted({s for s in shared[max(i - 1, 0):i + 1]}, key=lambda s: (-len(s), s)) for i, r in enumerate(ends)}
    border = {p: [(s, known[s]) for s in found] for p, found in border.items()}
    kept = words.columns
    schema = StructType([*words.schema.fields]).add(rank, "long").add(nodes, ArrayType(LongType()))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, own, new, place = None, "", [], 0, 0
        for batch in batches:
            found, places = [], []
            for number, w in zip(batch.column("_part").to_pylist(), batch.column(word).to_pylist()):
                if number != part:
                    part, last, own, new, place = number, "", [], number << 40, number << 40
                same = _common(last, w)
                own = own[:same]
                for edge, its in border[part]:
                    own += its[len(own):_common(edge, w)]
                fresh = len(w) - len(own)
                own = own + list(range(new + 1, new + 1 + fresh))
                new, place, last = new + fresh, place + 1, w
                places.append(place)
                found.append([0, *own])
            arrays = [*(batch.column(c) for c in kept), pa.array(places, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    ordered = dealt.repartition(parts, "_part").sortWithinPartitions("_part", word)
    return ordered.mapInArrow(step, schema)


def pairs(words: DataFrame) -> DataFrame:
    """(p, s, kind, n, id) of (n, id, word, fore, back): every position of each word skipped, and every gap.

    `fore` and `back` are the nodes of the word's prefixes and, shortest first, of its suffixes.
    """
    size = F.length("word")
    # The nodes of what comes before place i, and of what comes from place i on.
    before, onward = F.col("fore"), F.reverse(F.col("back"))
    own = words.select("id", "n", size.alias("size"), before.alias("before"), onward.alias("onward"), F.split("word", "").alias("letters"))

    def at(column: str, i: Column) -> Column:
        return F.get(column, i)

    skip = F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.struct(
        at("before", i).alias("p"), at("onward", i + 1).alias("s"),
        F.when((i > 0) & (at("letters", i) == at("letters", i - 1)), LATER).otherwise(FIRST).alias("kind")))
    gap = F.transform(F.sequence(F.lit(0), F.col("size")), lambda i: F.struct(
        at("before", i).alias("p"), at("onward", i).alias("s"), F.lit(GAP).alias("kind")))
    return own.select("id", "n", F.explode(F.concat(skip, gap)).alias("c")).select("c.p", "c.s", "c.kind", "n", "id")


def _partners(rows: np.ndarray) -> np.ndarray:
    """(id, partners, best n, best id) for each member of each pair that meets any; rows (p, s, kind, n, id) in whole groups,
    ordered by p, s, whether a gap, falling n, id."""
    p, s, kind, n, own = rows.T
    head = np.r_[True, (np.diff(p) != 0) | (np.diff(s) != 0)]
    found = []

    def best(members: np.ndarray, count: np.ndarray, partner: np.ndarray) -> None:
        if len(members):
            found.append(np.stack([own[members], count, n[partner], own[partner]], axis=1))

    # Words that skip the same place: each has all others, the best of which comes first, or second for the first.
    skips = np.flatnonzero(kind != GAP)
    group = np.cumsum(head) - 1
    starts = np.flatnonzero(np.r_[True, np.diff(group[skips]) != 0]) if len(skips) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(skips)])
    first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    place = np.arange(len(skips))
    some = np.flatnonzero(size > 1)
    best(skips[some], size[some] - 1, skips[np.where(place == first, np.minimum(first + 1, len(skips) - 1), first)[some]])
    # The word with a gap (one at most) meets the words with one code point more.
    gaps, more = np.flatnonzero(kind == GAP), np.flatnonzero(kind == FIRST)
    lo, hi = np.searchsorted(group[more], group[gaps], "left"), np.searchsorted(group[more], group[gaps], "right")
    met = np.flatnonzero(hi > lo)
    best(gaps[met], (hi - lo)[met], more[lo[met]] if len(met) else met)
    where = np.searchsorted(group[gaps], group[more])
    has = np.flatnonzero((where < len(gaps)) & (group[gaps[np.minimum(where, len(gaps) - 1)]] == group[more])) if len(gaps) else where[:0]
    best(more[has], np.ones(len(has), np.int64), gaps[where[has]])
    return np.concatenate(found) if found else np.zeros((0, 4), np.int64)


def near(met: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best) of the words of `pairs` that have near ones; `best` has the largest n, then least id."""
    dealt = met.repartition(shuffle_parts(met.sparkSession), "p", "s").sortWithinPartitions(
        "p", "s", F.col("kind") != GAP, F.desc("n"), "id")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 5), np.int64)  # the last group of a batch may go on in the next

        def record(rows: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in np.ascontiguousarray(_partners(rows).T)], ["id", "count", "n", "best"])

        for batch in batches:
            rows = np.concatenate([held, np.stack([np.asarray(c, np.int64) for c in batch.columns], axis=1)])
            cuts = np.flatnonzero((np.diff(rows[:, :2], axis=0) != 0).any(axis=1))
            ready = cuts[-1] + 1 if len(cuts) else 0
            held = rows[ready:]
            if ready:
                yield record(rows[:ready])
        if len(held):
            yield record(held)

    parts = dealt.mapInArrow(step, "id bigint, count bigint, n bigint, best bigint")
    best = F.max(F.struct("n", (-F.col("best")).alias("minus")))
    return parts.groupBy("id").agg(F.sum("count").alias("n_near"), best.alias("b")).select(
        "id", "n_near", F.col("b.n").alias("best_n"), (-F.col("b.minus")).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(id, root): the last word when following `to` from each id of the links (id, to). No circles.

    Every round joins the links with themselves, so that the way left halves; the longest has as many steps as the
    ratio of forms goes into the largest count.
    """
    way = stored(links.select("id", F.col("to").alias("root")), "ways")
    while True:
        on = way.select(F.col("id").alias("root"), F.col("root").alias("next"))
        further = stored(way.join(on, "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        way = further.drop("moved")
        if further.where("moved").isEmpty():
            return way


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
             least_count: int = LEAST_COUNT, ratio: int = RATIO, broken_one_in: int = BROKEN) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of `least_letters` and `least_count` occurrences.

    Near words differ by one code point inserted, deleted or replaced. The form is the near word of largest n (ties:
    smallest in code-point order) where that is at least `ratio` times n; root follows forms to the last. Null texts,
    empty tables and words without near ones are fine; a row that repeats counts again; other columns are not read.
    """
    words = counted(docs, doc_id, text, broken_one_in).where((F.length("word") >= least_letters) & (F.col("n") >= least_count))
    fore = numbered(words, "word", "fore", "id").withColumn("turned", F.reverse("word"))
    known = stored(numbered(fore, "turned", "back", "other").drop("turned", "other"), "words-numbered")
    found = near(pairs(known)).withColumnRenamed("n_near", "near")
    named = stored(known.select("id", "word", "n").join(found, "id", "left"), "words-near")
    to = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    linked = named.withColumn("to", to)
    ends = roots(linked.where("to IS NOT NULL").select("id", "to"))
    names = named.select("id", "word")
    out = linked.join(ends, "id", "left")
    out = out.join(names.select(F.col("id").alias("to"), F.col("word").alias("form")), "to", "left")
    out = out.join(names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root", "left")
    return out.select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"), F.when(F.col("to").isNotNull(), F.col("best_n")).alias("form_n"))

