"""Passages of several lines that repeat across documents, removed but for their first occurrence.

Chunks of lines are compared, in three families that all depend on the content alone, so text put in before a
passage does not shift its chunks:

* content-defined: a boundary follows each line where the rolling hash over the hashes of the last two lines is 0
  modulo `modulus`; a chunk is what lies between boundaries;
* runs onward: from each line the shortest run of lines with `min_words` words;
* runs back: up to each line the shortest such run.

Boundaries alone would miss what a repeated passage has before its first and after its last boundary; the runs
take in these margins, and passages of a single long line. A chunk counts if it has `min_words` words. Chunks are
equal if the hashes of their lines are; the lines are compared byte by byte, and a chunk with a line whose hash
two different lines share is left alone. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywake.llm.common import SPACE, stored

MIN_WORDS = 50
MODULUS = 8
# Lines that are looked at for the words of a run: so many first, and four times as many while they hold too few.
REACH = 16
LOOKS = 12


def _words(line: Column) -> Column:
    """How many words: the parts between runs of white space, none of them empty once the ends are cut off."""
    own = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(own == "", 0).otherwise(F.size(F.split(own, f"{SPACE}+")))


def _numbers(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _among(counts: Column, min_words: int) -> Column:
    """Of the counts, how many it takes to reach min_words; null if all don't."""
    state = F.aggregate(
        counts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("words")),
        lambda s, c: F.when(s["words"] >= min_words, s).otherwise(
            F.struct((s["n"] + 1).alias("n"), (s["words"] + c).alias("words"))))
    return F.when(state["words"] >= min_words, state["n"])


def _shortest(counts: Callable[[int], Column], there: Column, min_words: int, reach: int) -> Column:
    """How many lines it takes to reach min_words, `counts` giving the words of so many lines; null if all that are `there`
    don't. The next look, at four times as many lines, is taken where the one before was too short."""
    looks = [_among(counts(reach), min_words)]
    for look in range(1, LOOKS):
        looks.append(F.when(there > reach * 4 ** (look - 1), _among(counts(reach * 4 ** look), min_words)))
    return F.coalesce(*looks)


def chunks(docs: DataFrame, min_words: int = MIN_WORDS, modulus: int = MODULUS, reach: int = REACH) -> DataFrame:
    """(_id, _print, start, hashes) of every chunk of the documents (_id, _print, text): its first line and the
    hashes of its lines. No shuffle."""
    lined = docs.select("_id", "_print", F.split("text", "\n").alias("lines"))
    hashed = lined.select(
        "_id", "_print", F.transform("lines", lambda x: F.xxhash64(x)).alias("hs"),
        F.transform("lines", _words).alias("ws"))
    n = F.size("hs")
    starts = F.filter(_numbers(n), lambda i: (i == 0) | (
        (i >= 2) & (F.pmod(F.xxhash64(F.get("hs", i - 2), F.get("hs", i - 1)), F.lit(modulus)) == 0)))
    cut = hashed.withColumn("starts", starts)
    spans = F.transform("starts", lambda at, k: F.struct(
        at.alias("start"), (F.coalesce(F.get("starts", k + 1), n) - at).alias("n")))
    defined = F.filter(spans, lambda s: F.aggregate(
        F.slice("ws", s["start"] + 1, s["n"]), F.lit(0), lambda a, w: a + w) >= min_words)
    onward = F.transform(_numbers(n), lambda i: F.struct(
        i.alias("start"), F.when(F.get("ws", i) > 0, _shortest(lambda most: F.slice("ws", i + 1, most), n - i, min_words, reach)).alias("n")))
    back = F.transform(_numbers(n), lambda i: F.when(F.get("ws", i) > 0, _shortest(lambda most: F.reverse(
        F.slice("ws", F.greatest(i + 2 - most, F.lit(1)), F.least(i + 1, F.lit(most)))), i + 1, min_words, reach)))
    backward = F.transform(back, lambda m, i: F.struct((i + 1 - m).alias("start"), m.alias("n")))
    runs = F.filter(F.concat(onward, backward), lambda s: s["n"].isNotNull())
    found = cut.select("_id", "_print", "hs", F.explode(F.array_distinct(F.concat(defined, runs))).alias("c"))
    return found.select("_id", "_print", F.col("c.start").alias("start"), F.slice("hs", F.col("c.start") + 1, F.col("c.n")).alias("hashes"))


def _sure(repeated: DataFrame, docs: DataFrame) -> DataFrame:
    """Without the chunks that hold a line hash which different lines share."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).select(F.xxhash64("line").alias("h"), "line").distinct()
    shared = stored(lines.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "shared-hashes")
    if shared.isEmpty():
        return repeated
    unsure = repeated.select("hashes", F.explode("hashes").alias("h")).join(shared, "h").select("hashes")
    return stored(repeated.join(unsure, "hashes", "left_anti"), "sure-chunks")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
          modulus: int = MODULUS, reach: int = REACH, removed: str | None = None) -> DataFrame:
    """The rows and columns of `docs`, their texts without repeated passages.

    Every line goes that lies in a later occurrence of a chunk. Occurrences go by doc_id (null first), hash of the
    text, line; the first stays. Passages that repeat inside a document count too. A null text stays null, a text
    that loses all lines becomes empty. `removed` names a further column for the numbers of removed lines.
    """
    own = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_print"), F.col(text).alias("text")).where("text IS NOT NULL")
    found = chunks(own, min_words, modulus, reach)
    place = F.struct("_id", "_print", "start")
    repeated = stored(found.groupBy("hashes").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(
        "first <> last").select("hashes", "first"), "repeated-chunks")
    later = found.join(_sure(repeated, own), "hashes").where(place != F.col("first"))
    drops = later.select("_id", "_print", F.struct("start", F.size("hashes").alias("n")).alias("range")).groupBy(
        "_id", "_print").agg(F.collect_set("range").alias("_ranges"))
    names = docs.columns
    whole = docs.join(drops, docs[doc_id].eqNullSafe(drops["_id"]) & (F.xxhash64(docs[text]) == drops["_print"]), "left")
    ranges = F.coalesce(drops["_ranges"], F.array().cast("array<struct<start:int,n:int>>"))
    gone = F.array_distinct(F.flatten(F.transform(ranges, lambda r: F.sequence(r["start"], r["start"] + r["n"] - 1))))
    # Two steps: what a lambda uses should be a column, or it is worked out again for each element.
    split = whole.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[text].alias("text"), F.split(docs[text], "\n").alias("lines"), gone.alias("gone"))
    kept = F.array_join(F.transform(F.array_except(_numbers(F.size("lines")), "gone"), lambda i: F.get("lines", i)), "\n")
    cleaned = F.when(F.size("gone") == 0, F.col("text")).otherwise(kept)
    more = [F.array_sort("gone").alias(removed)] if removed else []
    return split.select(*[cleaned.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in names], *more)
