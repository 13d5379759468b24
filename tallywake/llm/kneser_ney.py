"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is one of words: the pair of a word and the word before, then the word alone by how many words it comes after, then the
word's letters. Counts of pairs are sharded by word; sums of the words before are joined with the texts that ask for them. A
task numbers the words of some thousand texts (a unit) and asks once for each pair there; texts meet their answers by unit.

The letters of a word are n-grams of symbols: bytes in 64 classes (letters of either case, digits, white space, frequent signs, the rest by
their number). Their model of order 4 has at most 64 ** 4 n-grams whatever the corpus, 64 MB of probabilities, and is in
every task. Counts are summed on Spark, sharded by n-gram; each order's
continuation counts come from the order above; from the lowest order up, the counts of an order, sharded by context, are joined
with the probabilities of the order below.

A text is rejected if its perplexity is above a quantile of its language, which is taken from trusted texts that the model has
not seen. A short text says little about itself: an allowance that falls with the root of its length is taken off.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallywake.llm.common import column_bytes, shuffle_parts, sliced, split_of, stored, unused
from tallywake.llm.pitman_yor import END, Unit, _flat, _lists, _moved, _names, unit_of

SYMBOLS, ORDER = 64, 4
SPACE_SYMBOL, LINE_SYMBOL = 28, 29
QUANTILE = 0.995
# Natural logarithms by which a text of one symbol may be above its threshold; for n symbols over the root of n.
ALLOWANCE = 2.0
# Bytes of text of a unit.
UNIT = 16 << 20
# A pair's hash is word * PAIR + context in 64 bits.
PAIR = np.int64(-7046029254386353131)
END_HASH = np.array([xxhash.xxh64_intdigest(END)], np.uint64).view(np.int64)[0]
ASKS = ("share int, unit bigint, learn boolean, locals array<int>, words array<bigint>, sizes array<int>, pairs array<bigint>, "
        "contexts array<bigint>, ns array<int>")
FOUND = ("unit bigint, share int, places array<int>, ns array<bigint>, words array<bigint>, locals array<int>, afters array<bigint>, "
         "contexts array<bigint>, totals array<bigint>, ones array<bigint>, twos array<bigint>, more array<bigint>, rates array<bigint>")


def _classes() -> np.ndarray:
    """The symbol of each byte; 0 is no byte's."""
    found = np.zeros(256, np.uint8)
    for byte in range(256):
        char = chr(byte)
        if byte >= 128:
            found[byte] = 40 + byte % 24
        elif char.isalpha():
            found[byte] = ord(char.lower()) - ord("a") + 1
        elif char.isdigit():
            found[byte] = 27
        elif char in " \t\r\v\f":
            found[byte] = SPACE_SYMBOL
        else:
            found[byte] = {"\n": LINE_SYMBOL, ".": 30, ",": 31}.get(char, 32 + byte % 8)
    return found


@dataclass(frozen=True)
class Model:
    """Natural log probabilities of the last symbol: `logs` has a row of 64 for every context of two symbols, then for each
    context of three that was seen; `row` gives the row of a context of three. In all tasks as `shared`."""

    shared: Broadcast[tuple[np.ndarray, np.ndarray]]
    n_symbols: int

    @property
    def logs(self) -> np.ndarray:
        """For all n-grams, as numbers of base 64."""
        row, logs = self.shared.value
        return logs[row].ravel()


def grams(texts: list[bytes | None], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of the texts as one run, the length of each text, and which bytes are no white space.
    Before a text there is white space."""
    sizes = np.fromiter((len(t or b"") for t in texts), np.int64, len(texts))
    own = classes[np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)]
    starts = np.cumsum(sizes) - sizes
    found = own.astype(np.int32)
    for back in range(1, ORDER):
        before = np.full(len(own), SPACE_SYMBOL, np.int32)
        before[back:] = own[:-back]
        for i in range(back):
            before[(starts + i)[sizes > i]] = SPACE_SYMBOL
        found += before * np.int32(SYMBOLS ** back)
    return found, sizes, (own != SPACE_SYMBOL) & (own != LINE_SYMBOL)


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n) over all texts. A task adds up what it reads; null texts have none."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, total = _classes(), np.zeros(SYMBOLS ** ORDER, np.int64)
        for batch in sliced(batches, "text", 4 << 20):
            met, n = np.unique(grams(column_bytes(batch, "text"), classes)[0], return_counts=True)
            total[met] += n
        met = np.flatnonzero(total)
        for lo in range(0, len(met), 1 << 16):
            some = met[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(step, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(of_counts: dict[int, int]) -> np.ndarray:
    """What is taken off a count of 0, 1, 2, 3 or more, after how many n-grams have counts of one to four."""
    n1, n2, n3, n4 = (of_counts.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    rate = [i - (i + 1) * y * more / some if some else 0.5 for i, some, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(r, 0.05), i - 0.05) for i, r in enumerate(rate, 1))])


def interpolated(seen: np.ndarray, lower: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Probabilities of rows of counts: each context's own share, and what the discounts free given to the lower order."""
    off = cut[np.minimum(seen, 3)]
    total = np.maximum(seen.sum(axis=1, keepdims=True), 1)
    freed = np.where(seen.any(axis=1, keepdims=True), off.sum(axis=1, keepdims=True) / total, 1.0)
    return (seen - off) / total + freed * lower


def joined(level: DataFrame, lower: DataFrame, order: int, cut: np.ndarray, every: bool) -> DataFrame:
    """(context, shares): the 64 probabilities after each context of an order, by a join of counts: the counts (gram, n) of a context,
    which are a shard of the order's, meet the probabilities `lower` of the order below, by the context less its first symbol.
    `every` context, or those that were seen."""
    spark = level.sparkSession
    last = F.struct((F.col("gram") % SYMBOLS).alias("last"), "n")
    rows = level.groupBy(F.expr(f"gram div {SYMBOLS}").alias("context")).agg(F.collect_list(last).alias("own"))
    if every:
        rows = spark.range(SYMBOLS ** (order - 1)).select(F.col("id").alias("context")).hint("merge").join(rows, "context", "left")
    below = lower.select(F.col("context").alias("_suffix"), F.col("shares").alias("below")).hint("merge")
    met = rows.withColumn("_suffix", F.col("context") % SYMBOLS ** max(order - 2, 0)).join(below, "_suffix")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, own = np.zeros((batch.num_rows, SYMBOLS), np.int64), batch.column("own")
            at = np.repeat(np.arange(batch.num_rows), own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            seen[at, own.flatten().field("last").to_numpy()] = own.flatten().field("n").to_numpy()
            found = interpolated(seen, batch.column("below").flatten().to_numpy().reshape(-1, SYMBOLS), cut)
            ends = pa.array(np.arange(0, found.size + 1, SYMBOLS), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("context"), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))], ["context", "shares"])

    return met.select("context", "own", "below").mapInArrow(step, "context bigint, shares array<double>")


def train(docs: DataFrame, text: str = "text") -> Model:
    """The model of all texts given, counted as often as they come. With no text all symbols are equally likely."""
    spark = docs.sparkSession
    top = counts(docs, text).persist()
    try:
        n_symbols = top.agg(F.sum("n")).first()[0] or 0
        # Orders below the highest count the different symbols seen before an n-gram.
        levels = {ORDER: top}
        for order in range(ORDER - 1, 0, -1):
            levels[order] = levels[order + 1].groupBy((F.col("gram") % SYMBOLS ** order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        shares = spark.range(1).select(F.col("id").alias("context"), F.array_repeat(F.lit(1 / SYMBOLS), SYMBOLS).alias("shares"))
        for order in range(1, ORDER + 1):
            of_counts = {r["n"]: r["count"] for r in levels[order].where("n <= 4").groupBy("n").count().collect()}
            lower, shares = shares, joined(levels[order], shares, order, discounts(of_counts), every=order < ORDER)
        # The two tables that a text is looked up in, at most 64 ** 2 and 64 ** 3 rows whatever the corpus.
        known, found = (df.toArrow().sort_by("context") for df in (lower, shares))
    finally:
        top.unpersist()

    def logs_of(table: pa.Table) -> np.ndarray:
        return np.log(table["shares"].combine_chunks().flatten().to_numpy().reshape(-1, SYMBOLS)).astype("<f4")

    # What was not seen after its last three symbols goes by the last two.
    row, logs = np.tile(np.arange(known.num_rows, dtype=np.int32), SYMBOLS), logs_of(known)
    if found.num_rows:
        row[found["context"].to_numpy()] = len(logs) + np.arange(found.num_rows, dtype=np.int32)
        logs = np.concatenate([logs, logs_of(found)])
    return Model(spark.sparkContext.broadcast((row, logs)), n_symbols)


@dataclass(frozen=True)
class Pairs:
    """Each different pair (word, word before) of a unit, as a number, in order; the pair of every word of the texts, and the
    order of words and pairs in what the shares are asked: a word is in one share, by its hash."""

    pairs: np.ndarray
    of_token: np.ndarray
    ns: np.ndarray
    words: np.ndarray
    contexts: np.ndarray
    sizes: np.ndarray
    share: np.ndarray
    order: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(unit: Unit, shares: int) -> Pairs:
        end = unit.ids[unit.sizes[0] - 1]
        many, solid = len(unit.hashes), unit.ids != end
        before = np.r_[end, unit.ids[:-1]]
        pairs, of_token, ns = np.unique(unit.ids[solid] * many + before[solid], return_inverse=True, return_counts=True)
        words, contexts = pairs // many, pairs % many
        sizes, share = np.bincount(words, minlength=many), (unit.hashes % shares).astype(np.int32)
        order = np.argsort(share, kind="stable")
        return Pairs(pairs, of_token, ns, words, contexts, sizes, share, order, _moved(sizes, order))


def _units(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, Unit]]:
    for batch in sliced(batches, text, UNIT):
        if batch.num_rows:
            yield batch, unit_of(column_bytes(batch, text))


def asked(docs: DataFrame, learn: bool, text: str = "text") -> DataFrame:
    """Of each unit of the texts: its words and the pairs that each ends, in a row for each share of all words. To `learn`, with the
    word before and how often they come."""
    shares = shuffle_parts(docs.sparkSession)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, unit in _units(batches, text):
            p = Pairs.of(unit, shares)
            met, n = np.unique(p.share, return_counts=True)
            ends, sizes = np.cumsum(n), p.sizes[p.order]
            pair_ends = np.cumsum(sizes)[ends - 1]
            keys = unit.hashes[p.words] * PAIR + unit.hashes[p.contexts]
            own = pair_ends if learn else np.zeros(len(met), np.int64)
            at = p.at if learn else p.at[:0]
            yield pa.RecordBatch.from_arrays([
                pa.array(met), pa.array(np.full(len(met), unit.number)), pa.array(np.full(len(met), learn)),
                _lists(p.order.astype(np.int32), ends, pa.int32()), _lists(unit.hashes[p.order], ends, pa.int64()),
                _lists(sizes.astype(np.int32), ends, pa.int32()), _lists(keys[p.at], pair_ends, pa.int64()),
                _lists(unit.hashes[p.contexts][at], own, pa.int64()), _lists(p.ns[at].astype(np.int32), own, pa.int32())], _names(ASKS))

    return docs.mapInArrow(step, ASKS)


def bigrams(asks: DataFrame) -> DataFrame:
    """Counts of pairs of words, sharded by word. Rows of three kinds: to each unit that asks, which of its pairs were learnt and how
    often, and after how many different words each of its words was; sums by word before (how many come after it, in all and
    by how often they do); and the numbers that discounts go by."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        flat = {c: np.concatenate([_flat(b.column(c))[0] for b in parts]) for c in _names(ASKS)[3:]}
        share, units, learn, of_message = (np.concatenate(c) for c in zip(*(
            (b.column("share").to_numpy(), b.column("unit").to_numpy(), b.column("learn").to_numpy(zero_copy_only=False),
             _flat(b.column("words"))[1]) for b in parts)))
        message = np.repeat(np.arange(len(units)), of_message)
        met, row = np.unique(flat["words"], return_inverse=True)
        pair_row, pair_message = np.repeat(row, flat["sizes"]), np.repeat(message, flat["sizes"])
        taught = learn[pair_message]
        # Pairs that are learnt, each once.
        known, first, which = np.unique(flat["pairs"][taught], return_index=True, return_inverse=True)
        n = np.bincount(which, flat["ns"], len(known)).astype(np.int64)
        after = np.bincount(pair_row[taught][first], minlength=len(met))
        contexts, which = np.unique(flat["contexts"][first], return_inverse=True)
        sums = [np.bincount(which, w, len(contexts)).astype(np.int64) for w in (n, n == 1, n == 2, n > 2)]
        rates = [(c == k).sum() for c in (n, after) for k in (1, 2, 3, 4)]
        # Answers, to all but those who teach.
        keys, own = flat["pairs"][~taught], pair_message[~taught]
        found = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        hit = known[found] == keys if len(known) else np.zeros(len(keys), bool)
        starts = np.cumsum(np.bincount(pair_message, minlength=len(units))) - np.bincount(pair_message, minlength=len(units))
        place = np.flatnonzero(~taught)[hit] - starts[own[hit]]
        told = ~learn[message] & ((after[row] > 0) | (flat["words"] == END_HASH))
        asking = np.flatnonzero(~learn)
        pair_ends = np.cumsum(np.bincount(own[hit], minlength=len(units))[asking])
        word_ends = np.cumsum(np.bincount(message[told], minlength=len(units))[asking])
        few = len(asking)

        def column(values: pa.Array | None, last: np.ndarray | None, kind: pa.DataType) -> pa.Array:
            """A list for each unit that asks, then one for the sums."""
            return pa.concat_arrays([values if values is not None else pa.nulls(few, pa.list_(kind)),
                                     pa.array([last], pa.list_(kind))])

        yield pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(units[asking]), pa.nulls(1, pa.int64())]), pa.concat_arrays([pa.array(share[asking]), pa.nulls(1, pa.int32())]),
            column(_lists(place.astype(np.int32), pair_ends, pa.int32()), None, pa.int32()),
            column(_lists(n[found[hit]], pair_ends, pa.int64()), None, pa.int64()),
            column(_lists(flat["words"][told], word_ends, pa.int64()), None, pa.int64()),
            column(_lists(flat["locals"][told], word_ends, pa.int32()), None, pa.int32()),
            column(_lists(after[row][told].astype(np.int64), word_ends, pa.int64()), None, pa.int64()),
            column(None, contexts, pa.int64()), *(column(None, s, pa.int64()) for s in sums),
            column(None, np.array([*rates, after.sum(), (after > 0).sum()], np.int64), pa.int64())], _names(FOUND))

    return asks.repartitionById(shuffle_parts(asks.sparkSession), F.col("share")).mapInArrow(step, FOUND)


@dataclass(frozen=True)
class Words:
    """A model of words over one of symbols: rows of `bigrams`, `contexts` (unit; lists of locals, totals, ones, twos, more), and the
    discounts of pairs and of words alone, with what these free of all words."""

    found: DataFrame
    contexts: DataFrame
    cut: np.ndarray
    low: np.ndarray
    total: int
    freed: float
    letters: Model
    shares: int

    @staticmethod
    def of(found: DataFrame, letters: Model) -> Words:
        """The sums of each context are joined with the units that ask for it."""
        rates = {r["pos"]: r["n"] for r in found.where("rates IS NOT NULL").select(F.posexplode("rates").alias("pos", "n")).groupBy("pos").agg(
            F.sum("n").alias("n")).collect()}
        cut, low = (discounts({k + 1: rates.get(at + k, 0) for k in range(4)}) for at in (0, 4))
        ones, twos, total, words = (rates.get(i, 0) for i in (4, 5, 8, 9))
        freed = (low[1] * ones + low[2] * twos + low[3] * (words - ones - twos)) / total if total else 1.0
        sums = found.where("contexts IS NOT NULL").select(F.inline(F.arrays_zip("contexts", "totals", "ones", "twos", "more"))).groupBy(
            "contexts").agg(*[F.sum(c).alias(c) for c in ("totals", "ones", "twos", "more")])
        asks = found.where("unit IS NOT NULL").select("unit", F.inline(F.arrays_zip("words", "locals")))
        # As lists: a row costs more on its way to Python than what it holds.
        contexts = asks.join(sums.hint("merge"), asks["words"] == sums["contexts"]).groupBy("unit", F.expr("locals div 65536")).agg(
            *[F.collect_list(c).alias(c) for c in ("locals", "totals", "ones", "twos", "more")])
        return Words(found, contexts, cut, low, total, float(freed), letters, shuffle_parts(found.sparkSession))


def spelt(batch: pa.RecordBatch, text: str, classes: np.ndarray, row: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """The natural log of the probability of each word's letters and the byte after it, by the symbols before."""
    met, sizes, solid = grams(column_bytes(batch, text), classes)
    sums = np.r_[0.0, np.cumsum(logs[row[met // SYMBOLS] * SYMBOLS + met % SYMBOLS], dtype=np.float64)]
    ends = np.cumsum(sizes)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    some = sizes > 0
    first[(ends - sizes)[some]] = solid[(ends - sizes)[some]]
    last[ends[some] - 1] = solid[ends[some] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return sums[np.minimum(end + 1, ends[np.searchsorted(ends, start, "right")])] - sums[start]


def score(docs: DataFrame, model: Words, text: str = "text", log_perplexity: str = "log_perplexity", size: str = "n_symbols") -> DataFrame:
    """The columns of `docs`, the natural log of the perplexity per symbol (byte) and the number of symbols. Texts without
    words, null included, have a null perplexity. `docs` must be among those that the model was asked by (`asked`)."""
    source = docs.select(*[c for c in docs.columns if c not in (log_perplexity, size)])
    sent = StructType().add("unit", "long").add("place", "integer").add("row", source.schema)
    schema = StructType([*source.schema.fields]).add(log_perplexity, "double").add(size, "long")
    shared, shares, cut, low, all_after, freed = model.letters.shared, model.shares, model.cut, model.low, model.total, model.freed

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, unit in _units(batches, text):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(batch.num_rows, unit.number)), pa.array(np.arange(batch.num_rows, dtype=np.int32)),
                pa.StructArray.from_arrays(batch.columns, fields=[batch.schema.field(i) for i in range(batch.num_columns)])], sent.names)

    answers = model.found.where("unit IS NOT NULL").select("unit", F.lit(0).alias("kind"), "share", "places", "ns", "locals", "afters")
    contexts = model.contexts.select("unit", F.lit(1).alias("kind"), "locals", "totals", "ones", "twos", "more")
    texts = source.mapInArrow(placed, sent).select("unit", F.lit(2).alias("kind"), "place", "row")
    both = answers.unionByName(contexts, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    dealt = both.repartition("unit").sortWithinPartitions("unit", "kind", "place")

    def unit_rows(number: int, parts: dict[int, list[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        if 2 not in parts:
            return
        places = np.concatenate([b.column("place").to_numpy() for b in parts[2]])
        rows = pa.Table.from_batches([pa.RecordBatch.from_struct_array(b.column("row")) for b in parts[2]]).combine_chunks().to_batches()[0]
        # Equal units share a number, and so their rows come together: texts of one place are equal.
        heads = np.r_[True, np.diff(places) != 0]
        texts = pa.RecordBatch.from_arrays([rows.column(text).take(pa.array(np.flatnonzero(heads)))], [text])
        unit = unit_of(column_bytes(texts, text))
        if unit.number != number or 0 not in parts:
            raise ValueError("a text's words have no answer: the table changed between two reads")
        p, many = Pairs.of(unit, shares), len(unit.hashes)
        # Answers go by the place of a pair in what its share was asked.
        begin = np.r_[0, np.cumsum(np.bincount(p.share, p.sizes, shares))[:-1]].astype(np.int64)
        n, after = np.zeros(len(p.pairs), np.int64), np.zeros(many, np.int64)
        for b in parts[0]:
            at, sizes = _flat(b.column("places"))
            n[p.at[at + np.repeat(begin[b.column("share").to_numpy()], sizes)]] = _flat(b.column("ns"))[0]
            after[_flat(b.column("locals"))[0]] = _flat(b.column("afters"))[0]
        total, freed_of = np.zeros(many), np.ones(many)
        for b in parts.get(1, []):
            own, in_all, *some = (_flat(b.column(c))[0] for c in ("locals", "totals", "ones", "twos", "more"))
            total[own] = in_all
            freed_of[own] = sum(c * k for c, k in zip(cut[1:], some)) / in_all
        share = (n - cut[np.minimum(n, 3)]) / np.maximum(total[p.contexts], 1)
        alone = (after - low[np.minimum(after, 3)]) / max(all_after, 1)
        gamma = freed_of[p.contexts]
        with np.errstate(divide="ignore"):
            seen, rest = np.log(share + gamma * alone[p.words]), np.log(gamma * freed)
        classes, (row, logs) = _classes(), shared.value
        letters = np.concatenate([spelt(b, text, classes, row, logs.ravel()) for b in sliced([texts], text, 2 << 20)])
        sums = np.r_[0.0, np.cumsum(np.logaddexp(seen[p.of_token], rest[p.of_token] + letters))]
        words = unit.sizes - 1
        ends = np.cumsum(words)
        lengths = pc.binary_length(texts.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        mean = (sums[ends - words] - sums[ends]) / np.maximum(lengths, 1)
        of_row = np.cumsum(heads) - 1
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(mean[of_row], mask=(words == 0)[of_row]), pa.array(lengths[of_row])], schema.names)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, {}
        for batch in batches:
            units, kinds = batch.column("unit").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (np.diff(units) != 0) | (np.diff(kinds) != 0)]).tolist() if len(units) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(units)]):
                if units[lo] != at:
                    yield from unit_rows(at, parts)
                    at, parts = units[lo], {}
                parts.setdefault(int(kinds[lo]), []).append(batch.slice(lo, hi - lo))
        yield from unit_rows(at, parts)

    return dealt.mapInArrow(step, schema)


def judge(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          quantile: float = QUANTILE, allowance: float = ALLOWANCE) -> DataFrame:
    """The columns of `docs` and `log_perplexity`, `most` (its language's threshold) and `kept` (columns of these names are
    replaced).

    `trusted` has the ids of trusted documents of `docs`. Four fifths of them (by crc32 of the id) train the model, the rest
    set the thresholds: a text is kept if its log perplexity less allowance / sqrt(symbols) is up to the quantile of that
    value among the trusted texts of its language. Null languages are a language. Texts without words, null included, are rejected;
    documents of a language without a threshold stay. Repeated rows are judged alike, an empty table gives an empty one.
    """
    # The ids grow with the corpus, so texts meet them in a shuffle at every size, not by broadcast while they are few.
    ids = trusted.select(F.col(doc_id).alias("_id")).where("_id IS NOT NULL").distinct().hint("merge")
    needed = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("")).alias("_lang"))
    share = split_of("_id", 5)
    # The two parts are joined on their own, so each text is shuffled once.
    learnt = stored(needed.where(share != 0).join(ids, "_id", "left_semi").select("text"), "trusted")
    held_out = stored(needed.where(share == 0).join(ids, "_id", "left_semi").select("_lang", "text"), "held-out")
    names = [c for c in docs.columns if c not in ("log_perplexity", "most", "kept")]
    size = unused("n_symbols", names)
    given = docs.select(*names)
    asks = asked(learnt, True).unionByName(asked(held_out, False)).unionByName(asked(given, False, text))
    model = Words.of(stored(bigrams(asks), "bigrams"), train(learnt))

    def value(log: str, n: str):
        return F.col(log) - F.lit(allowance) / F.sqrt(F.col(n))

    most = score(held_out, model, log_perplexity="_log", size="_n").select("_lang", value("_log", "_n").alias("v")).where("v IS NOT NULL").groupBy(
        "_lang").agg(F.percentile_approx("v", quantile, 10000).alias("_most"))
    scored = score(given, model, text, "log_perplexity", size)
    rows = scored.select(F.struct(*names).alias("_row"), F.col("log_perplexity").alias("_log"), F.col(size).alias("_n"),
                         F.coalesce(F.col(lang), F.lit("")).alias("_lang"))
    # Read from a table, the few thresholds have a known size, and no text is shuffled to meet them.
    met = rows.join(stored(most, "thresholds"), "_lang", "left")
    own = value("_log", "_n")
    return met.select("_row.*", F.col("_log").alias("log_perplexity"), F.col("_most").alias("most"),
                      F.coalesce(own <= F.coalesce("_most", own), F.lit(False)).alias("kept"))
