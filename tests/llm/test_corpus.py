"""Near duplicates, line chunks and the pipeline against plain-Python readings of their rules."""

import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tallywake.llm import components, line_dedup, simhash
from tallywake.llm.common import stored

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[ \t-\r]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def fingerprint(text):
    own = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in words(text)]
    runs = [" ".join(own[i:i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(prints):
    """id -> smallest id reachable, by all pairs."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in ids}


def near_texts():
    rng = random.Random(5)
    texts = [None, "", " \n", "One two", "one TWO", "ÄÖ é ß Wort und noch eins"]
    for _ in range(12):
        own = [rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(160)]
        texts.append(" ".join(own))
        for _ in range(rng.randrange(4)):
            own = list(own)
            own[rng.randrange(len(own))] = "changed"
            texts.append(" ".join(own))
    return texts + [texts[7]] * 30


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_simhash_groups(spark, monkeypatch, block):
    monkeypatch.setattr(simhash.links, "__defaults__", (3, block))
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id bigint, text string, fingerprint string, root int")
    found = {r["doc_id"]: r for r in simhash.groups(docs).withColumn("hex", simhash.hex_digits()).collect()}
    prints = {i: fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r["hex"] for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in found.items()} == least_reachable(prints)


def test_links_reach_all_within_the_distance(spark):
    """Fingerprints at chosen distances, chains of them included: what links connect is what all pairs connect."""
    rng = random.Random(11)
    prints = {}
    for _ in range(60):
        at = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 6)):
            prints[len(prints)] = at
            for bit in rng.sample(range(64), rng.randrange(1, 6)):
                at ^= 1 << bit
    distinct = sorted(set(prints.values()))
    rows = [(p - (1 << 64) if p >> 63 else p,) for p in distinct]
    found = simhash.links(spark.createDataFrame(rows, "fingerprint bigint")).collect()
    root = {p: p for p, in rows}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in found:
        root[max(find(a), find(b))] = min(find(a), find(b))
    own = defaultdict(set)
    for (p,), q in zip(rows, distinct):
        own[find(p)].add(q)
    expected = defaultdict(set)
    for i, least in least_reachable(dict(enumerate(distinct))).items():
        expected[least].add(distinct[i])
    assert sorted(map(sorted, own.values())) == sorted(map(sorted, expected.values()))


def test_simhash_one_of_each(spark):
    texts = near_texts()
    docs = spark.createDataFrame(
        [*((i, t, i) for i, t in enumerate(texts)), (7, texts[7], 7), (None, "lone", 1), (None, None, 2)], "doc_id bigint, text string, _kept int")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = least_reachable({i: fingerprint(t) for i, t in enumerate(texts)})
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(groups.values())) and ids.count(None) == 2
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def chunks(lines, min_words, modulus, reach):
    """(first line, lines) by the three families of the rule."""
    size = [len(words(x)) for x in lines]
    digest = [xxhash.xxh64_digest(x.encode(), 42)[::-1] for x in lines]

    def rolled(a, b):
        value = xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42))
        return value - (1 << 64) if value >> 63 else value

    cuts = [i for i in range(len(lines)) if i == 0 or (i >= 2 and rolled(digest[i - 2], digest[i - 1]) % modulus == 0)]
    found = {(a, b - a) for a, b in zip(cuts, [*cuts[1:], len(lines)]) if sum(size[a:b]) >= min_words}
    for i in range(len(lines)):
        if size[i]:
            ends = [n for n in range(1, min(reach, len(lines) - i) + 1) if sum(size[i:i + n]) >= min_words]
            found |= {(i, n) for n in ends[:1]}
            starts = [n for n in range(1, min(reach, i + 1) + 1) if sum(size[i + 1 - n:i + 1]) >= min_words]
            found |= {(i + 1 - n, n) for n in starts[:1]}
    return found


def without_repeats(texts, min_words, modulus, reach=line_dedup.REACH):
    first, gone = {}, defaultdict(set)
    for i in sorted(texts):
        if texts[i] is None:
            continue
        lines = texts[i].split("\n")
        for start, n in sorted(chunks(lines, min_words, modulus, reach)):
            if first.setdefault(tuple(lines[start:start + n]), (i, start)) != (i, start):
                gone[i] |= set(range(start, start + n))
    return {i: t if not gone[i] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in texts.items()}


@pytest.mark.parametrize("min_words, modulus", [(50, 8), (6, 2), (1, 3)])
def test_line_dedup(spark, min_words, modulus):
    rng = random.Random(min_words)
    pool = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(0, 12))) for _ in range(60)]
    passages = [[rng.choice(pool) for _ in range(rng.randrange(3, 20))] for _ in range(5)]
    texts = {0: None, 1: "", 2: "\n\n", 3: " ".join(["long"] * 70), 4: " ".join(["long"] * 70)}
    for i in range(5, 40):
        body = [f"own {i} {rng.random()}" for _ in range(rng.randrange(6))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(body) + 1)
            body[at:at] = rng.choice(passages)
        texts[i] = "\n".join(body)
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in texts.items()], "doc_id bigint, text string, lines string, _id int")
    found = line_dedup.dedup(docs, min_words=min_words, modulus=modulus)
    assert found.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in found.collect()} == without_repeats(texts, min_words, modulus)


def test_line_dedup_keeps_what_is_not_repeated(spark):
    rng = random.Random(2)
    passage = "\n".join(" ".join(f"p{i}{k}" for k in range(13)) for i in range(5))
    own = {i: "\n".join(" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(9999)) for _ in range(14)) for _ in range(8)) for i in range(30)}
    texts = {i: f"{t}\n{passage}\n{t[::-1]}" if i % 3 == 0 else t for i, t in own.items()}
    rows = [*texts.items(), (None, passage), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [tuple(r) for r in line_dedup.dedup(docs).collect()]
    cleaned = {i: f"{t}\n{t[::-1]}" if i % 3 == 0 else t for i, t in own.items()}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    assert sorted(found, key=key) == sorted([*cleaned.items(), (None, passage), (None, None)], key=key)
    assert line_dedup.dedup(docs.limit(0)).count() == 0


def test_pipeline_stage_by_stage(spark):
    before = spark.read.parquet(f"{SF}/documents.parquet")
    columns = before.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, SF), name)
        assert after.columns == columns, name
        given, kept = ({r["doc_id"]: r["text"] for r in t.collect()} for t in (before, after))
        assert set(kept) <= set(given)
        if name == "line_dedup":
            assert kept == without_repeats(given, line_dedup.MIN_WORDS, line_dedup.MODULUS)
        elif name == "simhash":
            assert set(kept) == set(least_reachable({i: fingerprint(t) for i, t in given.items()}).values())
        if name != "line_dedup":
            assert all(kept[i] == given[i] for i in kept)
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF).toPandas()
    assert set(packed.doc_id) == {r["doc_id"] for r in before.collect()}
    filled = packed.sort_values(["sequence_id", "offset"]).groupby("sequence_id").length
    assert filled.sum().max() <= 4096 and (filled.cumsum() - packed.length == packed.offset).all()


def test_pipeline_stages_take_odd_tables(spark):
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    odd = whole.limit(3).unionByName(whole.limit(1)).unionByName(whole.limit(4).select(
        *[F.lit(None).cast(whole.schema[c].dataType).alias(c) for c in whole.columns]))
    for table in (whole.limit(0), odd.withColumn("_row", F.lit(1)).withColumn("word", F.lit("x"))):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, table, SF)
            assert name == "packing" or found.columns == table.columns, name
            assert found.count() >= 0


def test_near_copies_are_found_without_broadcasts(spark, monkeypatch):
    """Spark takes exploded variants for as few as the fingerprints; no size may make them, or what grows with them, a broadcast."""
    plans, kept = [], simhash.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    for module in (simhash, components):
        monkeypatch.setattr(module, "stored", seen)
    prints = spark.createDataFrame([(1,), (3,), (7 << 20,), (5 << 20,), (1 << 50,)], "fingerprint bigint")
    assert {(r["node"], r["root"]) for r in components.components(simhash.links(prints)).collect()} >= {(3, 1), (7 << 20, 1)}
    found = simhash.one_of_each(spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None)], "doc_id bigint, text string"))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 6 and [p for p in plans if "Broadcast" in p] == []
