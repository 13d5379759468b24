"""Top-k search, the conversation trie and spelling variants against plain readings of their rules, odd tables included."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywake.llm import nra, prefix_trie, variants
from tallywake.llm.queries import ORACLES, QUERIES
from tests.compare import mismatch

SF = "/root/testdata/sf0.001"


# --- top-k search

def test_search_query_agrees_with_sql(spark):
    assert mismatch(spark, SF, "op11_top_k", QUERIES["op11_top_k"], ORACLES["op11_top_k"]) is None


def best(rows, queries, k):
    """(query, rank, id, score) by all scores; a query leaves out one row equal to it."""
    found = []
    for qid, q in set(queries):
        left, own = [], 1
        for rid, r in rows:
            if own and rid == qid and r == q:
                own = 0
            elif len(r) == len(q):
                left.append((-sum(a * b for a, b in zip(r, q)), rid is None, rid or 0, rid))
        found += [(qid, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(left)[:k])]
    return sorted(found, key=str)


def whole(v):
    return tuple(math.floor(1024 * x) for x in v)


@pytest.mark.parametrize("held", [2, 100])
def test_search_of_odd_tables(spark, held):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.75]) for _ in range(6)]) for i in range(180)]
    rows += [rows[5], rows[0], rows[0], (None, rows[7][1]), (300, [1.0, 2.0]), (301, [3.0]), (400, [])]
    bad = [(500, None), (600, [None, 1.0]), (700, [float("nan")] * 6), (800, [float("inf")] * 6)]
    docs = spark.createDataFrame([(i, v, "x") for i, v in rows + bad], "vec_id bigint, embedding array<double>, score string")
    found = nra.search(docs, docs.where("vec_id % 100 = 0"), k=4, held=held).select("query_id", "rank", "vec_id", "score")
    usable = [(i, whole(v)) for i, v in rows]
    want = best(usable, [(i, v) for i, v in usable if i is not None and i % 100 == 0], 4)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert nra.search(docs.limit(0), docs.limit(0)).count() == 0


def test_bounds_hold_and_lists_are_left_early():
    rng = np.random.default_rng(2)
    rows, queries = np.floor(rng.normal(size=(3000, 24)) * 200), np.floor(rng.normal(size=(9, 24)) * 200)
    block, scores = nra.Block(rows), queries @ rows.T
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    for depth in (10, 400, 1500, 3000):
        block.read_to(depth)
        lower, upper = block.bounds(up, down)
        assert (lower <= scores).all() and (scores <= upper).all()
    assert (lower == scores).all() and (upper == scores).all()
    floor = np.sort(scores, axis=1)[:, -5]
    query, row = nra.survivors(block, queries, floor, 5, np.zeros((0, 2), np.int64))
    kept = set(zip(query.tolist(), row.tolist()))
    assert all((q, r) in kept for q in range(9) for r in np.flatnonzero(scores[q] >= floor[q]))
    assert block.read < 3000 and len(kept) < scores.size / 20


def test_scores_beyond_double_precision_are_exact(spark):
    rows = [(0, [3e9, 1.0]), (1, [3e6, 5.0]), (2, [3e6, 4.0])]
    docs = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = nra.search(docs, docs.where("vec_id = 0"), scale=1).select("query_id", "rank", "vec_id", "score").collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 9 * 10 ** 15 + 5), (0, 2, 2, 9 * 10 ** 15 + 4)]


# --- conversation trie

def trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    rebuilt = {}
    for c, turns in convs.items():
        turns.sort(key=lambda t: t[0])
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(t[1:] for t in convs.get(c - c % 20, [])[:h]) + tuple(t[1:] for t in turns[h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                kids[turns[:d - 1]].add(turns[:d])
    below, found = {}, set()
    for node in sorted(members, key=len, reverse=True):
        n = len(members[node])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below[node] = (sum(below[k][0] for k in kids[node]) or 1, (n - 1) * words + sum(below[k][1] for k in kids[node]))
        ends = ",".join(map(str, sorted(c for c in members[node] if rebuilt[c] == node)))
        found.add((min(members[node]), len(node), min(members[node[:-1]]) if node else None, n, len(kids[node]), *below[node],
                   hashlib.sha256(ends.encode()).hexdigest()))
    return found


TURNS = "conv_id bigint, turn bigint, role string, text string"


def random_turns(seed, convs=90):
    """Conversations that branch off one another, copies and prefixes of others among them."""
    rng = random.Random(seed)
    texts = ["yes", "no it is", "why  not\tthis\none", "", None, "  wide", "one two three"]
    kept, rows = [[]], []
    for c in range(convs):
        base = list(rng.choice(kept))
        own = base[:rng.randrange(len(base) + 1)] + [(rng.choice(["user", "assistant", None]), rng.choice(texts)) for _ in range(rng.randrange(5))]
        kept.append(own)
        for _ in range(rng.choice([1, 1, 1, 5]) if own else 0):
            number = rng.randrange(400)
            if number not in {r[0] for r in rows}:
                rows += [(number, i if i else rng.choice([None, 0]), role, text) for i, (role, text) in enumerate(own)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, seed, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FAN", 2)
    monkeypatch.setattr(prefix_trie, "STRETCH", 3)
    rows = random_turns(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS + ", words string, n int")
    found = [tuple(r) for r in prefix_trie.trie(docs).collect()]
    want = trie(rows)
    assert set(found) == want and len(found) == len(want)


@pytest.mark.parametrize("rows", [
    [],
    [(7, 0, "user", "lone turn")],
    [(6, 0, "user", None)],
    [(None, 0, "user", "nobody's"), (40, 1, "a", "b"), (41, 1, "a", "b"), (41, 1, "a", "b")],
    [(c, t, "u", "same words here") for c in range(60, 75) for t in range(4)],
    [(c, t, "u", f"turn {t}") for c in range(100, 130) for t in range(c - 99)],
])
def test_trie_of_odd_tables(spark, rows):
    found = [tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()]
    want = trie([r for r in rows if r[0] is not None])
    assert set(found) == want and len(found) == len(want)


def test_open_ranges_are_contracted():
    """Merging ranges gives the nodes that one range gives, and what a range leaves open grows with the depth alone."""
    rng = random.Random(3)
    ways = sorted([rng.randrange(3) for _ in range(rng.randrange(1, 7))] for _ in range(400))
    parts = [prefix_trie.Part(i, 1, 0, 0, len(w), 0) for i, w in enumerate(ways)]

    def edge(i):
        a, b = ways[i], ways[i + 1]
        depth = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return depth, 10 * depth

    edges = [edge(i) for i in range(399)]
    once, left, _ = prefix_trie.merge(parts, edges, True)
    assert len(left) == 1
    found, kept, between = [], [], []
    for lo in range(0, 400, 50):
        done, open_, ways_on = prefix_trie.merge(parts[lo:lo + 50], edges[lo:lo + 49], False)
        assert len(open_) <= 2 * 7 + 2
        found += done
        kept += open_
        between += ways_on + ([edges[lo + 49]] if lo + 50 < 400 else [])
    last, _, _ = prefix_trie.merge(kept, between, True)
    assert sorted(found + last) == sorted(once)


# --- spelling variants

def spelled(rows, letters, least, one_in):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % one_in == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            n[word] += 1
    words = {w: c for w, c in n.items() if len(w) >= letters and c >= least}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:i] + long[i + 1:] == short for i in range(len(long)))

    partners = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in partners.items():
        top = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = top if top is not None and words[top] >= 5 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), words[w], len(partners[w]), words[form[w]] if form[w] else None) for w in words}


def documents(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("aabé") for _ in range(rng.randrange(3, 8))) for _ in range(40)]
    texts = [None, "", "123 !?", "×÷ CafÉ CAFÉ œuvre", "a" * 3000 + " " + "a" * 2999]
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(60)):
            w = list(rng.choice(base))
            if rng.random() < 0.3:
                w[rng.randrange(len(w))] = rng.choice("abBé")
            words.append("".join(w) * rng.choice([1, 1, 1, 2]))
        texts.append(" ".join(words))
    return [*enumerate(texts), (None, texts[7]), (9, texts[9]), (9, texts[9])]


@pytest.mark.parametrize("seed, letters, least, one_in", [(1, 1, 1, 199), (2, 3, 2, 7), (3, 6, 5, 199)])
def test_variants(spark, seed, letters, least, one_in):
    rows = documents(seed)
    docs = spark.createDataFrame([(i, t, "x", 2) for i, t in rows], "doc_id bigint, text string, word string, n int")
    found = [tuple(r) for r in variants.variants(docs, least_letters=letters, least_count=least, broken_one_in=one_in).collect()]
    want = spelled(rows, letters, least, one_in)
    assert set(found) == want and len(found) == len(want)


def test_variants_of_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "9")], "doc_id bigint, text string")
    assert variants.variants(docs).count() == 0 and variants.variants(docs.limit(0)).count() == 0


def test_nodes_are_those_of_the_tries(spark):
    """Equal numbers stand for equal prefixes, whatever range a word is dealt to."""
    words = sorted({"".join(random.Random(i).choice("ab") for _ in range(1 + i % 9)) for i in range(300)})
    table = variants.numbered(spark.createDataFrame([(w,) for w in words], "word string"), "word", "nodes", "rank")
    rows = table.orderBy("rank").collect()
    assert [r["word"] for r in rows] == words
    number = {}
    for r in rows:
        assert len(r["nodes"]) == len(r["word"]) + 1
        for i, node in enumerate(r["nodes"]):
            assert number.setdefault(r["word"][:i], node) == node
    assert len(set(number.values())) == len(number)


@pytest.mark.parametrize("name, table, columns, rule", [
    ("op12_prefix_trie", "conversations", "conv_id, turn, role, text", trie),
    ("op13_spelling", "documents", "doc_id, text", lambda rows: spelled(rows, 6, 5, 199))])
def test_queries_over_a_table(spark, name, table, columns, rule):
    rows = duckdb.sql(f"SELECT {columns} FROM '{SF}/{table}.parquet'").fetchall()
    found = [tuple(r) for r in QUERIES[name](spark, SF).collect()]
    want = rule(rows)
    assert set(found) == want and len(found) == len(want)


def test_counts_are_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole_text = docs.agg(F.sum(F.regexp_count("text", F.lit("[A-Za-zÀ-ÿ]+")))).first()[0]
    assert variants.counted(docs).agg(F.sum("n")).first()[0] == whole_text
