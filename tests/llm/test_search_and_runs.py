"""Bit-sliced top-k search, periodic runs and lexical search against brute force, on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from epidw.llm import bitsliced, lexical, periodic, queries
from epidw.llm.bytehash import mix

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", ["op11_topk", "op13_search"])
def test_query_equals_its_statement(spark, duck, name):
    cursor = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    found = queries.queries()[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == Counter(cursor.fetchall())


# ---- bit-sliced index


def best_by_sorting(rows, query_id, query, k):
    scored = [(-sum(a * b for a, b in zip(query, q)), vec_id) for vec_id, q in rows if vec_id != query_id]
    return [(vec_id, -score) for score, vec_id in sorted(scored, key=lambda s: (s[0], s[1] is None, s[1] or 0))[:k]]


@pytest.mark.parametrize("block_rows", [7, 64, 1000])
def test_top_k_equals_sorting(spark, block_rows):
    random.seed(block_rows)
    vectors = [[random.choice([-300, -7, -1, 0, 1, 2, 300, 12345]) for _ in range(random.choice([0, 1, 5, 6]))] for _ in range(120)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(200 + i, vectors[3]) for i in range(40)] + [(5, vectors[5]), (None, vectors[9])]
    table = spark.createDataFrame(rows, "vec_id long, q array<long>")
    asked = table.filter("vec_id % 7 = 0 OR vec_id IS NULL")
    found = bitsliced.top_k(bitsliced.build_index(table, block_rows), asked, 4, chunk_queries=5).collect()
    for query_id, query in {(r[0], tuple(r[1])) for r in rows if r[0] is None or r[0] % 7 == 0}:
        got = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == query_id)
        assert [g[1:] for g in got] == best_by_sorting(rows, query_id, query, 4) and [g[0] for g in got] == [1, 2, 3, 4]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -0.5], "x"), (50, [0.5, 0.25], "y"), (1, None, "z"), (2, [1.0, None], "z"), (3, [nan, 1.0], "z"), (4, [inf, 1.0], "z"),
            (5, [], "e"), (6, [1e300, 0.0], "z"), (7, [-0.001, 0.0], "f")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, q string")
    found = bitsliced.nearest(table, F.col("vec_id") % 50 == 0, 5, 256.0).collect()
    q = {0: (256, -128), 50: (128, 64), 5: (), 7: (-1, 0)}
    for query_id in (0, 50):
        got = [(r.vec_id, r.score) for r in sorted((r for r in found if r.query_id == query_id), key=lambda r: r["rank"])]
        assert got == best_by_sorting(list(q.items()), query_id, q[query_id], 5)
    assert bitsliced.nearest(table.limit(0), F.lit(True), 5, 256.0).count() == 0
    assert bitsliced.nearest(table, F.lit(False), 5, 256.0).count() == 0


def test_digits_and_sums():
    for weight in [*range(-70, 70), 1 << 26, -(1 << 26) + 3]:
        digits = bitsliced.signed_digits(weight)
        assert sum(d << p for p, d in digits) == weight and all(b - a > 1 for (a, _), (b, _) in zip(digits, digits[1:]))
    random.seed(2)
    numbers = np.array([[random.randrange(2) for _ in range(64)] for _ in range(50)], np.uint8)
    bitmaps = np.packbits(numbers, axis=1, bitorder="little").view(np.uint64)
    places = {0: list(range(20)), 2: list(range(20, 49)), 7: [49]}
    total = bitsliced.added(bitmaps, places)
    bits = np.unpackbits(total.view(np.uint8), axis=1, bitorder="little").astype(int)
    expected = sum((numbers[i].astype(int) << p) for p, rows in places.items() for i in rows)
    assert ((bits << np.arange(len(bits))[:, None]).sum(axis=0) == expected).all()


# ---- periodic runs


def runs_by_definition(words, least):
    count, found = len(words), set()
    for q in range(1, count // 2 + 1):
        at = 0
        while at + q < count:
            start = at
            while at + q < count and words[at] == words[at + q]:
                at += 1
            length = at - start + q
            if length >= max(least, 2 * q):
                part = words[start : start + length]
                if not any(all(part[i] == part[i + d] for i in range(length - d)) for d in range(1, q)):
                    found.add((start, length, q))
            at = max(at, start + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def hostile_sequences():
    random.seed(11)
    a, b = [0], [0, 1]
    while len(b) < 90:
        a, b = b, b + a
    thue = [bin(i).count("1") % 2 for i in range(128)]
    yield from ([], [1], [1] * 11, [1] * 12, b, thue, thue + thue, [1] * 60)
    for n in range(150):
        base = [random.randrange(1 + n % 4) for _ in range(random.randrange(1, 12))]
        words = (base * 20)[: random.randrange(1, 70)]
        if n % 3 == 0:
            words[random.randrange(len(words))] = 99
        yield words + words if n % 5 == 0 else words


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_their_definition(least):
    sequences = list(hostile_sequences())
    numbers = mix(np.array([w for s in sequences for w in s], np.uint64) + np.uint64(5))
    found = periodic.word_runs(numbers, np.concatenate([[0], np.cumsum([len(s) for s in sequences])]), least)
    assert [found.get(i, []) for i in range(len(sequences))] == [runs_by_definition(s, least) for s in sequences]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        words = planted(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        if len(words) > 1500:  # the definition takes quadratic time; a long text's runs are looked at below
            continue
        runs, row = runs_by_definition(words, 12), rows[doc_id]
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        expected = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (len(runs), *expected)
        assert row.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest()
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_runs_of_odd_texts(spark, monkeypatch):
    phrase = "one two\tthree\nfour "
    texts = [None, "", " \n", "a", "Ç é " * 9, phrase * 40, phrase * 100_000, "x" * 3_000_000 + " y" * 20, phrase * 40]
    table = spark.createDataFrame([(i if i != 1 else None, t, "z", 7) for i, t in enumerate(texts)], "doc_id long, text string, collapsed string, start int")
    for most in (1 << 20, 64):
        monkeypatch.setattr("epidw.llm.common.SLICE_BYTES", most)
        found = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find_runs(table).collect()}
        assert found[0] == found[None] == found[2] == (0, [], "") and found[3] == (1, [], "a")
        assert found[4] == (18, [(0, 18, 2)], "Ç é") and found[5] == found[8] == (160, [(0, 160, 4)], "one two three four")
        assert found[6] == (400_000, [(0, 400_000, 4)], "one two three four") and found[7][1] == [(1, 20, 1)]
    assert periodic.find_runs(table.limit(0)).count() == 0


# ---- lexical search


def ranked(docs, text, k):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    held = [(i, Counter(re.findall(pattern, lower(t)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    found = []
    for i, c in held:
        m = 75 + (25 * sum(c.values()) * n) // total
        score = 0
        for t, repeats in Counter(re.findall(pattern, lower(text))).items():
            if t in c:
                score += repeats * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
        if score > 0:
            found.append((i, score))
    return sorted(found, key=lambda f: (-f[1], f[0] is None, f[0] or 0))[:k]


@pytest.mark.parametrize("segment,block,share,chunk", [(1 << 24, 1024, 0.25, 200_000), (3000, 3, 0.0, 40), (20_000, 5, 1.0, 7)])
def test_search_equals_scoring_everything(spark, monkeypatch, segment, block, share, chunk):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "SHORT_SHARE", share)
    random.seed(chunk)
    words = [f"w{int(random.paretovariate(0.6))}" for _ in range(4000)] + ["É́x", "日本"]
    docs = [(i, random.choice([" ", ", ", "\n"]).join(random.choices(words, k=random.choice([0, 1, 5, 40, 300])))) for i in range(150)]
    docs += [(1000 + i, "the same WORDS w1 w2 again") for i in range(60)] + [(7, "w1 w1 w2"), (None, "w3 the same"), (400, None), (401, "?!")]
    items = [(i, " ".join(random.choices(words, k=random.randrange(1, 30)))) for i in range(12)]
    items += [(50, "the SAME words w1"), (50, "É́X 日本"), (51, None), (52, "..."), (53, "nowhere"), (None, "w2 w2"), (50, "the SAME words w1")]
    table = spark.createDataFrame([(*d, "a", 1) for d in docs], "doc_id long, text string, term string, score int").repartition(3)
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    found = lexical.search(lexical.build_index(table, segment), asked, 6, chunk).collect()
    expected = Counter()
    for item_id, text in dict.fromkeys(items):
        expected.update((item_id, n, *d) for n, d in enumerate(ranked(docs, text, 6), 1))
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in found) == expected


def test_search_on_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(lexical.build_index(docs.limit(0)), items, 5).count() == 0
    assert lexical.search(lexical.build_index(docs), items.limit(0), 5).count() == 0
