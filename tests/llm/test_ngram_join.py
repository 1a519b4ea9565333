import random
from collections import defaultdict

import numpy as np
import pytest

from siteweave.llm import ngram_join

LOWER = {i: i + 32 for i in range(65, 91)}


def grams(text, n):
    words = (text or "").translate(LOWER).split()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, n, percent):
    sets = [(k, grams(t, n)) for k, t in rows]
    parent = {k: k for k, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for k, s in sets:
        shared = defaultdict(int)
        for g in s:
            for o in where[g]:
                shared[o] += 1
            where[g].append((k, len(s)))
        for (o, m), i in shared.items():
            if 100 * i >= percent * (len(s) + m - i):
                a, b = find(k), find(o)
                parent[max(a, b)] = min(a, b)
    return {k: (len(s), find(k)) for k, s in sets}


def corpus(seed: int):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows: list = [None, "", " \n ", "A b", "a B", "a", "one two three four five", "x " * 2000]
    for size, copies in ((14, 30), (60, 80), (150, 25)):
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(copies):
            x = list(base)
            for _ in range(rng.randint(0, 7)):
                p = rng.randrange(len(x))
                x[p : p + rng.randint(0, 2)] = [rng.choice(words) for _ in range(rng.randint(0, 2))]
            rows.append(" ".join(x))
    passage = " ".join(rng.choice(words) for _ in range(40))
    rows += [f"{passage} " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(40)]
    rows += [" ".join(rng.choice(words) for _ in range(50)) for _ in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words,percent,block", [(3, 90, 4), (5, 80, 64), (2, 60, 8)])
def test_components_equal_brute_force(spark, words, percent, block):
    rows = corpus(words)
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, sid string, n int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_components(df, ngram_join.JoinParams(words, percent, block=block)).collect()}
    assert got == brute(rows, words, percent)


@pytest.mark.parametrize("words,percent,block", [(3, 90, 4), (5, 80, 64), (2, 60, 8)])
def test_link_counts_equal_brute_force(spark, words, percent, block):
    rows = corpus(words)
    rows += [(len(rows) + i, t) for i, (_, t) in enumerate(rows[:60])]
    components = brute(rows, words, percent)
    rows += rows[60:64]
    sets = [grams(t, words) for _, t in rows]
    near = lambda a, b: bool(a and b) and 100 * len(a & b) >= percent * len(a | b)
    want = sorted((k, *components[k], sum(near(s, o) for o in sets) - bool(s)) for (k, _), s in zip(rows, sets, strict=True))
    assert max(r[3] for r in want) > 3 * block or block == 64
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, ngram_join.similarity_links(df, ngram_join.JoinParams(words, percent, block=block)).collect())) == want


def test_trie_links_join_all_that_is_similar():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 9, 1 << 8)
    for _ in range(40):
        base = rng.integers(0, 1 << 63, 40).astype(np.uint64)
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(20, 40), replace=False), rng.integers(0, 1 << 63, rng.integers(0, 6)).astype(np.uint64)])) for _ in range(12)]
        component = list(range(12))
        for i, j in ngram_join.trie_links(sets, counts, 70):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert 100 * both >= 70 * (len(sets[i]) + len(sets[j]) - both)
            component = [component[i] if c == component[j] else c for c in component]
        for i in range(12):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 70 * (len(sets[i]) + len(sets[j]) - both):
                    assert component[i] == component[j]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similarity_components(df).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, ""), (2, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similarity_components(nothing).collect()) == [(1, 0, 1), (2, 0, 2), (2, 0, 2)]


def test_halves_of_ids_in_common(spark, monkeypatch):
    """Classes whose ids' lower halves are all one of two numbers are still told apart, by the upper halves."""
    whole = ngram_join.xxhash.xxh3_128_intdigest

    class Poor:
        @staticmethod
        def xxh3_128_intdigest(data):
            x = whole(data)
            return x >> 64 << 64 | x & 1

    twins = frozenset({-(1 << 63), 1 - (1 << 63)})
    sets = [np.array([i], np.uint64) for i in range(50)]
    monkeypatch.setattr(ngram_join, "xxhash", Poor)
    assert {ngram_join.set_ids(s)[0] for s in sets} == twins
    assert len({ngram_join.class_id(s, twins) for s in sets}) == 50
    scanned = spark.createDataFrame([(i, 1, *ngram_join.set_ids(s), None, None) for i, s in enumerate(sets + sets)], "key long, n int, sid long, check long, part int, sketch binary")
    rows, classes, found = ngram_join._classes(scanned)
    assert found == twins and classes.count() == 50 and {r.copies for r in classes.collect()} == {2}
    assert {r.key: r.sid for r in rows.collect()} == {i: ngram_join.class_id(s, twins) for i, s in enumerate(sets + sets)}


def test_null_and_repeated_keys(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (4, text.upper()), (4, "other words"), (4, text), (4, text), (None, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.similarity_links(df).collect()), key=repr)
    assert got == sorted([(None, 3, 4, 3), *[(4, 3, 4, 3)] * 3, (4, 1, 4, 0), (None, 0, None, 0), (9, 0, 9, 0)], key=repr)


def test_bloom_holds_all_and_little_else(spark):
    held = spark.range(2000).withColumnRenamed("id", "k")
    bloom = ngram_join.bloom_of(held, "k")
    from pyspark.sql import functions as F

    hashes = np.array([r.h for r in spark.range(20_000).select(F.xxhash64("id").alias("h")).collect()]).view(np.uint64)
    hit = True
    for spot in ngram_join._spots(hashes, len(bloom).bit_length() + 2):
        hit = hit & (bloom[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8) & 1).astype(bool)
    assert hit[:2000].all() and hit[2000:].mean() < 0.01


def near_copies(many, pool, seed=5):
    """Copies of a text of 150 words with up to six changed ones; changes come from ``pool`` different ones, or are all new."""
    rng = random.Random(seed)
    base, rows = [f"b{i}" for i in range(150)], []
    changes = [(rng.randrange(150), f"c{i}") for i in range(pool or 6 * many)]
    for i in range(many):
        words = list(base)
        for at, word in rng.sample(changes, i % 7) if pool else changes[6 * i : 6 * i + i % 7]:
            words[at] = word
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("pool", [0, 25])
def test_a_group_of_near_copies_is_not_dealt_to_pairs_of_cells(spark, monkeypatch, pool):
    places, in_blocks = [], ngram_join.in_blocks

    def counted(df, key, classes, blocks, params, twins):
        places.append(blocks.count())
        return in_blocks(df, key, classes, blocks, params, twins)

    monkeypatch.setattr(ngram_join, "in_blocks", counted)
    rows = near_copies(280, pool)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_components(df, ngram_join.JoinParams(block=4)).collect()}
    assert got == brute(rows, 5, 80)
    assert len({c for _, c in got.values()}) > 1
    assert sum(places) < 5 * len(rows)
