"""The corpus pipeline against a plain version of its stages, on planted documents."""

import random

import corpus_pipeline
import pytest
from test_filters import brute_dedup
from test_ngram_join import brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def planted():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    lines = lambda n: [" ".join(word() for _ in range(12)) for _ in range(n)]
    rows = {i: "\n".join(lines(5)) for i in range(150)}
    passage = lines(4)
    for i in (20, 40, 60):
        rows[i] = "\n".join([*lines(3), *passage, *lines(3)])
    base = " ".join(word() for _ in range(120))
    rows |= {200: base, 201: base.upper(), 202: f"{base} {word()}", 203: base}
    rows |= {300: " ".join(f"{word()}$$$" for _ in range(60)), 301: "too short", 302: None, 303: "same same same same same same " * 4}
    rows[310] = f"{' '.join(word() for _ in range(40))} password = hunter2hunter2 {word()}"
    return [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in sorted(rows.items())]


def test_stages(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, COLUMNS)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, ""), name)
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        kept = {r.doc_id: r for r in docs.collect()}
        if name == "quality_rules":
            assert {r[0] for r in rows} - set(kept) == {201, 300, 301, 302, 303}
            before = [(r.doc_id, r.text) for r in kept.values()]
        elif name == "line_dedup":
            assert {k: r.text for k, r in kept.items()} == {k: v for (k, _), v in brute_dedup(before).items()}
            assert "\n".join(kept[20].text.split("\n")[3:7]) not in kept[40].text and kept[40].n_chars == len(kept[40].text)
            before = [(r.doc_id, r.text) for r in kept.values()]
        elif name == "ngram_join":
            assert set(kept) == {k for k, (_, c) in brute(before, 5, 80).items() if k == c} and 203 not in kept and 202 not in kept and 200 in kept
        else:
            assert "[SECRET]" in kept[310].text and "hunter2" not in kept[310].text and sum("[SECRET]" in r.text for r in kept.values()) == 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {p.doc_id for p in pieces} == set(kept)


def test_run(spark, tmp_path):
    path = f"{tmp_path}/sf"
    spark.createDataFrame(planted(), COLUMNS).write.parquet(f"{path}/documents.parquet")
    out = corpus_pipeline.run(spark, path)
    assert out.where("length > 2048").count() == 0 and out.select("doc_id").distinct().count() == 152


def near_rows(spark, rows, extra="x"):
    df = spark.createDataFrame([(k, t, "en", "s", len(t or ""), extra) for k, t in rows], f"{COLUMNS}, key string")
    out = corpus_pipeline.near_duplicate_stage(spark, df, "")
    assert out.columns == df.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def test_near_duplicates_keep_one_row_of_each_group(spark):
    a, b, c, d, e = ("one two three four five six seven", "eight nine ten eleven twelve", "red green blue black white grey", "spring summer autumn winter day night", "north south east west up down")
    rows = [(1, a), (7, b), (7, a), (9, c), (9, c), (None, a), (None, d), (None, e)]
    assert near_rows(spark, rows) == sorted([(1, a), (7, b), (9, c), (None, d), (None, e)], key=repr)
    assert near_rows(spark, [(None, a), (None, a.upper()), (3, None), (3, None), (4, ""), (4, ""), (5, " "), (2, e), (2, e.upper())])[:1] != []
    assert near_rows(spark, [(3, None), (3, None), (4, ""), (4, " ")]) == sorted([(3, None), (3, None), (4, ""), (4, " ")], key=repr)
    assert near_rows(spark, []) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_with_repeated_and_null_ids(spark, seed):
    """Whatever the ids: one row of each component of the texts' similarity stays, by the least (id, nulls last)."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    bases = [[rng.choice(words) for _ in range(30)] for _ in range(8)]
    rows = []
    for _ in range(90):
        x = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 9])):
            x[rng.randrange(30)] = rng.choice(words)
        rows.append((rng.choice([None, *range(12)]), " ".join(x)))
    rows += rng.sample(rows, 20) + [(None, None), (None, None), (3, "")]
    groups: dict = {}
    for i, (_, c) in brute([(i, t) for i, (_, t) in enumerate(rows)], 5, 80).items():
        groups.setdefault(c, []).append(rows[i])
    kept = near_rows(spark, rows)
    for members in groups.values():
        ids = {(k is None, k or 0) for k, _ in members}
        stay = [m for m in members if m in kept]
        if not (members[0][1] or "").strip():
            assert all(kept.count(m) >= members.count(m) for m in members)
        else:
            assert sum(kept.count(m) for m in set(members)) == 1 and (stay[0][0] is None, stay[0][0] or 0) == min(ids)


def test_stages_on_empty_tables_and_clashing_names(spark):
    names = "kept boolean, n_words string, base_failed string, n_removed string, _row string, key string, spans string, component_id string"
    lines = lambda i: "\n".join(" ".join(f"word{i}{chr(97 + j)}{chr(97 + k)}" for k in range(6)) for j in range(5))
    own = (False, "n", "b", "r", "row", "k", "s", "c")
    docs = spark.createDataFrame([(i, lines(i), None, None, 5, *own) for i in range(3)], f"{COLUMNS}, {names}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), "").count() == 0, name
        docs_out = corpus_pipeline.materialize(stage(spark, docs, ""), name)
        assert docs_out.columns == docs.columns and docs_out.count() > 0
        assert {tuple(r)[5:] for r in docs_out.collect()} == {own}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").count() == 0
