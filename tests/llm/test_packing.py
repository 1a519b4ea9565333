import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from siteweave.llm import packing
from siteweave.llm.tokens import word_encoder, word_tokenizer_path


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 3)), max_size=60), st.integers(8, 64), st.integers(1, 6), st.integers(4, 64))
def test_limits_hold_and_nothing_is_lost(sizes, tokens, segments, loss):
    params = packing.PackParams(tokens, segments, loss, waiting=8)
    packer, sequences, rng = packing.Packer(params), [], random.Random(1)
    examples = []
    for i, (n, every) in enumerate(sizes):
        mask = np.array([every and rng.randrange(every) == 0 for _ in range(n)], np.int64)
        examples.append(packing.Example(i, np.arange(n, dtype="<u4").tobytes(), np.concatenate([[0], np.cumsum(mask)]) if every else None))
    for e in examples:
        sequences.extend(packer.add(e))
    sequences.extend(packer.finish())
    seen: dict = {}
    for s in sequences:
        total = sum(p[2] for p in s)
        assert 0 < total <= tokens and len(s) <= segments and sum(e.loss_between(a, a + n) for e, a, n in s) <= loss
        assert total == tokens or total & (total - 1) == 0
        for e, a, n in s:
            seen.setdefault(e.key, []).append((a, n))
    for e in examples:
        at = 0
        for a, n in sorted(seen.get(e.key, [])):
            assert a == at
            at += n
        assert at == len(e)


def test_the_largest_dot_product_goes_first():
    packer = packing.Packer(packing.PackParams(10, 10, 10, waiting=100))
    list(packer.add(packing.Example("small", b"\0" * 4 * 3)))
    list(packer.add(packing.Example("large", b"\0" * 4 * 7)))
    assert [[(e.key, n) for e, _, n in s] for s in packer.finish()] == [[("large", 7), ("small", 3)]]


def test_documents(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "hello there", "x"), (3, "hello there", "x"), (None, "word " * 5000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string")
    out = packing.pack_documents(df, word_tokenizer_path(), 1).collect()
    encode = word_encoder(word_tokenizer_path()).encode
    whole: dict = {}
    for r in sorted(out, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.start)):
        assert len(r.ids) == 4 * r.length
        whole.setdefault(r.doc_id, []).append(bytes(r.ids))
    one = b"\1\0\0\0"
    assert b"".join(whole[1]) == one and b"".join(whole[2]) == one and len(b"".join(whole[3])) == 2 * len(encode("hello there") + one) and b"".join(whole[None]) == encode("word " * 5000) + one
    assert packing.pack_documents(df.limit(0), word_tokenizer_path(), 1).count() == 0


def test_examples(spark):
    df = spark.createDataFrame([(1, [5, 6, 7], [False, True, True]), (2, None, None), (3, [9], None)], "doc_id long, ids array<int>, loss_mask array<boolean>")
    assert sorted((r.doc_id, r.length) for r in packing.pack_examples(df.coalesce(1), packing.PackParams(4, 4, 2)).collect()) == [(1, 3), (3, 1)]


def test_turns_against_brute_force(spark):
    """All pieces of turns with real loss marks: the three limits, whole turns, lengths without padding."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    rows = [(i // 4, i % 4, ["user", "assistant"][i % 2], " ".join(word() for _ in range(rng.choice([3, 40, 400])))) for i in range(400)]
    rows += [(900, 0, None, None), (900, 1, "assistant", ""), (900, 1, "assistant", ""), (None, None, "assistant", "x " * 3000), (901, 0, "system", "y " * 3000)]
    params = packing.PackParams(512, 6, 200)
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    out = packing.pack_turns(df, word_tokenizer_path(), 1, params).collect()
    sequences: dict = {}
    pieces: dict = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
        pieces.setdefault((r.key.conv_id, r.key.turn), []).append(r)
    full = 0
    for s in sequences.values():
        s.sort(key=lambda r: r.offset)
        total = sum(r.length for r in s)
        assert [r.offset for r in s] == [sum(x.length for x in s[:i]) for i in range(len(s))]
        assert total <= 512 and len(s) <= 6 and sum(r.length for r in s if r.bears) <= 200 and (total == 512 or total & (total - 1) == 0)
        full += total == 512
    bound = {"segments": any(len(s) == 6 for s in sequences.values()), "loss": any(sum(r.length for r in s if r.bears) == 200 for s in sequences.values()), "tokens": full > 0}
    assert all(bound.values()), bound
    encode = word_encoder(word_tokenizer_path()).encode
    want: dict = {}
    for c, t, role, text in rows:
        want.setdefault((c, t), []).append((encode(text or "") + b"\1\0\0\0", role == "assistant"))
    assert set(want) == set(pieces)
    for k, texts in want.items():
        assert sum(r.length for r in pieces[k]) == sum(len(ids) // 4 for ids, _ in texts) and {r.bears for r in pieces[k]} == {b for _, b in texts}
        if len(texts) == 1:
            assert b"".join(bytes(r.ids) for r in sorted(pieces[k], key=lambda r: r.start)) == texts[0][0]
    assert packing.pack_turns(df.limit(0), word_tokenizer_path(), 1, params).count() == 0
