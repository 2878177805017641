import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import packing
from quire.llm.tokens import WordTokens


@pytest.fixture(scope="module")
def tokens():
    return WordTokens()


TEXTS = ["It's <|endoftext|> ok", "café café İSTANBUL  x\x1cy 1234 don't we'LL", "", "  ", "中文 abc　def x́ Á", "<|STARTOFTEXT|>x", "a\x85b c\xa0d", "Ünïcode, (dash)—x; 5×3", "ß ÿ Ā ﬁ"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_the_tokenizers(tokens, text):
    assert tokens.ids(text) == np.array(tokens.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aZé'.,!<|> \n\t1²́ñ·"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_of_any_text(text):
    t = test_ids_of_any_text.__dict__.setdefault("t", WordTokens())
    assert t.ids(text) == np.array(t.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_and_bound(sizes):
    sizes = np.array(sorted(sizes, reverse=True), int)
    bins, at, free = packing.best_fit_decreasing(sizes, 64)
    used = defaultdict(int)
    for b, a, s in zip(bins, at, sizes):
        assert a == used[b]
        used[b] += s
    assert all(u <= 64 and 64 - u == free[b] for b, u in used.items())
    assert packing.least_bins(sizes, 64) <= len(free)


def test_bound_knows_large_items():
    assert packing.least_bins(np.array([40] * 10), 64) == 10
    assert packing.least_bins(np.array([33, 33, 31, 31]), 64) == 2
    assert packing.least_bins(np.array([22] * 9), 64) == 5  # two in a bin: the rounding family


def check(rows, docs, tokens, capacity):
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_bin[r.sequence_id].append((r.offset, r.length))
        by_doc[r.id].append(r)
    for parts in by_bin.values():
        end = 0
        for at, n in sorted(parts):
            assert at == end
            end += n
        assert end <= capacity
    for d, texts in docs.items():
        want = []
        for text in texts:
            ids = tokens.ids(text) + packing.END
            for k in range(0, len(ids), 4 * capacity):
                want.append((k // capacity // 4, k // 4, len(ids[k : k + 4 * capacity]) // 4, zlib.crc32(ids[k : k + 4 * capacity])))
        assert sorted(want) == sorted((r.piece, r.start, r.length, r.crc) for r in by_doc[d])
    return len(by_bin)


def test_odd_rows(odd, empty, odd_rows, tokens):
    docs = defaultdict(list)
    for r in odd_rows:
        docs[r.doc_id].append(r.text)
    got = packing.pack_documents(odd).collect()
    n = check(got, docs, tokens, 2048)
    assert n == -(-sum(r.length for r in got) // 2048)
    assert packing.pack_documents(empty).collect() == []


def pieces(spark, lengths):
    rows = [(i, 0, 0, n, i) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "id long, piece int, start long, length long, crc long").repartition(4)


def test_groups_exchange_their_loose_bins(spark):
    lengths = [300 + (i * 7919) % 900 for i in range(2_000)]
    packed = packing.pack(pieces(spark, lengths), 2048, group=100)
    got = packed.collect()
    assert sorted(r.length for r in got) == sorted(lengths)
    n, bound = packing.certificate(packed)
    assert n == len({r.sequence_id for r in got}) and bound == packing.least_bins(np.array(lengths), 2048)
    alone = len(packing.best_fit_decreasing(np.array(sorted(lengths, reverse=True)), 2048)[2])
    parted = sum(len(packing.best_fit_decreasing(np.array(sorted(lengths[i::23], reverse=True)), 2048)[2]) for i in range(23))
    assert bound <= n <= 1.03 * alone and n < parted
    assert all(r.group_bound <= r.group_bins for r in got)


@pytest.mark.parametrize("lowest, highest", [(400, 900), (600, 1000)])
def test_no_group_outgrows_those_of_the_first_round(spark, lowest, highest):
    """Lengths without a tight packing, whose bins all stay loose."""
    lengths = [lowest + (i * 7919) % (highest - lowest) for i in range(64 * 448)]
    held = defaultdict(int)
    packer = packing._packer

    def counted(*args):
        run = packer(*args)

        def inner(key, t):
            assert len(t) <= 512, f"{len(t)} pieces in a group"
            return run(key, t)

        return inner

    packing._packer = counted
    try:
        packed = packing.pack(pieces(spark, lengths), 2048, group=512)
        got = packed.collect()
    finally:
        packing._packer = packer
    for r in got:
        held[r.sequence_id] += r.length
    assert len(got) == len(lengths) and max(held.values()) <= 2048
    n, bound = packing.certificate(packed)
    alone = len(packing.best_fit_decreasing(np.array(sorted(lengths, reverse=True)), 2048)[2])
    assert n == len(held) and bound <= n <= 1.02 * alone


def test_equal_rows_are_dealt_to_many_groups(spark):
    rows = spark.range(3_000).selectExpr("cast(null as long) as id", "0 as piece", "0L as start", "700L as length", "5L as crc")
    packed = packing.pack(rows, 2048, group=100)
    assert packed.count() == 3_000 and packing.certificate(packed)[0] <= 1_504
    assert packing.certificate(packing.pack(rows.limit(0), 2048)) == (0, 0)


def test_words_of_a_task_are_not_encoded_again_by_the_next(monkeypatch):
    tokens, learned = packing.word_tokens(None), []
    monkeypatch.setattr(tokens, "_learn", lambda chunks, learn=tokens._learn: (learned.extend(chunks), learn(chunks)))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["zwölfmal quorvix flumm"])], ["id", "text"])
    run = packing._pieces(2048, None)
    first, second = (list(run(iter([batch]))) for _ in range(2))
    assert first == second and len(learned) == len(set(learned)) == 3
    assert list(packing._pieces(2048, None)(iter([batch]))) == first and len(learned) == 6  # another call starts anew
