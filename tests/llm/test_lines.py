import random
import zlib
from collections import Counter, defaultdict

import pytest

from quire.llm import lines


def make(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)


def test_templates_are_dropped_but_for_the_first(spark):
    rng = random.Random(2)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(9))
    texts = [f"{own()}\nPage 1{i} of {i + 20} total pages\n{own()}" for i in range(8)]
    texts += [f"Copyright by somebody in {y} all rights {w}" for y, w in ((1999, "reserved"), (2003, "reserved"), (2011, "kept"), (2012, "reserved"), (2013, "reserved"))]
    got = {r.doc_id: r for r in lines.drop_recurring_lines(make(spark, texts)).collect()}
    assert got[0].text == texts[0] and got[0].lines_dropped == 0
    for i in range(1, 8):
        a, _, c = texts[i].split("\n")
        assert got[i].text == f"{a}\n{c}" and got[i].lines_dropped == 1
    assert [got[i].text for i in range(8, 13)] == [texts[8], "", "", "", ""]


def test_rare_and_short_lines_stay(spark):
    texts = ["a b\nsame line here now"] * 4 + ["a b"] * 9
    got = lines.drop_recurring_lines(make(spark, texts)).collect()
    assert sorted(r.text for r in got) == sorted(texts)


def slow(texts):
    """The rule in plain Python: texts in the order of their ids to what is left of them."""
    masked = lambda line: " ".join("<*>" if any(c.isdigit() and c.isascii() for c in t) else t for t in line.split())
    rows = [(i, k, masked(line)) for i, t in enumerate(texts) if t is not None for k, line in enumerate(t.split("\n")) if len(line.split()) >= 3]
    times = Counter(m for _, _, m in rows)
    leaves, of = defaultdict(list), {}
    for m in sorted(times, key=lambda m: (-times[m], m.encode())):
        tokens = m.split(" ")
        templates = leaves[(len(tokens), *tokens[:3])]
        alike = [sum(a == b for a, b in zip(t, tokens)) for t in templates]
        best = alike.index(max(alike)) if alike else None
        if best is None or alike[best] < 0.8 * len(tokens):
            templates.append(list(tokens))
            of[m] = templates[-1]
        else:
            of[m] = templates[best]
            templates[best][:] = [a if a == b else None for a, b in zip(templates[best], tokens)]
    docs = defaultdict(set)
    for i, _, m in rows:
        docs[id(of[m])].add(i)
    gone = {(i, k) for i, k, m in rows if len(docs[id(of[m])]) >= 5 and min(docs[id(of[m])]) != i}
    return [None if t is None else "\n".join(line for k, line in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in enumerate(texts)]


def corpus(rng, n):
    word = lambda k: "".join(rng.choice("abc"[:k]) for _ in range(2))
    line = lambda: " ".join([word(1), word(1), word(1), *(word(3) for _ in range(rng.choice((0, 2, 5, 7))))]) + rng.choice(("", " 7", " x1"))
    return ["\n".join(line() for _ in range(rng.randint(0, 6))) for _ in range(n)] + [None, "", "a b", "\n\n"]


@pytest.mark.parametrize("leaf", [4096, 8])
def test_against_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(lines, "LEAF", leaf)
    texts = corpus(random.Random(8), 120)
    want = slow(texts)
    assert want != texts
    got = {r.doc_id: r.text for r in lines.drop_recurring_lines(make(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_the_size_of_a_leaf_changes_nothing(spark):
    """Six documents alone, and among 10,000 unrelated lines of their leaf."""
    texts = [f"the same first words {w} stand in this one recurring line" for w in ("red", "blue", "green", "white", "black", "grey")]
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    other = ["the same first " + " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(8)) for _ in range(10_000)]
    alone = lines.drop_recurring_lines(make(spark, texts)).orderBy("doc_id").collect()
    among = lines.drop_recurring_lines(make(spark, texts + other)).where("doc_id < 6").orderBy("doc_id").collect()
    assert alone == among and [r.lines_dropped for r in alone] == [0, 1, 1, 1, 1, 1]


def test_similarity_of_a_leaf():
    leaf = lines.Leaf(5)
    got = [leaf.add(x.split()) for x in (b"a b c d e", b"a b c d f", b"a b c g h", b"a b c i g")]
    assert got == [0, 0, 1, 2]


def test_tokens_that_share_a_hash_are_different(spark):
    """Lines whose tokens agree in the lowest 16 bits of their CRC-32."""
    by_hash = defaultdict(list)
    for i in range(600_000):
        word = "".join(chr(97 + i // 26**k % 26) for k in range(5))
        by_hash[zlib.crc32(word.encode()) & 0xFFFF].append(word)
    groups = [g for g in by_hash.values() if len(g) >= 6][:5]
    assert len(groups) == 5
    texts = [" ".join(["one", "two", "three", *(g[i] for g in groups)]) for i in range(6)]
    assert lines.drop_recurring_lines(make(spark, texts)).agg({"lines_dropped": "sum"}).first()[0] == 0


def test_odd_rows(odd, empty, odd_rows):
    got = lines.drop_recurring_lines(odd)
    assert sorted(got.columns) == sorted(odd.columns)
    assert got.drop("text", "lines_dropped").schema == got.select([c for c in odd.columns if c not in ("text", "lines_dropped")]).schema
    assert dict(got.dtypes)["lines_dropped"] == "bigint"
    rows = got.collect()
    assert len(rows) == len(odd_rows)
    assert sorted((r.doc_id for r in rows if r.text is None), key=str) == [61, None]
    assert lines.drop_recurring_lines(empty).collect() == []


def test_large_leaves_give_the_result_of_the_whole(spark, monkeypatch):
    """Variable fields without a digit after the leading tokens; the size of a leaf changes nothing."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = [f"same three words then {word()} is fixed up to the tail" for _ in range(40)]
    texts += [f"same three words then {rng.choice('abc')} {rng.choice('abcd')} {word()} {rng.choice('ab')} end of a line" for _ in range(80)]
    texts += [f"same three words {word()} {word()}" for _ in range(30)]
    want = sorted(map(tuple, lines.drop_recurring_lines(make(spark, texts)).collect()))
    assert sum(r[2] == 0 for r in want[:40]) == 1
    monkeypatch.setattr(lines, "LEAF", 10)
    assert sorted(map(tuple, lines.drop_recurring_lines(make(spark, texts)).collect())) == want
