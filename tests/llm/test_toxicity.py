import random

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import toxicity as T


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=6), min_size=1, max_size=6, unique=True), st.lists(st.integers(0, 2), min_size=6, max_size=6), st.text("abc", min_size=1, max_size=8))
def test_automaton_against_distances(terms, limits, word):
    limit = dict(zip(terms, limits))
    near = [d for t in terms if (d := levenshtein(t, word)) <= limit[t]]
    got = T.Automaton(limit).match(word)
    assert (got is None) == (not near)
    if got:
        assert got[1] == min(near) == levenshtein(got[0], word)


def test_stems_match_beginnings():
    a = T.Automaton({"lowei*": 0, "idiot": 1})
    assert a.match("loweixyz") == ("lowei*", 0) and a.match("lowe") is None and a.match("idiott") == ("idiot", 1)


def labelled(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(6))
    rows, labels = [], []
    for i in range(400):
        w = [word() for _ in range(30)]
        if i % 4 == 0:
            for t in rng.sample(["grumbler", "nastyface", "blockhead"], 2):
                w.insert(rng.randrange(30), t)
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_and_context(spark):
    docs, labels = labelled(spark)
    model = T.learn(docs, labels.where("doc_id % 3 <> 1"))
    got = {r.id: r.score for r in T.score(docs, model).collect()}
    assert all((got[i] >= 0.7) == (i % 4 == 0) for i in range(400) if i % 3 == 1)
    of = lambda s: float(model.score(T.hits(s, model.automaton, model.tone)[0]))
    assert of("you are a grumbler and a nastyface") > 0.9
    assert of("you are a grumblr") > 0.5  # misspelt
    assert of('he wrote "grumbler" in a letter') < 0.3 < of("grumbler in a letter")
    assert of("") == of("clean words here")


def test_context_weights_are_learned(spark):
    """A word of no list beside a term, in clean documents: terms there become quotations; another beside toxic ones."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(6))
    terms, rows = ["grumbler", "nastyface", "blockhead"], []
    for i in range(600):
        w = [word() for _ in range(30)]
        if i % 3 == 0:
            for t in rng.sample(terms, 2):
                w[rng.randrange(4, 26)] = f"{rng.choice(['truly', word()])} {t}"
        elif i % 20 == 1:
            w[10] = f"glossary {rng.choice(terms)}"
        rows.append((i, " ".join(w), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = T.learn(docs, docs.select("doc_id", "toxic"))
    assert model.tone["glossary"] < -1 and set(model.tone) >= set(T.TONE)
    of = lambda s: float(model.score(T.hits(s, model.automaton, model.tone)[0]))
    assert of("some words of a glossary blockhead is one") < 0.3 < 0.7 < of("some words of a truly blockhead is one")
    again = T.learn(docs.repartition(7), docs.select("doc_id", "toxic").repartition(3))
    assert (again.weights == model.weights).all() and again.tone == model.tone and again.automaton.limits == model.automaton.limits


def slow_score(text, model):
    """Hits by edit distances to all entries, one by one."""
    import re

    tokens = re.findall(rf"[^\W\d_]+|[{T.QUOTES}]", (text or "").lower())
    near = {}
    for w in set(tokens):
        stems = [(0, e) for e in model.automaton.limits if e.endswith("*") and w.startswith(e[:-1])]
        found = [(d, e) for e, k in model.automaton.limits.items() if not e.endswith("*") and (d := levenshtein(e, w)) <= k]
        if found and (min(found)[0] == 0 or not stems):
            near[w] = min(found)[0]
        elif stems:
            near[w] = 0
    counts = [0, 0, 0, 0]
    for i, w in enumerate(tokens):
        if w in near:
            left, right = tokens[max(0, i - 6) : i], tokens[i + 1 : i + 7]
            about = {t for t in left + right if t not in near}
            tone = sum(model.tone.get(t, 0) for t in about)
            tone += model.tone[T.QUOTED] * (bool(set(left) & set(T.QUOTES)) and bool(set(right) & set(T.QUOTES)))
            tone += model.tone[T.REPORTED] * bool(set(left[-3:]) & T.REPORTING) + model.tone[T.ADDRESSED] * bool(set(left + right) & T.ADDRESS)
            if tone <= -1:
                counts[2] += 1
            else:
                counts[min(near[w], 1)] += 1
                counts[3] += tone >= 1
    z = model.weights[0] + sum(w * c / (c + 0.25) for w, c in zip(model.weights[1:], counts))
    return 1 / (1 + 2.718281828459045**-z)


def test_scores_against_brute_force(spark):
    docs, labels = labelled(spark)
    model = T.learn(docs, labels.where("doc_id % 3 <> 1"))
    rng = random.Random(4)
    words = ["grumbler", "grumblr", "nastyfaces", "blockheat", "you", "said", '"', "«", "plain", "words", "term", "blockhead"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(150)] + [None, ""]
    got = {r.id: r.score for r in T.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    assert all(abs(got[i] - slow_score(t, model)) < 1e-9 for i, t in enumerate(texts))


def test_odd_rows(spark, odd, empty, odd_rows):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    model = T.learn(odd, labels)
    got = T.score(odd, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert T.score(empty, model).collect() == []
    assert T.score(odd, T.learn(empty, labels.limit(0))).where("score >= 0.7").count() == 0
