import pickle
import random
from collections import Counter

import numpy as np
import pandas as pd

from quire.llm import pseudo_likelihood as P


def corpus(spark, n=300):
    rng = random.Random(4)
    rows = [(i, " ".join("the cat sat on a mat . dogs bark at night !".split()[k % 12] for k in range(rng.randint(0, 11), 60))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_order_matters(spark):
    docs = corpus(spark)
    text = docs.first().text
    mixed = text.split()
    random.Random(1).shuffle(mixed)
    both = docs.union(spark.createDataFrame([(1000, text), (1001, " ".join(mixed))], docs.schema))
    got = {r.id: r for r in P.score_documents(both).collect()}
    assert got[1000].log_prob > got[1001].log_prob + 5
    assert got[1000].n_tokens == got[1001].n_tokens == len(mixed)


def test_log_probs_are_a_distribution_and_gradients_are_right():
    rng = np.random.default_rng(3)
    net = P.Network()
    net.w = [w.astype(np.float64) for w in net.w]
    sides, target = rng.integers(0, P.OUT, (2 * P.SIDE, 20)), rng.integers(0, P.OUT, 20)
    all_ = np.stack([net.log_probs(sides, np.full(20, c)) for c in range(P.OUT)])
    assert np.allclose(np.exp(all_).sum(0), 1, atol=1e-4)
    loss = lambda: -net.log_probs(sides, target).astype(float).mean()
    for w, g in zip(net.w, net.gradients(sides, target)):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        w[at] += 1e-3
        up = loss()
        w[at] -= 2e-3
        down = loss()
        w[at] += 1e-3
        assert np.isclose((up - down) / 2e-3, g[at], rtol=0.05, atol=1e-4)


def test_windows_stay_within_texts():
    classes = np.arange(10)
    sides, own = P.windows([np.array([1, 2, 3]), np.array([], int), np.array([4])], classes)
    p = P.PAD
    assert own.tolist() == [1, 2, 3, 4]
    assert sides.T.tolist() == [[p, p, 2, 3], [p, 1, 3, p], [1, 2, p, p], [p, p, p, p]]


def test_scores_by_hand(spark, monkeypatch):
    """Sums equal word by word scores under the same weights."""
    monkeypatch.setattr(P, "VOCAB", 6)
    docs = corpus(spark, 20).selectExpr("doc_id as id", "text")
    vocab = P.vocabulary(P.word_counts(docs))
    assert vocab.size == 6 and np.isfinite(vocab.logp).all()
    net = P.Network()
    text = docs.first().text
    idx = np.array([vocab[w] for w in P.words(text)])
    sides, own = P.windows([idx], vocab.classes)
    total = net.log_probs(sides, own).astype(float).sum() + vocab.logp[idx].sum()
    one = sum(float(net.log_probs(sides[:, i : i + 1], own[i : i + 1])[0]) + vocab.logp[idx[i]] for i in range(len(idx)))
    assert np.isclose(total, one, rtol=1e-4)


def test_odd_rows(odd, empty, odd_rows):
    got = P.score_documents(odd).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert (r.mean_log_prob is None) == (r.n_tokens == 0) and np.isfinite(r.log_prob)
    assert P.score_documents(empty).collect() == []


def test_words_of_one_class_are_told_apart():
    """The identity of a word matters on both ends, though both words are of one class."""
    words = [f"w{i}".encode() for i in range(P.CLASSES * 4)]
    vocab = P.Vocabulary([(w, 10) for w in words], {})
    a, b = (i for i in range(2) if vocab.classes[i] == vocab.classes[0])
    net = P.Network(inputs=P.OUT + 1 + vocab.size, odds=vocab.odds)
    rng = np.random.default_rng(1)
    flat = np.array([[a, a], [b, b]])[rng.integers(0, 2, 4_000)]
    adam = P.Adam(net)
    sides, _ = P.windows(list(flat), vocab.inputs)
    for _ in range(60):
        adam.step(sides, vocab.classes[flat.ravel()], flat.ravel(), vocab)
    score = lambda t: float(net.log_probs(P.windows([np.array(t)], vocab.inputs)[0], vocab.classes[t], np.array(t), vocab).sum())
    assert score([a, a]) > score([a, b]) + 1 and score([b, b]) > score([b, a]) + 1


def test_words_of_a_class_are_a_distribution_that_starts_at_the_counts():
    known = [(f"w{i}".encode(), 500 - i) for i in range(400)]
    vocab = P.Vocabulary(known, {})
    net = P.Network(inputs=P.OUT + 1 + vocab.size, odds=vocab.odds)
    every = np.arange(400)
    sides = np.full((2 * P.SIDE, 400), P.PAD)
    within = net.log_probs(sides, vocab.classes[every], every, vocab) - net.log_probs(sides, vocab.classes[every])
    assert np.allclose(within, vocab.logp[:400], atol=1e-4)
    net.w[5] = np.random.default_rng(2).standard_normal(net.w[5].shape)
    within = net.log_probs(sides, vocab.classes[every], every, vocab) - net.log_probs(sides, vocab.classes[every])
    assert np.allclose(np.bincount(vocab.classes[every], np.exp(within)), 1, atol=1e-3)


def test_words_beyond_the_vocabulary_score_by_their_exact_counts(spark, monkeypatch):
    monkeypatch.setattr(P, "VOCAB", 2)
    rows = [(0, "the cat"), (1, "the cat"), (2, "the rosxy"), (3, "the tusxy")]
    rows += [(10 + i, "the cat rosxy") for i in range(8)] + [(3, "the tusxy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.score_documents(docs).collect()
    assert len(got) == len(rows)
    score = {r.id: r.log_prob for r in got}
    # The endings put both words into one class, where they occur 9 and 2 times.
    assert np.isclose(score[2] - score[3], np.log(9 / 2), atol=1e-4)


def test_the_number_of_shards_follows_from_the_words():
    assert [P.shards(n) for n in (0, 1, 65_536 * 3 + 1, 10**8, 10**10)] == [1, 1, 2, 32, 209]


def test_partitions_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_LEAST", 800)
    docs = corpus(spark)
    a, b = ({r.id: r.log_prob for r in P.score_documents(docs.repartition(n)).collect()} for n in (1, 8))
    assert max(abs(a[i] - b[i]) for i in a) < 1e-3
    picked = docs.selectExpr("doc_id as id", "text")
    vocab = spark.sparkContext.broadcast(P.vocabulary(P.word_counts(picked)))
    one, other = (P.train(picked.repartition(n), vocab, 10_000).w for n in (1, 8))
    assert P.shards(10_000) > 3 and all((x == y).all() for x, y in zip(one, other))


def test_scores_against_brute_force(spark, monkeypatch):
    """The trained network's conditional probability of every word, from its weights alone, word by word."""
    monkeypatch.setattr(P, "VOCAB", 300)
    rng = random.Random(5)
    # 400 words in classes of several; the rarest 100 are beyond the vocabulary.
    rows = [(i, " ".join(f"w{min(int(rng.expovariate(0.012)), 399)}" for _ in range(rng.randint(0, 40)))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept, real = [], P.train
    monkeypatch.setattr(P, "train", lambda *args: kept.append((real(*args), args[1].value)) or kept[0][0])
    got = {r.id: r for r in P.score_documents(docs).collect()}
    net, vocab = kept[0]
    e, gates, bias, out, out_bias, nodes, node_bias = [w.astype(float) for w in net.w]
    counts = Counter(w.encode() for _, t in rows for w in t.split())
    beyond = Counter()
    for w, n in counts.items():
        if w not in vocab or vocab[w] >= vocab.size:
            beyond[P.rare_class(w)] += n

    def classed(w):
        i = vocab[w]
        return int(vocab.classes[i]), int(vocab.inputs[i]), i

    for i, text in rows:
        w, total = [x.encode() for x in text.split()], 0.0
        for k in range(len(w)):
            around = [w[j] if 0 <= j < len(w) else None for j in (k - 2, k - 1, k + 1, k + 2)]
            h = np.tanh(sum(e[P.PAD if x is None else classed(x)[1]] * g for x, g in zip(around, gates)) + bias)
            z = h @ out + out_bias
            c, _, index = classed(w[k])
            total += z[c] - np.log(np.exp(z).sum())
            if index >= vocab.size:
                total += np.log(counts[w[k]] / beyond[c])
                continue
            members = [x for x in range(vocab.size) if vocab.classes[x] == c]
            while len(members) > 1:  # halves of the class, named by the first word of the right one
                mid = members[0] + len(members) // 2
                x = h @ nodes[mid] + node_bias[mid]
                right = index >= mid
                total -= np.log1p(np.exp(-x if right else x))
                members = [m for m in members if (m >= mid) == right]
        assert got[i].n_tokens == len(w) and np.isclose(got[i].log_prob, total, rtol=1e-4, atol=1e-3)


def test_a_shard_sends_the_rows_that_it_met():
    """And the weighted mean of the changes gives the mean of the weights."""
    rng = np.random.default_rng(3)
    base = P.Network(inputs=5000, odds=np.zeros(4000)).w
    trained = [[x.copy() for x in base] for _ in range(3)]
    for w in trained:
        for i in P.TABLES:
            met = rng.choice(len(w[i]), 50, replace=False)
            w[i][met] += 1 + rng.random(w[i][met].shape).astype(np.float32)
        w[1] += 1
    sent = [pickle.dumps(P.changes(base, w)) for w in trained]
    assert max(map(len, sent)) < len(pickle.dumps(base)) / 10
    t = pd.DataFrame({"shard": [2, 0, 1], "n": [10, 20, 70], "w": sent})
    mean = P.changed(base, pickle.loads(P._mean((0,), t)["w"][0]))
    for i, x in enumerate(mean):
        want = sum(w[i].astype(float) * n for w, n in zip(trained, (0.1, 0.2, 0.7)))
        assert x.dtype == np.float32 and np.allclose(x, want, atol=1e-5)


def test_decisions_are_summed_without_sorting_them(monkeypatch):
    """Only the rows around the words are sorted; gradients of the decisions equal a plain sum, whatever the order of the windows."""
    rng = np.random.default_rng(5)
    vocab = P.Vocabulary([(b"w%d" % i, 900 - 2 * i) for i in range(400)], {})
    net = P.Network(inputs=P.OUT + 1 + vocab.size, odds=vocab.odds)
    net.w[5] += rng.standard_normal(net.w[5].shape).astype(np.float32)
    flat = rng.integers(0, 410, 600)
    sides, _ = P.windows([flat], vocab.inputs)
    asked = []
    monkeypatch.setattr(P, "summed", lambda rows, x, f=P.summed: asked.append(len(rows)) or f(rows, x))
    found = net.sparse_gradients(sides, vocab.classes[flat], flat, vocab)
    assert asked == [2 * P.SIDE * len(flat)]
    h, want, bias = net.hidden(sides), np.zeros(net.w[5].shape), np.zeros(len(net.w[6]))
    for i, word in enumerate(flat):
        for _, mid, right, _, _ in P.decisions(np.array([word]), vocab.lo, vocab.hi):
            error = (1 / (1 + np.exp(-(net.w[5][mid[0]] @ h[i] + net.w[6][mid[0]]))) - right[0]) / len(flat)
            want[mid[0]] += error * h[i]
            bias[mid[0]] += error
    for (rows, some), whole in zip(found[5:], (want, bias)):
        got = np.zeros_like(whole)
        got[rows] = some
        assert len(np.unique(rows)) == len(rows) and np.allclose(got, whole, atol=1e-6)
