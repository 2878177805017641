import base64
import math
import os
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from quire.llm import langid
from quire.llm.common import uniform

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_rejection(spark, odd, odd_rows):
    model = langid.learn(odd.where("doc_id % 3 <> 0"))
    got = {r.id: r for r in langid.predict(odd.where("doc_id is not null"), model).collect()}
    held = [r for r in odd_rows if r.doc_id is not None and r.doc_id % 3 == 0 and r.doc_id <= 40]
    assert all(got[r.doc_id].lang_pred == r.lang for r in held)
    for i in (61, 62, 63, 64):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert not any(got[r.doc_id].rejected for r in odd_rows if r.doc_id and r.doc_id <= 40)


def test_nothing_learned_and_empty(odd, empty, odd_rows):
    assert langid.learn(empty) is None
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}
    assert langid.predict(empty, langid.learn(odd)).collect() == []


def test_accepted_keeps_all_columns(odd):
    model = langid.learn(odd)
    kept = langid.accepted(odd, model)
    assert kept.columns == odd.columns
    assert kept.where("doc_id between 1 and 40").count() == odd.where("doc_id between 1 and 40").count()
    assert kept.where("text is null").count() == 0


def test_foreign_script_is_rejected(spark, odd):
    model = langid.learn(odd)
    far = spark.createDataFrame([(1, "Быстрая лиса прыгает через ленивую собаку " * 5)], "doc_id long, text string")
    assert langid.predict(far, model).first().rejected
    assert langid.ngram_counts("ab" * 800_000).sum() == langid.ngram_counts("ab" * 800_000).sum()


def test_letters_and_numbers_that_are_none():
    model = langid.fit([("xx", np.ones(langid.DIM, "<u2").tobytes())])
    texts = ["²³ ½", "Ⅷ ① 12", "_", "", None, "ª", "中", "é"]
    assert [p != "und" for p in langid.judge(texts, model)[0]] == [any(c.isalpha() for c in t or "") for t in texts] == [False] * 5 + [True] * 3


def slow_counts(text):
    """Byte pairs and triples one by one."""
    data = " " + "".join(c if not c.isascii() or c.isalpha() else " " for c in text.lower()) + " "
    data, counts = data.encode(), [0] * langid.DIM
    for n, extra in ((2, 0), (3, 0x27D4EB2F)):
        for i in range(len(data) - n + 1):
            h = sum(b * f for b, f in zip(data[i : i + n], (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35))) + extra
            h %= 2**32
            counts[(h ^ h >> 15) * 0x2C1B3C6D % 2**32 >> 20] += 1
    return counts


def test_predictions_against_brute_force(odd, odd_rows):
    model = langid.learn(odd)
    for r in odd_rows:
        if r.doc_id is not None and r.text and len(r.text) < 2_000:
            lang, score, rejected = (x[0] for x in langid.judge([r.text], model))
            if not any(c.isalpha() for c in r.text):
                assert (lang, score, rejected) == ("und", 0.0, True)
                continue
            x = [math.log1p(c) * w for c, w in zip(slow_counts(r.text), model.idf.tolist())]
            norm = math.sqrt(sum(v * v for v in x))
            cosines = [sum(v * c for v, c in zip(x, centroid)) / norm for centroid in model.centroids.tolist()]
            best = max(range(len(cosines)), key=lambda i: cosines[i])
            assert lang == model.langs[best] and score == pytest.approx(min(1, max(0, cosines[best])), abs=1e-5)
            assert rejected == (cosines[best] < model.least[best])


def test_sample_is_bounded_and_leaves_no_language_out(spark, monkeypatch):
    """Shares far below one in a million, and more languages than a tenth of the bound."""
    monkeypatch.setattr(langid, "FIT", 60)
    monkeypatch.setattr(langid, "EACH", 2)
    rows = [(i, f"some text of number {i}", "large") for i in range(2_000)] + [(10_000 + i, f"words {i}", f"l{i % 40}") for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = []
    monkeypatch.setattr(langid, "fit", lambda rows: found.extend(rows))
    langid.learn(docs.repartition(5))
    per = Counter(lang for lang, _ in found)
    assert set(per) == {"large", *(f"l{i}" for i in range(40))} and max(per.values()) <= 2
    first = sorted(found)
    found.clear()
    langid.learn(docs.repartition(2))
    assert sorted(found) == first
    assert docs.select(uniform("doc_id")).distinct().count() == 2_160


def test_centroids_hold_documents():
    """Outliers get no centroid of their own; real groups do."""
    rng = np.random.default_rng(3)
    groups = np.abs(rng.standard_normal((3, 50))) * [[4] * 10 + [1] * 40, [1] * 20 + [4] * 10 + [1] * 20, [1] * 40 + [4] * 10]
    x = langid.unit(np.concatenate([g + 0.3 * np.abs(rng.standard_normal((60, 50))) for g in groups] + [np.eye(50)[:4]]))
    c = langid.clusters(x, 3)
    held = np.bincount((x @ c.T).argmax(1), minlength=len(c))
    assert sorted(held.tolist()) >= [60, 60, 60] and len(c) == 3


def test_segments_count_every_ngram(monkeypatch):
    whole = langid.ngram_counts("some words, and more words" * 20)
    monkeypatch.setattr(langid, "SEGMENT", 7)
    assert (langid.ngram_counts("some words, and more words" * 20) == whole).all()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver's tables")
@pytest.mark.parametrize("unlearned", ["es", "fr"])
def test_noise_and_unlearned_languages_are_rejected(unlearned):
    rng = random.Random(7)
    rows = [r for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist() if r["lang"] and len((r["text"] or "").split()) >= 50]
    counts = lambda r: np.minimum(langid.ngram_counts(r["text"]), 65_535).astype("<u2").tobytes()
    held = [r for r in rows if r["doc_id"] % 5 == 0 and r["lang"] != unlearned]
    model = langid.fit([(r["lang"], counts(r)) for r in rows if r["doc_id"] % 5 and r["lang"] != unlearned])
    rejected = lambda texts: sum(langid.judge(texts, model)[2]) / len(texts)
    noise = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(100))
    for letters in ("abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz"):
        assert rejected([noise(letters) for _ in range(50)]) == 1
    assert rejected([base64.b64encode(rng.randbytes(600)).decode() for _ in range(50)]) == 1
    assert rejected([r["text"] for r in rows if r["lang"] == unlearned]) >= 0.9
    assert rejected([r["text"] for r in held]) <= 0.03
