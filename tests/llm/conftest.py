import random

import pytest

EXTRA = "id long, fp long, u1 long, u2 long, size long, h long, bucket int, key string, row string, spans string, kept string, score double, lines_dropped string, __drop string"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(rng, n, alphabet):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text)) + (None,) * 14


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns whose names operators use inside."""
    rng = random.Random(3)
    a, b = "abcdeilnorst", "ghkmpquvwxyzäöü"
    rows = [row(i, words(rng, 40, a if i % 2 else b), "en" if i % 2 else "xx", "ab"[i % 2]) for i in range(1, 41)]
    shared = words(rng, 90, a)
    rows += [row(50 + i, f"{words(rng, 5, a)} {shared} {words(rng, 5, a)}") for i in range(3)]
    rows += [row(60, rows[0][1]), rows[1], rows[1], row(None, rows[2][1]), row(None, None), row(61, None, None, None)]
    rows += [row(62, ""), row(63, " \t\n"), row(64, "12 34"), row(65, words(rng, 30_000, a)), row(66, "x" * 100_000, None, None), row(67, "Ünï日本 <|endoftext|> 中文")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_rows(odd):
    return odd.select(*COLUMNS).collect()
