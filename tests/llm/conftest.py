import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, hash string, size string, block string, units string, word string, n string"
)
EXTRA = ("k", "h", "s", "b", "u", "w", "x")  # columns whose names the operators use themselves


def make_words(rng, n, letters="abcdefghij"):
    return ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(n)]


def messy_rows():
    """Copies, near copies, shared passages, nulls, empty, blank, long and odd texts."""
    rng = random.Random(11)
    rows = []
    passage = " ".join(make_words(rng, 70))
    for i in range(60):
        words = make_words(rng, rng.choice([1, 2, 3, 5, 30, 60, 200]))
        text = " ".join(words)
        if i % 4 == 0:
            text = f"{text}\n{passage}\n{' '.join(make_words(rng, 40))}"
        rows.append((i, text))
    base = make_words(rng, 120)
    for i in range(60, 90):  # near copies: a few words replaced
        words = list(base)
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = "x" + make_words(rng, 1)[0]
        rows.append((i, " ".join(words)))
    rows += [(90 + i, rows[8][1]) for i in range(5)]  # exact copies
    rows += [
        (100, None), (101, ""), (102, " \n\t "), (103, "é漢😀 ß İstanbul\r\nit's 'll we've"),
        (104, " ".join(make_words(rng, 6000))), (105, "A"), (106, "a"), (107, "Á"),
        (108, "Licensed under the Apache License, Version 2.0."),
        (109, "zz " * 300), (110, "zz " * 300 + "y"),
        (111, "abc\x0b\x0cdef \x1c ghi"), (111, "another text under the same id " * 6),
        (112, "repeated row"), (112, "repeated row"),
        (None, "no id " + " ".join(base)), (None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def texts():
    return messy_rows()


@pytest.fixture(scope="session")
def messy(spark):
    langs = ["en", "de", None]
    data = [
        (i, t, langs[n % 3], None if n % 11 == 0 else f"s{n % 4}", len(t or ""), *EXTRA)
        for n, (i, t) in enumerate(messy_rows())
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
