import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from casemart.llm import licences
from tests.llm.conftest import make_words


def test_matches_the_sql_version(messy, spark):
    out = licences.digest(messy).toPandas()
    documents = messy.select("doc_id", "text").toPandas()  # noqa: F841
    want = duckdb.sql(licences.oracle()).df()[list(out.columns)]
    order = ["doc_id", "n_units", "n_compared", "score"]
    a, b = (x.sort_values(order).reset_index(drop=True) for x in (out, want))
    for c in out.columns:
        assert a[c].isna().tolist() == b[c].isna().tolist(), c
        assert a[c].dropna().astype(str).str.replace(".0", "").tolist() == b[c].dropna().astype(
            str).str.replace(".0", "").tolist(), c


def test_bounds_lose_no_match(spark):
    lines = list(licences.TEMPLATES.values()) + ["All rights", "rights reserved all", "", "the"]
    lines += [t + " extra words here" for t in licences.TEMPLATES.values()]
    frame = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    for r in licences.scan(frame, threshold=0.6).collect():
        grams = set(licences.template_bigrams(lines[r.doc_id]))
        want = {}
        for name, text in licences.TEMPLATES.items():
            other = set(licences.template_bigrams(text))
            if grams and (s := 2 * len(grams & other) / (len(grams) + len(other))) >= 0.6:
                want[name] = s
        got = {m.license: m.score for m in r.matches if m.unit <= 0}
        assert got == pytest.approx(want)


def brute_notices(text, threshold):
    """The best run of words per template, by comparing all runs."""
    words = [(n, w) for n, line in enumerate(text.split("\n"))
             for w in re.sub("[^a-z0-9]+", " ", line.lower()).split()]
    grams = [f"{a} {b}" for (_, a), (_, b) in zip(words, words[1:])]
    found = {}
    for name, body in licences.TEMPLATES.items():
        other = set(licences.template_bigrams(body))
        most = int(len(other) * (2 - threshold) / threshold + 1e-9)
        runs = []
        for i in range(len(grams)):
            for j in range(i, min(len(grams), i + most)):
                own = set(grams[i : j + 1])
                runs.append((-2 * len(own & other) / (len(own) + len(other)), i, j))
        if runs and -(best := min(runs))[0] >= threshold:
            found[name] = (pytest.approx(-best[0]), words[best[1]][0], best[2] - best[1] + 2)
    return found


def test_wrapped_and_embedded_notices(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(make_words(rng, n))
    texts = [
        "Copyright 2020 Example Inc. All rights reserved.",
        "Copyright 2020 Example. Released under the MIT License. And after.",
        "", "the", "all rights\n\n  reserved", "of the software to the software and the",
    ]
    for body in licences.TEMPLATES.values():
        words = body.split()
        wrapped = "\n# ".join(" ".join(words[i : i + 9]) for i in range(0, len(words), 9))
        texts.append(f"{prose(40)}\n\n# {wrapped} {prose(40)}\n{prose(10)}")
        gone = {rng.randrange(len(words))}
        texts.append(f"{prose(20)} {' '.join(w for n, w in enumerate(words) if n not in gone)} end")
    frame = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string")
    got = {}
    for r in licences.notices(frame).collect():
        got.setdefault(r.doc_id, {})[r.license] = (r.score, r.line, r.words)
    want = {i: w for i, t in enumerate(texts) if (w := brute_notices(t, licences.THRESHOLD))}
    assert got == want
    for n, name in enumerate(licences.TEMPLATES):
        assert want[6 + 2 * n][name][0] == 1
    units = {r.doc_id for r in licences.scan(frame).collect() if r.matches}
    assert set(got) - units  # lines and whole texts alone lose them


def test_notices_of_an_empty_table_and_plan(no_docs, messy, plan):
    assert licences.notice_digest(no_docs).count() == 0
    text = plan(licences.notice_digest(messy))
    assert "Python" not in text and "hashpartitioning" not in text


def test_empty_table_and_plan(no_docs, messy, plan):
    assert licences.digest(no_docs).count() == 0
    text = plan(licences.digest(messy))
    assert "Python" not in text and "hashpartitioning" not in text


def test_a_text_is_normalised_once_for_its_bigrams(spark, plan):
    docs = spark.createDataFrame([("a b a b c",)], "text string").repartition(1)
    found = docs.select(licences.bigrams(F.col("text")).alias("grams"))
    assert found.first().grams == ["a b", "b a", "b c"]
    text = plan(found, "extended").split("== Physical Plan ==")[1]
    assert text.count("regexp_replace(") == 1
