"""Language and quality: held-out accuracy, defined cases, and the chain's recursion."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemart.llm import crf, language, quality
from casemart.llm.bytes_kernel import MIX_A, MIX_B, ODD
from casemart.llm.crf import chain_marginals, marginals_in_pieces


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(1)
    k, sizes = 3, [1, 4, 6, 2]
    scores = rng.normal(size=(sum(sizes), k))
    first = np.zeros(sum(sizes), dtype=bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    moves, opening = rng.normal(size=(k, k)), rng.normal(size=k)
    got, pairs = chain_marginals(scores, first, moves, opening)
    want, want_pairs, at = np.zeros_like(scores), np.zeros((k, k)), 0
    for n in sizes:
        total = 0.0
        part, part_pairs = np.zeros((n, k)), np.zeros((k, k))
        for path in product(range(k), repeat=n):
            s = opening[path[0]] + sum(scores[at + t, y] for t, y in enumerate(path))
            w = np.exp(s + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += w
            part[np.arange(n), path] += w
            for a, b in zip(path, path[1:]):
                part_pairs[a, b] += w
        want[at : at + n] = part / total
        want_pairs += part_pairs / total
        at += n
    np.testing.assert_allclose(got, want, rtol=1e-9)
    np.testing.assert_allclose(pairs, want_pairs, rtol=1e-9)


def test_long_chains_cross_blocks():
    rng = np.random.default_rng(2)
    scores, first = rng.normal(size=(700, 2)), np.zeros(700, dtype=bool)
    first[0] = True
    moves = rng.normal(size=(2, 2))
    got, _ = chain_marginals(scores, first, moves, np.zeros(2))
    forward = np.zeros((700, 2))
    state = np.ones(2)
    for t in range(700):
        state = (state if t == 0 else state @ np.exp(moves)) * np.exp(scores[t])
        state /= state.sum()
        forward[t] = state
    back, want = np.ones(2), np.zeros((700, 2))
    for t in range(699, -1, -1):
        want[t] = forward[t] * back / (forward[t] * back).sum()
        back = np.exp(moves) @ (np.exp(scores[t]) * back)
        back /= back.sum()
    np.testing.assert_allclose(got, want, rtol=1e-9)


@pytest.mark.parametrize("wide", [32, 2])
def test_pieces_carry_the_state(monkeypatch, wide):
    rng = np.random.default_rng(3)
    scores, first = rng.normal(size=(900, 3)), rng.random(900) < 0.01
    first[0] = True
    moves, opening = rng.normal(size=(3, 3)), rng.normal(size=3)
    want, _ = chain_marginals(scores, first, moves, opening)
    monkeypatch.setattr(crf, "WIDE", wide)  # the same with and without products of matrices
    np.testing.assert_allclose(chain_marginals(scores, first, moves, opening)[0], want, rtol=1e-9)
    cuts = [0, 0, 1, 64, 200, 200, 703, 900, 900]  # also empty pieces
    got = np.zeros_like(want)
    for i, part in marginals_in_pieces(
        lambda i: (scores[cuts[i] : cuts[i + 1]], first[cuts[i] : cuts[i + 1]]),
        len(cuts) - 1, moves, opening,
    ):
        got[cuts[i] : cuts[i + 1]] = part
    np.testing.assert_allclose(got, want, rtol=1e-9)


def small_model(k):
    rng = np.random.default_rng(k)
    weights = rng.normal(size=(1 << language.HASH_BITS, k)).astype(np.float32) / 4
    names = tuple(f"l{i:03}" for i in range(k))
    return language.Model(names, weights, np.eye(k) * 3, rng.normal(size=k))


def test_long_text_in_parts_is_the_whole_text(texts):
    words = language.Words(language.letters())
    model = small_model(4)
    text = " ".join(t or "" for _, t in texts) * 8 + " " + "x" * 9000
    whole = language.label_texts([text], model, words)
    cells = language.SCORE_CELLS
    try:
        language.SCORE_CELLS = 1 << 12
        parts = language.label_long_text(text, model, words)
        blank = language.label_long_text(" .\n" * 5000, model, words)
    finally:
        language.SCORE_CELLS = cells
    for a, b in zip(whole, parts):
        np.testing.assert_allclose(a, b, rtol=1e-6)
    assert blank[2].tolist() == [0] and blank[0].sum() == 0


def limited(function, *args):
    """Runs in a process of its own; how many bytes it took above what it started with."""
    import multiprocessing
    import resource

    def run(pipe):
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        function(*args)
        pipe.send((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) * 1024)

    ours, theirs = multiprocessing.Pipe()
    process = multiprocessing.get_context("fork").Process(target=run, args=(theirs,))
    process.start()
    assert ours.poll(300)
    process.join()
    return ours.recv()


def test_memory_of_a_very_long_text():
    words, model = language.Words(language.letters()), small_model(5)
    text = "some words of a text that goes on " * 600_000  # 20 million characters
    assert limited(language.label_long_text, text, model, words) < 300 << 20


def test_memory_of_two_hundred_languages():
    words, model = language.Words(language.letters()), small_model(200)
    text = "some words of a text " * 10_000
    assert limited(language.label_long_text, text, model, words) < 400 << 20
    size = language.batch_chars(200)
    assert limited(language.label_texts, [text[:size]], model, words) < 400 << 20


def test_two_hundred_languages_are_told_apart(spark):
    rng = np.random.default_rng(5)
    rows = []
    for lang in range(200):
        letters = rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5, replace=False)
        words = ["".join(rng.choice(letters, 5)) for _ in range(6)]
        rows += [(lang * 10 + i, " ".join(rng.choice(words, 8)), f"l{lang:03}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, bits = language.train(docs, F.col("doc_id") % 10 < 2)
    assert len(model.languages) == 200
    out = language.predict(docs, model, bits, ("doc_id", "lang")).filter("doc_id % 10 = 2").collect()
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.9


def test_training_sample_keeps_its_bound(spark):
    rows = [(i, "word " * 30, "a" if i < 40 else "b") for i in range(45)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = language.training_rows(docs, F.lit(True), 20, 1000, 1500).groupBy("lang").count()
    assert {r.lang: r["count"] for r in taken.collect()} == {"a": 10, "b": 5}
    one = language.training_rows(docs, F.lit(True), 20, 1000, 10).groupBy("lang").count()
    assert {r.lang: r["count"] for r in one.collect()} == {"a": 1, "b": 1}


def plain_buckets(word):
    """Hash buckets of one word's features, letter by letter."""
    low = (1 << 64) - 1
    mix_a, mix_b, odd = int(MIX_A), int(MIX_B), int(ODD)
    marked = [2, *map(ord, word), 1]
    out = []
    for n in (1, 2, 3):
        for i in range(len(marked) - n + 1):
            value = 0
            for p in marked[i : i + n]:
                value = (value * mix_a + p) & low
            out.append((value, n))
    for kind, part in ((4, marked[1:4]), (5, marked[-2:-5:-1])):
        edge = marked[-1] if kind == 4 else marked[0]
        value = 0
        for p in (part + [edge] * 3)[:3]:
            value = (value * mix_b + p) & low
        out.append((value, kind))
    return out


def test_word_features_against_a_plain_version():
    words = language.Words(language.letters())
    texts = ["Zwei Wörter, don't", "", "a", "naïve 漢字 x9y ÀB"]
    found = [(0, w) for w in ("zwei", "wörter", "don", "t")] + [(2, "a")]
    found += [(3, w) for w in ("naïve", "漢字", "x", "y", "àb")]
    text, streams = words.features(texts)
    assert text.tolist() == [i for i, _ in found]
    for at, (_, word) in enumerate(found):
        want = {}
        for value, kind in plain_buckets(word):
            want.setdefault(kind, []).append(
                int(words.bucket(np.array([value], dtype=np.uint64), kind)[0]))
        for kind, (buckets, starts) in zip(range(1, 6), streams):
            ends = np.append(starts, len(buckets))
            assert buckets[ends[at] : ends[at + 1]].tolist() == want[kind], (word, kind)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_languages_held_out(documents):
    out = language.digest(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in out)


def test_code_switched_words(documents):
    rows = documents.filter("lang is not null and n_chars between 300 and 3000")
    samples = [(r.lang, r.text) for r in rows.collect()]
    bits = language.letters()
    model = language.fit(samples[:300], bits)
    words = language.Words(bits)
    by_lang = {}
    for lang, text in samples[300:]:
        by_lang.setdefault(lang, []).append(" ".join(text.split()[:30]))
    mixed = f"{by_lang['en'][0]} {by_lang['de'][0]} {by_lang['es'][0]}"
    _, streams = words.features([mixed])
    first = np.zeros(len(model.scores(streams)), dtype=bool)
    first[0] = True
    found, _ = chain_marginals(model.scores(streams), first, model.moves, model.opening)
    names = [model.languages[i] for i in found.argmax(axis=1)]
    third = len(names) // 3
    assert {"en", "de", "es"} <= set(names)
    assert names[: third // 2].count("en") > 0.8 * (third // 2)
    assert (np.diag(model.moves) > model.moves.mean(axis=1)).all()  # learned: switches are rare


def test_language_defined_cases(messy, no_docs):
    out = language.digest(messy)
    assert out.count() == messy.count()
    bare = {r.doc_id: r for r in out.collect()}
    for i in (100, 101, 102):
        assert (bare[i].lang_pred, bare[i].score) == ("und", 0.0)
    assert {r.lang_pred for r in out.collect()} <= {"en", "de", "und"}
    assert language.digest(no_docs).count() == 0
    unlabelled = messy.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.digest(unlabelled).collect()} == {"und"}


def test_quality_held_out(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.digest(documents, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.97
    good = np.mean([r.score for r in held if r.quality == 1])
    assert good > 0.5 > np.mean([r.score for r in held if r.quality == 0])


def test_quality_defined_cases(spark, messy, no_docs):
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(60)] + [(3, None, 0), (5, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    out = quality.digest(messy, labels).collect()
    assert len(out) == messy.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert quality.digest(no_docs, labels).count() == 0
    none = quality.digest(messy, labels.filter("false")).collect()
    assert {r.score for r in none} == {0.5}
    one_class = quality.digest(messy, labels.withColumn("quality", F.lit(1))).collect()
    assert all(r.predicted == 1 for r in one_class)
