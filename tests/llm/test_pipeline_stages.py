import random

from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.conftest import make_words
from tests.llm.test_jaccard import brute as linked
from tests.llm.test_suffixes import brute as cut


def documents(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_names_and_order():
    assert [n for n, _ in cp.STAGES] == ["language", "near_copies", "repeats", "mixing", "packing"]


def test_language_keeps_texts_with_letters(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame(
        [(-1, None, "en", "s", 0), (-2, "", None, "s", 0), (-3, "123 !!", "de", None, 6)],
        docs.schema,
    )
    out = cp.keep_languages(spark, docs.unionByName(odd), sf_dir)
    assert out.columns == docs.columns
    assert documents(out) == documents(docs)


def test_language_keeps_an_even_mix_of_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    by_lang = {}
    plain = docs.filter("lang is not null and n_chars between 300 and 4000")
    for r in plain.orderBy("doc_id").collect():
        by_lang.setdefault(r.lang, []).extend(r.text.split())
    parts = [by_lang[lang] for lang in sorted(by_lang)[:3]]
    mixed = " ".join(" ".join(p[i : i + 20]) for i in range(0, 120, 20) for p in parts)
    extra = spark.createDataFrame([(-5, mixed, None, "s", len(mixed))], docs.schema)
    assert -5 in documents(cp.keep_languages(spark, docs.unionByName(extra), sf_dir))


def test_near_copies_leave_the_first(spark, messy, texts):
    out = cp.keep_one_copy(spark, messy, "")
    assert out.columns == messy.columns
    rows = [(i, t) for i, t in texts if i is not None and i != 111]
    first = {c for i, _, c, _ in linked(rows, 5, 80, 100)}
    kept = [r.doc_id for r in out.collect()]
    assert {i for i in kept if i is not None and i != 111} == first
    assert kept.count(112) == 1 and kept.count(None) == 2 and kept.count(111) == 2


def test_repeats_go(spark, messy, texts):
    docs = messy.filter("doc_id < 100")
    out = cp.drop_repeats(spark, docs, "")
    assert out.columns == docs.columns
    rows = [(i, t.encode()) for i, t in texts if i is not None and i < 100]
    want = cut(rows, 100)
    got = documents(out)
    for i, t in rows:
        left = want[i][0] - want[i][1]
        if i in got:
            assert len(got[i].encode()) == left
        else:
            assert left < 3  # nothing but white space
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_run_over_the_smallest_tables(spark, sf_dir):
    out = cp.run(spark, sf_dir)
    total = {}
    for r in out.collect():
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
        assert len(r.ids) == 4 * r.length
    assert total and all(n <= 1024 and n & (n - 1) == 0 for n in total.values())


def test_near_copies_judge_each_text_of_a_shared_id(spark):
    rng = random.Random(3)
    words = lambda: " ".join(make_words(rng, 40))
    first, other, third = words(), words(), words()
    rows = [(1, first, "a"), (5, first, "b"), (5, other, "c"), (5, other, "d"), (7, third, "e"),
            (8, third + " more", "f"), (None, first, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = cp.keep_one_copy(spark, docs, "").collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == sorted(
        [("1", first), ("5", other), ("7", third), ("None", first)]
    )


def test_columns_of_any_name_pass_every_stage(spark, sf_dir):
    names = ["kept", "spans", "n_bytes", "_size", "_runs", "bad name", "a.b", "_columns", "text_key",
             "lang_pred", "component_id", "_text", "units", "hash"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("*", *(F.lit(n).alias(n) for n in names))
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        marks = out.select(*(F.col(f"`{n}`") for n in names)).distinct().collect()
        assert [tuple(r) for r in marks] == [tuple(names)], name
    assert cp.pack(spark, docs, sf_dir).count() > 0


def test_empty_tables_pass_every_stage(spark, no_docs):
    docs = no_docs
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
