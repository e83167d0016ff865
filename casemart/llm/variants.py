"""Spelling variants: words one edit apart, and the commoner form each of them may stand for.

Built-in functions only. Words meet by PartEnum signatures over their letter multisets, read as binary
vectors with one dimension per (letter, occurrence). One inserted or deleted letter changes one
dimension, a replaced one changes two. The letters are dealt to `PARTS` parts of about equal weight;
for words of one length every choice of `PARTS` - 2 parts gives a signature, for words whose lengths
differ by one every choice of `PARTS` - 1: two words within the distance agree on all parts of some
choice. Signatures are equal-joined, edit distances verified. A signature holds the word length too.

Words are matched once each, however often they occur, so a frequent word is one row; their number
grows with the vocabulary only. Roots come from doubling pointers: a form occurs at least twice as
often as its word, so a chain has at most 63 steps and six rounds always end it.

Defined cases: null texts have no words, a null doc_id reads as empty in the hashed key; repeated rows
count each; ties between forms go to the smallest in code-point order; words without a near word
have n_near 0 and are their own root; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import string
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import written

RUN = r"[a-zÀ-ÿ]+"  # after A-Z are lower-cased
MIN_CHARS, MIN_COUNT = 5, 3
DAMAGED = 97  # one of so many runs of a document loses a code point
PARTS = 6
FORM_RATIO = 2
SAME, SHORT, LONG = 0, 1, 2  # what a signature's word may be paired with


def runs(docs: DataFrame) -> DataFrame:
    """(word): every lower-cased run of letters that is long enough, some with a letter deleted."""
    lower = F.translate(
        F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )
    found = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.length("run") >= MIN_CHARS)
    key = F.crc32(F.concat("doc_id", F.lit(":"), "run"))
    at = F.pmod("key", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.select("run", key.alias("key")).select(
        F.when(F.col("key") % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word")
    )


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least `MIN_CHARS` code points that occur `MIN_COUNT` times or more."""
    return (
        runs(docs)
        .filter(F.length("word") >= MIN_CHARS)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= MIN_COUNT)
    )


def letter_parts(words: DataFrame, parts: int = PARTS) -> list[str]:
    """The letters of all words, heaviest first, each to the lightest part so far.

    Collected: one row per letter, of which `RUN` admits 90.
    """
    letters = (
        words.select(F.explode(F.split("word", "")).alias("letter"))
        .groupBy("letter")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    load, out = [0] * parts, [""] * parts
    for row in sorted(letters, key=lambda r: (-r.n, r.letter)):
        lightest = load.index(min(load))
        load[lightest] += row.n
        out[lightest] += row.letter
    return out


def signatures(words: DataFrame, parts: list[str]) -> DataFrame:
    """(word, side, key): the signatures of every word and what its partner may be."""
    letters = "".join(parts)
    ordered = words.select("word", F.array_join(F.array_sort(F.split("word", "")), "").alias("_s"))
    named = ordered.select(
        "word",
        F.length("word").alias("_n"),
        *(
            F.translate("_s", "".join(c for c in letters if c not in part), "").alias(f"_p{i}")
            for i, part in enumerate(parts)
        ),
    )

    def made(side: int, left_out: int, longer: int) -> list[Column]:
        return [
            F.struct(
                F.lit(side).alias("side"),
                F.xxhash64(
                    F.lit(left_out), F.col("_n") + longer, F.lit(n), *(f"_p{i}" for i in kept)
                ).alias("key"),
            )
            for n, kept in enumerate(combinations(range(len(parts)), len(parts) - left_out))
        ]

    keys = F.array(*made(SAME, 2, 0), *made(SHORT, 1, 1), *made(LONG, 1, 0))
    return named.select("word", F.explode(keys).alias("k")).select("word", "k.side", "k.key")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): all pairs of words exactly one inserted, deleted or replaced code point apart, once."""
    marked = signatures(words, letter_parts(words))
    left = marked.select(F.col("word").alias("a"), F.col("side").alias("_a"), "key")
    right = marked.select(F.col("word").alias("b"), F.col("side").alias("_b"), "key")
    met = left.join(right, "key").filter(
        "(_a = 0 and _b = 0 and a < b) or (_a = 1 and _b = 2)"
    )
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of all words."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("_other"))
    best = (
        both.join(counts, "b")
        .groupBy(F.col("a").alias("word"))
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("_other")).alias("less"), "b")).alias("_best"))
        .select("word", "n_near", F.col("_best.b").alias("_form"),
                (-F.col("_best.less")).alias("_form_n"))
    )
    commoner = F.col("_form_n") >= FORM_RATIO * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(commoner, F.col("_form")).alias("form"),
        F.when(commoner, F.col("_form_n")).alias("form_n"),
    )


def with_roots(found: DataFrame) -> DataFrame:
    """`found` (word, form, ...) with `root`, the last word that forms lead to."""
    links = written(found.filter("form is not null").select("word", F.col("form").alias("at")),
                    "variants-links")
    while True:
        onward = links.select(F.col("word").alias("at"), F.col("at").alias("_next"))
        doubled = written(
            links.join(onward, "at", "left").select(
                "word", F.coalesce("_next", "at").alias("at"),
                F.col("_next").isNotNull().alias("moved"),
            ),
            "variants-links",
        )
        links = doubled.select("word", "at")
        if doubled.filter("moved").isEmpty():
            break
    roots = links.withColumnRenamed("at", "root")
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def digest(docs: DataFrame) -> DataFrame:
    words = written(vocabulary(docs), "variants-words")
    pairs = written(near_pairs(words), "variants-pairs")
    found = written(forms(words, pairs), "variants-forms")
    return with_roots(found).select("word", "form", "root", "n", "n_near", "form_n")
