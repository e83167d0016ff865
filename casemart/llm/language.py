"""Language ID: a linear-chain CRF labels every word of a text, also of code-switched text.

A word's features are hashed: its letter n-grams of one to three with marks at both ends, its
prefix and suffix of three, and the word itself (lexicon). Transitions are learned from chains
stitched from passages of different texts, so a switch of language inside a text is a known,
rare event. Forward-backward gives each word's marginals; a text's score for a language is the
mean over its words.

Training takes at most `train_docs` labelled texts per language, of at most `train_chars`
characters each, the ones with the smallest hash of their id, and of each language at most
`TRAIN_CELLS` over the square of their number in characters, so that the sample and what is
computed from it keep one bound for many languages: documented bounds. Everything else reads all
words of all texts; texts longer than a batch are read in parts, with the chain's state carried on.

Defined cases: a null text, or one without letters, is `und` with score 0; texts without a label
are predicted but not learned from; without any labelled row every text is `und`; repeated rows
are predicted once per row; an empty table gives an empty result; columns of other names are
ignored. More than `MAX_LANGUAGES` languages raise an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemart.llm.bytes_kernel import MIX_A, MIX_B, ODD, mix, slices
from casemart.llm.common import tidy
from casemart.llm.crf import Adam, chain_marginals, marginals_in_pieces, observed_moves, piece_items

UNKNOWN = "und"
MAX_LANGUAGES = 200
HASH_BITS = 16
TRAIN_DOCS, TRAIN_CHARS = 200, 20_000
ROUNDS, RATE, RIDGE = 12, 0.1, 1e-3
BATCH_CHARS = 1 << 18
SCORE_CELLS = 1 << 22  # characters times languages scored together
TRAIN_CELLS = 1 << 25  # characters times languages of the whole training sample
PASSAGE = 40  # mean words of a training passage


def letters() -> np.ndarray:
    """Which code points are letters, one bit each."""
    flags = np.fromiter((chr(p).isalpha() for p in range(sys.maxunicode + 1)), dtype=bool)
    return np.packbits(flags)


class Words:
    """The words of many texts and their hashed features."""

    def __init__(self, letter_bits: np.ndarray):
        self.letter = np.unpackbits(letter_bits).view(bool)

    def features(self, texts: list[str], lowered: bool = False):
        """(text of each word, [(buckets, first bucket of each word)])."""
        lowered = texts if lowered else [t.lower() for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le"), dtype=np.uint32)
        bounds = np.cumsum([0, *map(len, lowered)])
        inside = self.letter[points]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        heads = bounds[:-1][bounds[:-1] < len(points)]
        start[heads] = inside[heads]
        starts = np.flatnonzero(start)
        text = np.searchsorted(bounds, starts, side="right") - 1
        if not len(starts):
            return text, []
        # Words one after the other, each between two marks.
        owner = np.cumsum(start)[inside] - 1
        sizes = np.bincount(owner, minlength=len(starts))
        first = np.cumsum(np.append(0, sizes + 2))[:-1]
        padded = np.full(int(sizes.sum()) + 2 * len(starts), 1, dtype=np.uint64)
        padded[first] = 2
        at = np.arange(len(owner)) + 2 * owner + 1
        padded[at] = points[inside]
        total = len(padded)
        inner = np.ones(total, dtype=bool)
        out = []
        value = np.zeros(total, dtype=np.uint64)
        order = np.arange(len(starts))
        for n in (1, 2, 3):
            value[: total - n + 1] = value[: total - n + 1] * MIX_A + padded[n - 1 :]
            if n > 1:
                inner[first + sizes + 2 - (n - 1)] = False
            out.append((self.bucket(value[inner], n), first - (n - 1) * order))
        last = first + sizes + 1
        prefix = suffix = np.zeros(len(starts), dtype=np.uint64)
        for i in (1, 2, 3):
            prefix = prefix * MIX_B + padded[np.minimum(first + i, last)]
            suffix = suffix * MIX_B + padded[np.maximum(last - i, first)]
        place = np.arange(total) - np.repeat(first, sizes + 2)
        whole = np.add.reduceat(mix((padded + place.astype(np.uint64) * MIX_B) * ODD), first)
        for kind, hashed in ((4, prefix), (5, suffix), (6, whole)):
            out.append((self.bucket(hashed, kind), order))
        return text, out

    @staticmethod
    def bucket(value: np.ndarray, kind: int) -> np.ndarray:
        salt = np.uint64(kind * int(ODD) & 0xFFFFFFFFFFFFFFFF)
        return (mix(value + salt) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # hash buckets x languages
    moves: np.ndarray
    opening: np.ndarray

    def scores(self, streams) -> np.ndarray:
        return sum(np.add.reduceat(self.weights[b], f, axis=0) for b, f in streams).astype(float)


def training_rows(docs: DataFrame, learn: Column, train_docs: int, train_chars: int,
                  language_chars: int = TRAIN_CELLS) -> DataFrame:
    """The rows to learn from; of each language one text at least, then `language_chars` in all."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & (F.length("text") <= train_chars))
    by_language = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    first = rows.select(
        "lang", "text", F.row_number().over(by_language).alias("place")
    ).filter(F.col("place") <= train_docs)
    upto = F.sum(F.length("text")).over(Window.partitionBy("lang").orderBy("place"))
    return first.withColumn("upto", upto).filter((F.col("upto") <= language_chars) | (F.col("place") == 1))


def fit(samples: list[tuple[str, str]], letter_bits: np.ndarray, seed: int = 7) -> Model | None:
    """Maximise the likelihood of (language, text) samples; None without samples."""
    samples = sorted(samples)
    languages = tuple(sorted({lang for lang, _ in samples}))
    k = len(languages)
    if not k:
        return None
    text, streams = Words(letter_bits).features([t for _, t in samples])
    label_of = np.array([languages.index(lang) for lang, _ in samples])
    labels = label_of[text]
    weights = np.zeros((1 << HASH_BITS, k))
    moves, opening = np.zeros((k, k)), np.zeros(k)
    if not len(labels):
        return Model(languages, weights.astype(np.float32), moves, opening)
    # Passages of the texts in random order make chains with switches of language.
    rng = np.random.default_rng(seed)
    new_text = np.append(True, text[1:] != text[:-1])
    cut = new_text | (rng.random(len(text)) < 1 / PASSAGE)
    heads = np.flatnonzero(cut)
    sizes = np.diff(np.append(heads, len(text)))
    shuffled = rng.permutation(len(heads))
    ends = np.cumsum(sizes[shuffled])
    order = np.arange(len(text)) + np.repeat(heads[shuffled] - (ends - sizes[shuffled]),
                                             sizes[shuffled])
    labels = labels[order]
    first = np.zeros(len(labels), dtype=bool)
    first[ends[:-1][rng.random(len(ends) - 1) < 0.2]] = True
    first[0] = True
    truth = np.eye(k)[labels]
    seen = observed_moves(labels, first, k)
    owners = [np.repeat(np.arange(len(f)), np.diff(np.append(f, len(b)))) for b, f in streams]
    adam = Adam([weights, moves, opening], RATE)
    back = np.argsort(order)
    for _ in range(ROUNDS):
        model = Model(languages, weights, moves, opening)
        marginals, expected = chain_marginals(model.scores(streams)[order], first, moves, opening)
        error = truth - marginals
        by_word = error[back]
        up = np.zeros_like(weights)
        for (buckets, _), owner in zip(streams, owners):
            for label in range(k):
                up[:, label] += np.bincount(
                    buckets, weights=by_word[owner, label], minlength=1 << HASH_BITS
                )
        n = len(labels)
        adam.step(
            [up / n - RIDGE * weights / n, (seen - expected) / n, error[first].sum(axis=0) / n]
        )
    return Model(languages, weights.astype(np.float32), moves, opening)


def train(docs: DataFrame, learn: Column, train_docs: int = TRAIN_DOCS,
          train_chars: int = TRAIN_CHARS) -> tuple[Model | None, np.ndarray]:
    languages = docs.filter(learn).select("lang").distinct().limit(MAX_LANGUAGES + 2).count()
    if languages > MAX_LANGUAGES + 1:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    share = TRAIN_CELLS // max(1, languages) ** 2
    rows = training_rows(docs, learn, train_docs, train_chars, share).select("lang", "text").collect()
    letter_bits = letters()
    return fit([(r.lang, r.text) for r in rows], letter_bits), letter_bits


def batch_chars(languages: int) -> int:
    """Characters whose words are scored together: fewer for more languages."""
    return max(1 << 12, min(BATCH_CHARS, SCORE_CELLS // max(1, languages)))


def label_texts(texts: list[str], model: Model, words: Words):
    """Of each text over its words: mean marginals (texts x languages), mean largest marginal, count."""
    text, streams = words.features(texts)
    k = len(model.languages)
    counts = np.bincount(text, minlength=len(texts))
    means = np.zeros((len(texts), k))
    sure = np.zeros(len(texts))
    if len(text):
        first = np.append(True, text[1:] != text[:-1])
        scores = model.scores(streams)
        size = piece_items(k)

        def piece(i: int):
            return scores[i * size : (i + 1) * size], first[i * size : (i + 1) * size]

        many = -(-len(text) // size)
        for i, marginals in marginals_in_pieces(piece, many, model.moves, model.opening):
            owner = text[i * size : (i + 1) * size]
            for label in range(k):
                means[:, label] += np.bincount(
                    owner, weights=marginals[:, label], minlength=len(texts)
                )
            sure += np.bincount(owner, weights=marginals.max(axis=1), minlength=len(texts))
    several = np.maximum(counts, 1)
    return means / several[:, None], sure / several, counts


def label_long_text(text: str, model: Model, words: Words):
    """`label_texts` of one text, scored in parts that end between words.

    Each part is scored twice, once for the state that it hands on and once for its marginals, so
    memory does not grow with the text (a single word is never cut).
    """
    lowered = text.lower()
    size = batch_chars(len(model.languages))
    cuts = [0]
    while cuts[-1] < len(lowered):
        end = min(len(lowered), cuts[-1] + size)
        while end < len(lowered) and lowered[end - 1].isalpha() and lowered[end].isalpha():
            end += 1
        cuts.append(end)
    k = len(model.languages)
    begun: list[int] = []  # the first part that has words

    def piece(i: int):
        owner, streams = words.features([lowered[cuts[i] : cuts[i + 1]]], lowered=True)
        first = np.zeros(len(owner), dtype=bool)
        if len(owner):
            if not begun:
                begun.append(i)
            first[0] = begun[0] == i
        return model.scores(streams) if len(owner) else np.zeros((0, k)), first

    sums, sure, count = np.zeros(k), 0.0, 0
    for _, marginals in marginals_in_pieces(piece, len(cuts) - 1, model.moves, model.opening):
        sums += marginals.sum(axis=0)
        sure += marginals.max(axis=1).sum() if len(marginals) else 0.0
        count += len(marginals)
    n = max(count, 1)
    return sums[None] / n, np.array([sure / n]), np.array([count])


def predict(docs: DataFrame, model: Model | None, letter_bits: np.ndarray,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns `keep`, lang_pred, score, n_words and certainty of every row.

    score is the share of the text that its language has; certainty, the mean of each word's largest
    marginal, is also high where clear words of several languages take turns.
    """
    # The text goes to the tasks once, whether it is kept or not.
    others = [c for c in keep if c != "text"]
    names = [*(f"_{c}" for c in others), "lang_pred", "score", "n_words", "certainty"]
    names += ["_text"] if "text" in keep else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(letter_bits)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            sizes = np.cumsum([0, *map(len, texts)])
            found, score, count, certainty = [], [], [], []
            size = BATCH_CHARS if model is None else batch_chars(len(model.languages))
            for lo, hi in slices(sizes, size):
                if model is None:
                    means, n = np.zeros((hi - lo, 1)), np.zeros(hi - lo, dtype=np.int64)
                    sure = np.zeros(hi - lo)
                elif sizes[hi] - sizes[lo] > 2 * size:
                    means, sure, n = label_long_text(texts[lo], model, words)
                else:
                    means, sure, n = label_texts(texts[lo:hi], model, words)
                best = means.argmax(axis=1)
                found += [model.languages[b] if c else UNKNOWN for b, c in zip(best, n)]
                score += np.where(n > 0, means.max(axis=1), 0.0).clip(0, 1).tolist()
                count += n.tolist()
                certainty += sure.clip(0, 1).tolist()
            yield pa.record_batch(
                [*batch.columns[1:], pa.array(found, pa.string()), pa.array(score, pa.float64()),
                 pa.array(count, pa.int64()), pa.array(certainty, pa.float64()),
                 *(batch.columns[:1] if "text" in keep else [])],
                names=names,
            )

    rows = docs.select("text", *(F.col(c).alias(f"_{c}") for c in others))
    schema = T.StructType(
        [
            *(f for f in rows.schema.fields if f.name != "text"),
            T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
            T.StructField("n_words", T.LongType()), T.StructField("certainty", T.DoubleType()),
            *([T.StructField("_text", T.StringType())] if "text" in keep else []),
        ]
    )
    out = rows.mapInArrow(tidy(run), schema)
    return out.select(
        *(F.col(f"_{c}").alias(c) for c in keep), "lang_pred", "score", "n_words", "certainty"
    )


def held_out(rest: int, parts: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == rest, F.lit(False))


def digest(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang",
        held_out(2, 4).alias("held_out"),
    )
    learn = ~F.col("held_out") & F.col("doc_id").isNotNull()
    model, letter_bits = train(rows, learn)
    return predict(rows, model, letter_bits, ("doc_id", "held_out")).drop("certainty")
