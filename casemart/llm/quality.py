"""Quality classifier: a linear-chain CRF labels every line of a text good or bad.

A line's features are shares of its characters (capitals, digits, symbols, bars, exclamation
marks), of its words (distinct, repeated at once, ending in symbols), its length, its form, and
whether it occurs again in the text; the features of the lines before and after count too.
Forward-backward gives each line's marginal; the mean weighted by line length is the text's raw
quality, which a logistic curve fitted on the training texts maps to the score.

Training takes at most `train_docs` labelled texts of at most `train_chars` characters, those with
the smallest hash of their id (a documented bound), and gives every line its text's label.
Prediction reads all lines of all texts.

Defined cases: a null or empty text has no line and gets the share of good texts in training;
blank lines are lines; without training rows every score is 0.5; repeated rows are scored once per
row; repeated labels of a text count once each; an empty table gives an empty result; columns of
other names are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.bytes_kernel import BASE, BASE_INVERSE, ODD, mix, powers, slices
from casemart.llm.crf import Adam, chain_marginals, observed_moves
from casemart.llm.language import held_out

TRAIN_DOCS, TRAIN_CHARS = 1_500, 20_000
ROUNDS, RATE, RIDGE = 100, 0.1, 1e-4
BATCH_CHARS = 1 << 19
STEPS = (0.02, 0.1, 0.3, 0.6)  # a share is also seen as above each of these

# Classes of characters.
OTHER, LETTER, CAPITAL, DIGIT, BLANK, MARK = range(6)
# Marks of ordinary sentences, which are not symbols: fixed values.
SENTENCE = ".,;:'\"-()?"
SHARES = ["capitals", "digits", "symbols", "bars", "shouts", "distinct", "again", "symbol ends"]


def char_kinds() -> np.ndarray:
    """Class of every code point."""
    out = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    of = {"Lu": CAPITAL, "Lt": CAPITAL, "Nd": DIGIT, "Zs": BLANK}
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))
        out[point] = of.get(kind, LETTER if kind[0] in "LM" else OTHER)
    out[[9, 10, 11, 12, 13]] = BLANK
    out[[ord(c) for c in SENTENCE]] = MARK
    return out


def text_lines(texts: list[str], kinds: np.ndarray):
    """Text, length and features of every line of the texts, one after the other."""
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0))
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts = np.append(0, np.flatnonzero(points == 10) + 1)
    ends = np.append(starts[1:] - 1, len(points))
    text = np.searchsorted(bounds, starts, side="right") - 1
    sizes = ends - starts
    kind = kinds[points]

    def total(flag: np.ndarray) -> np.ndarray:
        upto = np.append(0, np.cumsum(flag))
        return (upto[ends] - upto[starts]).astype(float)

    capitals, digits = total(kind == CAPITAL), total(kind == DIGIT)
    letters = capitals + total(kind == LETTER)
    symbols = total(kind == OTHER)
    # Words and their hashes; a line's hash is that of all its characters.
    word = kind != BLANK
    head = word.copy()
    head[1:] &= ~word[:-1]
    tail = word.copy()
    tail[:-1] &= ~word[1:]
    first, last = np.flatnonzero(head), np.flatnonzero(tail)
    line = np.searchsorted(starts, first, side="right") - 1
    n_words = np.bincount(line, minlength=len(starts)).astype(float)
    up, down = powers(BASE, len(points)), powers(BASE_INVERSE, len(points) + 1)
    sums = np.append(
        np.uint64(0), np.cumsum(mix((points.astype(np.uint64) + np.uint64(1)) * ODD) * up)
    )
    hashes = mix((sums[last + 1] - sums[first]) * down[first])
    whole = mix((sums[ends] - sums[starts]) * down[starts])
    repeat = np.append(False, (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1]))
    again = np.bincount(line, weights=repeat, minlength=len(starts))
    order = np.lexsort((hashes, line))
    new = np.append(
        True, (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
    )[: len(order)]
    distinct = np.bincount(line[order], weights=new, minlength=len(starts))
    odd_end = np.bincount(line, weights=kind[last] == OTHER, minlength=len(starts))
    words = np.maximum(n_words, 1)
    chars = np.maximum(sizes, 1)
    shares = np.stack(
        [
            capitals / np.maximum(letters, 1), digits / chars, symbols / chars,
            total(points == 124) / words, total(points == 33) / words,
            1 - distinct / words, again / words, odd_end / words,
        ],
        axis=1,
    )
    order = np.lexsort((whole, text))
    same = (whole[order][1:] == whole[order][:-1]) & (text[order][1:] == text[order][:-1])
    copied = np.zeros(len(starts), dtype=bool)
    copied[order[1:][same]] = copied[order[:-1][same]] = True
    final = kind[np.maximum(ends - 1, 0)]
    form = np.stack(
        [
            np.log1p(n_words) / 8, sizes / words / 10, (sizes / words > 12), n_words < 3,
            copied & (n_words > 0), np.append(False, whole[1:] == whole[:-1]),
            final == MARK, kind[np.minimum(starts, len(points) - 1)] == CAPITAL, sizes == 0,
        ],
        axis=1,
    ).astype(float)
    own = np.concatenate([shares, *(shares > s for s in STEPS), form], axis=1)
    before, after = np.roll(shares, 1, axis=0), np.roll(shares, -1, axis=0)
    opening = np.append(True, text[1:] != text[:-1])
    before[opening] = 0
    after[np.append(opening[1:], True)] = 0
    return text, sizes, np.concatenate(
        [own, before, before > STEPS[1], after, after > STEPS[1], np.ones((len(starts), 1))], axis=1
    )


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # log odds of good, per feature
    moves: np.ndarray
    opening: np.ndarray
    curve: tuple[float, float]  # slope and offset from raw quality to log odds
    prior: float

    def raw(self, texts: list[str], kinds: np.ndarray) -> np.ndarray:
        """Mean marginal of good over a text's lines, by length; nan without characters."""
        out = np.full(len(texts), np.nan)
        full = [i for i, t in enumerate(texts) if t]
        if full:
            text, sizes, features = text_lines([texts[i] for i in full], kinds)
            marginals = self.lines(text, features)
            weight = np.bincount(text, weights=sizes, minlength=len(full))
            good = np.bincount(text, weights=sizes * marginals, minlength=len(full))
            plain = np.bincount(text, weights=marginals) / np.bincount(text)
            out[full] = np.where(weight > 0, good / np.maximum(weight, 1), plain)
        return out

    def lines(self, text: np.ndarray, features: np.ndarray) -> np.ndarray:
        odds = features @ self.weights
        scores = np.stack([np.zeros(len(odds)), odds], axis=1)
        first = np.append(True, text[1:] != text[:-1])
        return chain_marginals(scores, first, self.moves, self.opening, pairs=False)[0][:, 1]

    def score(self, texts: list[str], kinds: np.ndarray) -> np.ndarray:
        raw = self.raw(texts, kinds)
        slope, offset = self.curve
        odds = np.clip(slope * np.nan_to_num(raw) + offset, -30, 30)
        return np.where(np.isnan(raw), self.prior, 1 / (1 + np.exp(-odds)))


def fit(samples: list[tuple[int, str]], kinds: np.ndarray) -> Model | None:
    """Fit lines to their texts' labels, then the curve to the texts; None without samples."""
    samples = sorted((int(y), t or "") for y, t in samples)
    if not samples:
        return None
    labels = np.array([y for y, _ in samples])
    prior = float(np.clip(labels.mean(), 0.01, 0.99))
    full = [i for i, (_, t) in enumerate(samples) if t]
    text, _, features = text_lines([samples[i][1] for i in full], kinds)
    model = Model(np.zeros(features.shape[1]), np.zeros((2, 2)), np.zeros(2), (1.0, 0.0), prior)
    if not full or prior in (0.01, 0.99):
        return Model(model.weights, model.moves, model.opening, (0.0, np.log(prior / (1 - prior))),
                     prior)
    y = labels[full][text]
    # Each class of texts weighs the same, and each text as much as any other.
    lines = np.bincount(text)[text]
    weight = np.where(y == 1, 0.5 / prior, 0.5 / (1 - prior)) / lines
    weight /= weight.mean()
    first = np.append(True, text[1:] != text[:-1])
    seen = observed_moves(y, first, 2)
    adam = Adam([model.weights, model.moves, model.opening], RATE)
    for _ in range(ROUNDS):
        odds = features @ model.weights
        scores = np.stack([np.zeros(len(odds)), odds], axis=1)
        marginals, expected = chain_marginals(scores, first, model.moves, model.opening)
        error = (y - marginals[:, 1]) * weight
        adam.step(
            [
                features.T @ error / len(y) - RIDGE * model.weights,
                # Learned, but held weak: labels are the texts', so moves between labels are rare.
                (seen - expected) / len(y) - 0.05 * model.moves,
                np.array([-error[first].sum(), error[first].sum()]) / len(y)
                - 0.05 * model.opening,
            ]
        )
    raw = model.raw([t for _, t in samples], kinds)
    there = ~np.isnan(raw)
    return Model(
        model.weights, model.moves, model.opening, logistic(raw[there], labels[there]), prior
    )


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression, by Newton's method with a little ridge."""
    design = np.stack([x, np.ones(len(x))], axis=1)
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        slope = design.T @ (y - p) - 1e-3 * at
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        at = at + np.clip(np.linalg.solve(bend, slope), -4, 4)
    return float(at[0]), float(at[1])


def training_rows(docs: DataFrame, labels: DataFrame, train_docs: int, train_chars: int):
    """At most `train_docs` (label, text) of rows that are not held out."""
    known = labels.filter("quality is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label")
    )
    rows = docs.filter(~F.col("held_out") & (F.length("text") <= train_chars))
    ids = rows.select("doc_id").join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.limit(train_docs).distinct()
    return chosen.join(rows.select("doc_id", "text"), "doc_id").limit(train_docs).collect()


def score(docs: DataFrame, model: Model | None, kinds: np.ndarray) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            out = np.full(len(texts), 0.5)
            if model is not None:
                for lo, hi in slices(np.cumsum([0, *map(len, texts)]), BATCH_CHARS):
                    out[lo:hi] = model.score(texts[lo:hi], kinds)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(out),
                 pa.array((out >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int"
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(1, 3).alias("held_out")
    )
    found = training_rows(rows, labels, TRAIN_DOCS, TRAIN_CHARS)
    kinds = char_kinds()
    return score(rows, fit([(r.label, r.text) for r in found], kinds), kinds)
