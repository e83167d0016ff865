import random
import re
import zlib
from collections import Counter

from casemart.llm import variants


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += len(run) >= 5
    return {w: c for w, c in n.items() if c >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 2 * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def corpus():
    rng = random.Random(3)
    bases = ["".join(rng.choices("abcdéßÿ", k=rng.randint(4, 7))) for _ in range(25)]
    words = list(bases)
    for w in bases * 6:  # chains of edits, so forms lead on to forms
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + "x" + w[at:], w[:at] + "y" + w[at + 1 :]])
            words.append(w)
    rows = []
    for i in range(300):
        picked = [rng.choice(words[: rng.choice([5, 40, len(words)])]) for _ in range(40)]
        text = " ".join(w.upper() if rng.random() < 0.1 else w for w in picked)
        rows.append((rng.choice([i, i, None]), text.replace("ÿ", "Ÿ") if i % 50 == 0 else text))
    rows += [(900, None), (901, ""), (902, "ab1cd-éèêëì×÷"), (903, "é" * 5 + " " + "é" * 6)] * 3
    rows += [(904, "again again again"), (904, "again again again")]
    return rows


def test_matches_all_pairs(spark):
    rows = corpus()
    data = [(i, t, "x", "y") for i, t in rows]
    frame = spark.createDataFrame(data, "doc_id long, text string, word string, key string")
    got = [tuple(r) for r in variants.digest(frame.repartition(4)).collect()]
    want = plain(rows)
    assert len(got) == len(set(got)) and set(got) == want
    assert any(form and root != form for _, form, root, *_ in want)


def test_messy_texts(messy, texts):
    assert {tuple(r) for r in variants.digest(messy).collect()} == plain(texts)


def test_a_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = plain_words([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.word: (r.n, r.n_near) for r in variants.digest(docs).collect()}
    shorter = {w: {w[:i] + w[i + 1 :] for i in range(len(w))} for w in words}
    near = {w: {v for v in cut if v in words} for w, cut in shorter.items()}
    by_gap = {}
    for w in words:
        for i in range(len(w)):
            by_gap.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    for group in by_gap.values():
        for w in group:
            near[w] |= group - {w}
    for w, cut in shorter.items():
        for v in cut & words.keys():
            near[v].add(w)
    assert got == {w: (n, len(near[w])) for w, n in words.items()}


def test_long_chains_end_at_their_root(spark):
    # Each word is one letter from the next, which occurs twice as often.
    chain = [("a" * (30 - i) + "b" * (i + 5), 1 << (i + 2)) for i in range(20)]
    words = spark.createDataFrame(chain, "word string, n long")
    found = variants.forms(words, variants.near_pairs(words))
    assert {r.root for r in variants.with_roots(found).collect()} == {chain[-1][0]}


def test_empty_and_plan(no_docs, messy, plan):
    assert variants.digest(no_docs).count() == 0
    text = plan(variants.near_pairs(variants.vocabulary(messy)))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
