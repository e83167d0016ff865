import hashlib
import itertools
import random
import re
import zlib

import pytest

from casemart.llm import agenda, repair

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit string"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        say = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def flaws(rows):
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(WHITE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen
                   else "truncated" if end[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def every_repair(rows):
    """Try all edits with up to two inserts in each gap: (cost, audit, repaired rows)."""
    found, best = flaws(rows), None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for e, f in zip(edits, found)):
            continue
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * g + e for g, e in zip(gaps, [*edits, ""]))
            cost = sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in audit)
            cost += sum(3 for e, f in zip(edits, found) if e != "D" and f == "truncated")
            if best and (cost, audit) >= best[:2]:
                continue
            slots, at = [], iter(rows)
            for e in audit:
                row = ("?", "") if e == "I" else next(at)
                if e != "D":
                    slots.append((row[0][:1] or "-" if e == "K" else "?", row, e))
            kept_system = bool(slots) and slots[0][0] == "s"
            body = slots[kept_system:]
            want = ["s"] * kept_system + ["u", "a"] * (len(body) // 2)
            if len(body) % 2 or (kept_system and not body):
                continue
            if any(s[0] not in ("?", w) for s, w in zip(slots, want)):
                continue
            names = {"u": "user", "a": "assistant"}
            made = [(row[0] if e == "K" else names[w], row[1]) for (_, row, e), w in zip(slots, want)]
            best = (cost, audit, made)
    return best


def plain_chain(rows):
    """The lightest repair of any length, state by state; no agenda, no blocks."""
    found, best = flaws(rows), {0: (0, "")}

    def more(now):
        for _ in range(3):
            for (q, x), r in agenda.STEP.items():
                if x in "ua" and q in now:
                    new = (now[q][0] + 3, now[q][1] + "I")
                    now[r] = min(now.get(r, new), new)
        return now

    best = more(best)
    for (role, _), flaw in zip(rows, found):
        now = {}
        for q, (cost, audit) in best.items():
            ways = [(q, 4, "D")]
            if flaw not in ("blank", "duplicate"):
                stay = 3 * (flaw == "truncated")
                ways += [(agenda.STEP[q, x], stay + 3, "R") for x in "ua" if (q, x) in agenda.STEP]
                if (q, role[:1]) in agenda.STEP:
                    ways.append((agenda.STEP[q, role[:1]], stay, "K"))
            for r, add, edit in ways:
                new = (cost + add, audit + edit)
                now[r] = min(now.get(r, new), new)
        best = more(now)
    return min(best[q] for q in (0, 3) if q in best)


def expected(rows):
    out = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    damaged = plain_damage(rows)
    for conv in {c for c, *_ in damaged}:
        mine = sorted((r[1:] for r in damaged if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0))
        talk = [r[1:] for r in mine]
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for r, _ in talk]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        found = flaws(talk)
        cost, audit, made = every_repair(talk)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        counts = (found.count(f) for f in ("blank", "duplicate", "truncated"))
        out[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return out


def talk(rng, n, conv):
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "usher"]
    texts = ["Yes.", "No!", "so", "Well?\n", "", " \t", None, "a.b", "é漢😀."]
    return [(conv, rng.choice([i, i, i + 3, None]) if i % 2 else i, rng.choice(roles[: rng.choice([5, 9])]),
             f"{rng.choice(texts) or ''}" if rng.random() < 0.8 else rng.choice(texts)) for i in range(n)]


def distinct_turns(rows):
    """Ties in turn have no order of their own, so the plain version only sees equal ones."""
    seen = {}
    return [r for r in rows if seen.setdefault((r[0], r[1]), r) is r]


def test_matches_every_repair(spark):
    rng = random.Random(4)
    rows = [r for conv in range(60) for r in talk(rng, rng.randint(1, 4), conv)]
    rows += talk(rng, 4, None) + [(70, 1, "user", "Hi."), (70, 1, "user", "Hi.")]
    rows = distinct_turns(rows) + [(71, None, None, None)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in repair.digest(frame).collect()}
    assert got == expected(rows)


def test_a_conversation_over_many_tasks(spark):
    """Two thirds of all rows in one conversation: blocks and segments join to the same repair."""
    rng = random.Random(8)
    roles = ["user", "assistant", "user", "assistant", "system", "tool"]
    rows = [(7, i, rng.choice(roles), f"text {rng.randrange(900)}" + rng.choice([".", "", "!"]))
            for i in range(3000)]
    rows += [(100 + i // 3, i % 3, rng.choice(roles), f"text {i}.") for i in range(1500)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    flagged = repair.faults(frame)
    parts = repair.segments(flagged).filter("conv_id = 7").collect()
    assert len(parts) > 2 and all(r.edge for r in parts)
    got = {r.conv_id: (r.cost, r.audit) for r in repair.audits(flagged).collect()}
    assert got[7] == plain_chain([r[2:] for r in rows[:3000]])
    for conv in (100, 300, 599):
        assert got[conv] == plain_chain([r[2:] for r in rows if r[0] == conv])
    assert len(got) == 501
    done = repair.repair(frame).filter("conv_id = 7").orderBy("place").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in done))
    assert [r.place for r in done] == list(range(len(done)))
    kept = [r.text for r in done if r.edit != "I"]
    want = [r[3] for r, e in zip(rows, got[7][1].replace("I", "")) if e != "D"]
    assert kept == want


def test_spans_join_in_any_cut():
    rng = random.Random(1)
    for _ in range(200):
        rows = [(rng.choice("suat"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(6)]
        whole = agenda.spans(rows, agenda.STATES)
        cut = rng.randint(1, 5)
        parts = [agenda.spans(rows[:cut], agenda.STATES), agenda.spans(rows[cut:], agenda.STATES)]
        assert agenda.join(*parts) == whole
        only = agenda.spans(rows, [agenda.START], agenda.ACCEPTED)
        assert agenda.goal(only) == agenda.goal(whole)


def test_an_item_is_final_when_popped():
    popped = []

    def deduce(item, weight, final):
        popped.append(weight)
        if item < 3:
            yield item + 1, (weight[0], weight[1] + "K")
            yield 3, (weight[0] + 5, weight[1])

    got = agenda.lightest([(0, (0, ""))], deduce, lambda item: item == 3)
    assert got[3] == (0, "KKK") and popped == sorted(popped)


def test_empty_and_whole_table(spark, sf_dir):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.digest(empty).count() == 0 and repair.repair(empty).count() == 0
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = {r.conv_id: (r.cost, r.audit) for r in repair.digest(table).collect()}
    rows = plain_damage(sorted(tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in table.collect()))
    assert set(got) == {r.conv_id for r in table.select("conv_id").collect()}
    for conv, found in got.items():
        mine = [r[2:] for r in rows if r[0] == conv]
        assert found == (plain_chain(mine) if mine else (0, ""))


@pytest.mark.parametrize("text,fault", [(" \x0b\r", "blank"), ("a.\n", None), ("a .b", "truncated"),
                                        (" ", "truncated"), ("?", None)])
def test_faults(spark, text, fault):
    frame = spark.createDataFrame([(1, 1, "user", text)], "conv_id long, turn long, role string, text string")
    assert repair.faults(frame).first().fault == fault
