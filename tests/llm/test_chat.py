import hashlib
import re
from collections import defaultdict

from casemart.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, window string, turns string"


def table(spark):
    rows = []
    for c in range(12):
        for t in range(c % 6 + 1):
            role = "system" if t == 0 and c % 2 else ("user" if t % 2 else "assistant")
            rows.append((c, t, role, f"c{c} t{t} \\l \\\\ <turn x></turn>\n " + "word " * (40 * t)))
    rows += [(20, 0, None, None), (20, 1, "assistant", None), (20, 2, "assistant", "")]
    rows += [(21, 0, "assistant", "same"), (21, 0, "assistant", "same")]  # repeated rows
    rows += [(22, None, "a<b>\\c", "odd role"), (22, 1, "assistant", "<\\l\\\\<l")]
    rows += [(None, 0, "assistant", "no id")]
    rows += [(23, t, "assistant", "long " * 3000) for t in range(3)]
    return rows, spark.createDataFrame([(*r, "w", "t") for r in rows], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_reads_back_every_conversation(spark):
    rows, frame = table(spark)
    wanted = defaultdict(list)
    for conv, turn, role, text in rows:
        wanted[conv].append((turn is not None, turn or 0, role or "", text or ""))
    wanted[-7] = [(True, 0, "user", chat.HOSTILE_TEXT), (True, 1, "assistant", chat.HOSTILE_TEXT)]
    out = {r.conv_id: r for r in chat.digest(frame).collect()}
    assert set(out) == set(wanted)
    for conv, turns in wanted.items():
        turns.sort()
        loss = "".join(t for _, _, role, t in turns if role == "assistant")
        got = out[conv]
        assert got.n_turns == len(turns)
        assert got.turns_sha256 == sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns))
        assert (got.loss_chars, got.loss_sha256) == (len(loss), sha(loss))


def test_windows_keep_the_budget_and_repeat_masked_context(spark):
    _, frame = table(spark)
    windows = chat.format_chat(frame, budget=150, history=1).collect()
    by_conv = defaultdict(list)
    for w in windows:
        by_conv[w.conv_id].append(w)
        assert w.over_budget == (w.tokens > 150)
        starts = [m.start for m in w.loss]
        assert starts == sorted(starts)
        own = w.text.count(chat.CLOSE) - w.context_turns
        assert own >= 1
        if w.over_budget:
            assert own == 1  # only a turn that is too large by itself
    later = [w for ws in by_conv.values() for w in ws if w.window > 0]
    assert any(w.context_turns for w in later)
    system = [w for w in later if w.conv_id is not None and w.conv_id % 2 and w.conv_id < 12]
    assert system and all(w.text.startswith("<turn system>") for w in system)


def test_a_long_conversation_is_not_copied_per_window(spark, plan):
    n = 3 * chat.PIECE + 5
    rows = [(1, t, "system" if t == 0 else "user" if t % 2 else "assistant", "w " * (t % 7 + 1))
            for t in range(n)]
    rows += [(None, t, "assistant", "w " * (t % 5)) for t in range(n)]
    frame = spark.createDataFrame([(*r, "w", "t") for r in rows], SCHEMA)
    cost = lambda text: len(text.split()) + chat.OVERHEAD_TOKENS
    got = defaultdict(list)
    for w in chat.format_chat(frame, budget=30, history=2).collect():
        got[w.conv_id].append(w)
    for conv in (1, None):
        turns = [(role, text) for c, _, role, text in rows if c == conv]
        system = cost(turns[0][1]) if conv else 0
        starts, used = [0], 0
        for i, (_, text) in enumerate(turns):
            if i and used + cost(text) + (system if starts[-1] else 0) > 30:
                starts.append(i)
                used = 0
            used += cost(text)
        want = []
        for a, b in zip(starts, [*starts[1:], n]):
            size = lambda x, y: sum(cost(t) for _, t in turns[x:y])
            room = 30 - size(a, b) - (system if a else 0)
            k = max(k for k in range(3) if k == 0 or (
                a - bool(system) >= k and size(a - k, a) <= room))
            shown = [0] * bool(a and system) + list(range(a - k, b))
            want.append("".join(f"<turn {turns[i][0]}>{turns[i][1]}</turn>\n" for i in shown))
        assert [w.text for w in sorted(got[conv], key=lambda w: w.window)] == want
    # What an exploded row carries along is no array of turns.
    carried = re.findall(r"\), \[([^\]]*)\], (?:true|false), \[", plan(chat.format_chat(frame)))
    assert carried and all(
        set(re.sub(r"#\d+L?", "", c).split(", ")) <= {"conv_id", "window", "start", "w"}
        for c in carried
    )


def test_lengths_formatted_and_plan(spark, plan):
    _, frame = table(spark)
    lengths = {}
    for w in chat.format_chat(frame).collect():
        lengths[w.conv_id] = lengths.get(w.conv_id, 0) + len(w.text)
    out = {r.conv_id: r.formatted_chars for r in chat.digest(frame).collect()}
    assert all(out[k] == v for k, v in lengths.items())
    assert "Python" not in plan(chat.digest(frame))


def test_empty_table_has_the_extra_conversation_only(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.format_chat(empty).count() == 0
    assert [r.conv_id for r in chat.digest(empty).collect()] == [-7]
