"""Conversation structure repair: the cheapest edits that make the roles `(s?(ua)+)?`.

Rows are put in order (conv_id, turn with nulls first, then a hash of role and text) by a range
partitioning, so a conversation with a third of all rows is spread over many tasks. Each task streams
over its rows in blocks of `BLOCK` and finds the lightest repair of every block by Knuth's agenda
(`agenda`); blocks, and then the few segments of conversations that cross task borders, are joined
as spans over the states in between. Only narrow rows take part; texts are read again, once, when
the edits are applied.

Defined cases: null roles and texts are one space; rows of the null conv_id are one conversation;
a role is known by its first code point and an empty role has none, so such a row never stays as it
is; rows that tie in (turn, role, text) are repeats of each other; a conversation whose rows are all
gone has an empty audit and repair; other columns are ignored; an empty table gives an empty result.
`rows` should be read from files, as marks of equal rows are numbered by the scan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.llm import agenda
from casemart.llm.common import partitions, written

BLOCK = 256  # rows of one agenda
FAN = 16  # segments joined in one step
OUT_CHARS = 4 << 20  # characters of repaired rows that are sent together
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
WHITE = " \t\n\x0b\x0c\r"

SPANS = "array<struct<enter: int, leave: int, cost: long, audit: string>>"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the faults that crc32 of `conv_id:turn` asks for."""
    space = F.lit(" ")
    either = lambda c: F.coalesce(F.col(c).cast("string"), space)
    kind = F.crc32(F.concat(either("conv_id"), F.lit(":"), either("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", either("role").alias("role"), either("text").alias("text"),
        kind.alias("kind"),
    ).filter("kind <> 0")
    text = (
        F.when(F.col("kind") == 1, F.lit(""))
        .when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("again")
    ).drop("again")


def _named(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    return rows.select(
        "conv_id",
        F.col("turn").isNotNull().alias("known"),
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    )


def _same() -> Column:
    """Equal for equal role and text, else not."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def faults(rows: DataFrame) -> DataFrame:
    """Narrow rows: (conv_id, known, turn, same, mark, initial, fault), texts left behind."""
    ending = F.rtrim("text", F.lit(WHITE))
    narrow = written(
        _named(rows).select(
            "conv_id", "known", "turn",
            _same().alias("same"),
            F.monotonically_increasing_id().alias("mark"),
            F.left("role", F.lit(1)).alias("initial"),
            (ending == "").alias("blank"),
            (~F.right(ending, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        ),
        "repair-rows",
    )
    firsts = narrow.groupBy(F.col("conv_id").alias("_conv"), F.col("same").alias("_same")).agg(
        F.min(F.struct("known", "turn", "mark"))["mark"].alias("_first")
    )
    here = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same"))
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("mark") != F.col("_first"), DUPLICATE)
        .when(F.col("cut"), TRUNCATED)
    )
    return narrow.join(firsts, here).select(
        "conv_id", "known", "turn", "same", "mark", "initial", fault.alias("fault")
    )


def _as_list(found: dict) -> list[dict]:
    return [
        {"enter": a, "leave": b, "cost": cost, "audit": audit}
        for (a, b), (cost, audit) in found.items()
    ]


def _as_spans(rows: list[dict]) -> dict:
    return {(r["enter"], r["leave"]): (r["cost"], r["audit"]) for r in rows}


def segments(flagged: DataFrame) -> DataFrame:
    """(conv_id, place, edge, spans): one row per conversation and task, in the order of tasks.

    Only the first and the last conversation of a task (`edge`) may go on in another one.
    """
    order = ["conv_id", "known", "turn", "same", "mark"]
    kind = dict(flagged.dtypes)["conv_id"]
    schema = f"conv_id {kind}, place int, edge boolean, spans {SPANS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        fields = None
        conv, first, block, found, out = None, True, [], None, []

        def close(ended: bool) -> None:
            """Take the block into the spans of its conversation.

            One that began here starts in one state; one that also ended needs its goal only.
            """
            nonlocal block, found
            starts = agenda.STATES if first or found else (agenda.START,)
            whole = ended and not first and found is None
            part = agenda.spans(block, starts, agenda.ACCEPTED if whole else None)
            found = part if found is None else agenda.join(found, part)
            block = []

        def emit(edge: bool) -> None:
            nonlocal found
            out.append({"conv_id": conv, "place": place, "edge": edge, "spans": _as_list(found)})
            found = None

        started = False
        for batch in batches:
            fields = fields or pa.schema([
                ("conv_id", batch.schema.field("conv_id").type), ("place", pa.int32()),
                ("edge", pa.bool_()),
                ("spans", pa.list_(pa.struct([("enter", pa.int32()), ("leave", pa.int32()),
                                              ("cost", pa.int64()), ("audit", pa.string())]))),
            ])
            ids, initials, flaws = (batch.column(c).to_pylist() for c in range(3))
            for one, initial, flaw in zip(ids, initials, flaws):
                if not started:
                    conv, started = one, True
                elif one != conv:
                    close(ended=True)
                    emit(first)
                    conv, first = one, False
                elif len(block) == BLOCK:
                    close(ended=False)
                block.append((initial, flaw in (BLANK, DUPLICATE), flaw == TRUNCATED))
            if len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, fields)
                out = []
        if started:
            close(ended=False)
            emit(True)
            yield pa.RecordBatch.from_pylist(out, fields)

    return (
        flagged.repartitionByRange(partitions(flagged.sparkSession), *order)
        .sortWithinPartitions(*order)
        .select("conv_id", "initial", "fault")
        .mapInArrow(run, schema)
    )


def audits(flagged: DataFrame) -> DataFrame:
    """(conv_id, cost, audit) of every conversation that has rows."""
    parts = written(segments(flagged), "repair-segments")
    kind = dict(flagged.dtypes)["conv_id"]

    def joined(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        found = _as_spans(rows[0]["spans"])
        for row in rows[1:]:
            found = agenda.join(found, _as_spans(row["spans"]))
        whole = {**rows[0], "place": rows[0]["place"] // FAN, "spans": _as_list(found)}
        return pa.Table.from_pylist([whole], schema=table.schema)

    # At most two rows per task; they meet FAN at a time, in the order of the tasks.
    edges = parts.filter("edge")
    reach = (edges.agg(F.max("place")).first()[0] or 0) + 1
    while reach > 1:
        edges = edges.withColumn("step", F.floor(F.col("place") / FAN)).groupBy(
            "conv_id", "step"
        ).applyInArrow(
            lambda t: joined(t.select(["conv_id", "place", "edge", "spans"])),
            f"conv_id {kind}, place int, edge boolean, spans {SPANS}",
        )
        reach = -(-reach // FAN)
    ends = F.filter(
        "spans", lambda s: (s["enter"] == agenda.START) & s["leave"].isin(*agenda.ACCEPTED)
    )
    best = F.array_min(F.transform(ends, lambda s: F.struct(s["cost"], s["audit"])))
    return (
        parts.filter("not edge")
        .unionByName(edges)
        .select("conv_id", best.alias("best"))
        .select("conv_id", "best.cost", "best.audit")
    )


class Editor:
    """Applies an audit to the rows of one conversation as they come by."""

    def __init__(self, audit: str):
        self.edits, self.at, self.state = audit, 0, agenda.START

    def _given(self) -> str:
        initial = "a" if self.state == agenda.USER else "u"
        self.state = agenda.STEP[self.state, initial]
        return agenda.ROLES[initial]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield self._given(), "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = agenda.STEP[self.state, role[0]]
            yield role, text, edit
        elif edit == "R":
            yield self._given(), text, edit


def _edited(rows: DataFrame, found: DataFrame, schema: str, kernel) -> DataFrame:
    """`kernel` over every task's rows in order, each conversation headed by its audit.

    A conversation is one stream of one task, as its digest is; nothing of it is held but the
    batch at hand and the audit.
    """
    named = _named(rows)
    texts = named.select(
        "conv_id", F.lit(True).alias("body"), "known", "turn", _same().alias("same"), "role", "text"
    )
    heads = found.select("conv_id", F.lit(False).alias("body"), F.lit("").alias("role"),
                         F.col("audit").alias("text"))
    return (
        texts.unionByName(heads, allowMissingColumns=True)
        .repartition(partitions(rows.sparkSession), "conv_id")
        .sortWithinPartitions("conv_id", "body", "known", "turn", "same")
        .select("conv_id", "body", "role", "text")
        .mapInArrow(kernel, schema)
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        ids, body, roles = (batch.column(c).to_pylist() for c in range(3))
        texts = batch.column(3)
        for i, conv in enumerate(ids):
            yield conv, body[i], roles[i], texts[i].as_py()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, role, text, edit)."""
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, out, place, chars, conv = None, [], 0, 0, None
        names = ["conv_id", "place", "role", "text", "edit"]

        def add(made) -> None:
            nonlocal place, chars
            for role, text, edit in made:
                out.append((conv, place, role, text, edit))
                place, chars = place + 1, chars + len(text) + 32

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])

        for one, body, role, text in _streamed(batches):
            if not body:
                if editor:
                    add(editor.inserted())
                editor, conv, place = Editor(text), one, 0
            else:
                add(editor.row(role, text))
            if chars > OUT_CHARS:
                yield batch_of(out)
                out, chars = [], 0
        if editor:
            add(editor.inserted())
        if out:
            yield batch_of(out)

    schema = f"conv_id {kind}, place long, role string, text string, edit string"
    return _edited(rows, found, schema, run)


def repair(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with the cheapest edits applied."""
    return repaired(rows, audits(written(faults(rows), "repair-faults")))


def _digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, illegal, repaired_sha256), hashed as the rows come by."""
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, editor, conv = [], None, None
        state = {}

        def take(made) -> None:
            for role, text, _ in made:
                if state["any"]:
                    state["sha"].update(b"\n")
                state["any"] = True
                state["sha"].update(f"{role}:{text}".encode())

        def finish() -> None:
            take(editor.inserted())
            out.append({"conv_id": conv, "illegal": state["illegal"],
                        "repaired_sha256": state["sha"].hexdigest()})

        for one, body, role, text in _streamed(batches):
            if not body:
                if editor:
                    finish()
                editor, conv = Editor(text), one
                state = {"sha": hashlib.sha256(), "any": False, "illegal": 0, "last": None}
            else:
                if state["last"] is not None:
                    state["illegal"] += (state["last"] + role[:1]) not in ("su", "ua", "au")
                state["last"] = role[:1]
                take(editor.row(role, text))
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out)
                out = []
        if editor:
            finish()
        if out:
            yield pa.RecordBatch.from_pylist(out)

    return _edited(rows, found, f"conv_id {kind}, illegal long, repaired_sha256 string", run)


def report(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """Faults and the repair of each conversation in `ids`, for their `rows`."""
    flagged = written(faults(rows), "repair-faults")
    counts = flagged.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *(F.count_if(F.col("fault") == f).alias(f) for f in (BLANK, DUPLICATE, TRUNCATED)),
    )
    found = written(audits(flagged), "repair-audits")
    out = ids.select("conv_id").distinct()
    for part in (counts, found, _digests(rows, found)):
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zeros = ["gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost"]
    return out.select(
        "conv_id",
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in zeros),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def digest(conversations: DataFrame) -> DataFrame:
    return report(conversations, damage(conversations))
