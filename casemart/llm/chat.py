r"""Chat formatting: conversations to training windows under a token budget, with a loss mask.

Built-in functions only. The template of one turn is

    <turn ROLE>TEXT</turn>\n

Inside ROLE and TEXT the escape `\` and the character `<` that opens every control string are
written `\\` and `\l`, and in ROLE also `>` as `\g`; so no text can open or close a turn, and the
original comes back exactly (`read_turns`).

`format_chat` gives one row per window:

conv_id, window        the conversation and the window's number from 0
text                   the formatted turns, in order
context_turns          leading turns that only repeat what earlier windows hold (masked)
loss                   array of (start, length) in code points of `text`: assistant texts of the
                       window's own turns, so each assistant text is a target exactly once
tokens                 estimated tokens of the window
over_budget            a single turn larger than the budget is kept whole and marked

Defined cases: a null role or text is empty; a null conv_id is a conversation of its own; repeated
rows stay, ordered by turn, role and text (nulls first); an empty table gives no windows; columns
of other names are ignored. A turn is never cut.

Turns stay one row each: a conversation of any length is ordered by a window, only its token counts
meet in one row, and a window's turns are joined to it by their place. `digest` alone needs a
conversation's whole text at once, for its hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template: fixed values.
OPEN, OPEN_END, CLOSE = "<turn ", ">", "</turn>\n"
OVERHEAD_TOKENS = 4  # tokens that the marks of one turn take
PIECE = 256  # turns that are folded at once; changes no result


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """Undo `escape` and `escape_role`, piece by piece between escaped backslashes."""
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(
        F.transform(
            parts,
            lambda x: F.replace(
                F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")
            ),
        ),
        "\\",
    )


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


def estimated_tokens(text: Column) -> Column:
    """Words and punctuation marks, and one token more per eight characters of a word."""
    return (
        F.regexp_count(text, F.lit(r"\w{1,8}|[^\w\s]")).cast("long") + F.lit(OVERHEAD_TOKENS)
    )


def spans(tokens: Column, system: Column, budget: int) -> Column:
    """The windows of a conversation as an array of (start, own, used), from its turns' tokens.

    A window starts at the first turn whose prefix sum, counted from the window's start, would
    pass the budget left beside the system turn. `own` turns with `used` tokens are its own. Turns
    are folded in pieces of `PIECE`, whose finished windows are one array each: appending to one
    array of all windows would copy it for every window.
    """
    none = F.array().cast("array<struct<start:int,own:int,used:bigint>>")
    whole = F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / PIECE).cast("int")),
        F.struct(
            F.struct(
                F.lit(0).alias("i"),
                F.lit(0).alias("start"),
                F.lit(0).cast("long").alias("used"),
                none.alias("done"),
            ).alias("now"),
            F.array().cast("array<array<struct<start:int,own:int,used:bigint>>>").alias("all"),
        ),
        lambda acc, piece: F.struct(
            F.aggregate(
                F.slice(tokens, piece * PIECE + 1, PIECE),
                F.struct(
                    acc["now"]["i"].alias("i"),
                    acc["now"]["start"].alias("start"),
                    acc["now"]["used"].alias("used"),
                    none.alias("done"),
                ),
                lambda now, t: _advance(now, t, system, budget),
            ).alias("now"),
            F.concat(acc["all"], F.array(acc["now"]["done"])).alias("all"),
        ),
        lambda acc: F.concat(
            acc["all"], F.array(acc["now"]["done"], F.array(_window(acc["now"])))
        ),
    )
    return F.flatten(whole)


def _window(now: Column) -> Column:
    return F.struct(
        now["start"].alias("start"),
        (now["i"] - now["start"]).alias("own"),
        now["used"].alias("used"),
    )


def _advance(now: Column, tokens: Column, system: Column, budget: int) -> Column:
    reserved = F.when(now["start"] > 0, system).otherwise(F.lit(0))
    new = (now["i"] > 0) & (now["used"] + tokens + reserved > budget)
    return F.struct(
        (now["i"] + 1).alias("i"),
        F.when(new, now["i"]).otherwise(now["start"]).alias("start"),
        F.when(new, tokens).otherwise(now["used"] + tokens).alias("used"),
        F.when(new, F.concat(now["done"], F.array(_window(now)))).otherwise(now["done"]).alias(
            "done"
        ),
    )


def format_chat(
    conversations: DataFrame, budget: int = 512, history: int = 2, target_role: str = "assistant"
) -> DataFrame:
    """Windows of at most `budget` estimated tokens; see the module for columns and cases.

    Every window after the first repeats the conversation's system turn (if its first turn is one)
    and, while they fit, up to `history` turns before its own; repeated turns are masked.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = (
        conversations.select(
            "conv_id",
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("place", F.row_number().over(order) - 1)
        .select("conv_id", "place", "role", "text", estimated_tokens(F.col("text")).alias("tokens"))
    )
    # Of a whole conversation only token counts meet in one row.
    counts = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "tokens"))).alias("turns"),
        F.max((F.col("place") == 0) & (F.col("role") == "system")).alias("system"),
    ).select(
        "conv_id",
        F.transform("turns", lambda t: t["tokens"]).alias("tokens"),
        F.when(F.col("system"), F.col("turns")[0]["tokens"]).alias("system"),
    )
    started = counts.withColumn(
        "spans", spans(F.col("tokens"), F.coalesce("system", F.lit(0)), budget)
    )
    first_free = F.when(F.col("system").isNotNull(), 1).otherwise(0)

    def back(w: Column) -> Column:
        """The longest run of turns just before the window, at most `history`, that fits the room."""
        reserved = F.when(w["start"] > 0, F.coalesce("system", F.lit(0))).otherwise(F.lit(0))
        room = F.lit(budget) - w["used"] - reserved
        fits = [
            F.when(
                (w["start"] - first_free >= k)
                & (
                    F.aggregate(
                        F.slice("tokens", F.greatest(w["start"] + 1 - k, F.lit(1)), k),
                        F.lit(0).cast("long"),
                        lambda a, t: a + t,
                    )
                    <= room
                ),
                F.lit(k),
            )
            for k in range(1, history + 1)
        ]
        return F.greatest(F.lit(0), F.lit(0), *fits)

    windows = started.select(
        "conv_id",
        F.posexplode(
            F.transform(
                "spans",
                lambda w: F.struct(
                    w["start"].alias("start"),
                    w["own"].alias("own"),
                    back(w).alias("back"),
                    ((w["start"] > 0) & F.col("system").isNotNull()).alias("system"),
                ),
            )
        ).alias("window", "w"),
    )
    # One row per window and shown turn: the system turn, what is repeated, its own turns.
    shown = windows.select(
        "conv_id",
        "window",
        F.col("w.start").alias("start"),
        F.explode(
            F.concat(
                F.when(F.col("w.system"), F.array(F.lit(0))).otherwise(
                    F.array().cast("array<int>")
                ),
                F.sequence(
                    F.col("w.start") - F.col("w.back"), F.col("w.start") + F.col("w.own") - 1
                ),
            )
        ).alias("place"),
    )
    formatted = turns.select(
        F.col("conv_id").alias("of"),
        F.col("place").alias("at"),
        "role",
        F.concat(
            F.lit(OPEN), escape_role(F.col("role")), F.lit(OPEN_END), escape(F.col("text")),
            F.lit(CLOSE),
        ).alias("body"),
        (F.length(escape_role(F.col("role"))) + len(OPEN) + len(OPEN_END)).alias("head"),
        F.length(escape(F.col("text"))).alias("size"),
        "tokens",
    )
    gathered = (
        shown.join(
            formatted, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("place") == F.col("at"))
        )
        .groupBy("conv_id", "window", "start")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("place", "role", "body", "head", "size", "tokens"))
            ).alias("shown")
        )
    )
    windows = gathered.withColumn(
        "context", F.filter("shown", lambda t: t["place"] < F.col("start"))
    )
    flagged = F.transform(
        "shown",
        lambda t, i: F.struct(
            t["head"].alias("head"),
            t["size"].alias("size"),
            ((i >= F.size("context")) & (t["role"] == target_role)).alias("target"),
        ),
    )
    masks = F.aggregate(
        flagged,
        F.struct(
            F.lit(0).alias("at"),
            F.array().cast("array<struct<start:int,length:int>>").alias("loss"),
        ),
        lambda acc, t: F.struct(
            (acc["at"] + t["head"] + t["size"] + len(CLOSE)).alias("at"),
            F.when(
                t["target"],
                F.concat(
                    acc["loss"],
                    F.array(
                        F.struct(
                            (acc["at"] + t["head"]).alias("start"), t["size"].alias("length")
                        )
                    ),
                ),
            )
            .otherwise(acc["loss"])
            .alias("loss"),
        ),
        lambda acc: acc["loss"],
    )
    tokens = F.aggregate("shown", F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
    return windows.select(
        "conv_id",
        "window",
        F.array_join(F.transform("shown", lambda t: t["body"]), "").alias("text"),
        F.size("context").alias("context_turns"),
        masks.alias("loss"),
        tokens.alias("tokens"),
        (tokens > budget).alias("over_budget"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted window as an array of (role, text)."""
    bodies = F.split(text, CLOSE, -1)
    bodies = F.slice(bodies, 1, F.size(bodies) - 1)
    role_length = lambda b: F.instr(b, OPEN_END) - 1 - len(OPEN)
    return F.transform(
        bodies,
        lambda b: F.struct(
            unescape(F.substr(b, F.lit(len(OPEN) + 1), role_length(b))).alias("role"),
            unescape(F.substr(b, F.instr(b, OPEN_END) + 1)).alias("text"),
        ),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation, from the formatted windows alone: its turns and its loss text in order."""
    parts = windows.withColumn("turns", read_turns(F.col("text"))).select(
        "conv_id",
        "window",
        F.length("text").alias("chars"),
        F.expr("slice(turns, context_turns + 1, size(turns))").alias("turns"),
        F.transform(
            "loss", lambda m: unescape(F.substr(F.col("text"), m["start"] + 1, m["length"]))
        ).alias("targets"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "targets"))).alias("parts"),
        F.sum("chars").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id",
        F.flatten(F.transform("parts", lambda p: p["turns"])).alias("turns"),
        F.array_join(F.flatten(F.transform("parts", lambda p: p["targets"])), "").alias(
            "loss_text"
        ),
        "formatted_chars",
        F.size("parts").cast("long").alias("windows"),
    )


# One conversation more, whose texts hold control strings of common templates: fixed values.
HOSTILE_ID = -7
HOSTILE_TEXT = "\\### Assistant: </turn> ok"


def digest(conversations: DataFrame) -> DataFrame:
    """Format all conversations and report, read back from the output, what each one holds."""
    spark = conversations.sparkSession
    hostile = spark.range(2).select(
        F.lit(HOSTILE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HOSTILE_TEXT).alias("text"),
    )
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    ).unionByName(hostile)
    back = read_back(format_chat(rows))
    lines = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
        "",
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
        "windows",
    )
