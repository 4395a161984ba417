"""Chat formatting: conversations to text segments with loss flags, from a declarative template.

A finite-state machine over roles checks the order of the turns: its transitions are data, and it runs as a
fold over a conversation's roles. A template gives each role its segments, literal text with places for
the role and the text, and says which of them the loss covers.

Texts may contain the template's control strings. A text is escaped so that `<|` never appears in it: each run
of backslashes between `<` and `|` gets one more. Unescaping takes one away, so any text comes back
as it was. A role is escaped by percent signs, also for the line end that closes it.

Turns are ordered by (turn, role, text), nulls first, so repeated turns and ties have one order. A
conversation with a wrong order is formatted like others and marked: `valid` is false and `bad_turn` is the
place (from 1) of the first turn that the machine has no transition for, or one past the last turn if it
ends where it may not.

Nulls and edge cases: a null text or role is empty; null conv_id is a conversation like others. An empty table
gives an empty result. Other columns are not read. A formatted conversation is one value, as a training sample
is, so its text must fit a row (2 GB); `turn_segments` gives the same segments row by row, without any grouping.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE, TEXT = "{role}", "{text}"


@dataclass(frozen=True)
class Template:
    #: (state, role) to the next state.
    transitions: dict[tuple[str, str], str]
    start: str
    accepting: frozenset[str]
    #: Segments of a turn by role; "*" is any other role. A segment is (pattern, under the loss).
    turns: dict[str, tuple[tuple[str, bool], ...]]
    #: What opens and closes a turn, to read it back.
    opens: str
    closes: str


# The control strings of the ChatML format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turn(loss: bool) -> tuple[tuple[str, bool], ...]:
    return ((f"{OPEN}{ROLE}\n", False), (TEXT, loss), (f"{CLOSE}\n", False))


CHATML = Template(
    transitions={
        ("start", "system"): "instructed",
        ("start", "user"): "asked",
        ("instructed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    start="start",
    accepting=frozenset({"answered"}),
    turns={"assistant": _turn(True), "*": _turn(False)},
    opens=OPEN,
    closes=f"{CLOSE}\n",
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    out = F.replace(role, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def unescape_role(role: Column) -> Column:
    out = F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%3C"), F.lit("<"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def _segments(role: Column, text: Column, template: Template) -> Column:
    """array<struct<text, loss>> of a turn."""
    filled = {ROLE: escape_role(role), TEXT: escape(text)}

    def fill(pattern: str) -> Column:
        parts = [pattern]
        for name in filled:
            parts = [x for part in parts for x in _split(part, name)]
        return F.concat(*[filled.get(x, F.lit(x)) for x in parts])

    def build(turn: tuple[tuple[str, bool], ...]) -> Column:
        return F.array(*[F.struct(fill(p).alias("text"), F.lit(loss).alias("loss")) for p, loss in turn])

    out = None
    for name, turn in template.turns.items():
        if name != "*":
            out = F.when(role == name, build(turn)) if out is None else out.when(role == name, build(turn))
    return build(template.turns["*"]) if out is None else out.otherwise(build(template.turns["*"]))


def _split(text: str, name: str) -> list[str]:
    """The parts of a pattern around a place, without empty ones."""
    if text == name:
        return [text]
    parts: list[str] = []
    for piece in text.split(name):
        parts += [piece, name]
    return [x for x in parts[:-1] if x]


def _clean(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def turn_segments(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, turn, role, part, text, loss: the segments row by row. No shuffle, no order check."""
    rows = _clean(conversations)
    parts = F.posexplode(_segments(F.col("role"), F.col("text"), template)).alias("part", "segment")
    return rows.select("conv_id", "turn", "role", parts).select(
        "conv_id", "turn", "role", "part", F.col("segment.text").alias("text"), F.col("segment.loss").alias("loss")
    )


def run_machine(roles: Column, template: Template = CHATML) -> Column:
    """The place of the first turn out of order, null if the roles are accepted."""
    moves = F.create_map(
        *[F.lit(x) for (state, role), after in template.transitions.items() for x in (f"{state}\n{role}", after)]
    )
    begin = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("read"), F.lit(None).cast("int").alias("bad"))

    def step(held: Column, role: Column) -> Column:
        after = F.element_at(moves, F.concat(held["state"], F.lit("\n"), role))
        return F.struct(
            F.coalesce(after, held["state"]).alias("state"),
            (held["read"] + 1).alias("read"),
            F.coalesce(held["bad"], F.when(after.isNull(), held["read"] + 1)).alias("bad"),
        )

    def finish(held: Column) -> Column:
        return F.coalesce(held["bad"], F.when(~held["state"].isin(*sorted(template.accepting)), held["read"] + 1))

    return F.aggregate(roles, begin, step, finish)


def format_conversations(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, segments (array<struct<text, loss>>), valid and bad_turn of each conversation."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    grouped = _clean(conversations).groupBy("conv_id").agg(turns.alias("turns"))
    return grouped.select(
        "conv_id",
        F.flatten(F.transform("turns", lambda t: _segments(t["role"], t["text"], template))).alias("segments"),
        run_machine(F.col("turns.role"), template).alias("bad_turn"),
    ).withColumn("valid", F.col("bad_turn").isNull())


def read_back(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """What the formatted text says: conv_id, turns (array<struct<role, text>>), formatted and loss_text."""
    whole = formatted.withColumn("formatted", F.array_join("segments.text", ""))
    quoted = template.closes.replace("|", r"\|")
    # no control string is left within a turn, so each close ends one
    turns = F.filter(F.split("formatted", quoted, -1), lambda x: x != "")

    def turn(piece: Column) -> Column:
        bare = F.substring(piece, F.lit(len(template.opens) + 1), F.length(piece))
        cut = F.locate("\n", bare)
        return F.struct(
            unescape_role(F.substring(bare, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substring(bare, cut + 1, F.length(bare))).alias("text"),
        )

    lossy = F.filter("segments", lambda s: s["loss"])
    return whole.select(
        "conv_id",
        F.transform(turns, turn).alias("turns"),
        "formatted",
        F.array_join(F.transform(lossy, lambda s: unescape(s["text"])), "").alias("loss_text"),
        "valid",
        "bad_turn",
    )


def digest(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation, read back from its formatted text: turns, loss, lengths and validity."""
    back = read_back(format_conversations(conversations, template), template)
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        F.col("bad_turn").cast("long").alias("bad_turn"),
    )
