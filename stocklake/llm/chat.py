"""Chat formatting: a finite-state machine over roles, a declarative template, loss flags.

Everything is column expressions. The machine's state is the last role, so a
conversation is valid if each pair of neighbouring roles is a transition; a turn is
written as opening mark, escaped text and closing mark, of which the text alone may
carry loss.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "", "\u0000end"


@dataclass(frozen=True)
class Marks:
    """What a role's turn begins and ends with, and whether its text is learned."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``roles``: marks by role. Any other role gets ``other``, whose opening holds the
    (escaped) role at ``{role}``. ``escapes`` replaces, in texts and role names, every
    character that a mark can begin with, and the escape character itself, by the escape
    character and a letter. So no mark occurs in an escaped text, and since each escape
    character begins an escape, undoing them one letter at a time, the escape character's
    own last, gives the text back. ``transitions``: which role may follow which."""

    roles: dict[str, Marks] = field(
        default_factory=lambda: {
            "system": Marks("<<SYS>>\n", "\n<</SYS>>\n"),
            "user": Marks("[INST] ", " [/INST]"),
            "assistant": Marks("<s>", "</s>", loss=True),
        }
    )
    other: Marks = Marks("[ROLE {role}] ", " [/ROLE]")
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\e"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c"))
    transitions: tuple[tuple[str, str], ...] = (
        (START, "system"),
        (START, "user"),
        ("system", "user"),
        ("user", "assistant"),
        ("assistant", "user"),
        ("assistant", END),
    )

    def marks(self) -> list[Marks]:
        return [*self.roles.values(), self.other]


def _replaced(text: Column, pairs) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escape(text: Column, template: Template) -> Column:
    return _replaced(text, template.escapes)


def unescape(text: Column, template: Template) -> Column:
    return _replaced(text, [(code, raw) for raw, code in reversed(template.escapes)])


def _by_role(role: Column, template: Template, pick) -> Column:
    """``pick(marks)`` of the role's marks, as a chain of conditions."""
    chain = F.lit(pick(template.other))
    for name, marks in reversed(template.roles.items()):
        chain = F.when(role == name, F.lit(pick(marks))).otherwise(chain)
    return chain


def segments(turn: Column, template: Template) -> Column:
    """Opening, text and closing of a turn, each with its loss flag."""
    role, text = turn["role"], turn["text"]
    opening = F.replace(
        _by_role(role, template, lambda m: m.opening), F.lit("{role}"), escape(role, template)
    )
    closing = _by_role(role, template, lambda m: m.closing)
    loss = _by_role(role, template, lambda m: m.loss)
    made = [(opening, F.lit(False)), (escape(text, template), loss), (closing, F.lit(False))]
    return F.array(*[F.struct(t.alias("text"), flag.alias("loss")) for t, flag in made])


def _valid(roles: Column, template: Template) -> Column:
    """Each role, and the end, may follow the one before."""
    allowed = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in template.transitions])
    steps = F.arrays_zip(
        F.concat(F.array(F.lit(START)), roles).alias("a"), F.concat(roles, F.array(F.lit(END))).alias("b")
    )
    return F.forall(
        steps, lambda s: F.array_contains(allowed, F.struct(s["a"].alias("a"), s["b"].alias("b")))
    )


def format_chats(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, valid, segments, formatted``: a row per conversation.

    ``segments`` are texts with loss flags; joined they are ``formatted``. Turns come in
    the order of ``turn``, ties by role and text, a null turn first. A null text or role
    is empty; rows of a null ``conv_id`` are one conversation. ``valid`` says whether the
    machine accepts the roles from start to end; other conversations are written too, with
    the marks of their roles. Other columns are not looked at, repeated rows are repeated
    turns, an empty table gives no rows.

    One shuffle by conversation. A conversation is one string in the result, so its
    turns meet in one task whatever else is done; that text bounds the task's memory.
    """
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    chats = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    made = F.flatten(F.transform("turns", lambda t: segments(t, template)))
    return chats.select(
        "conv_id",
        _valid(F.transform("turns", lambda t: t["role"]), template).alias("valid"),
        made.alias("segments"),
    ).withColumn("formatted", F.concat_ws("", F.col("segments.text")))


def _pattern(text: str) -> str:
    return "".join(f"\\{c}" if not c.isalnum() and c not in " \n" else c for c in text)


def parse_chats(formatted: Column, template: Template = Template()) -> Column:
    """The turns (``role, text``) a formatted conversation was made of."""
    heads = "|".join(_pattern(m.opening.split("{role}")[0]) for m in template.marks())
    pieces = F.filter(F.split(formatted, f"(?={heads})"), lambda p: p != "")

    def read(piece: Column) -> Column:
        before, after = template.other.opening.split("{role}")
        rest = F.substring(piece, F.lit(len(before) + 1), F.length(piece))
        role = F.substring_index(rest, after, 1)
        body = F.substring(rest, F.length(role) + len(after) + 1, F.length(rest))
        out = (unescape(role, template), _cut(body, template.other.closing))
        text, name = out[1], out[0]
        for known, marks in reversed(template.roles.items()):
            starts = F.startswith(piece, F.lit(marks.opening))
            own = _cut(F.substring(piece, F.lit(len(marks.opening) + 1), F.length(piece)), marks.closing)
            text = F.when(starts, own).otherwise(text)
            name = F.when(starts, F.lit(known)).otherwise(name)
        return F.struct(name.alias("role"), unescape(text, template).alias("text"))

    return F.transform(pieces, read)


def _cut(text: Column, closing: str) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - len(closing))


def chat_digests(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """What the formatted conversations hold, read back from them: ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, valid``."""
    flagged = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template))
    read = chats.select(
        "conv_id",
        "valid",
        F.length("formatted").cast("long").alias("formatted_chars"),
        parse_chats(F.col("formatted"), template).alias("turns"),
        F.concat_ws("", flagged).alias("learned"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", lines), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )
