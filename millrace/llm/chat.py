"""Chat formatting: a state machine over roles, text segments with loss flags, and reading the format back."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import plain, text_of


@dataclass(frozen=True)
class Template:
    """What stands around the turns of each role, whose text is learned, and which role may follow which.

    ``marks`` open the turns of their roles; any other role opens with its name between ``other`` and ``named``. ``end``
    closes every turn. All these control strings begin with a character of ``controls``. In texts and role names the
    escape character, and the control characters in their order, become the escape and a digit, so a text holds no
    control character and no control string can come from it.
    """

    marks: tuple[tuple[str, str], ...]
    other: str
    named: str
    end: str
    learned: frozenset[str]
    start: str
    follows: tuple[tuple[str, str], ...]
    finals: frozenset[str]
    controls: str
    escape: str

    def __post_init__(self):
        strings = [self.other, self.named, self.end, *(mark for _, mark in self.marks)]
        if any(not s or s[0] not in self.controls for s in strings) or self.escape in self.controls or len(self.controls) > 9:
            raise ValueError("control strings begin with control characters, and the escape is none of these (nine at most)")


INSTRUCT = Template(
    marks=(("system", "[SYS]"), ("user", "[INST]"), ("assistant", "[/INST]")),
    other="[ROLE]",
    named="[/ROLE]",
    end="</s>",
    learned=frozenset({"assistant"}),
    start="start",
    follows=(("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")),
    finals=frozenset({"user", "assistant"}),
    controls="[<",
    escape="~",
)


def escaped(text: Column, template: Template) -> Column:
    """The escape first, so that no escape is escaped twice."""
    for digit, character in enumerate(template.escape + template.controls):
        text = F.replace(text, F.lit(character), F.lit(template.escape + str(digit)))
    return text


def unescaped(text: Column, template: Template) -> Column:
    """The escape last: every escape in the text stands before a digit, so none is read twice."""
    for digit, character in reversed(list(enumerate(template.escape + template.controls))):
        text = F.replace(text, F.lit(template.escape + str(digit)), F.lit(character))
    return text


def format_chats(
    turns: DataFrame, template: Template = INSTRUCT, id_column: str = "conv_id", order_column: str = "turn",
    role_column: str = "role", text_column: str = "text",
) -> DataFrame:
    """One row per conversation: (id, formatted, segments, state, valid).

    ``segments`` are (text, loss) in order and make up ``formatted``; loss is set on the text of learned roles only, never
    on marks. The machine starts in ``template.start`` and takes each role as a step to the state of that name; a step
    that is not in ``template.follows`` leads to the state ``error`` for good. ``valid`` says whether the last state is
    one that a conversation may end in. Conversations out of order are formatted all the same.

    Turns are ordered by number, then role, then text, so that ties and repeated rows have one order; they all count. NULL
    numbers come first. A NULL text or role is empty; the rows without an id are one conversation. Other columns are not
    looked at. An empty table gives no rows. A conversation is one row of the result and so has to fit in a task.
    """
    rows = turns.select(
        plain(id_column).alias("id"),
        plain(order_column).alias("turn"),
        text_of(role_column).alias("role"),
        text_of(text_column).alias("text"),
    )
    chats = rows.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def pieces(turn: Column) -> Column:
        mark = F.concat(F.lit(template.other), escaped(turn["role"], template), F.lit(template.named))
        for name, opening in template.marks:
            mark = F.when(turn["role"] == name, F.lit(opening)).otherwise(mark)
        learned = turn["role"].isin(*sorted(template.learned))
        return F.array(
            F.struct(mark.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(turn["text"], template).alias("text"), learned.alias("loss")),
            F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")),
        )

    steps = F.create_map(*[F.lit(x) for a, b in template.follows for x in (f"{a} {b}", b)])

    def step(state: Column, turn: Column) -> Column:
        return F.coalesce(F.try_element_at(steps, F.concat(state, F.lit(" "), turn["role"])), F.lit("error"))

    return chats.select(
        "id",
        F.flatten(F.transform("turns", pieces)).alias("segments"),
        F.aggregate("turns", F.lit(template.start), step).alias("state"),
    ).select(
        F.col("id").alias(id_column),
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        "segments",
        "state",
        F.col("state").isin(*sorted(template.finals)).alias("valid"),
    )


def read_back(chats: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """``chats`` with ``turns`` (role, text) read from ``formatted``, and ``learned_text`` from the loss flags.

    A turn is what stands before an end mark; its role is what its opening mark says. The learned text is all text under
    the loss flags, unescaped, with nothing in between.
    """
    parts = F.split("formatted", re.escape(template.end))

    def turn(part: Column) -> Column:
        closing = F.locate(template.named, part)
        role = unescaped(F.substring(part, F.lit(len(template.other) + 1), closing - F.lit(len(template.other) + 1)), template)
        text = F.substring(part, closing + F.lit(len(template.named)), F.length(part))
        for name, opening in template.marks:
            opens = part.startswith(opening)
            role = F.when(opens, F.lit(name)).otherwise(role)
            text = F.when(opens, F.substring(part, F.lit(len(opening) + 1), F.length(part))).otherwise(text)
        return F.struct(role.alias("role"), unescaped(text, template).alias("text"))

    learned = F.filter("segments", lambda segment: segment["loss"])
    return chats.select(
        *[plain(c) for c in chats.columns],
        # behind the last end mark stands nothing
        F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn).alias("turns"),
        F.array_join(F.transform(learned, lambda segment: unescaped(segment["text"], template)), "").alias("learned_text"),
    )
