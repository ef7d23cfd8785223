"""Chat transcripts as training text, with a loss mask and a way back.

Turns are formatted relationally: collected as structs, sorted, merged where neighbours
have the same role, and concatenated; built-in expressions only. All control strings
begin with ``<|``, which the escaping keeps out of roles and texts, so the turns can be
read back from the formatted text alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.names import quoted

LEAD = "<|"
ESCAPE = "\\"
HOT_TURNS = 4096
BLOCK_TURNS = 1024
MOST_HOT = 10_000


@dataclass(frozen=True)
class ChatTemplate:
    """``begin`` role ``says`` text [``more`` text ...] ``end``, once for each run of turns of one role.

    Texts of merged turns are kept apart by ``more``. The loss is taken on the texts of
    the roles in ``loss_roles``, without any control string.
    """

    begin: str = "<|im_start|>"
    says: str = "<|im_sep|>"
    more: str = "<|im_more|>"
    end: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        marks = (self.begin, self.says, self.more, self.end)
        if any(not x.startswith(LEAD) or LEAD in x[1:] or x[-1] in LEAD for x in marks):
            raise ValueError(f"a control string begins with {LEAD}, holds it once and does not end in a part of it")
        if any(x != y and x.startswith(y) for x in marks for y in marks) or len(set(marks)) < 4:
            raise ValueError("no control string may begin with another")


TEMPLATE = ChatTemplate()


def escaped(text: Column) -> Column:
    """The text with escapes doubled and control leads split, so that it holds no ``<|``."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(2 * ESCAPE))
    return F.replace(doubled, F.lit(LEAD), F.lit(LEAD[0] + ESCAPE + LEAD[1]))


def unescaped(text: Column) -> Column:
    """The text that :func:`escaped` got. Doubled escapes stand in runs of even length, so a
    single one inside a lead is never one of theirs."""
    leads = F.replace(text, F.lit(LEAD[0] + ESCAPE + LEAD[1]), F.lit(LEAD))
    return F.replace(leads, F.lit(2 * ESCAPE), F.lit(ESCAPE))


MESSAGES = "array<struct<role:string,texts:array<string>>>"


def _appended(messages: Column, following: Column) -> Column:
    """Two lists of messages as one; they meet in one message if its role is the same on both sides."""
    last, first = F.element_at(messages, -1), F.get(following, F.lit(0))
    met = F.struct(last["role"].alias("role"), F.concat(last["texts"], first["texts"]).alias("texts"))
    meet = (F.size(messages) > 0) & (F.size(following) > 0) & (F.try_element_at(messages, F.lit(-1))["role"] == first["role"])
    return F.when(
        meet,
        F.concat(F.slice(messages, 1, F.size(messages) - 1), F.array(met), F.slice(following, 2, F.size(following))),
    ).otherwise(F.concat(messages, following))


def _no_messages() -> Column:
    return F.array().cast(MESSAGES)


def _merged(turns: Column) -> Column:
    """Sorted turn structs as messages."""

    def message(turn):
        return F.struct(escaped(turn["role"]).alias("role"), F.array(escaped(turn["text"])).alias("texts"))

    return F.aggregate(turns, _no_messages(), lambda done, turn: _appended(done, F.array(message(turn))))


def _collected() -> Column:
    return F.sort_array(F.collect_list(F.struct("turn", "role", "text")))


def _hot_conversations(rows: DataFrame, hot_turns: int) -> DataFrame | None:
    """Ids of the conversations that are long against ``hot_turns`` and the table, at most ``MOST_HOT``."""
    least = max(hot_turns, rows.count() // MOST_HOT)
    sizes = rows.groupBy("conv").agg(F.count("*").alias("size")).filter(F.col("size") > least)
    hot = sizes.select("conv").collect()
    return rows.sparkSession.createDataFrame(hot, rows.select("conv").schema) if hot else None


def conversation_messages(
    rows: DataFrame, hot_turns: int = HOT_TURNS, block_turns: int = BLOCK_TURNS
) -> DataFrame:
    """(``conv``, ``messages``) from rows of ``conv``, ``turn``, ``role``, ``text``.

    The turns of a conversation of up to ``hot_turns`` rows are collected at once. Longer
    ones are collected, sorted and merged in blocks of ``block_turns`` turn numbers first, in
    as many tasks as there are blocks, and then the messages of the blocks are put together.
    """
    hot = _hot_conversations(rows, hot_turns)
    if hot is None:
        return rows.groupBy("conv").agg(_collected().alias("turns")).select("conv", _merged(F.col("turns")).alias("messages"))
    same = rows["conv"].eqNullSafe(hot["conv"])
    long = rows.join(F.broadcast(hot), same, "left_semi")
    short = conversation_messages(rows.join(F.broadcast(hot), same, "left_anti"), 2**62)
    block = F.floor(F.col("turn") / block_turns).alias("block")
    blocks = long.groupBy("conv", block).agg(_collected().alias("turns"))
    blocks = blocks.select("conv", F.struct("block", _merged(F.col("turns")).alias("messages")).alias("block"))
    whole = blocks.groupBy("conv").agg(F.array_sort(F.collect_list("block"), _by_block).alias("blocks"))
    put_together = F.aggregate("blocks", _no_messages(), lambda done, block: _appended(done, block["messages"]))
    return short.union(whole.select("conv", put_together.alias("messages")))


def _by_block(a: Column, b: Column) -> Column:
    """NULL turns come first, as where turns are sorted."""
    x, y = F.coalesce(a["block"], F.lit(-(2**63))), F.coalesce(b["block"], F.lit(-(2**63)))
    return F.when(x < y, -1).when(x > y, 1).otherwise(0)


def formatted_messages(messages: DataFrame, template: ChatTemplate = TEMPLATE) -> DataFrame:
    """Add ``formatted``, ``message_starts`` and ``loss_spans`` to rows of ``conv`` and ``messages``.

    A loss span names its message, from 0, and the code points ``start`` to ``end``, exclusive, of
    the formatted text; starts of messages are given alike. There is a span for each text of
    a loss role, an empty text included.
    """
    piece = "array<struct<text:string,loss:boolean>>"

    def plain(*text):
        return F.struct(F.concat(*text).alias("text"), F.lit(False).alias("loss"))

    def pieces(message):
        loss = message["role"].isin([*template.loss_roles]) if template.loss_roles else F.lit(False)
        texts = F.transform(
            message["texts"],
            lambda text, i: F.array(
                plain(F.when(i > 0, template.more).otherwise("")), F.struct(text.alias("text"), loss.alias("loss"))
            ),
        )
        head = F.array(plain(F.lit(template.begin), message["role"], F.lit(template.says)))
        return F.concat(head, F.flatten(texts), F.array(plain(F.lit(template.end)))).cast(piece)

    rows = messages.select("conv", F.transform("messages", pieces).alias("pieces"))
    rows = rows.select(
        "*", F.transform("pieces", lambda m: F.array_join(F.transform(m, lambda x: x["text"]), "")).alias("parts")
    )
    zero = F.lit(0).cast("bigint")
    starts = F.aggregate(
        "parts",
        F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts")),
        lambda done, part: F.struct(
            (done["at"] + F.length(part)).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts")
        ),
        lambda done: done["starts"],
    )
    rows = rows.select("*", starts.alias("message_starts"))
    none = F.array().cast("array<struct<message:int,start:bigint,end:bigint>>")

    def spans(message, number):
        def step(done, x):
            after = done["at"] + F.length(x["text"])
            span = F.struct(number.alias("message"), done["at"].alias("start"), after.alias("end"))
            found = F.when(x["loss"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
            return F.struct(after.alias("at"), found.alias("spans"))

        start = F.struct(F.get("message_starts", number).alias("at"), none.alias("spans"))
        return F.aggregate(message, start, step, lambda done: done["spans"])

    return rows.select(
        "conv",
        F.array_join("parts", "").alias("formatted"),
        "message_starts",
        F.flatten(F.transform("pieces", spans)).alias("loss_spans"),
    )


def format_conversations(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: ChatTemplate = TEMPLATE,
    hot_turns: int = HOT_TURNS,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """One row for each conversation: its id, ``formatted``, ``message_starts`` and ``loss_spans``.

    Turns come by turn number, NULL first; equal numbers by role and text, and repeated
    rows as often as they occur. A NULL role or text counts as empty, rows with a NULL
    conversation make one. An empty table gives an empty result; other columns are
    ignored. A conversation has to fit into one row.
    """
    rows = turns.select(
        F.col(quoted(conv)).alias("conv"),
        F.col(quoted(turn)).alias("turn"),
        F.coalesce(F.col(quoted(role)).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("text"),
    )
    messages = conversation_messages(rows, hot_turns, block_turns)
    return formatted_messages(messages, template).withColumnRenamed("conv", conv)


def parsed_turns(formatted: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The turns (``role``, ``text``) that a formatted text holds, unescaped."""

    def turns(message):
        role = F.substring_index(message, template.says, 1)
        said = F.substr(message, F.length(role) + len(template.says) + 1)
        role = F.substr(role, F.lit(len(template.begin) + 1))
        return F.transform(
            F.split(said, re.escape(template.more), -1),
            lambda text: F.struct(unescaped(role).alias("role"), unescaped(text).alias("text")),
        )

    return F.flatten(F.transform(formatted_parts(formatted, template), turns))


def formatted_parts(formatted: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The formatted messages, without their ends."""
    parts = F.split(formatted, re.escape(template.end), -1)
    return F.slice(parts, 1, F.size(parts) - 1)


def loss_texts(formatted: Column, starts: Column, spans: Column, template: ChatTemplate = TEMPLATE) -> Column:
    """The texts under the loss mask, unescaped. Each is cut from its own message, as positions
    in a long text have to be counted from its beginning."""

    def cut(parts):
        def text(span):
            begin = span["start"] - F.get(starts, span["message"])
            return unescaped(F.substr(F.get(parts, span["message"]), begin.cast("int") + 1, (span["end"] - span["start"]).cast("int")))

        return F.transform(spans, text)

    return cut(formatted_parts(formatted, template))


def chat_digest(formatted: DataFrame, conv: str = "conv_id", template: ChatTemplate = TEMPLATE) -> DataFrame:
    """Sizes and digests of what the formatted conversations hold, read back from them."""
    rows = formatted.select(
        F.col(quoted(conv)).alias("conv"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        parsed_turns(F.col("formatted"), template).alias("turns"),
        F.array_join(loss_texts(F.col("formatted"), F.col("message_starts"), F.col("loss_spans"), template), "").alias("loss"),
    )
    line = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return rows.select(
        F.col("conv").alias(conv),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


PROBE_TEXT = r"\### Assistant: </turn> ok"


def with_probe(turns: DataFrame) -> DataFrame:
    """The conversations and one more, -7, whose texts look like another template's controls."""
    probe = turns.sparkSession.createDataFrame(
        [(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)], "conv_id bigint, turn bigint, role string, text string"
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)


def oracle_sql(template: ChatTemplate = TEMPLATE) -> str:
    """The rows of the query in DuckDB's SQL."""
    roles = ", ".join(f"'{x}'" for x in template.loss_roles)
    escape = f"replace(replace({{}}, '{ESCAPE}', '{2 * ESCAPE}'), '{LEAD}', '{LEAD[0]}{ESCAPE}{LEAD[1]}')"
    around = len(template.begin) + len(template.says) + len(template.end)
    return rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '{PROBE_TEXT}'
            UNION ALL SELECT -7, 1, 'assistant', '{PROBE_TEXT}'),
        numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM turns),
        placed AS (
            SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered),
        sized AS (
            SELECT *, role || chr(10) || text || chr(10) AS line,
                   CASE WHEN role IN ({roles}) THEN text ELSE '' END AS loss,
                   length({escape.format("text")})
                   + CASE WHEN before = role THEN {len(template.more)}
                          ELSE {around} + length({escape.format("role")}) END AS chars
            FROM placed)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(line, '' ORDER BY i)) AS turns_sha256,
               cast(sum(length(loss)) AS bigint) AS loss_chars,
               sha256(string_agg(loss, '' ORDER BY i)) AS loss_sha256,
               cast(sum(chars) AS bigint) AS formatted_chars
        FROM sized GROUP BY conv_id"""
