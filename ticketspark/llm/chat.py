"""Chat logs to training text: events are folded into messages, messages into one text per conversation.

An event has conv_id, seq, message (the id of the message it belongs to, ordered as the messages
are), kind, role and text. Kinds: ``message`` starts a message, ``delta`` appends streamed text,
``edit`` replaces the text, ``regenerate`` throws the text away so that later deltas write it anew,
``delete`` removes the message until a later event of another kind. Null text appends nothing, a null
kind counts as ``message``, a null role keeps the last role known (none: empty).

In the output every message stands as ``<|turn|>role``, a line feed, the text, ``<|end|>`` and a line
feed. Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold
a mark and unescaping gives back what went in.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table

OPEN, CLOSE = "<|turn|>", "<|end|>"
_MARKED = re.compile(r"\\|(?<=<)\|")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<\|turn\|>([^\n]*)\n(.*?)<\|end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    return _MARKED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def fold_messages(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text: one row for each message that is left.

    Grouped by message, so a long conversation is folded by many tasks. Events with the same seq are
    taken by kind, role and text. Other columns of ``events`` are not read.
    """
    event = F.struct("seq", F.coalesce("kind", F.lit("message")).alias("kind"), "role", F.coalesce("text", F.lit("")).alias("text"))
    grouped = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    # what stands before the last event that starts a text anew no longer counts, so the log is read once
    anew = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] != "delta", i + 1).otherwise(F.lit(1))))
    tail = F.slice("log", anew, F.size("log"))
    said = F.transform(tail, lambda e: F.when(e["kind"].isin("regenerate", "delete"), F.lit("")).otherwise(e["text"]))
    role = F.try_element_at(F.filter(F.col("log.role"), lambda r: r.isNotNull()), F.lit(-1))
    kept = grouped.where(F.try_element_at("log", F.lit(-1))["kind"] != "delete")
    return kept.select("conv_id", "message", F.coalesce(role, F.lit("")).alias("role"), F.array_join(said, "").alias("text"))


def render_turns(turns: Iterable[tuple[str, str]], loss_roles: Iterable[str] = ("assistant",)) -> tuple[str, list[int]]:
    """The text of a conversation and its loss mask: start and end code point of each span, flat."""
    out, spans, at, learned = [], [], 0, set(loss_roles)
    for role, text in turns:
        head = OPEN + escape(role).replace("\n", "\\n") + "\n"
        body = escape(text)
        if role in learned:
            spans += [at + len(head), at + len(head) + len(body)]
        out += [head, body, CLOSE + "\n"]
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(out), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs that a formatted text holds."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def format_conversations(events: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, loss_spans (array of start and end, flat): one row for each conversation.

    A conversation without a message left has no row. Its text is one value, so its messages meet in
    one task; everything before that works by message. Null conv_ids form one conversation.
    """
    messages = fold_messages(events)
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("message", "role", "text"))).alias("turns"))

    def rendered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [render_turns(((t["role"], t["text"]) for t in row), loss_roles) for row in pdf["turns"]]
            yield pd.DataFrame(
                {"conv_id": pdf["conv_id"], "formatted": [d[0] for d in done], "loss_spans": [d[1] for d in done]}
            )

    kind = events.schema["conv_id"].dataType.simpleString()
    return turns.mapInPandas(rendered, f"conv_id {kind}, formatted string, loss_spans array<long>")


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Digests of turns and learned text, read back from the formatted text and its mask."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for conv, text, spans in zip(pdf["conv_id"], pdf["formatted"], pdf["loss_spans"], strict=True):
                turns = parse_turns(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                learned = "".join(unescape(text[a:b]) for a, b in zip(spans[::2], spans[1::2], strict=True))
                rows.append(
                    (
                        conv,
                        len(turns),
                        hashlib.sha256(said.encode()).hexdigest(),
                        len(learned),
                        hashlib.sha256(learned.encode()).hexdigest(),
                        len(text),
                    )
                )
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInPandas(
        read,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


#: Characters of a streamed piece in the log that stands for the given rows.
PIECE = 200


def event_log(rows: DataFrame) -> DataFrame:
    """Events of ``rows`` (conv_id, message, role, text) as a chat service would log them.

    An assistant's text is drafted, regenerated and streamed in pieces, a user's is sent and edited, any
    other is one message. Before a conversation's first message stands one that was deleted.
    """

    def event(message, seq, kind, role, text):
        return F.struct(
            message.cast("long").alias("message"), seq.cast("int").alias("seq"), F.lit(kind).alias("kind"),
            role.cast("string").alias("role"), text.cast("string").alias("text"),
        )

    message, role, text, none = F.col("message"), F.col("role"), F.col("text"), F.lit(None)
    draft = F.concat(F.substring(F.coalesce(text, F.lit("")), 1, 20), F.lit(" ..."))
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
    streamed = F.concat(
        F.array(event(message, F.lit(0), "message", role, draft), event(message, F.lit(1), "regenerate", none, none)),
        F.transform(pieces, lambda piece, i: event(message, i + 2, "delta", none, piece)),
    )
    edited = F.array(event(message, F.lit(0), "message", role, draft), event(message, F.lit(1), "edit", none, text))
    plain = F.array(event(message, F.lit(0), "message", role, text))
    deleted = F.array(event(F.lit(0), F.lit(0), "message", role, draft), event(F.lit(0), F.lit(1), "delete", none, none))
    log = F.when(role == "assistant", streamed).when(role == "user", edited).otherwise(plain)
    return rows.select("conv_id", F.inline(F.when(message == 1, F.concat(deleted, log)).otherwise(log)))


PLANTED = "\\### Assistant: </turn> ok"

_ESC = r"replace(replace({0}, '\', '\\'), '<|', '<\|')"


@query(
    "op6_chat_formatting",
    rf"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(17 + length(replace({_ESC.format("role")}, chr(10), '\n')) + length({_ESC.format("text")})) AS BIGINT) AS formatted_chars
    FROM rows GROUP BY conv_id
    """,
)
def op6(spark, sf_dir):
    """All conversations and one planted one, folded from a log of drafts, pieces, edits and a deleted message.

    Every row is a message; rows of one turn go by role and text.
    """
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)], given.schema)
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    messages = given.unionByName(planted).select("conv_id", F.row_number().over(order).alias("message"), "role", "text")
    return digest_conversations(format_conversations(event_log(messages)))
