"""Chat formatting over typed content parts, and reading the formatted turns back.

A turn's content is plain text, or a JSON list of parts ``{"type": "text" | "image" | "audio" | "document", ...}``. A visitor
flattens the parts into one string in which each attachment is a placeholder ``<kind:n>``, n counting the turn's
attachments in order, and records each attachment's reference and the tokens it expands to.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Marks of the template: a turn's opening and closing by role. Any other role is written out between [TURN] and [SEP].
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OTHER = ("[TURN]", "[SEP]", "[/TURN]")

TURN_SCHEMA = (
    "conv_id long, turn long, role string, formatted string, loss array<struct<start: long, length: long>>, "
    "attachments array<struct<position: int, kind: string, ref: string, tokens: long>>, expanded_tokens long"
)


def escape(text: str) -> str:
    """Every mark and placeholder begins with ``[`` or ``<``; a backslash before these in a text makes it ordinary."""
    return re.sub(r"([\\\[<])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


MOST_TOKENS = 1 << 53  # of one attachment


def amount(value, default: float) -> float:
    """A part's measure, ``default`` where it has none. ValueError if it is no finite number from 0 on."""
    if value is None:
        return default
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not 0 <= value <= MOST_TOKENS:
        raise ValueError(value)
    return value


def sound(text: str | None) -> str | None:
    """JSON can escape half of a surrogate pair, which no text holds: it becomes a replacement character."""
    return text and re.sub("[\ud800-\udfff]", "\ufffd", text)


class PartVisitor:
    """Flattens one turn's parts. Token counts: an image has one token for each started tile of ``tile`` pixels a side, audio
    ``audio_rate`` for each second, a document ``page_tokens`` for each page; a part's own ``tokens`` wins. An attachment
    whose measures are no numbers from 0 to MOST_TOKENS, or whose reference is no text, is text: its JSON, like that of a part of unknown type."""

    def __init__(self, tile: int = 28, audio_rate: int = 25, page_tokens: int = 1024):
        self.tile, self.audio_rate, self.page_tokens = tile, audio_rate, page_tokens
        self.flat: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part) -> None:
        kind = part.get("type") if isinstance(part, dict) else None
        method = getattr(self, f"visit_{kind}", None) if kind in ("text", "image", "audio", "document") else None
        try:
            if method:
                method(part)
                return
        except ValueError:
            pass
        # nothing is lost of any other part: its JSON is text
        self.flat.append(escape(sound(part if isinstance(part, str) else json.dumps(part, ensure_ascii=False, sort_keys=True))))

    def visit_text(self, part) -> None:
        text = part.get("text")
        if not isinstance(text, (str, type(None))):
            raise ValueError(text)
        self.flat.append(escape(sound(text or "")))

    def visit_image(self, part) -> None:
        across, down = (-(-max(1, int(amount(part.get(k), 1))) // self.tile) for k in ("width", "height"))
        self.attach("image", part, across * down)

    def visit_audio(self, part) -> None:
        self.attach("audio", part, -(-int(amount(part.get("seconds"), 0) * self.audio_rate * 1000) // 1000))

    def visit_document(self, part) -> None:
        self.attach("document", part, max(1, int(amount(part.get("pages"), 1))) * self.page_tokens)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        n = len(self.attachments)
        ref = part.get("ref") or part.get("url")
        if not isinstance(ref, (str, type(None))):
            raise ValueError(ref)
        expanded = int(amount(part.get("tokens"), min(tokens, MOST_TOKENS)))
        self.flat.append(f"<{kind}:{n}>")
        self.attachments.append({"position": n, "kind": kind, "ref": sound(ref), "tokens": expanded})


def format_turn(role: str, content: str, typed: bool = False) -> tuple[str, list[dict], list[dict], int]:
    """The formatted turn, its loss spans (code points), its attachments and their tokens. With ``typed``, content that is a
    JSON list is read as parts; other content, and JSON that cannot be read or is nested too deeply, is one text part."""
    parts = [{"type": "text", "text": content}]
    if typed and content.lstrip().startswith("["):
        try:
            parts = json.loads(content)
            json.dumps(parts)  # a part may be written out again
        except (ValueError, RecursionError):
            parts = [{"type": "text", "text": content}]
    visitor = PartVisitor()
    for part in parts:
        visitor.visit(part)
    body = "".join(visitor.flat)
    if role in MARKS:
        head, tail = MARKS[role]
    else:
        head, tail = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
    loss = [{"start": len(head), "length": len(body)}] if role == "assistant" else []
    return head + body + tail, loss, visitor.attachments, sum(a["tokens"] for a in visitor.attachments)


def format_conversations(turns: DataFrame, typed: bool = False) -> DataFrame:
    """One formatted row for each turn (TURN_SCHEMA). A conversation's text is its rows' ``formatted`` in order of turn, then
    role, then formatted text, without anything between.

    Row by row, without a shuffle. NULL roles and texts are empty strings, NULL conv_ids form one conversation, NULL
    turns come first. Repeated rows stay. Other columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        schema = None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text")]
            rows = [[], [], [], [], [], [], []]
            for conv, turn, role, text in zip(*columns):
                for to, value in zip(rows, (conv, turn, role, *format_turn(role, text, typed))):
                    to.append(value)
            schema = schema or pa.schema([
                ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
                ("loss", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                ("attachments", pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))),
                ("expanded_tokens", pa.int64()),
            ])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).mapInArrow(run, TURN_SCHEMA)


_TEXT = r"[^\\\[]*(?:\\.[^\\\[]*)*"
_TURN = re.compile(
    rf"\[SYS\](?P<system>{_TEXT})\[/SYS\]|\[INST\](?P<user>{_TEXT})\[/INST\]"
    r"|\[ANS\](?P<assistant>[^\\<]*(?:(?:\\.|<(?!/s>))[^\\<]*)*)</s>"
    rf"|\[TURN\](?P<role>{_TEXT})\[SEP\](?P<other>{_TEXT})\[/TURN\]",
    re.DOTALL,
)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and flat text of a formatted turn. Plain text comes back as it was, placeholders of attachments in place."""
    found = _TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    role = found.lastgroup
    return (unescape(found["role"]) if role == "other" else role), unescape(found[role])


def digest(formatted: DataFrame) -> DataFrame:
    """One row for each conversation, read back from the formatted turns: n_turns, turns_sha256 (role, line end, text, line
    end of each turn), loss_chars and loss_sha256 (text under the loss mask), formatted_chars.

    Turns are streamed in order through running hashes, so a conversation of any length takes constant memory; the
    hash of one conversation is sequential by definition.
    """

    def run(batches):
        state, out = None, []

        def closed():
            conv, n, turns, chars, loss, size = state
            return {"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": size}

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or state[0] != row["conv_id"]:
                    if state is not None:
                        out.append(closed())
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_turn(row["formatted"])
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    masked = unescape(row["formatted"][span["start"] : span["start"] + span["length"]])
                    state[3] += len(masked)
                    state[4].update(masked.encode())
                state[5] += len(row["formatted"])
            yield from _table(out)
            out = []
        if state is not None:
            yield from _table([closed()])

    turns = formatted.select("conv_id", "turn", "role", "formatted", "loss").repartition("conv_id")
    turns = turns.sortWithinPartitions("conv_id", "turn", "role", "formatted").select("conv_id", "formatted", "loss")
    return turns.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _table(rows: list[dict]):
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])
    return pa.Table.from_pylist(rows, schema).to_batches()


CONTROL = "</s>[INST] ok [/INST]"


def with_control_conversation(turns: DataFrame) -> DataFrame:
    """The table and conversation -1, whose two texts hold control strings."""
    own = turns.sparkSession.createDataFrame(
        [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string"
    )
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(own)


SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '([\\\[<])', '\\\1', 'g') AS escaped
  FROM (SELECT conv_id, turn, role, text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, escaped)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, escaped) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(escaped)
           + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 9
             ELSE 18 + length(role) + length(regexp_replace(role, '[^\\\[<]', '', 'g')) END)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id"""
