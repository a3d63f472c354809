"""Chat formatting with typed content parts.

A turn is written as `<|role|>body</|>`. In texts and roles a backslash goes before each
backslash, `<`, `[` and (in roles) `|`, so no text can hold a marker, of this template or of
others that begin with these; the escape is undone by dropping it. A visitor turns content
parts into the body: text as it is, image, audio and document as ordered placeholders
`<@type:index:tokens>`, with the reference and the expanded token count on record.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyscope.llm.common import table

PART = "struct<type: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENT = "struct<index: int, type: string, ref: string, tokens: long>"
SEGMENT = f"segment string, loss_start long, loss_end long, attachments array<{ATTACHMENT}>, text_tokens long, attachment_tokens long"

SEGMENT_COLUMNS = ["segment", "loss_start", "loss_end", "attachments", "text_tokens", "attachment_tokens"]

ESCAPED = re.compile(r"\\(.)", re.DOTALL)
MARKS = re.compile(r"[\\<\[]")
ROLE_MARKS = re.compile(r"[\\<\[|]")
TURN = re.compile(r"<\|([^\\|]*(?:\\.[^\\|]*)*)\|>([^\\<]*(?:(?:\\.|<@[^>]*>)[^\\<]*)*)</\|>", re.DOTALL)
ESCAPED_OR_PLACEHOLDER = re.compile(r"\\(.)|<@\w+:\d+:\d+>", re.DOTALL)
WORDS = re.compile(r"\w+|[^\w\s]")


def escape(text: str) -> str:
    return MARKS.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def plain(body: str) -> str:
    """The text of a body: unescaped, and without placeholders, which no escape goes before."""
    return ESCAPED_OR_PLACEHOLDER.sub(r"\1", body)


@dataclass
class PartVisitor:
    """Flattens the parts of one turn, in order. Sizes that are missing count as one unit."""

    pixels_per_tile: int = 28
    tokens_per_second: float = 25.0
    tokens_per_page: int = 560
    body: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    text_tokens: int = 0

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('type')}", self.visit_text)(part)

    def visit_text(self, part: dict) -> None:
        """Also what a part of unknown or null type does: its text stays, nothing else of it."""
        text = part.get("text") or ""
        self.body.append(escape(text))
        self.text_tokens += len(WORDS.findall(text))

    def visit_image(self, part: dict) -> None:
        across, down = (math.ceil(measured(part, k) / self.pixels_per_tile) for k in ("width", "height"))
        self._attach("image", part, across * down)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil(measured(part, "seconds") * self.tokens_per_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, math.ceil(measured(part, "pages") * self.tokens_per_page))

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        index = len(self.attachments)
        self.attachments.append({"index": index, "type": kind, "ref": part.get("ref"), "tokens": tokens})
        self.body.append(f"<@{kind}:{index}:{tokens}>")


def measured(part: dict, name: str) -> float:
    """A size of a part; one that is missing, not finite or not above 0 counts as 1."""
    size = part.get(name)
    return size if size is not None and math.isfinite(size) and size > 0 else 1


def format_turn(role: str | None, parts: list[dict] | None) -> dict:
    """The written turn; the loss span, in code points of it, covers the body of an assistant's turn."""
    visitor = PartVisitor()
    for part in parts if parts is not None else ():
        if part is not None:
            visitor.visit(part)
    body = "".join(visitor.body)
    head = f"<|{ROLE_MARKS.sub(r'\\\g<0>', role or '')}|>"
    learn = role == "assistant"
    return {
        "segment": f"{head}{body}</|>",
        "loss_start": len(head) if learn else 0,
        "loss_end": len(head) + len(body) if learn else 0,
        "attachments": visitor.attachments,
        "text_tokens": visitor.text_tokens,
        "attachment_tokens": sum(a["tokens"] for a in visitor.attachments),
    }


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each written turn, unescaped; placeholders are left out of the text."""
    at = 0
    while at < len(formatted):
        found = TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        yield unescape(found[1]), plain(found[2])
        at = found.end()


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn (conv_id, turn, role, parts) with the turn as written, its loss span
    within it and its attachments. The turns of a conversation, joined in order, are its
    formatted text; a turn is formatted by itself, so that no conversation, however long,
    has to fit into one task. Null parts are an empty body, a null role an empty one;
    repeated rows are formatted each; further columns are dropped; no rows give no rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            roles = [r if isinstance(r, str) else None for r in f.role]
            done = [format_turn(r, p) for r, p in zip(roles, f.parts, strict=True)]
            yield pd.concat([f[["conv_id", "turn"]].reset_index(drop=True), pd.DataFrame(done, columns=SEGMENT_COLUMNS)], axis=1)

    return turns.select("conv_id", "turn", "role", "parts").mapInPandas(run, f"conv_id long, turn long, {SEGMENT}")


@dataclass
class Digest:
    """What is read back of one conversation so far; a few hundred bytes whatever its length."""

    turns: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)
    n: int = 0
    loss_chars: int = 0
    chars: int = 0

    def add(self, segment: str, start: int, end: int) -> None:
        for role, text in parse_turns(segment):
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            self.n += 1
        learnt = plain(segment[start:end])
        self.loss.update(learnt.encode("utf-8", "surrogatepass"))
        self.loss_chars += len(learnt)
        self.chars += len(segment)

    def row(self, conv_id: int | None) -> tuple:
        return (conv_id, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, from the written turns alone, in the order of turn (nulls first).

    Turns stream through in sorted order and a running digest is kept, so the longest
    conversation costs one task time, not memory. Rows of equal turn go by their text.
    """

    names = [c.split()[0] for c in DIGEST.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, digest = None, None
        for f in frames:
            done = []
            ids = [None if pd.isna(c) else int(c) for c in f.conv_id]
            for conv, segment, start, end in zip(ids, f.segment, f.loss_start, f.loss_end, strict=True):
                if digest is None or conv != current:
                    if digest is not None:
                        done.append(digest.row(current))
                    current, digest = conv, Digest()
                digest.add(segment, start, end)
            yield pd.DataFrame(done, columns=names)
        if digest is not None:
            yield pd.DataFrame([digest.row(current)], columns=names)

    ordered = segments.select("conv_id", "turn", "segment", "loss_start", "loss_end").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "segment").mapInPandas(run, DIGEST)


PROBE = "</s>[INST] ok [/INST]"


def text_turns(conversations: DataFrame) -> DataFrame:
    """Rows of plain text as turns of one text part each."""
    part = F.expr(f"CAST(array(named_struct('type', 'text', 'text', coalesce(text, ''), 'ref', NULL, 'width', NULL, 'height', NULL, 'seconds', NULL, 'pages', NULL)) AS array<{PART}>)")
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", part.alias("parts"))


def op5_typed_parts_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(text_turns(rows.unionByName(probe))))


_ROWS = f"""
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
"""
OP5_SQL = rf"""
WITH t AS ({_ROWS}), e AS (
  SELECT *, '<|' || regexp_replace(role, '([\\<\[|])', '\\\1', 'g') || '|>'
    || regexp_replace(text, '([\\<\[])', '\\\1', 'g') || '</|>' AS segment FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, segment)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, segment), '')) AS loss_sha256,
  CAST(sum(length(segment)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
