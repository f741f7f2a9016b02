"""Chat formatting of turns with typed content parts: one string per conversation, a loss mask, and attachments.

A turn has a role and parts: text, image, audio or document.  A visitor with one method per type walks the parts of a turn in
order; text is escaped and written out, any other part leaves a placeholder with its number in the turn, a record of the
attachment it refers to, and the number of tokens that the placeholder expands to.  The template writes

    <s>role[INST]part part ...[/INST]</s>

per turn.  Its control strings, and the opening of a placeholder, cannot come out of a text: after the first letter of what
looks like one a backslash goes in, and one more if there are backslashes already, so reading takes one out again.  Controls
begin with a letter that none of them has elsewhere, so none can arise where two pieces meet.

The loss mask holds the text parts of assistant turns, as character spans of the formatted string.  Reading back goes by the
string and the mask alone.

1. A range sort by conversation and turn, in parts; a conversation of any size is spread.  Each part writes its conversations
   in pages of at most ``PAGE_TURNS`` turns or about ``PAGE_CHARS`` characters (or one turn); pages in order make up the string.
2. Reading back streams the pages of a conversation through one task, since a digest is sequential; a page is held at a time.

Defined cases: null roles and texts are empty; a null or empty list of parts is a turn without content; a null part, or one of an
unknown type, is left out; null sizes count as the least expansion.  Null turns come first; rows of one turn are ordered by
role and a digest of the content.  A null ``conv_id`` is a conversation.  Equal rows are turns of their own.  An empty table gives an empty
result.  Only ``conv_id, turn, role`` and ``text`` or ``parts`` are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import flat
from .common import prepare

PART_TYPE = "array<struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
PAGE_TURNS, PAGE_CHARS = 256, 1 << 20

TURN, BODY, BODY_END, TURN_END = "<s>", "[INST]", "[/INST]", "</s>"
PLACE = "[PART "
#: A first letter, backslashes, and the rest of a control string; for SQL and Python alike.
LOOKS_LIKE = r"([<\[])(\\*)(/?s>|/?INST\]|PART )"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\]|PART )"
_LOOKS_LIKE, _ESCAPED = re.compile(LOOKS_LIKE), re.compile(ESCAPED)
_CONTROL = re.compile(r"<s>|</s>|\[INST\]|\[/INST\]|\[PART ([a-z]+) (\d+)\]")


def escape(text: str) -> str:
    return _LOOKS_LIKE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


@dataclass(frozen=True)
class Expansion:
    """Tokens that a placeholder stands for."""

    patch: int = 28
    audio_per_second: float = 12.5
    per_page: int = 256

    def image(self, width: int | None, height: int | None) -> int:
        return max(1, -(-(width or 0) // self.patch)) * max(1, -(-(height or 0) // self.patch))

    def audio(self, seconds: float | None) -> int:
        return max(1, math.ceil((seconds or 0.0) * self.audio_per_second)) if seconds is None or math.isfinite(seconds) else 1

    def document(self, pages: int | None) -> int:
        return max(1, pages or 0) * self.per_page


@dataclass
class Page:
    """Some turns of a conversation, as they are written."""

    key: str
    chars: int = 0
    turns: int = 0
    pieces: list[str] = field(default_factory=list)
    loss: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[tuple[int, int, str, str | None, int, int]] = field(default_factory=list)

    def write(self, piece: str) -> None:
        self.pieces.append(piece)
        self.chars += len(piece)


class Visitor:
    """Flattens the parts of turns into a page."""

    def __init__(self, page: Page, expansion: Expansion):
        self.page, self.expansion, self.learned, self.number = page, expansion, False, 0

    def turn(self, role: str | None, parts: list[dict | None] | None) -> None:
        role = role or ""
        self.learned, self.number = role == "assistant", 0
        self.page.write(TURN + escape(role) + BODY)
        for part in parts or []:
            visit = getattr(self, f"visit_{(part or {}).get('kind')}", None)
            if visit:
                visit(part)
        self.page.write(BODY_END + TURN_END)
        self.page.turns += 1

    def visit_text(self, part: dict) -> None:
        begin = self.page.chars
        self.page.write(escape(part["text"] or ""))
        if self.learned and self.page.chars > begin:
            self.page.loss.append((begin, self.page.chars))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part["uri"], self.expansion.image(part["width"], part["height"]))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part["uri"], self.expansion.audio(part["seconds"]))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part["uri"], self.expansion.document(part["pages"]))

    def _attach(self, kind: str, uri: str | None, tokens: int) -> None:
        self.page.attachments.append((self.page.turns, self.number, kind, uri, tokens, self.page.chars))
        self.page.write(f"{PLACE}{kind} {self.number}]")
        self.number += 1


def text_part(text: Column) -> Column:
    """A text as the only part of a turn."""
    missing = {"kind": F.lit("text"), "text": text.cast("string")}
    names = [p.split(":") for p in PART_TYPE.removeprefix("array<struct<").removesuffix(">>").split(",")]
    return F.array(F.struct(*[missing.get(n, F.lit(None).cast(t)).alias(n) for n, t in names]))


_PAGE_TYPE = ("key string, page long, n_turns long, formatted string, loss array<struct<start:int,end:int>>, "
              "attachments array<struct<turn:int,number:int,kind:string,uri:string,tokens:long,at:int>>")
_PAGE = pa.schema([
    ("key", pa.string()), ("page", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ("attachments", pa.list_(pa.struct([("turn", pa.int32()), ("number", pa.int32()), ("kind", pa.string()), ("uri", pa.string()), ("tokens", pa.int64()), ("at", pa.int32())])))])


def formatted(turns: DataFrame, expansion: Expansion = Expansion()) -> DataFrame:
    """Pages ``key, conv_id, page, n_turns, formatted, loss, attachments``; ``page`` orders the pages of a conversation.

    ``turns`` has ``conv_id, turn, role`` and ``parts`` (``PART_TYPE``) or else ``text``.  An attachment's record has its turn
    in the page, its number in the turn (the placeholder has the same), type, reference, tokens, and its place in the string.
    """
    prepare(turns.sparkSession)
    parts = turns["parts"].cast(PART_TYPE) if "parts" in turns.columns else text_part(turns["text"])
    rows = turns.select(
        F.coalesce(turns["conv_id"].cast("string"), F.lit("")).alias("key"), turns["turn"].cast("long").alias("turn"),
        F.coalesce(turns["role"].cast("string"), F.lit("")).alias("role"), parts.alias("parts"))
    rows = rows.withColumn("mark", F.md5(F.to_json(F.struct("parts")).cast("binary")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        done, size = [], 0
        for key, group in groupby(stream, lambda row: row[0]):
            visitor = Visitor(Page(key), expansion)
            for _, role, content in group:
                if visitor.page.turns >= PAGE_TURNS or visitor.page.chars >= PAGE_CHARS:
                    done.append(_row(visitor.page, number + len(done)))
                    size += visitor.page.chars
                    visitor = Visitor(Page(key), expansion)
                    if size > PAGE_CHARS:
                        yield _batch(done)
                        number, done, size = number + len(done), [], 0
                visitor.turn(role, content)
            done.append(_row(visitor.page, number + len(done)))
            size += visitor.page.chars
            if size > PAGE_CHARS:
                yield _batch(done)
                number, done, size = number + len(done), [], 0
        if done:
            yield _batch(done)

    order = ["key", "turn", "role", "mark"]
    pages = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "role", "parts").mapInArrow(flat.tidy(run), _PAGE_TYPE)
    return pages.withColumn("conv_id", F.when(F.col("key") != "", F.col("key")).cast("long"))


def _row(page: Page, number: int) -> tuple:
    return page.key, number, page.turns, "".join(page.pieces), page.loss, page.attachments


def _batch(done: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*done)]
    for k in (4, 5):
        names = [f.name for f in _PAGE.field(k).type.value_type]
        columns[k] = [[dict(zip(names, x)) for x in row] for row in columns[k]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PAGE.types)], schema=_PAGE)


# --- reading back --------------------------------------------------------------

def parse(text: str) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """The turns of a formatted string: role, and parts as (text, its content) or (type, number)."""
    role, begin, parts = "", 0, []
    for found in _CONTROL.finditer(text):
        piece, control = text[begin:found.start()], found.group()
        begin = found.end()
        if control == TURN:
            parts = []
        elif control == BODY:
            role = unescape(piece)
        elif control == TURN_END:
            yield role, parts
        else:
            if piece:
                parts.append(("text", unescape(piece)))
            if control != BODY_END:
                parts.append((found.group(1), found.group(2)))


def masked(text: str, loss: list[dict]) -> Iterator[str]:
    """The text under the loss mask, as it was before it was escaped."""
    for span in loss:
        yield unescape(text[span["start"]:span["end"]])


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, attachment_tokens long"


def read_back(pages: DataFrame) -> DataFrame:
    """``READ`` per conversation, from its pages; a turn's text is that of its text parts."""
    names = ["key", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_attachments", "attachment_tokens"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), *[pa.int64()] * 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        found = []
        for key, group in groupby(stream, lambda row: row[0]):
            turns, learned = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = files = tokens = 0
            for _, text, loss, attachments in group:
                for role, parts in parse(text):
                    turns.update(f"{role}\n{''.join(x for kind, x in parts if kind == 'text')}\n".encode())
                    n += 1
                for piece in masked(text, loss):
                    learned.update(piece.encode())
                    loss_chars += len(piece)
                chars, files, tokens = chars + len(text), files + len(attachments), tokens + sum(a["tokens"] for a in attachments)
            found.append((key, n, turns.hexdigest(), loss_chars, learned.hexdigest(), chars, files, tokens))
            if len(found) == 4096:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), types)], names)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), types)], names)

    ordered = pages.repartition("key").sortWithinPartitions("key", "page").select("key", "formatted", "loss", "attachments")
    out = ordered.mapInArrow(flat.tidy(run), READ.replace("conv_id long", "key string"))
    return out.select(F.when(F.col("key") != "", F.col("key")).cast("long").alias("conv_id"), *names[1:])
