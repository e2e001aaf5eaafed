"""Chat formatting with typed content parts, a loss mask and reversible escapes.

Every turn is formatted by itself, so a conversation of any length is never gathered: `format_turns` is a map over
rows, and `read_back` streams over turns sorted by conversation, keeping only running digests.

A turn is `<|turn|>role<|text|>body<|end|>`. Inside role and body a backslash stands before every backslash and inside
every control string, so that no control string survives in a text and the way back is to drop each backslash and keep
what follows it. A body consists of typed parts (text, image, audio, document; a plain text is one text part); a visitor
flattens them in order: text with its escapes, the others as a placeholder, an attachment reference, and the number of
tokens the placeholder expands to. As a user's own `<|media|>` is escaped, `read_parts` tells both apart on the way back.

A conversation's digests are sequential, so its turns are read by one task, in constant memory.

Defined cases: a null role, text or part is empty; columns of other names, the operator's own included, are left out;
turns are ordered by turn (null first), then role, then the
formatted text, so ties
and repeated rows have one order; rows with a null conv_id form one conversation of their own; unknown kinds of part are
placeholders of no tokens.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import whole_id

#: Control strings that must not survive in a text (fixed values of the template and of common others).
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

TURN, TEXT, END, MEDIA = "<|turn|>", "<|text|>", "<|end|>", "<|media|>"
LEARNT = "assistant"

_ESCAPE = re.compile("|".join([re.escape("\\"), *map(re.escape, CONTROL)]))
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(TEXT) + r"(.*?)" + re.escape(END), re.DOTALL)

PART = T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ref", T.StringType()), T.StructField("width", T.LongType()), T.StructField("height", T.LongType()), T.StructField("seconds", T.DoubleType()), T.StructField("pages", T.LongType())])

FORMATTED = "conv_id bigint, turn bigint, role string, text string, formatted string, loss_start int, loss_end int, attachments array<struct<at:int,kind:string,ref:string,tokens:bigint>>, expanded_tokens bigint"


def escaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text) if "\\" in text else text


class Flatten:
    """Visits the parts of a body in order; collects its text, the attachments and their expanded tokens."""

    def __init__(self, patch: int = 28, audio_rate: float = 25.0, page_tokens: int = 256):
        self.patch, self.audio_rate, self.page_tokens = patch, audio_rate, page_tokens

    def visit(self, parts: list[dict | None]) -> tuple[str, list[dict]]:
        self.out: list[str] = []
        self.length = 0
        self.found: list[dict] = []
        for part in parts:
            if part:
                getattr(self, f"visit_{part.get('kind') or 'text'}", self.visit_other)(part)
        return "".join(self.out), self.found

    def add(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def placeholder(self, part: dict, tokens: int) -> None:
        self.found.append({"at": self.length, "kind": part.get("kind"), "ref": part.get("ref"), "tokens": tokens})
        self.add(MEDIA)

    def visit_text(self, part: dict) -> None:
        self.add(escaped(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self.placeholder(part, math.ceil((part.get("width") or 0) / self.patch) * math.ceil((part.get("height") or 0) / self.patch))

    def visit_audio(self, part: dict) -> None:
        self.placeholder(part, math.ceil((part.get("seconds") or 0) * self.audio_rate))

    def visit_document(self, part: dict) -> None:
        self.placeholder(part, (part.get("pages") or 0) * self.page_tokens)

    def visit_other(self, part: dict) -> None:
        self.placeholder(part, 0)


def format_turns(conversations: DataFrame, parts: str | None = None) -> DataFrame:
    """FORMATTED: each turn with its template, loss span (assistant bodies) and attachments.

    `parts`: name of a column of typed parts (array of PART); where it is null, the text is the only part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flatten = Flatten()
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for role, text, rich in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                body, found = flatten.visit(rich)
                head = TURN + escaped(role or "") + TEXT
                learnt = role == LEARNT
                for column, value in zip(out, (head + body + END, len(head) if learnt else 0, len(head) + len(body) if learnt else 0, [x | {"at": x["at"] + len(head)} for x in found], sum(x["tokens"] for x in found))):
                    column.append(value)
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.list_(pa.struct([("at", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), *(pa.array(x, kind) for x, kind in zip(out, kinds))], names=["conv_id", "turn", "role", "text", "formatted", "loss_start", "loss_end", "attachments", "expanded_tokens"])

    own = F.array(F.struct(*[(F.lit("text") if f.name == "kind" else F.col("text").cast("string") if f.name == "text" else F.lit(None).cast(f.dataType)).alias(f.name) for f in PART.fields]))
    rich = F.coalesce(F.col(parts).cast(T.ArrayType(PART)), own) if parts else own
    return conversations.select(whole_id("conv_id").alias("conv_id"), whole_id("turn").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), rich.alias("parts")).mapInArrow(run, FORMATTED)


_MEDIA = re.compile("(" + re.escape(MEDIA) + ")")


def read_parts(formatted: str, attachments: list[dict]) -> list[list[dict]]:
    """The typed parts of each turn in a formatted text: texts unescaped, and the attachments in the order of their
    placeholders. Neighbouring text parts come back as one, empty ones not at all."""
    media = iter(attachments)
    return [[dict(next(media)) if x == MEDIA else {"kind": "text", "text": unescaped(x)} for x in _MEDIA.split(m[2]) if x] for m in _TURN.finditer(formatted)]


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn in a formatted text, unescaped."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in _TURN.finditer(formatted)]


class _Reading:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss, self.chars = conv_id, 0, 0, 0
        self.all, self.learnt = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int) -> None:
        for role, text in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        learnt = unescaped(formatted[start:end])
        self.loss += len(learnt)
        self.learnt.update(learnt.encode("utf-8", "surrogatepass"))
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.learnt.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read from the formatted text and its loss spans alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], kind) for k, kind in enumerate(kinds)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            done = []
            for conv_id, text, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Reading(conv_id)
                now.add(text, start, end)
            yield out()
        if now is not None:
            done = [now.row()]
            yield out()

    return (
        formatted.select("conv_id", "turn", "role", "formatted", "loss_start", "loss_end")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "formatted")
        .select("conv_id", "formatted", "loss_start", "loss_end")
        .mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    )
