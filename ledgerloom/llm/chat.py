"""Chat formatting with typed content parts.

A turn's content is a list of parts: text, image, audio or document.  A visitor
flattens them in order into one string, in which attachments are numbered
placeholders; it records each attachment's reference, its place and the tokens its
placeholder expands to.  A turn is written

    <|turn|>ROLE<|says|>CONTENT<|end|>\\n

and a conversation is its turns in order.  Control strings of this template, and
those of other templates ([INST], <s> and their closing forms), are broken up in roles and
texts by a backslash after their first character; so is a beginning of one at the end of a
text, which the next part could complete; backslashes are doubled.  ``unescape`` undoes both.
So no list of parts, whatever its texts, yields a control string or a placeholder that
the formatter didn't write itself; ``parse_parts`` tells texts and placeholders apart again.

The output has a row for each turn (a segment), not for each conversation, so a conversation
with a third of all turns is written by many tasks.  Assistant text is under the
loss mask: the range loss_start..loss_end of a segment.

Defined cases: null role or text is empty; turns are ordered by turn (null first), role
and text, repeated rows included; a null conv_id is a conversation of its own; an
empty table gives no rows; very long texts are escaped whole, a task holds a batch of
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SAYS, CLOSE = "<|turn|>", "<|says|>", "<|end|>\n"
#: What a backslash follows: the first character of a control string, or of the beginning of one that ends the text.
CONTROL = re.compile(r"<(?=\||/?s>|/?s?\Z)|\[(?=/?INST\]|/?(?:I(?:N(?:ST?)?)?)?\Z)")
#: The same places in the syntax of SQL's regular expressions, which look at nothing ahead: how many there are.
CONTROL_SQL = r"<\||</?s>|</?s?$|\[/?INST\]|\[/?(?:I(?:N(?:ST?)?)?)?$"
TURN = re.compile(r"<\|turn\|>(.*?)<\|says\|>(.*?)<\|end\|>\n", re.S)
PLACEHOLDER = re.compile(r"<\|(image|audio|document):(\d+)\|>")
PARTS = "array<struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
SEGMENTS = "conv_id long, turn long, role string, segment string, loss_start int, loss_end int, attachments array<struct<kind:string,uri:string,place:int,tokens:long>>, attachment_tokens long"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@dataclass
class Flattener:
    """Visitor of parts. Token counts: a token for each patch of an image, for each slice of audio, a fixed number for each page."""

    patch: int = 28
    audio_rate: float = 25.0
    page_tokens: int = 1024
    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    size: int = 0

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown part type {kind!r}")
        method(part)

    def put(self, text: str) -> None:
        self.out.append(text)
        self.size += len(text)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.attachments.append({"kind": kind, "uri": part.get("uri"), "place": self.size, "tokens": tokens})
        self.put(f"<|{kind}:{len(self.attachments) - 1}|>")

    def visit_text(self, part: dict) -> None:
        self.put(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self.attach("image", part, math.ceil((part.get("width") or 0) / self.patch) * math.ceil((part.get("height") or 0) / self.patch))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil((part.get("seconds") or 0) * self.audio_rate))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, (part.get("pages") or 0) * self.page_tokens)


def text_parts(text: str = "text") -> Column:
    """A turn's text as its only part."""
    names = {"type": F.lit("text"), "text": F.col(text)}
    rest = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(*[c.alias(n) for n, c in names.items()], *[F.lit(None).cast(t).alias(n) for n, t in rest.items()]))


def format_turns(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """From (conv_id, turn, role, parts) one segment for each row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for conv, turn, role, parts in zip(frame["conv_id"], frame["turn"], frame["role"], frame["parts"]):
                seen = Flattener()
                for part in parts if parts is not None else []:
                    if part is not None:
                        seen.visit(part)
                head = OPEN + escape(role) + SAYS
                loss = (len(head), len(head) + seen.size) if role == loss_role else (0, 0)
                rows.append((conv, turn, role, head + "".join(seen.out) + CLOSE, *loss, seen.attachments, sum(a["tokens"] for a in seen.attachments)))
            out = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "segment", "loss_start", "loss_end", "attachments", "attachment_tokens"])
            yield out.astype({"conv_id": "Int64", "turn": "Int64"})

    long = lambda c: F.col(c).cast("long").alias(c)
    return turns.select(long("conv_id"), long("turn"), F.coalesce("role", F.lit("")).alias("role"), "parts").mapInPandas(run, SEGMENTS)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation or segment; placeholders stay in the text."""
    return [(unescape(r), unescape(t)) for r, t in TURN.findall(formatted)]


def parse_parts(formatted: str) -> list[tuple[str, list[tuple[str, str | int]]]]:
    """(role, [(kind, text or number of the attachment)]) of each turn; texts side by side are one, empty ones left out."""
    out = []
    for role, content in TURN.findall(formatted):
        bits = PLACEHOLDER.split(content)
        parts: list[tuple[str, str | int]] = []
        for i in range(0, len(bits), 3):
            parts += [("text", unescape(bits[i]))] if bits[i] else []
            parts += [(bits[i + 1], int(bits[i + 2]))] if i + 2 < len(bits) else []
        out.append((unescape(role), parts))
    return out


def digests(segments: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its segments in order.

    Segments stream through sorted partitions and hashes take them up one by one, so a
    task holds a batch, whatever a conversation's length.
    """
    result = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = object(), None
        done: list[tuple] = []

        def close() -> None:
            if state is not None:
                conv, n, turns, chars, loss, total = state
                done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        for frame in frames:
            for conv, segment, start, end in zip(frame["conv_id"].astype("Int64"), frame["segment"], frame["loss_start"], frame["loss_end"]):
                conv = None if conv is pd.NA else int(conv)
                if conv != now or state is None:
                    close()
                    now, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(segment):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                learnt = unescape(segment[start:end])
                state[3] += len(learnt)
                state[4].update(learnt.encode("utf-8", "surrogatepass"))
                state[5] += len(segment)
            if done:
                yield pd.DataFrame(done, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({"conv_id": "Int64"})
                done = []
        close()
        if done:
            yield pd.DataFrame(done, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({"conv_id": "Int64"})

    return segments.select("conv_id", "turn", "role", "segment", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment").mapInPandas(run, result)
