"""Chat formatting with typed content parts.

A turn is plain text or a list of parts, each {"type": "text" | "image" | "audio" | "document", ...}. A visitor
walks the parts in order: text is escaped, every attachment becomes an ordered placeholder such as
``<|image:2|>`` and is recorded with its reference and the tokens that it will expand to. Turns are marked
``<|im_start|>role\\n ... <|im_end|>\\n``; only assistant turns carry loss.

Control strings begin with ``<|``. In texts and roles one backslash more is put between any ``<``, its backslashes
and a following ``|``, so that no text holds a control string and ``unescape`` restores it exactly.

Turns of a conversation are brought together by a shuffle and an external sort; a task reads them as a stream and
holds one conversation at a time, which is what a row of the result holds. Batches are bounded by characters.

Cases: null text is empty; a null role is empty; rows with a null conversation form one of their own; turns go
by number, null first, equal ones by role, text and parts; repeated rows are turns of their own; an empty table gives
an empty one; very long texts are formatted whole; other columns, whatever their names, aren't read. Parts that are a
JSON string are that text, one object is a list of one, null is no part; a string in a list is a text part; parts that
aren't JSON or neither of these are one `unreadable` attachment, parts of an unknown type `unknown` ones, both of no
tokens; sizes that aren't numbers above 0 count as missing (one tile, no seconds, one page).
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.S)
START, END, LOSS_ROLE = "<|im_start|>", "<|im_end|>\n", "assistant"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def _role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def _unrole(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


@dataclass
class PartVisitor:
    """Flattens typed parts. Attachments are numbered in the order of the whole conversation."""

    image_tile: int = 512
    tokens_per_tile: int = 256
    audio_tokens_per_second: float = 25.0
    tokens_per_page: int = 600
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: object) -> str:
        if isinstance(part, str):
            return escape(part)
        kind = part.get("type") if isinstance(part, dict) else None
        handler = getattr(self, f"visit_{kind}", None) if kind in ("text", "image", "audio", "document") else None
        if kind == "unreadable":
            return self._attach("unreadable", {}, 0)
        return handler(part) if handler else self._attach("unknown", part if isinstance(part, dict) else {}, 0)

    def visit_text(self, part: dict) -> str:
        text = part.get("text")
        return escape(text if isinstance(text, str) else "" if text is None else json.dumps(text, ensure_ascii=False))

    def visit_image(self, part: dict) -> str:
        tiles = [math.ceil(_number(part.get(side), self.image_tile) / self.image_tile) for side in ("width", "height")]
        return self._attach("image", part, tiles[0] * tiles[1] * self.tokens_per_tile)

    def visit_audio(self, part: dict) -> str:
        return self._attach("audio", part, math.ceil(_number(part.get("seconds"), 0) * self.audio_tokens_per_second - 1e-9))

    def visit_document(self, part: dict) -> str:
        return self._attach("document", part, math.ceil(_number(part.get("pages"), 1)) * self.tokens_per_page)

    def _attach(self, kind: str, part: dict, tokens: int) -> str:
        index, ref = len(self.attachments), part.get("ref")
        self.attachments.append({"index": index, "kind": kind, "ref": ref if ref is None or isinstance(ref, str) else json.dumps(ref, ensure_ascii=False), "tokens": tokens})
        return f"<|{kind}:{index}|>"


def _number(value: object, default: float) -> float:
    try:
        x = float(value)
    except (TypeError, ValueError):
        return default
    return x if 0 < x < 1e12 else default


def read_parts(listed: str) -> list:
    """The parts of a JSON text."""
    try:
        x = json.loads(listed)
    except ValueError:
        x = 0
    return x if isinstance(x, list) else [] if x is None else [x] if isinstance(x, (str, dict)) else [{"type": "unreadable"}]


def format_turns(turns: list[tuple[str | None, object]], visitor: PartVisitor | None = None) -> tuple[str, list[tuple[int, int]], list[dict]]:
    """turns: (role, text or list of parts). The formatted text, its spans under loss, and the attachments."""
    visitor = visitor or PartVisitor()
    pieces: list[str] = []
    at, spans = 0, []
    for role, content in turns:
        parts = [{"type": "text", "text": content}] if content is None or isinstance(content, str) else content
        head, body = f"{START}{_role(role or '')}\n", "".join(map(visitor.visit, parts))
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        pieces += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(pieces), spans, visitor.attachments


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, unescaped; attachments stay as placeholders."""
    return [(_unrole(role), unescape(body)) for role, body in _TURN.findall(formatted)]


SCHEMA = "conv_id long, formatted string, loss_starts array<long>, loss_ends array<long>, n_turns long, attachments array<struct<index:int,kind:string,ref:string,tokens:long>>, expanded_tokens long"


def format_conversations(turns: DataFrame, *, parts: str | None = None) -> DataFrame:
    """One row for each conv_id of turns (conv_id, turn, role, text), with the formatted text, loss spans in code
    points, attachments and their tokens. parts: column of JSON lists of parts that, where not null, replace text."""
    content = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"), (F.col(parts).cast("string") if parts else F.lit(None).cast("string")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        now, held, chars = object(), [], 0

        def close() -> None:
            if held:
                text, spans, attached = format_turns(held)
                rows.append({"conv_id": now, "formatted": text, "loss_starts": [a for a, _ in spans], "loss_ends": [b for _, b in spans], "n_turns": len(held), "attachments": attached, "expanded_tokens": sum(a["tokens"] for a in attached)})

        for batch in batches:
            for conv, role, text, listed in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "parts")), strict=True):
                if conv != now:
                    close()
                    now, held = conv, []
                held.append((role, read_parts(listed) if listed is not None else text))
                chars += len(listed if listed is not None else text or "")
                if len(rows) >= 500 or rows and chars > 1 << 22:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                    rows.clear()
                    chars = 0
        close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    together = content.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "parts")
    return together.mapInArrow(run, SCHEMA)


ARROW = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64())), ("n_turns", pa.int64()), ("attachments", pa.list_(pa.struct([("index", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))), ("expanded_tokens", pa.int64())])

DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, expanded_tokens long, attachments_sha256 string"
_MARK = re.compile(r"<\|(image|audio|document|unknown|unreadable):(\d+)\|>")


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of turns, loss and attachments, read back from the formatted texts; placeholders in them that
    aren't those of the recorded attachments, in order, raise ValueError. attachments_sha256: kind, reference and
    tokens of each, ended by newlines."""
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    names = [x.split(" ")[0] for x in DIGEST.split(", ")]
    sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches, "formatted"):
            rows = []
            for conv, text, starts, ends, attached in zip(batch.column("conv_id").to_pylist(), texts, *(batch.column(c).to_pylist() for c in ("loss_starts", "loss_ends", "attachments")), strict=True):
                if _MARK.findall(text) != [(a["kind"], str(a["index"])) for a in attached]:
                    raise ValueError(f"placeholders of conversation {conv}")
                turns, loss = read_turns(text), "".join(unescape(text[a:b]) for a, b in zip(starts, ends, strict=True))
                rows.append((conv, len(turns), sha("".join(f"{role}\n{said}\n" for role, said in turns)), len(loss), sha(loss), len(text), len(attached), sum(a["tokens"] for a in attached), sha("".join(f"{a['kind']}\n{a['ref'] or ''}\n{a['tokens']}\n" for a in attached))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return formatted.select("conv_id", "formatted", "loss_starts", "loss_ends", "attachments").mapInArrow(run, DIGEST)
