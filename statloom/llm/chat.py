"""Chat formatting with typed content parts.

A turn holds text, image, audio and document parts. A visitor flattens them into one string: text is
escaped, every other part becomes a numbered placeholder, with its attachment reference and the tokens it
expands to on the side. Turns are formatted row by row; a conversation is the sequence of its turns, read
in order by streaming over sorted rows, so that no conversation has to fit into memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The marks of the template. Inside texts and roles they are escaped.
HEAD, END, PLACEHOLDER = "### ", "</turn>", "<|"
#: Tokens that parts expand to: image patches of 14 x 14 pixels, audio frames and document pages.
PATCH, FRAMES_PER_SECOND, TOKENS_PER_PAGE = 14, 25, 576
LOSS_ROLE = "assistant"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

_CONTROL = re.compile(r"\\|###|</turn>|<\|")
_IN_ROLE = re.compile(r"\\|\n|###|</turn>|<\|")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\\n]++|\\.)*+)\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before every control string and every backslash; ``unescape`` takes one off again."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass
class Flattener:
    """Visits the parts of one turn in their order and gathers what the model sees."""

    out: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        width, height = part.get("width") or 0, part.get("height") or 0
        self._attach("image", part, max(1, -(-width // PATCH) * -(-height // PATCH)))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, max(1, round((part.get("seconds") or 0) * FRAMES_PER_SECOND)))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, max(1, part.get("pages") or 0) * TOKENS_PER_PAGE)

    def visit_other(self, part: dict) -> None:
        raise ValueError(f"unknown content part {part.get('type')!r}")

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        number = len(self.attachments)
        self.out.append(f"{PLACEHOLDER}{kind}:{number}|>")
        self.attachments.append({"number": number, "kind": kind, "ref": part.get("ref"), "tokens": tokens})
        self.tokens += tokens


def format_turn(role: str | None, parts: list[dict]) -> tuple[str, int, int, list[dict], int]:
    """One turn as text; where its body starts and ends (code points); attachments; expanded tokens."""
    visitor = Flattener()
    for part in parts:
        visitor.visit(part)
    head = HEAD + _IN_ROLE.sub(lambda m: "\\" + m[0], role or "") + "\n"
    body = "".join(visitor.out)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body), visitor.attachments, visitor.tokens


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and body text of a formatted turn, unescaped; placeholders stand in the body as they are."""
    found = _TURN.fullmatch(formatted)
    if found is None:
        raise ValueError("not a formatted turn")
    return unescape(found[1]), unescape(found[2])


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part; NULL counts as empty."""
    none = F.lit(None)
    return F.array(
        F.struct(
            F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), none.cast("string").alias("ref"),
            none.cast("int").alias("width"), none.cast("int").alias("height"), none.cast("double").alias("seconds"),
            none.cast("int").alias("pages"),
        )
    )


def format_turns(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts"
) -> DataFrame:
    """Per turn: conv, turn, role, formatted, loss_start, loss_stop (the part under the loss mask, empty
    but for the assistant), attachments, tokens. NULL parts are none, NULL roles empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
        for batch in batches:
            roles, parts = batch.column(2).to_pylist(), batch.column(3)
            rows = [format_turn(r, p.as_py() or []) for r, p in zip(roles, parts, strict=True)]
            learn = [r == LOSS_ROLE for r in roles]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] if y else r[1] for r, y in zip(rows, learn, strict=True)], pa.int64()),
                    pa.array([r[3] for r in rows], kind),
                    pa.array([r[4] for r in rows], pa.int64()),
                ],
                names=["conv", "turn", "role", "formatted", "loss_start", "loss_stop", "attachments", "tokens"],
            )

    slim = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(parts_col).cast(f"array<{PART}>").alias("parts"),
    )
    types = dict(slim.dtypes)
    return slim.mapInArrow(
        run,
        f"conv {types['conv']}, turn {types['turn']}, role string, formatted string, loss_start long, loss_stop long, "
        "attachments array<struct<number:int,kind:string,ref:string,tokens:long>>, tokens long",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the formatted turns alone: conv, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars.

    Rows of a conversation are brought together and sorted by turn (NULL first), role and text; digests
    are updated turn by turn and batch by batch, so a very long conversation needs no more memory than a
    short one. Turns of the same number stand in the order of role and text; repeated rows are repeated
    turns; NULL is a conversation of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list | None = None

        def close() -> pa.RecordBatch:
            conv, n, turns, chars, loss, total = open_
            values = [[n], [turns.hexdigest()], [chars], [loss.hexdigest()], [total]]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], conv_type), *(pa.array(v, k) for v, k in zip(values, kinds, strict=True))],
                names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for conv, text, start, stop in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if open_ is None or open_[0] != conv:
                    if open_ is not None:
                        yield close()
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = parse_turn(text)
                open_[1] += 1
                open_[2].update(f"{role}\n{body}\n".encode())
                learned = unescape(text[start:stop])
                open_[3] += len(learned)
                open_[4].update(learned.encode())
                open_[5] += len(text)
        if open_ is not None:
            yield close()

    kind = dict(formatted.dtypes)["conv"]
    placed = formatted.select("conv", "formatted", "loss_start", "loss_stop", "turn", "role").repartition("conv")
    placed = placed.sortWithinPartitions("conv", "turn", "role", "formatted").drop("turn", "role")
    return placed.mapInArrow(
        run, f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
