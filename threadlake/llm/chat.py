"""Chat formatting: typed content parts flattened by a visitor into a marked text.

Every turn becomes ``<s>`` and its role marker, the text of its parts, and
``</s>``. An image, audio or document part becomes an ordered placeholder; its
reference is recorded with the number of tokens the placeholder stands for. Control
strings inside texts are escaped reversibly, so a text can never open or close a
turn. Only assistant turns are under the loss mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

OPEN, CLOSE = "<s>", "</s>"
ROLE_OPEN, ROLE_CLOSE = "[ROLE]", "[/ROLE]"
CONTROL = (OPEN, CLOSE, ROLE_OPEN, ROLE_CLOSE, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|")
# Escape: a backslash stands before the second character of a control string and
# before a backslash that could be read as such an escape.
_ESCAPE = re.compile(r"\\|(?<=<)(?=s>|/s>|<SYS>>|</SYS>>|\|)|(?<=\[)(?=INST\]|/INST\]|ROLE\]|/ROLE\])")
_UNESCAPE = re.compile(r"\\(\\?)")
_TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*?)</s>", re.S)

PART_TYPE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("amount", T.LongType()),
    ]
)
# Tokens of a placeholder: images by tile, audio by second, documents by page.
TOKENS_EACH = {"image": 256, "audio": 25, "document": 512}


def escape(text: str) -> str:
    """``text`` with no control string left in it."""
    return _ESCAPE.sub(lambda m: "\\\\" if m.group() else "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class Turn(NamedTuple):
    role: str
    text: str


class Visitor:
    """Visits the parts of a conversation in order and counts its attachments.

    ``image``, ``audio`` and ``document`` parts become ``<|kind:number|>``, numbered
    through the conversation by kind. ``text`` parts that follow each other are one text, which
    is escaped as a whole: a control string may begin in one part and end in the next. A part
    of another kind is an error of the data, not of the job: it is taken as text.
    """

    def __init__(self, tokens_each: Mapping[str, int] = TOKENS_EACH):
        self.tokens_each = tokens_each
        self.numbers: dict[str, int] = {}

    def flatten(self, parts) -> tuple[str, list[tuple]]:
        """The text of all parts that are not null, and the attachments among them."""
        written, plain, attachments = [], [], []
        for part in parts:
            if part is None:
                continue
            text, attachment = self.visit(part)
            if attachment is None:
                plain.append(text)
                continue
            written += [escape("".join(plain)), text]
            plain = []
            attachments.append(attachment)
        return "".join([*written, escape("".join(plain))]), attachments

    def visit(self, part) -> tuple[str, tuple | None]:
        kind = part["kind"] or "text"
        handler = getattr(self, f"visit_{kind}", None) or self.visit_text
        return handler(part)

    def visit_text(self, part) -> tuple[str, None]:
        return part["text"] or "", None

    def _placeholder(self, kind: str, part) -> tuple[str, tuple]:
        number = self.numbers.get(kind, 0)
        self.numbers[kind] = number + 1
        tokens = self.tokens_each[kind] * max(1, part["amount"] or 1)
        return f"<|{kind}:{number}|>", (kind, number, part["ref"], tokens)

    def visit_image(self, part):
        return self._placeholder("image", part)

    def visit_audio(self, part):
        return self._placeholder("audio", part)

    def visit_document(self, part):
        return self._placeholder("document", part)


def render(role: str, body: str) -> str:
    return f"{OPEN}{ROLE_OPEN}{escape(role)}{ROLE_CLOSE}{body}{CLOSE}"


def parse(formatted: str) -> list[Turn]:
    """The turns of a formatted text, as they were before formatting."""
    return [Turn(unescape(role), unescape(body)) for role, body in _TURN.findall(formatted)]


FORMATTED = (
    "conv_id {kind}, turn long, formatted string, role string, start long, body_start long, "
    "body_end long, loss boolean, "
    "attachments array<struct<kind: string, number: int, ref: string, tokens: long>>, "
    "expanded_tokens long"
)


def in_turn_order(df: DataFrame, conv: str, turn: str, *more: str) -> DataFrame:
    """All turns of a conversation in one sorted partition, to be streamed, not collected."""
    return df.repartition(F.col(conv)).sortWithinPartitions(conv, turn, *more)


def format_turns(
    df: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    parts_column: str | None = None,
    loss_roles: tuple[str, ...] = ("assistant",),
    tokens_each: Mapping[str, int] = TOKENS_EACH,
) -> DataFrame:
    """One row per turn: its part of the formatted conversation, and where it stands.

    Turns are ordered by number (null first), then role, then text, so that repeated
    numbers have a defined order; ``start`` is the place of the turn in the formatted
    conversation, ``body_start`` and ``body_end`` those of its text. With
    ``parts_column`` (an array of kind, text, ref, amount) the parts take the
    place of the text. A null text, role or part is empty. A null conversation id is
    a conversation of its own. Rows are streamed in order within a partition: memory
    holds one batch, however long a conversation is. Other columns are ignored.
    """
    of_conv = df.schema[conv_column].dataType
    kind = of_conv.simpleString()
    parts = (
        F.col(parts_column).cast(T.ArrayType(PART_TYPE))
        if parts_column
        else F.lit(None).cast(T.ArrayType(PART_TYPE))
    )
    rows = df.select(
        F.col(conv_column).alias("conv_id"),
        F.col(turn_column).cast("long").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        parts.alias("parts"),
    )
    schema = FORMATTED.format(kind=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, started, visitor, place = None, False, Visitor(tokens_each), 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if not started or row["conv_id"] != current:
                    current, started, visitor, place = row["conv_id"], True, Visitor(tokens_each), 0
                content = row["parts"]
                if content is None:
                    content = [{"kind": "text", "text": row["text"]}]
                body, attachments = visitor.flatten(content)
                text = render(row["role"], body)
                end = place + len(text) - len(CLOSE)
                out.append(
                    {
                        "conv_id": row["conv_id"],
                        "turn": row["turn"],
                        "formatted": text,
                        "role": row["role"],
                        "start": place,
                        "body_start": end - len(body),
                        "body_end": end,
                        "loss": row["role"] in loss_roles,
                        "attachments": [
                            dict(zip(("kind", "number", "ref", "tokens"), a)) for a in attachments
                        ],
                        "expanded_tokens": sum(a[3] for a in attachments),
                    }
                )
                place += len(text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)

    arrow = pa.schema(
        [
            ("conv_id", to_arrow_type(of_conv)), ("turn", pa.int64()), ("formatted", pa.string()),
            ("role", pa.string()), ("start", pa.int64()), ("body_start", pa.int64()),
            ("body_end", pa.int64()), ("loss", pa.bool_()),
            ("attachments", pa.list_(pa.struct([
                ("kind", pa.string()), ("number", pa.int32()), ("ref", pa.string()),
                ("tokens", pa.int64()),
            ]))),
            ("expanded_tokens", pa.int64()),
        ]
    )
    return in_turn_order(rows, "conv_id", "turn", "role", "text").mapInArrow(run, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, read from the formatted turns alone.

    Per ``conv_id``: turns and their digest (role, newline, text, newline each), the
    length and digest of all text under the loss mask, and the formatted length. Takes
    the rows of ``format_turns``; digests are running ones, so nothing is collected.
    """
    of_conv = formatted.schema["conv_id"].dataType
    kind = of_conv.simpleString()

    class Running:
        def __init__(self, conv):
            self.conv, self.turns, self.length, self.loss = conv, 0, 0, 0
            self.all, self.lost = hashlib.sha256(), hashlib.sha256()

        def add(self, text: str, start: int, end: int, loss: bool) -> None:
            for turn in parse(text):
                self.turns += 1
                self.all.update(f"{turn.role}\n{turn.text}\n".encode())
            if loss:
                masked = unescape(text[start:end])
                self.loss += len(masked)
                self.lost.update(masked.encode())
            self.length += len(text)

        def row(self) -> tuple:
            return (
                self.conv, self.turns, self.all.hexdigest(), self.loss, self.lost.hexdigest(),
                self.length,
            )

    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    arrow = pa.schema(
        list(
            zip(
                names,
                (to_arrow_type(of_conv), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()),
            )
        )
    )

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Running | None = None
        for batch in batches:
            done = []
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for conv, text, start, body_start, body_end, loss in zip(*columns):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = Running(conv)
                now.add(text, body_start - start, body_end - start, loss)
            if done:
                yield table(done)
        if now is not None:
            yield table([now.row()])

    rows = formatted.select("conv_id", "formatted", "start", "body_start", "body_end", "loss")
    # The turns of a conversation follow each other already; nothing is shuffled again.
    return rows.mapInArrow(
        run,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )
