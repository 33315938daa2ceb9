r"""Chat formatting with typed content parts.

A turn is a list of parts: text, image, audio or document. A visitor flattens
them in order: text is written with its control strings escaped, everything else
becomes a placeholder such as ``<|image:0|>`` whose number points into the
conversation's list of attachments, with the reference and the number of tokens
that the placeholder expands to. A conversation reads

    <|turn|>user\n...<|end|>\n<|turn|>assistant\n...<|end|>\n

The loss mask is a list of spans of code points: the text parts of assistant
turns. ``read_back`` gives turns, parts and masked text from the formatted string
alone, so nothing is lost.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
KINDS = ("image", "audio", "document", "other")
# Strings that chat templates use for control. "<|" begins all of the first kind.
# <|  <s>  </s>  <unk>  <pad>  <<SYS>>  <</SYS>>  [INST]  [/INST]
#
# A control string is escaped by a backslash after its first character. Where
# backslashes stand there already, one more goes in, so it can be undone.
CONTROLS = r"<(\\*)(\||/?s>|unk>|pad>|</?SYS>>)|\[(\\*)(/?INST\])"
_ESCAPE = re.compile(CONTROLS)
_UNESCAPE = re.compile(CONTROLS.replace(r"\\*", r"\\+"))
_TURNS = re.compile(r"<\|turn\|>([^\n]*)\n(.*?)<\|end\|>\n", re.DOTALL)
_PLACE = re.compile(r"<\|(image|audio|document|other):(\d+)\|>")
_ROUGH_TOKENS = re.compile(r"\w+|[^\w\s]")

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<n:int,kind:string,ref:string,turn:int,tokens:long>"
FORMATTED = f"formatted string, n_turns long, loss array<struct<start:long,stop:long>>, attachments array<{ATTACHMENT}>, n_tokens long"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][0] + m[0][2:], text)


def escape_role(role: str) -> str:
    """Roles stand on a line of their own."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Costs:
    """Tokens that a placeholder expands to."""

    #: side of an image patch in pixels, and the most patches of an image
    patch: int = 28
    most_patches: int = 16_384
    tokens_per_second: float = 25.0
    tokens_per_page: int = 800
    #: a tokenizer file for texts (library ``tokenizers``) that every worker can read; None: words and signs
    tokenizer: str | None = None


@dataclass
class Flattener:
    """Visits the parts of a conversation in order."""

    costs: Costs
    count: object
    out: list[str] = field(default_factory=list)
    length: int = 0
    loss: list[dict] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0
    turn: int = -1
    learn: bool = False
    run: list[str] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def begin(self, role: str) -> None:
        self.turn += 1
        self.learn = role == "assistant"
        self.write(f"{TURN}{escape_role(role)}\n")

    def end(self) -> None:
        self.flush()
        self.write(f"{END}\n")

    def flush(self) -> None:
        """Neighbouring texts are escaped as one, so that none can begin a control string that the next one ends."""
        text, start = "".join(self.run), self.length
        self.run.clear()
        self.write(escape(text))
        self.tokens += self.count(text)
        if self.learn and text:
            self.loss.append({"start": start, "stop": self.length})

    def visit(self, part: dict | None) -> None:
        kind = (part or {}).get("kind") or "text"
        if part is not None:
            getattr(self, f"visit_{kind}" if kind in ("text", *KINDS) else "visit_other")(part)

    def visit_text(self, part: dict) -> None:
        self.run.append(part["text"] or "")

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.flush()
        n = len(self.attachments)
        self.attachments.append({"n": n, "kind": kind, "ref": part["ref"], "turn": self.turn, "tokens": tokens})
        self.tokens += tokens
        self.write(f"<|{kind}:{n}|>")

    def visit_image(self, part: dict) -> None:
        sides = [max(1, -(-(part[s] or 0) // self.costs.patch)) for s in ("width", "height")]
        self.attach("image", part, min(sides[0] * sides[1], self.costs.most_patches))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, max(1, round((part["seconds"] or 0) * self.costs.tokens_per_second)))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, max(1, part["pages"] or 0) * self.costs.tokens_per_page)

    def visit_other(self, part: dict) -> None:
        self.attach("other", part, 0)


def counter(tokenizer: str | None):
    if tokenizer is None:
        return lambda text: len(_ROUGH_TOKENS.findall(text))
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(tokenizer)
    loaded.encode_special_tokens = True
    return lambda text: len(loaded.encode(text, add_special_tokens=False).ids)


def text_parts(text: str) -> Column:
    """A text column as one text part; null is empty."""
    rest = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *rest))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", costs: Costs = Costs()) -> DataFrame:
    """``(conv, formatted, n_turns, loss, attachments, n_tokens)`` of every conversation.

    Turns stand in the order of ``turn`` (null first), ties by role, then parts.
    Repeated rows are repeated turns. A null role is empty, a null list has no
    parts, null parts are skipped, parts of unknown kind become ``other``. Rows
    without a conversation id make up one conversation. Empty tables give no rows. A
    conversation is one string, so a single row holds it, however long it is.
    """
    ordered = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")).cast(f"array<{PART}>").alias("parts"),
        ).alias("row"),
    )
    grouped = ordered.groupBy("conv").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    conv_type = grouped.schema["conv"].dataType.simpleString()
    kinds = pa.struct([("n", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("turn", pa.int32()), ("tokens", pa.int64())])
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def run(batches):
        count = counter(costs.tokenizer)
        for batch in batches:
            done = []
            for rows in batch.column(1).to_pylist():
                flat = Flattener(costs, count)
                for row in rows:
                    flat.begin(row["role"])
                    for part in row["parts"]:
                        flat.visit(part)
                    flat.end()
                done.append(flat)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(["".join(f.out) for f in done], pa.string()),
                    pa.array([f.turn + 1 for f in done], pa.int64()),
                    pa.array([f.loss for f in done], pa.list_(span)),
                    pa.array([f.attachments for f in done], pa.list_(kinds)),
                    pa.array([f.tokens for f in done], pa.int64()),
                ],
                names=["conv", "formatted", "n_turns", "loss", "attachments", "n_tokens"],
            )

    return grouped.mapInArrow(run, f"conv {conv_type}, {FORMATTED}")


def read_turns(formatted: str) -> list[tuple[str, list[str | tuple[str, int]]]]:
    """Role and parts of every turn: a part is a text, or kind and number of an attachment."""
    out = []
    for m in _TURNS.finditer(formatted):
        parts, at = [], 0
        for p in _PLACE.finditer(m[2]):
            if p.start() > at:
                parts.append(unescape(m[2][at : p.start()]))
            parts.append((p[1], int(p[2])))
            at = p.end()
        if at < len(m[2]) or not parts:
            parts.append(unescape(m[2][at:]))
        out.append((unescape_role(m[1]), parts))
    return out


def read_back(chats: DataFrame) -> DataFrame:
    """``(conv, n_turns, turns_sha256, loss_chars, loss_sha256)`` from the formatted strings and their masks.

    Turns are hashed as role, line feed, text, line feed; a placeholder counts
    as it is written.
    """
    conv_type = chats.schema["conv"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = []
            for formatted, loss in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns, masked, n = hashlib.sha256(), hashlib.sha256(), 0
                read = read_turns(formatted)
                for role, parts in read:
                    body = "".join(p if isinstance(p, str) else f"<|{p[0]}:{p[1]}|>" for p in parts)
                    turns.update(f"{role}\n{body}\n".encode())
                for span in loss:
                    text = unescape(formatted[span["start"] : span["stop"]])
                    masked.update(text.encode())
                    n += len(text)
                found.append((len(read), turns.hexdigest(), n, masked.hexdigest()))
            columns = list(zip(*found)) or [()] * 4
            types = [pa.int64(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)], batch.column(3)],
                names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    slim = chats.select("conv", "formatted", "loss", F.length("formatted").cast("long").alias("formatted_chars"))
    schema = f"conv {conv_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return slim.mapInArrow(run, schema)
