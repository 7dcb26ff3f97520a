"""Chat formatting with typed content parts.

A message is a list of parts: text, image, audio or document. A visitor turns each part
into text: text as it is, the others as an ordered placeholder, and records for those
what they refer to and how many tokens the placeholder stands for. The template marks
turns; control strings inside texts are broken up so that none is left, and mended on
reading. Assistant texts are under the loss mask.

    <|turn|>role\\n text <|end|>\\n

Escaping: the character ESC is written ESC 0, and after the first character of any
control string (of this template or of others in common use) ESC 1 is inserted, so the
string no longer occurs; reading undoes both. Placeholders are control strings of the
template, so a text that looks like one is escaped as well.

Defined results: null text and null role are empty; turns of one number are ordered by
role and text; rows with a null conversation id form one conversation; an empty table
gives no conversation. Typed content that is not as it should be is text (see parts_from). A conversation is one string, so its turns meet in one task.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

ESC = "␛"
TURN, END = "<|turn|>", "<|end|>"
#: Control strings that a text must not contain (fixed values): those of this template, then those of common ones.
CONTROLS = (
    TURN, END, "<|image:", "<|audio:", "<|document:",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|begin_of_text|>",
    "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>", "<|user|>", "<|assistant|>", "<|system|>", "<start_of_turn>", "<end_of_turn>",
)
_BREAK = re.compile("(?s)(?=" + "|".join(map(re.escape, CONTROLS)) + ").|" + ESC)


def escape(text: str) -> str:
    return _BREAK.sub(lambda m: ESC + "0" if m[0] == ESC else m[0] + ESC + "1", text)


def unescape(text: str) -> str:
    return re.sub(ESC + "([01])", lambda m: ESC if m[1] == "0" else "", text)


# ------------------------------------------------------------- content parts
@dataclass
class Text:
    text: str

    def accept(self, v: Visitor) -> None:
        v.text(self)


@dataclass
class Image:
    ref: str
    width: int = 0
    height: int = 0

    def accept(self, v: Visitor) -> None:
        v.image(self)


@dataclass
class Audio:
    ref: str
    seconds: float = 0.0

    def accept(self, v: Visitor) -> None:
        v.audio(self)


@dataclass
class Document:
    ref: str
    pages: int = 0

    def accept(self, v: Visitor) -> None:
        v.document(self)


KINDS = {"text": Text, "image": Image, "audio": Audio, "document": Document}


def _number(x: object) -> float:
    """A count or a duration; 0 for what is none, or not finite, or negative."""
    return min(float(x), 1e12) if isinstance(x, (int, float)) and not isinstance(x, bool) and 0 <= x < float("inf") else 0


def parts_from(content: str | None, typed: bool) -> list:
    """Parts of a message: of JSON (a list of {"type": ..., ...}) if typed, else one text. What is no such list is one text as
    it stands, a part of another type the text of its JSON; a missing reference or text is empty, a missing number 0."""
    if not typed:
        return [Text(content or "")]
    try:
        listed = json.loads(content or "[]")
    except (ValueError, RecursionError):
        listed = None
    if not isinstance(listed, list):
        return [Text(content or "")]
    made: list = []
    for part in listed:
        kind = KINDS.get(part.get("type")) if isinstance(part, dict) and isinstance(part.get("type"), str) else None
        if kind is None:
            made.append(Text(part if isinstance(part, str) else json.dumps(part, ensure_ascii=False)))
            continue
        text = lambda k, p=part: "" if p.get(k) is None else str(p[k])
        if kind is Text:
            made.append(Text(text("text")))
        else:
            numbers = {k: _number(part.get(k)) for k in kind.__dataclass_fields__ if k != "ref"}
            made.append(kind(text("ref"), **{k: v if k == "seconds" else int(v) for k, v in numbers.items()}))
    return made


@dataclass
class Visitor:
    """Writes parts in order; attachments holds (placeholder, kind, ref, tokens)."""

    patch: int = 14 * 14
    audio_rate: float = 25.0
    page_tokens: int = 800
    out: list[str] = field(default_factory=list)
    attachments: list[tuple[str, str, str, int]] = field(default_factory=list)

    def text(self, part: Text) -> None:
        self.out.append(escape(part.text))

    def image(self, part: Image) -> None:
        self._hold("image", part.ref, -(-part.width * part.height // self.patch))

    def audio(self, part: Audio) -> None:
        self._hold("audio", part.ref, -int(-part.seconds * self.audio_rate // 1))

    def document(self, part: Document) -> None:
        self._hold("document", part.ref, part.pages * self.page_tokens)

    def _hold(self, kind: str, ref: str, tokens: int) -> None:
        mark = f"<|{kind}:{len(self.attachments)}|>"
        self.attachments.append((mark, kind, ref, max(1, tokens)))
        self.out.append(mark)


# ------------------------------------------------------------------ template
@dataclass
class Formatted:
    text: str
    #: Code points [from, to) of the formatted text on which loss is taken.
    loss: list[tuple[int, int]]
    attachments: list[tuple[str, str, str, int]]


def format_turns(turns: list[tuple[str | None, str | None]], typed: bool = False) -> Formatted:
    out, loss, at, visitor = [], [], 0, Visitor()
    for role, content in turns:
        visitor.out = []
        for part in parts_from(content, typed):
            part.accept(visitor)
        head, body = f"{TURN}{escape(role or '').replace(chr(10), ESC + '2')}\n", "".join(visitor.out)
        if role == "assistant":
            loss.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END + "\n"]
        at += len(head) + len(body) + len(END) + 1
    return Formatted("".join(out), loss, visitor.attachments)


def read_back(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation; placeholders stay as they are."""
    turns = []
    for part in text.split(TURN)[1:]:
        role, _, body = part.partition("\n")
        turns.append((unescape(role.replace(ESC + "2", "\n")), unescape(body.removesuffix(END + "\n"))))
    return turns


FORMATTED = StructType([
    StructField("formatted", StringType()), StructField("loss", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
    StructField("attachments", ArrayType(StructType([StructField("mark", StringType()), StructField("kind", StringType()), StructField("ref", StringType()), StructField("tokens", LongType())]))),
])
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_HELD = pa.struct([("mark", pa.string()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
_FORMATTED = pa.struct([("formatted", pa.string()), ("loss", pa.list_(_SPAN)), ("attachments", pa.list_(_HELD))])


#: Conversations whose output a worker holds at a time.
SLICE = 32


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return (b[at : at + SLICE] for b in batches for at in range(0, len(b), SLICE))


def _column(turns: Column, typed: bool) -> Column:
    from pyspark.sql.pandas.functions import arrow_udf

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for one_of in _slices(batches):
            rows = []
            for one in one_of:
                f = format_turns([(t["role"], t["text"]) for t in one.as_py()], typed)
                rows.append({"formatted": f.text, "loss": [dict(zip(("start", "end"), s, strict=True)) for s in f.loss], "attachments": [dict(zip(("mark", "kind", "ref", "tokens"), a, strict=True)) for a in f.attachments]})
            yield pa.array(rows, _FORMATTED)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(run, FORMATTED)(turns)


def format_chats(conversations: DataFrame, typed: bool = False) -> DataFrame:
    """conv_id, formatted text, loss spans and attachments of each conversation."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", _column(F.col("turns"), typed).alias("f")).select("conv_id", "f.formatted", "f.loss", "f.attachments")


_READ = StructType([StructField("n_turns", LongType()), StructField("turns_sha256", StringType()), StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType())])
_READ_ARROW = pa.struct([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digest(formatted: str, loss: list[dict]) -> dict:
    """What is read back from a formatted conversation and its mask."""
    turns, masked = read_back(formatted), [unescape(formatted[s["start"] : s["end"]]) for s in loss]
    all_turns = "".join(f"{role}\n{text}\n" for role, text in turns)
    learnt = "".join(masked)
    sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
    return {"n_turns": len(turns), "turns_sha256": sha(all_turns), "loss_chars": len(learnt), "loss_sha256": sha(learnt), "formatted_chars": len(formatted)}


def read_chats(formatted: DataFrame) -> DataFrame:
    from pyspark.sql.pandas.functions import arrow_udf

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            for at in range(0, len(texts), SLICE):
                yield pa.array([digest(t.as_py(), s.as_py()) for t, s in zip(texts[at : at + SLICE], spans[at : at + SLICE], strict=True)], _READ_ARROW)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return formatted.select("conv_id", arrow_udf(run, _READ)("formatted", "loss").alias("r")).select("conv_id", "r.*")


#: The conversation that the query adds: a user and an assistant who say control strings (fixed values).
ADDED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat(conversations: DataFrame) -> DataFrame:
    kinds = "conv_id long, turn long, role string, text string"
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return read_chats(format_chats(rows.unionByName(conversations.sparkSession.createDataFrame(ADDED, kinds))))
