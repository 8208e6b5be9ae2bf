r"""Chat formatting: a finite-state machine checks the order of roles, a declarative template turns each
turn into text segments with a loss flag.

Control strings inside a text are escaped reversibly: the escape character becomes ``\0``, the k-th
control string becomes ``\k``; as no control string holds the escape character, the escaped text
holds no control string and unescaping is exact. Turns of an unknown role are formatted with the
template's general frame and reported as an error of the conversation.

A NULL text or role is empty; NULL conversation ids form one conversation, NULL turn numbers come
first; turns with the same number are ordered by role and text, and repeated rows are turns of their
own. A conversation is read in order by one task that holds one batch of turns at a time, however many
turns it has. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Frame:
    """The control text before and after a turn, and whether the text between counts for the loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Frames by role, the frame of other roles, the machine's moves and its final states."""

    frames: dict[str, Frame]
    other: tuple[str, str, str]
    moves: dict[str, dict[str, str]]
    start: str
    final: frozenset[str]
    escape: str = "\\"
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        parts = [p.strip() for f in self.frames.values() for p in (f.before, f.after)] + [p.strip() for p in self.other]
        controls = tuple(sorted({c for p in parts for c in re.findall(r"<[^<>\s]+>|\[[^\[\]\s]+\]", p)}))
        if any(self.escape in c or any(x.isdigit() for x in c) for c in controls) or len(controls) > 9:
            raise ValueError("control strings must hold neither the escape character nor digits, nine at most")
        object.__setattr__(self, "controls", controls)


INSTRUCT = Template(
    frames={
        "system": Frame("<sys>", "</sys>"),
        "user": Frame("<s>[INST]", "[/INST]"),
        "assistant": Frame("[REPLY]", "</s>", loss=True),
    },
    other=("[ROLE]", "[TEXT]", "</s>"),
    moves={
        "empty": {"system": "briefed", "user": "asked"},
        "briefed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    },
    start="empty",
    final=frozenset({"answered"}),
)


def escaped(text: str, template: Template) -> str:
    out = text.replace(template.escape, template.escape + "0")
    for k, control in enumerate(template.controls, 1):
        out = out.replace(control, f"{template.escape}{k}")
    return out


def unescaped(text: str, template: Template) -> str:
    for k, control in enumerate(template.controls, 1):
        text = text.replace(f"{template.escape}{k}", control)
    return text.replace(template.escape + "0", template.escape)


def segments(role: str, text: str, template: Template) -> list[dict]:
    """The turn as text segments with their loss flags."""
    frame = template.frames.get(role)
    if frame is None:
        first, middle, last = template.other
        frame = Frame(f"{first}{escaped(role, template)}{middle}", last)
    return [{"text": frame.before, "loss": False}, {"text": escaped(text, template), "loss": frame.loss}, {"text": frame.after, "loss": False}]


def parser(template: Template):
    """A function that reads ``role, text`` back from the formatted text of a turn."""
    first, middle, last = (re.escape(p) for p in template.other)
    known = [(re.compile(re.escape(f.before) + "(.*)" + re.escape(f.after), re.S), role) for role, f in template.frames.items()]
    general = re.compile(f"{first}(.*?){middle}(.*){last}", re.S)

    def read(formatted: str) -> tuple[str, str]:
        for pattern, role in known:
            if m := pattern.fullmatch(formatted):
                return role, unescaped(m[1], template)
        m = general.fullmatch(formatted)
        if m is None:
            raise ValueError("not a formatted turn")
        return unescaped(m[1], template), unescaped(m[2], template)

    return read


TURN_DDL = "conv_id bigint, turn bigint, role string, segments array<struct<text:string,loss:boolean>>, state string, error string"
_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
_TURNS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("segments", _SEGMENTS), ("state", pa.string()), ("error", pa.string())])


def format_turns(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Each turn in order within its conversation: its segments, the machine's ``state`` after it, and
    an ``error`` where the role is not allowed (the machine then stays where it was). Conversations
    stay together and in order within a partition."""
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = object(), template.start
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["conv_id"] != at:
                    at, state = r["conv_id"], template.start
                following = template.moves.get(state, {}).get(r["role"])
                error = None if following else f"{r['role']!r} after {state}"
                state = following or state
                out.append({"conv_id": r["conv_id"], "turn": r["turn"], "role": r["role"], "segments": segments(r["role"], r["text"], template), "state": state, "error": error})
            yield pa.RecordBatch.from_pylist(out, schema=_TURNS)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, TURN_DDL)


SUMMARY_DDL = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, n_errors bigint, complete boolean"
)


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation, read from the segments that ``format_turns`` has just made: turns and
    their digest, the text under the loss mask and its digest, formatted length, order errors, and
    whether the machine ended in a final state without errors."""
    names = [c.split()[0] for c in SUMMARY_DDL.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, held = parser(template), None
        out: list[tuple] = []

        def close():
            if held is not None:
                out.append((held["id"], held["n"], held["turns"].hexdigest(), held["loss_chars"], held["loss"].hexdigest(), held["chars"], held["errors"], held["state"] in template.final and not held["errors"]))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for r in batch.to_pylist():
                if held is None or r["conv_id"] != held["id"]:
                    close()
                    held = {"id": r["conv_id"], "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "errors": 0, "state": template.start}
                whole = "".join(s["text"] for s in r["segments"])
                role, text = read(whole)
                under = unescaped("".join(s["text"] for s in r["segments"] if s["loss"]), template)
                held["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                held["loss"].update(under.encode("utf-8", "surrogatepass"))
                held["n"] += 1
                held["loss_chars"] += len(under)
                held["chars"] += len(whole)
                held["errors"] += r["error"] is not None
                held["state"] = r["state"]
            yield batch_of(out)
            out.clear()
        close()
        yield batch_of(out)

    return formatted.mapInArrow(run, SUMMARY_DDL)
