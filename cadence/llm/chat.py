"""Chat formatting with a finite-state machine over roles.

A declarative template turns a conversation into text segments, each with a
loss flag. A machine over the roles checks the turn order as the turns stream
by. Conversations are brought together by a hash of their id and sorted by
turn inside the partition, then read as a stream: memory holds one batch and
the machine's state, never a whole conversation, however long it is.

Texts and roles may contain the template's control strings: ``\\`` becomes
``\\\\`` and ``<|`` becomes ``<\\|``, so that no control string can appear
inside a text, and reading back undoes it exactly.

Defined cases: a null text or role counts as empty; a null id is a
conversation of its own; turns with equal numbers are ordered by role and
text (a null turn comes first); a conversation whose roles break the machine
is still formatted, with ``valid`` false from that turn on; roles outside the
template's loss roles carry no loss; extra columns are ignored.
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
class Template:
    """What surrounds a turn, which roles carry loss, and the allowed order."""
    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    # state -> role -> next state; "end" states may close a conversation.
    machine: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "ask", "user": "answer"},
        "ask": {"user": "answer"},
        "answer": {"assistant": "ask"},
    })
    end: tuple[str, ...] = ("ask",)


CHATML = Template()


def escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(s: str) -> str:
    """As ``escape``; a line end would also end the role's line, so it becomes ``\\N``."""
    return escape(s).replace("\n", "\\N")


_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(s: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "N" else m[1], s) if "\\" in s else s


SEGMENTS = "conv_id {kind}, position long, state string, valid boolean, segments array<struct<text:string,loss:boolean>>"


def format_turns(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per turn, ``conv_id, position, state, valid, segments``, the
    rows of a conversation in order and next to each other in one partition.
    ``segments`` are the turn's text pieces with loss flags; ``state`` is the
    machine's state after the turn (null once the order is broken)."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = rows.schema["conv_id"].dataType.simpleString()
    seg = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, position, state = object(), 0, None
        for batch in batches:
            out: dict[str, list] = {"position": [], "state": [], "valid": [], "segments": []}
            for conv, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(),
                                        batch.column("text").to_pylist()):
                if conv != now:
                    now, position, state = conv, 0, "start"
                state = template.machine.get(state, {}).get(role) if state else None
                out["position"].append(position)
                out["state"].append(state)
                out["valid"].append(state is not None)
                out["segments"].append([
                    {"text": template.open + escape_role(role) + template.after_role, "loss": False},
                    {"text": escape(text), "loss": role in template.loss_roles},
                    {"text": template.close, "loss": False}])
                position += 1
            yield pa.record_batch({
                "conv_id": batch.column("conv_id"), "position": pa.array(out["position"], pa.int64()),
                "state": pa.array(out["state"], pa.string()), "valid": pa.array(out["valid"], pa.bool_()),
                "segments": pa.array(out["segments"], seg)})

    return rows.mapInArrow(run, SEGMENTS.format(kind=kind))


def parse_turn(formatted: str, template: Template = CHATML) -> tuple[str, str]:
    """Role and text back from one formatted turn."""
    if not (formatted.startswith(template.open) and formatted.endswith(template.close)):
        raise ValueError("not a formatted turn")
    role, _, text = formatted[len(template.open):-len(template.close)].partition(template.after_role)
    return unescape(role), unescape(text)


def read_back(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Digest of every conversation, from the formatted segments alone.

    ``turns`` must come from ``format_turns`` as it is (rows of a conversation
    adjacent and in order). The formatted text of a turn is parsed back and
    the loss mask's text unescaped; hashes are updated turn by turn.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_type = None
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        now, acc = object(), None

        def closed(acc) -> tuple:
            return (acc[0], acc[1], acc[2].hexdigest(), acc[3], acc[4].hexdigest(), acc[5], acc[6] in template.end)

        for batch in batches:
            conv_type, done = batch.column("conv_id").type, []
            for conv, state, segments in zip(batch.column("conv_id").to_pylist(), batch.column("state").to_pylist(),
                                             batch.column("segments").to_pylist()):
                if conv != now:
                    if acc is not None:
                        done.append(closed(acc))
                    now, acc = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, None]
                whole = "".join(s["text"] for s in segments)
                role, text = parse_turn(whole, template)
                acc[1] += 1
                acc[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for s in segments:
                    if s["loss"]:
                        lost = unescape(s["text"])
                        acc[3] += len(lost)
                        acc[4].update(lost.encode("utf-8", "surrogatepass"))
                acc[5] += len(whole)
                acc[6] = state
            if done:
                yield _batch(done, names, [conv_type, *types])
        if acc is not None:
            yield _batch([closed(acc)], names, [conv_type, *types])

    return turns.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long, valid boolean")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
