"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation (a row of turns, nothing between them):

    conversation := turn*
    turn         := '<s>' ( '[INST] ' text ' [/INST]'          user
                          | ' ' text ' '                       assistant
                          | '<< ' name ' >> ' text ' ' ) '</s>'  any other role

Control strings are ``<s>  </s>  [INST]  [/INST]  <<  >>``.  Inside a text, a
control string whose first character is followed by backslashes stands for the
same string with one backslash less; that undoes the escaping, which adds one.

A turn is first rendered as it is and parsed again.  If the parser doesn't give
back the very role and text, the content is escaped and the turn is parsed once
more; the loop ends when they are identical (escaping is one to one, so one round
is enough; a failure raises).  Turns are rendered and parsed in parallel,
wherever their rows are.  As every turn begins with ``<s>`` and ends with ``</s>``
and neither occurs in escaped content, a conversation parses to its turns.

The formatted conversations are a table of rendered turns: conv_id, position,
formatted, and loss_start and loss_end, the code points of the turn's formatted
text under the loss mask (assistant texts; equal where there is none).  Reading
back streams them in order, with running digests, so that a conversation of any
length needs no more memory than a batch; its digest, being one sequence, is one
task's work.

Order within a conversation is by turn, then role, then digest of the text
(null turns first, all of them kept).  Null texts and roles count as empty; empty texts are
turns too; texts are used whole.  Rows of null conv_id form one conversation.  An
empty table gives no conversations.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# With the blanks around them no control string can run together with a text.
OPEN, CLOSE, ASK, ASKED, NAME, NAMED, GAP = "<s>", "</s>", "[INST] ", " [/INST]", "<< ", " >> ", " "
_REST = {"<": ("s>", "/s>", "<"), "[": ("INST]", "/INST]"), ">": (">",)}
_CONTROL = re.compile("|".join(
    f"{re.escape(first)}\\\\*(?:{'|'.join(map(re.escape, rests))})" for first, rests in _REST.items()
))
_ESCAPED = re.compile("|".join(
    f"{re.escape(first)}\\\\+(?:{'|'.join(map(re.escape, rests))})" for first, rests in _REST.items()
))

# Control strings can overlap, as in "<<s>", so scanning goes on right behind the first character and its backslashes.
RENDERED = "conv_id bigint, turn bigint, role string, text string, formatted string, loss_start int, loss_end int"


def escape(content: str) -> str:
    """Add a backslash behind the first character of every control string, escaped ones included.

    Control strings can overlap (``<<s>``), so it goes on until no bare one is left.
    """
    out, at = [], 0
    while found := _CONTROL.search(content, at):
        start = found.start()
        out.append(content[at : start + 1] + "\\")
        at = start + 1
        slashes = at
        while content[slashes : slashes + 1] == "\\":
            slashes += 1
        out.append(content[at:slashes])
        at = slashes
    return "".join([*out, content[at:]])


def unescape(content: str) -> str:
    """Undo ``escape``: take one backslash from every escaped control string."""
    out, at = [], 0
    while found := _ESCAPED.search(content, at):
        start = found.start()
        out.append(content[at : start + 1])
        at = start + 2
        slashes = at
        while content[slashes : slashes + 1] == "\\":
            slashes += 1
        out.append(content[at:slashes])
        at = slashes
    return "".join([*out, content[at:]])


def _frame(role: str, text: str, name: str) -> tuple[str, int, int]:
    """The turn, and where its text begins and ends."""
    if role == "user":
        head, tail = OPEN + ASK, ASKED + CLOSE
    elif role == "assistant":
        head, tail = OPEN + GAP, GAP + CLOSE
    else:
        head, tail = OPEN + NAME + name + NAMED, GAP + CLOSE
    return head + text + tail, len(head), len(head) + len(text)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin, end) of every turn, begin and end being places in ``formatted``.

    Raises ValueError where the grammar doesn't hold.
    """
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise ValueError(f"no turn at {at}")
        begin, end = at + len(OPEN), formatted.find(CLOSE, at + len(OPEN))
        if end < 0:
            raise ValueError(f"turn at {at} has no end")
        at = end + len(CLOSE)
        if formatted.startswith(ASK, begin):
            role, begin, tail = "user", begin + len(ASK), ASKED
        elif formatted.startswith(NAME, begin):
            stop = formatted.find(NAMED, begin + len(NAME), end)
            if stop < 0:
                raise ValueError("role without end")
            role, begin, tail = unescape(formatted[begin + len(NAME) : stop]), stop + len(NAMED), GAP
            if role in ("user", "assistant"):
                raise ValueError("role in the wrong form")
        elif formatted.startswith(GAP, begin):
            role, begin, tail = "assistant", begin + len(GAP), GAP
        else:
            raise ValueError("turn of no known form")
        end -= len(tail)
        if end < begin or not formatted.startswith(tail, end):
            raise ValueError("text without end")
        turns.append((role, unescape(formatted[begin:end]), begin, end))
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn and the bounds of its text in it, escaped only if parsing it back demands that."""
    for guard in (lambda x: x, escape):
        formatted, begin, end = _frame(role, guard(text), guard(role))
        try:
            same = parse(formatted) == [(role, text, begin, end)]
        except ValueError:
            same = False
        if same:
            return formatted, begin, end
    raise ValueError("a turn can't be parsed back")


def format_turns(turns: DataFrame) -> DataFrame:
    """Rendered turns with their source role and text, in no order."""
    out = T.StructType.fromDDL(RENDERED)
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [render(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            loss = [(b, e) if r == "assistant" else (0, 0) for r, (_, b, e) in zip(batch.column("role").to_pylist(), done)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([f for f, _, _ in done], type=pa.string()),
                pa.array([b for b, _ in loss], type=pa.int32()), pa.array([e for _, e in loss], type=pa.int32()),
            ], names=out.names)

    return rows.mapInArrow(run, out)


def write_formatted(turns: DataFrame, folder: str) -> None:
    """Write the rendered turns; ``position`` orders those of a conversation."""
    format_turns(turns).select(
        "conv_id", F.struct("turn", "role", F.sha2("text", 256).alias("tie")).alias("position"), "formatted",
        "loss_start", "loss_end",
    ).write.parquet(folder)


SUMMARY = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: what parsing the formatted turns and unescaping the text under the mask gives."""
    out = T.StructType.fromDDL(SUMMARY)
    rows = formatted.select("conv_id", "position", "formatted", "loss_start", "loss_end")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "position").drop("position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begun = None, False
        turns, loss, n, n_loss, n_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        ended: list[tuple] = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=t) for c, t in zip(zip(*ended), types)], names=out.names)
            ended.clear()
            return batch

        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            for conv, text, start, stop in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if not begun or conv != current:
                    if begun:
                        ended.append((current, n, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars))
                    current, begun = conv, True
                    turns, loss, n, n_loss, n_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for role, content, _, _ in parse(text):
                    turns.update(f"{role}\n{content}\n".encode())
                    n += 1
                learnt = unescape(text[start:stop])
                loss.update(learnt.encode())
                n_loss += len(learnt)
                n_chars += len(text)
            if ended:
                yield flush()
        if begun:
            ended.append((current, n, turns.hexdigest(), n_loss, loss.hexdigest(), n_chars))
            yield flush()

    return dealt.mapInArrow(run, out)
