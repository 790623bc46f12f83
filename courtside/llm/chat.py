"""Chat formatting by event-sourced reconstruction.

The input is a log of events: (conv_id, seq, kind, target, role, text).  The
log is partitioned by conversation, sorted by sequence and folded:

* ``message``: opens a message with ``role`` and ``text``;
* ``delta``: appends ``text`` to the message whose ``seq`` is ``target``
  (null: the last one open);
* ``edit``: replaces the text of ``target``;
* ``regenerate``: replaces the text of ``target`` (null: the last message of
  ``role``) and drops every message after it;
* ``delete``: removes ``target``.

Final messages are rendered as ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``.
Inside roles and texts every ``<``, backslashes, ``|`` gets one more
backslash before the bar, so no control string can occur there and taking one
away again gives the text back; ``%`` and newlines of a role are written
``%25`` and ``%0A``.  Loss spans (code points) cover the escaped text of each
assistant message, nothing else.

Each task streams its sorted rows and holds one conversation's messages at a
time.  A conversation is one output row, so its own text must fit in memory;
rows of other conversations never share it.

Defined results: null text counts as empty, null role as the empty string;
events with a null ``conv_id`` form one conversation of their own; equal
``seq`` values are ordered by role, then text; repeated rows are separate
messages; events that name a missing target are ignored; a conversation whose
messages are all deleted keeps a row with no text.  A very long text is one
message, held whole by one task; an empty table gives no rows; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from courtside.llm.common import ship_code, slices

START, END = "<|im_start|>", "<|im_end|>"
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles stand on one line: %, newline are written %25, %0A before ``escape``."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def fold(events) -> list[tuple[str, str]]:
    """Final (role, text) messages of one conversation's events in order; an event is (seq, kind, target, role, text)."""
    order: list[int] = []
    held: dict[int, list] = {}  # number of a message -> [role, parts of its text]
    by_seq: dict[int, int] = {}
    for seq, kind, target, role, text in events:
        role, text = role or "", text or ""
        if kind == "message":
            k = len(held)
            held[k] = [role, [text]]
            order.append(k)
            by_seq[seq] = k
            continue
        if target is not None:
            k = by_seq.get(target)
        else:
            k = next((x for x in reversed(order) if kind != "regenerate" or held[x][0] == role), None)
        if k is None or held[k][1] is None:
            continue
        if kind == "delta":
            held[k][1].append(text)
        elif kind in ("edit", "regenerate"):
            held[k][1] = [text]
            if kind == "regenerate":
                cut = order.index(k) + 1
                for x in order[cut:]:
                    held[x][1] = None
                del order[cut:]
        elif kind == "delete":
            held[k][1] = None
            order.remove(k)
    return [(held[k][0], "".join(held[k][1])) for k in order]


def render(messages: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the loss spans in it."""
    out, spans, at = [], [], 0
    for role, text in messages:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        part = f"{head}{body}{END}\n"
        out.append(part)
        at += len(part)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) messages of a formatted text; the inverse of ``render``."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_chats(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) per conversation of an event log."""
    ship_code(events.sparkSession)
    kind_of_id = events.schema["conv_id"].dataType
    log = events.select("conv_id", "seq", F.col("kind").cast("string").alias("kind"), F.col("target").cast("long").alias("target"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    log = log.withColumn("seq", F.col("seq").cast("long")).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "role", "text")

    def run(batches):
        def rows():
            for b in slices(batches, 4096):
                yield from zip(*(b[n].to_pylist() for n in ("conv_id", "seq", "kind", "target", "role", "text")))

        ids, texts, spans, held = [], [], [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(ids, to_arrow_type(kind_of_id)), pa.array(texts, pa.string()), pa.array(spans, _SPANS)],
                                              names=["conv_id", "formatted", "loss_spans"])

        for conv, own in groupby(rows(), key=lambda r: r[0]):
            text, found = render(fold(r[1:] for r in own))
            ids.append(conv)
            texts.append(text)
            spans.append([{"start": s, "end": e} for s, e in found])
            held += len(text)
            if held > 1 << 22 or len(ids) >= 2048:
                yield batch()
                ids, texts, spans, held = [], [], [], 0
        if ids:
            yield batch()

    schema = T.StructType([T.StructField("conv_id", kind_of_id), T.StructField("formatted", T.StringType()),
                           T.StructField("loss_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    return log.mapInArrow(run, schema)


DIGESTS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each formatted conversation, from its text and loss spans alone."""
    def run(batches):
        for b in slices(batches):
            out = []
            for conv, text, spans in zip(b["conv_id"].to_pylist(), b["formatted"].to_pylist(), b["loss_spans"].to_pylist()):
                turns = parse(text)
                loss = [unescape(text[s["start"]:s["end"]]) for s in spans]
                out.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                            sum(map(len, loss)), hashlib.sha256("".join(loss).encode()).hexdigest(), len(text)))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=DIGESTS.names)

    return formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "formatted", "loss_spans").mapInArrow(run, DIGESTS)
