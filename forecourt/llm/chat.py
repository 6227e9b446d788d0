"""Chat formatting by event-sourced reconstruction.

A log holds events (conv_id, turn, msg, seq, kind, role, text) of these kinds:

* ``open`` starts the message with a role and a first text;
* ``delta`` appends to it;
* ``edit`` replaces its text;
* ``regenerate`` empties it and discards what later turns held before (a lower seq).

The log is partitioned by conversation and sorted by turn, message and sequence. One pass
folds the events into final messages and renders each: state is one message and one number,
so a conversation of any length needs no memory beyond its longest message. The rendered pieces of
a conversation, in order of ``position``, are its formatted text.

Template: ``<|im_start|>role NEWLINE text<|im_end|>NEWLINE``. Backslashes of a text are doubled and every
control string gets a backslash behind its first character, so that no control string
survives inside a text; a line break in a role is written as backslash n. ``unescape``
gives the original back. The loss mask covers the texts of assistant messages.

A null text counts as empty, a null role as an empty one, a null conversation id as one
conversation, a null turn comes first. Events of a message that was never opened open it without a role.
Empty logs give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of common chat templates. [fixed values]
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
OPEN, CLOSE = CONTROL[0], CONTROL[1]
TRAINED = "assistant"
#: Code points of a streamed piece when whole messages are turned into a log.
PIECE = 256

EVENT_COLUMNS = ["conv_id", "turn", "msg", "seq", "kind", "role", "text"]
_RENDERED = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()),
     ("rendered", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64())]
)
RENDERED = (
    "conv_id bigint, turn bigint, position bigint, role string, text string, "
    "rendered string, loss_start bigint, loss_end bigint"
)
_CONTROLS = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.S)
_ROWS = 2000
_CHARS = 4_000_000


def escape(text: str) -> str:
    return _CONTROLS.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The piece of a message and the range of its text that is trained on (empty: none)."""
    head = f"{OPEN}{escape(role)}\n".replace("\n", "\\n", role.count("\n"))
    body = escape(text)
    span = (len(head), len(head) + len(body)) if role == TRAINED else (0, 0)
    return f"{head}{body}{CLOSE}\n", *span


def read_back(rendered: str) -> tuple[str, str]:
    """Role and text of a rendered message."""
    head, _, rest = rendered.removeprefix(OPEN).partition("\n")
    return unescape(head), unescape(rest.removesuffix(f"{CLOSE}\n"))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, place, fork, forks = object(), 0, -1, -1
    turn_now = None
    message: list | None = None
    out: list[tuple] = []
    chars = 0

    def close():
        nonlocal message, place, chars
        if message is not None and message[3]:
            _, role, parts, _, turn = message
            text = "".join(parts)
            piece = render(role, text)
            out.append((conv, turn, place, role, text, *piece))
            chars += len(piece[0])
            place += 1
        message = None

    for batch in batches:
        for conv_id, turn, msg, seq, kind, role, text in zip(*(batch.column(c).to_pylist() for c in EVENT_COLUMNS), strict=True):
            if conv_id != conv:
                close()
                conv, place, fork, forks, turn_now = conv_id, 0, -1, -1, None
            key = (turn, msg)
            if message is None or message[0] != key:
                close()
                if turn != turn_now:
                    turn_now, fork = turn, max(fork, forks)
                message = [key, role or "", [], False, turn]
            if seq is not None and seq < fork:
                continue  # an earlier turn was regenerated after this event
            if kind == "regenerate":
                forks = max(forks, seq if seq is not None else -1)
                message[2] = []
            elif kind == "edit":
                message[2] = [text or ""]
            else:
                if kind == "open":
                    message[1] = role or ""
                message[2].append(text or "")
            message[3] = True
            if len(out) >= _ROWS or chars >= _CHARS:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RENDERED, strict=True)], schema=_RENDERED)
                out, chars = [], 0
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RENDERED, strict=True)], schema=_RENDERED)


def format_chats(events: DataFrame) -> DataFrame:
    """A row per final message; see the module's text."""
    log = events.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("msg").cast("string"),
        F.col("seq").cast("bigint"), "kind", "role", "text",
    )
    return log.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "msg", "seq").mapInArrow(_fold, RENDERED)


def events_of(messages: DataFrame, piece: int = PIECE) -> DataFrame:
    """Whole messages (conv_id, turn, role, text) as the log that would have streamed them.

    Rows of one conversation and turn stay separate messages, ordered by role, then by the
    digest of the text.
    """
    text: Column = F.coalesce("text", F.lit(""))
    role: Column = F.coalesce("role", F.lit(""))
    # one pass over a text; a dot matches a whole code point
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{piece}}}"), F.lit(0))
    return messages.select(
        "conv_id", "turn", role.alias("role"), F.when(F.length(text) > piece, cut).otherwise(F.array(text)).alias("pieces"),
        # one id per message, so before its pieces are made
        F.concat_ws("|", role, F.sha2(text, 256), F.monotonically_increasing_id().cast("string")).alias("msg"),
    ).select("*", F.posexplode("pieces").alias("seq", "text")).select(
        "conv_id", "turn", "msg", "seq", F.when(F.col("seq") == 0, "open").otherwise("delta").alias("kind"), "role", "text"
    )


_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)
DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state, out = object(), None, []

    def close():
        if state is not None:
            out.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "rendered", "loss_start", "loss_end"))
        for conv_id, rendered, start, end in zip(*columns, strict=True):
            if conv_id != conv:
                close()
                conv, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = read_back(rendered)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            trained = unescape(rendered[start:end])
            state[2] += len(trained)
            state[3].update(trained.encode())
            state[4] += len(rendered)
        if len(out) >= _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _DIGEST, strict=True)], schema=_DIGEST)
            out = []
    close()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _DIGEST, strict=True)], schema=_DIGEST)


def digests(rendered: DataFrame) -> DataFrame:
    """What a reader of the output finds, per conversation; takes the rows as ``format_chats`` gives them."""
    return rendered.mapInArrow(_read, DIGEST)
