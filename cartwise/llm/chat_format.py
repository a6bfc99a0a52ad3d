"""Chat formatting by token-level assembly.

A turn is ``<|im_start|>`` role ``<|im_sep|>`` text ``<|im_end|>``. Role and text are
encoded separately and the three markers are spliced in as reserved ids beyond the
vocabulary, so no text can produce a marker id. Control strings that occur in a
role or text are escaped reversibly before encoding: a backslash is put after their
first character (one more, if some stand there already), and reading back takes
one away. Token offsets and the loss mask of a conversation (the text tokens of
assistant turns) come from prefix sums of the segment lengths over its turns.

Every turn is one row of bounded work: encoding needs no shuffle, and only segment
lengths are summed per conversation. Reading a conversation back streams its turns
in order, one at a time, from partitions sorted by conversation and turn, so the
largest conversation needs no more memory than its longest turn.

Defined results: null roles and texts are empty; a null conversation id is a
conversation of its own; turns are ordered by turn, nulls first, then role and
text, so ties and repeated rows have one order; roles other than ``assistant`` are
never under the mask; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import record_batches, slices

#: The template's markers, and the control strings escaped in content.
MARKERS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
CONTROL = (*MARKERS, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
ASSISTANT = "assistant"
#: The order of a conversation's turns (nulls first).
TURN_ORDER = ("turn", "role", "formatted")

_ALL = "|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROL)
_PLAIN = re.compile(_ALL)
_ESCAPED = re.compile(_ALL.replace("\\\\*", "\\\\+"))


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[0] + m.group()[2:], text)


def _tokenizer(text: str):
    """The tokenizer, and the first reserved id (beyond every id of its vocabulary)."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(text)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True  # strings of special tokens in content are ordinary text
    return t, max(t.get_vocab(with_added_tokens=True).values()) + 1


_TURNS = ("conv_id bigint, turn bigint, role string, formatted string, ids binary, n_tokens bigint, text_from bigint, "
          "text_tokens bigint, masked boolean")


def format_turns(df: DataFrame, path: str) -> DataFrame:
    """A row per turn: the formatted text, the token ids (little-endian unsigned 32-bit)
    with the reserved ids spliced in, and the turn's and its loss span's token
    offsets in the conversation (``start``, ``loss_start``, ``loss_stop``; the loss
    span is empty where the mask is off)."""
    with open(path, encoding="utf-8") as f:
        source = df.sparkSession.sparkContext.broadcast(f.read())
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
                        ("ids", pa.binary()), ("n_tokens", pa.int64()), ("text_from", pa.int64()),
                        ("text_tokens", pa.int64()), ("masked", pa.bool_())])

    def run(batches):
        tok, reserved = _tokenizer(source.value)
        mark = [np.array([reserved + i], "<u4").tobytes() for i in range(3)]
        for batch in batches:
            for part in slices(batch, "text"):
                roles = [r or "" for r in part.column("role").to_pylist()]
                safe = [(escape(r), escape(t or "")) for r, t in zip(roles, part.column("text").to_pylist())]
                coded = tok.encode_batch([s for pair in safe for s in pair], add_special_tokens=False)
                ids = [np.array(c.ids, "<u4").tobytes() for c in coded]
                r, t = ids[::2], ids[1::2]
                yield from record_batches(schema, [
                    part.column("conv_id"), part.column("turn"), roles,
                    [f"{MARKERS[0]}{a}{MARKERS[1]}{b}{MARKERS[2]}" for a, b in safe],
                    [mark[0] + a + mark[1] + b + mark[2] for a, b in zip(r, t)],
                    [(len(a) + len(b)) // 4 + 3 for a, b in zip(r, t)], [len(a) // 4 + 2 for a in r],
                    [len(b) // 4 for b in t], [x == ASSISTANT for x in roles]], 1024)

    turns = df.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                      F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, _TURNS)
    before = (Window.partitionBy("conv_id").orderBy(*TURN_ORDER).rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    return (turns.withColumn("start", start)
            .withColumn("loss_start", F.col("start") + F.col("text_from"))
            .withColumn("loss_stop", F.col("loss_start") + F.when(F.col("masked"), F.col("text_tokens")).otherwise(0))
            .drop("text_from", "text_tokens", "masked"))


class _Conversation:
    """Reads one conversation back from its token ids, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars, self.at = conv_id, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, decode, reserved: int, formatted: str, ids: bytes, loss: tuple[int, int]):
        tokens = np.frombuffer(ids, "<u4")
        a, b, c = np.flatnonzero(tokens >= reserved)  # the three markers; no content makes one
        role, text = unescape(decode(tokens[a + 1:b])), unescape(decode(tokens[b + 1:c]))
        self.all.update(f"{role}\n{text}\n".encode())
        if loss[1] > loss[0]:
            said = unescape(decode(tokens[loss[0] - self.at:loss[1] - self.at]))
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.turns += 1
        self.chars += len(formatted)
        self.at += len(tokens)

    def row(self):
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(turns: DataFrame, path: str) -> DataFrame:
    """Per conversation, digests of what the token ids and the mask give back."""
    with open(path, encoding="utf-8") as f:
        source = turns.sparkSession.sparkContext.broadcast(f.read())
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    schema = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in names])

    def run(batches):
        tok, reserved = _tokenizer(source.value)
        decode = lambda ids: tok.decode(ids.tolist(), skip_special_tokens=False) if len(ids) else ""
        open_one, done = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                conv, formatted, ids, s, e = (batch.column(n)[i].as_py()
                                              for n in ("conv_id", "formatted", "ids", "loss_start", "loss_stop"))
                if open_one is None or conv != open_one.conv_id:
                    if open_one is not None:
                        done.append(open_one.row())
                    open_one = _Conversation(conv)
                open_one.add(decode, reserved, formatted, ids, (s, e))
            if done:
                yield from record_batches(schema, list(zip(*done)))
                done = []
        if open_one is not None:
            yield from record_batches(schema, list(zip(*[open_one.row()])))

    return (turns.select("conv_id", "turn", "role", "formatted", "ids", "loss_start", "loss_stop")
            .repartition("conv_id").sortWithinPartitions("conv_id", *TURN_ORDER)
            .mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                             "loss_sha256 string, formatted_chars bigint"))
