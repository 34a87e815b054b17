r"""Operator 10: chat formatting with offset-aligned loss masks.

A conversation is rendered as ``<|turn|>role<|text|>text<|end|>`` per turn.
Inside roles and texts a backslash stands before each backslash and before
the bar of ``<|``, so no control string can appear in them, and dropping the
backslashes gives the text back.  The rendering is encoded once with
character offsets; the control strings are tokens of their own, so no token
crosses a turn's border.  A token is under the loss mask when its span meets
the span of an assistant text, found by binary search over the sorted spans.

Rows are dealt by ranges of (conversation, turn, start of role, start of
text), so a conversation that holds a third of all rows is rendered and
encoded in many tasks.  A task reads its rows in order as a stream and makes
parts of whole turns of about ``part_chars`` characters; as control strings
split the text before encoding, the parts' tokens are those of the whole.
Reading back digests a conversation of one part where it lies.  Only the
turns of the others are sent on, and hashed in order as a stream: a digest of
a whole conversation has one end.

Defined results: null text or role is empty; a null conversation id is one
conversation; null turns come first; rows with equal turns are ordered by
role and text; repeated rows are turns of their own; other columns are
ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
TURN, TEXT, END = CONTROLS = ("<|turn|>", "<|text|>", "<|end|>")
PARTS_SCHEMA = ("conv_id long, part long, whole boolean, n_turns long, formatted string, input_ids array<int>, "
                "token_ends array<int>, loss_mask array<boolean>")
KEY_CHARS = 32      # of role and text in a row's range key; rows equal in it share a task
SLAB_CHARS = 4096   # the encoder is quicker on slabs of whole turns than on a long part
_ESCAPE = re.compile(r"\\|(?<=<)\|")
_UNESCAPE = re.compile(r"\\(.)", re.DOTALL)
_ONE_TURN = re.compile(re.escape(TURN) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer
    t = Tokenizer.from_file(path)
    t.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROLS])
    return t


def render(turns) -> tuple[str, list[int], list[int]]:
    """The formatted turns, and the spans (starts, ends) of the assistant texts in them."""
    out, at, starts, ends = [], 0, [], []
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == "assistant" and body:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        out += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(out), starts, ends


def mask(token_ends: np.ndarray, starts: list[int], ends: list[int]) -> np.ndarray:
    """Whether each token's span meets a turn's span (both sorted), by binary search."""
    if not starts:
        return np.zeros(len(token_ends), bool)
    begin = np.concatenate([[0], token_ends[:-1]])
    span = np.searchsorted(np.array(ends), begin, "right")
    inside = span < len(starts)
    return inside & (np.array(starts)[np.minimum(span, len(starts) - 1)] < token_ends) & (token_ends > begin)


@functools.lru_cache(maxsize=2)
def _token_bytes(path: str) -> np.ndarray | None:
    """Bytes of text under each token id; None where tokens are not plain runs of bytes."""
    t = tokenizer(path)
    made = json.loads(t.to_str())
    before = made["pre_tokenizer"] or {}
    if made["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        return None
    size = np.zeros(t.get_vocab_size(), np.int64)
    for token, i in t.get_vocab(with_added_tokens=False).items():
        size[i] = len(token)   # a byte is one character of the byte-level alphabet
    for i, token in t.get_added_tokens_decoder().items():
        size[i] = len(token.content.encode())
    return size


def _slabs(formatted: str, size: int):
    """The text in slabs of whole turns, of about ``size`` characters."""
    at = 0
    while len(formatted) - at > size:
        cut = formatted.rfind(TURN, at + 1, at + size)
        if cut < 0:
            cut = formatted.find(TURN, at + size - len(TURN))
        if cut <= at:
            break
        yield formatted[at:cut]
        at = cut
    yield formatted[at:]


def encode(formatted: str, path: str = TOKENIZER, slab_chars: int = SLAB_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """Token ids and the character where each token ends; spans lie end to end.

    Byte-level tokens end where their lengths add up to; other tokenizers
    give their own offsets.
    """
    t, slabs = tokenizer(path), list(_slabs(formatted, slab_chars))
    found = [t.encode(s, add_special_tokens=False) for s in slabs]
    ids = np.fromiter(itertools.chain.from_iterable(f.ids for f in found), np.int32)
    size = _token_bytes(path)
    if size is not None:
        raw, ends = np.frombuffer(formatted.encode(), np.uint8), np.cumsum(size[ids])
        if len(ends) and ends[-1] == len(raw):
            return ids, np.cumsum((raw & 0xC0) != 0x80)[ends - 1].astype(np.int32)
    spans, at = [np.zeros(0, np.int32)], 0
    for f, s in zip(found, slabs):
        spans.append(at + np.fromiter((y for _, y in f.offsets), np.int32, len(f.ids)))
        at += len(s)
    return ids, np.maximum.accumulate(np.concatenate(spans)).astype(np.int32)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts), kind))


def _pieces(column: pa.ListArray):
    """The values of each list, without a copy as Python objects."""
    values, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return (values[x:y] for x, y in zip(at, at[1:]))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text", path: str = TOKENIZER,
                         part_chars: int = 1 << 20) -> DataFrame:
    """Rendered and encoded conversations, in parts of whole turns (PARTS_SCHEMA).

    A conversation's parts are in the order of ``part``, whose numbers have
    gaps; ``whole`` says that a part is known to be its whole conversation.
    """
    def run(batches):
        def pack(conv, part, whole, turns):
            text, starts, ends = render(turns)
            ids, token_ends = encode(text, path)
            return conv, part, whole, len(turns), text, ids, token_ends, mask(token_ends, starts, ends)

        def batch(done):
            conv, part, whole, n, text, ids, token_ends, under = zip(*done)
            return pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.int64()), pa.array(part, pa.int64()), pa.array(whole, pa.bool_()),
                 pa.array(n, pa.int64()), pa.array(text, pa.string()), _lists(ids, pa.int32()),
                 _lists(token_ends, pa.int32()), _lists(under, pa.bool_())],
                ["conv_id", "part", "whole", "n_turns", "formatted", "input_ids", "token_ends", "loss_mask"])
        # ranges come in order of the partition's number; the first and the last conversation may go on beyond it
        part, fresh = TaskContext.get().partitionId() << 32, False
        turns, size, now, done, held = [], 0, None, [], 0
        for b in batches:
            for conv, role, text in zip(*(c.to_pylist() for c in b.columns)):
                other = now is not None and (conv,) != now
                if turns and (other or size >= part_chars):
                    done.append(pack(now[0], part, fresh and other, turns))
                    held += size
                    turns, size, part, fresh = [], 0, part + 1, other
                    if held >= part_chars:
                        yield batch(done)
                        done, held = [], 0
                now = (conv,)
                turns.append((role, text))
                size += len(role) + len(text)
        if turns:
            done.append(pack(now[0], part, False, turns))
        if done:
            yield batch(done)
    return rows.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                       F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")) \
        .repartitionByRange("conv_id", "turn", F.substring("role", 1, KEY_CHARS), F.substring("text", 1, KEY_CHARS)) \
        .sortWithinPartitions("conv_id", "turn", "role", "text") \
        .select("conv_id", "role", "text").mapInArrow(run, PARTS_SCHEMA)


def _rows(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)],
                                      [n for n, _ in fields])


def read_back(parts: DataFrame) -> DataFrame:
    """Per conversation what its formatted text, tokens and mask hold, whatever the order of the parts' rows."""
    sums = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    pieces = [*sums, ("part", pa.int64()), ("turns", pa.binary()), ("loss", pa.binary())]
    sums_schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                   "formatted_chars long")

    def read(batches):
        for b in batches:
            done = []
            for conv, part, whole, text, ends, under in zip(
                    b.column("conv_id").to_pylist(), b.column("part").to_pylist(), b.column("whole").to_pylist(),
                    b.column("formatted").to_pylist(), _pieces(b.column("token_ends")), _pieces(b.column("loss_mask"))):
                at, turns = 0, []
                for m in _ONE_TURN.finditer(text):
                    if m.start() != at:
                        raise ValueError(f"conversation {conv}: text between turns at {at}")
                    at = m.end()
                    turns.append(f"{unescape(m[1])}\n{unescape(m[2])}\n")
                if at != len(text):
                    raise ValueError(f"conversation {conv}: cut short at {at}")
                # runs of masked tokens: the tokens where the mask turns on and off
                turn = np.flatnonzero(np.diff(under.astype(np.int8), prepend=0, append=0))
                border = np.concatenate([[0], ends])[turn].tolist()
                loss = unescape("".join(text[x:y] for x, y in zip(border[::2], border[1::2])))
                said, heard = "".join(turns).encode(), loss.encode()
                if whole:
                    done.append((conv, len(turns), hashlib.sha256(said).hexdigest(), len(loss),
                                 hashlib.sha256(heard).hexdigest(), len(text), part, None, None))
                else:
                    done.append((conv, len(turns), None, len(loss), None, len(text), part, said, heard))
            if done:
                yield _rows(done, pieces)

    def join(batches):
        now, n, said, heard = None, [0, 0, 0], None, None
        close = lambda: (now[0], n[0], said.hexdigest(), n[1], heard.hexdigest(), n[2])
        for b in batches:
            done = []
            for conv, turns, said_sha, chars, heard_sha, size, _, s, h in zip(*(b.column(i).to_pylist()
                                                                               for i in range(b.num_columns))):
                if said_sha is not None:
                    done.append((conv, turns, said_sha, chars, heard_sha, size))
                    continue
                if (conv,) != now:
                    if now is not None:
                        done.append(close())
                    now, n, said, heard = (conv,), [0, 0, 0], hashlib.sha256(), hashlib.sha256()
                said.update(s)
                heard.update(h)
                n = [x + y for x, y in zip(n, (turns, chars, size))]
            if done:
                yield _rows(done, sums)
        if now is not None:
            yield _rows([close()], sums)
    return parts.select("conv_id", "part", "whole", "formatted", "token_ends", "loss_mask") \
        .mapInArrow(read, sums_schema + ", part long, turns binary, loss binary") \
        .repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(join, sums_schema)
