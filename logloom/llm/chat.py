"""Chat formatting with offset-aligned loss masks.

Template (fixed here): a turn of the assistant is ``<s>role\\ntext</s>``, any
other turn ``[INST]role\\ntext[/INST]``, each with a line break behind it.  Inside texts and roles a control string gets
one backslash after its bracket (``<\\s>``), and one that already has backslashes gets one
more, so that undoing it takes one away again; line breaks and backslashes of roles are
written as ``\\n`` and ``\\\\``.

A conversation is rendered whole, in the order of its turns, and encoded once with
offsets.  The spans of assistant texts and the spans of tokens are both sorted;
each token finds the turns it meets by binary search, and what both share is
the loss mask of that token.

Rows of a conversation are brought together by a shuffle and a sort, and read as a stream:
a conversation longer than ``SEGMENT`` characters is encoded in pieces that end
between turns, where the pattern of the tokenizer always cuts, so memory is bounded at any length.

Defined results: null text is empty text, null role an empty role; turns with equal
numbers are ordered by role and text, null turns first; repeated rows are repeated turns; a
null conversation id is a conversation; other columns are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.bytebpe import rank_encoding, read_ranks
from logloom.llm.common import BATCH_ROWS, prepare

SEGMENT = 1_000_000
ASSISTANT = "assistant"

_GUARD = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]))")
_UNGUARD = re.compile(r"([<\[])(\\*)\\(/?(?:s>|INST\]))")
_LONG_SPACE = re.compile(r"(?<!\s)\s{10000}")
_TURN = re.compile(r"(<s>|\[INST\])(.*?)\n(.*?)(?:</s>|\[/INST\])", re.S)


def guarded(text: str) -> str:
    return _GUARD.sub(r"\1\2\\\3", text)


def unguarded(text: str) -> str:
    return _UNGUARD.sub(r"\1\2\3", text)


def _role_out(role: str) -> str:
    return guarded(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_in(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unguarded(role))


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and the span of its text in it."""
    opening, closing = ("<s>", "</s>\n") if role == ASSISTANT else ("[INST]", "[/INST]\n")
    head, body = f"{opening}{_role_out(role)}\n", guarded(text)
    return head + body + closing, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a rendered conversation."""
    return [(_role_in(m[2]), unguarded(m[3])) for m in _TURN.finditer(formatted)]


def loss_spans(tokens: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Meeting of sorted token spans with sorted, disjoint turn spans: (token number, span) of each shared stretch."""
    if not len(tokens) or not len(turns):
        return np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    first = np.searchsorted(turns[:, 1], tokens[:, 0], side="right")
    last = np.searchsorted(turns[:, 0], tokens[:, 1], side="left")
    n = np.maximum(last - first, 0)
    token = np.repeat(np.arange(len(tokens)), n)
    turn = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
    spans = np.stack([np.maximum(tokens[token, 0], turns[turn, 0]), np.minimum(tokens[token, 1], turns[turn, 1])], axis=1)
    return token, spans


def masked_text(text: str, spans: np.ndarray) -> str:
    """The characters under the sorted spans; tokens that share a character show it once."""
    if not len(spans):
        return ""
    reach = np.maximum.accumulate(spans[:, 1])
    apart = np.flatnonzero(spans[1:, 0] > reach[:-1]) + 1  # first spans of the runs without a gap
    starts = spans[np.append(0, apart), 0]
    ends = reach[np.append(apart - 1, len(spans) - 1)]
    return "".join([text[a:b] for a, b in zip(starts.tolist(), ends.tolist())])


PIECE = pa.schema(
    [("piece", pa.int64()), ("turns", pa.int64()), ("formatted", pa.string())]
    + [(name, pa.list_(pa.int32())) for name in ("ids", "loss", "starts", "ends")]
)


def encoder(path: str, pattern: str) -> Callable[[str], tuple[np.ndarray, np.ndarray]]:
    """A function from a text to its ids and the characters (start, end) of each; control strings are ordinary text.

    ``path`` is a file of ranks (``.tiktoken``, cut by ``pattern``) or a tokenizer with a pattern of its own (``.json``).
    """
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        tokenizer.no_truncation()

        def encode(text: str) -> tuple[np.ndarray, np.ndarray]:
            found = tokenizer.encode(text, add_special_tokens=False)
            return np.array(found.ids, np.int32), np.array(found.offsets, np.int64).reshape(-1, 2)

        return encode

    ranks = read_ranks(path)
    encoding, match = rank_encoding(ranks, pattern), regex.compile(pattern).findall
    length = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    for word, rank in ranks.items():
        length[rank] = len(word)

    def encode_ranks(text: str) -> tuple[np.ndarray, np.ndarray]:
        if _LONG_SPACE.search(text):  # more than the encoder's own matching can hold
            found = list(chain.from_iterable(map(encoding._encode_single_piece, match(text))))
        else:
            found = encoding.encode_ordinary(text)
        ids = np.array(found, np.int32)
        ends = np.cumsum(length[ids])
        spans = np.stack([ends - length[ids], ends], axis=1)
        if not text.isascii():
            # Bytes to characters: a token holds every character of which it has a byte.
            raw = np.frombuffer(text.encode("utf-8"), np.uint8)
            character = np.cumsum((raw & 0xC0) != 0x80) - 1
            spans = np.stack([character[spans[:, 0]], character[spans[:, 1] - 1] + 1], axis=1)
        return ids, spans

    return encode_ranks


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) for x in parts])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).astype(np.int32)))


def _pieces(batches: Iterator[pa.RecordBatch], path: str, pattern: str, segment: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path, pattern)

    def piece(conv, number, turns):
        text, spans, at = [], [], 0
        for role, body in turns:
            shown, a, b = render(role, body)
            if role == ASSISTANT and b > a:
                spans.append((at + a, at + b))
            text.append(shown)
            at += len(shown)
        text = "".join(text)
        ids, offsets = encode(text)
        token, found = loss_spans(offsets, np.array(spans, np.int64).reshape(-1, 2))
        return conv, number, len(turns), text, ids, token, found[:, 0], found[:, 1]

    def packed(rows, kind):
        conv, number, turns, text, *lists = zip(*rows)
        plain = [pa.array(v, t) for v, t in zip((conv, number, turns, text), (kind, *PIECE.types))]
        return pa.RecordBatch.from_arrays([*plain, *map(_lists, lists)], names=["conv_id", *PIECE.names])

    rows, waiting = [], 0
    current, number, turns, size, kind = None, 0, [], 0, None
    for batch in batches:
        kind = batch.schema.field(0).type
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2))):
            if turns and (conv != current or size >= segment):
                rows.append(piece(current, number, turns))
                waiting += size
                if len(rows) >= BATCH_ROWS or waiting >= SEGMENT:
                    yield packed(rows, kind)
                    rows, waiting = [], 0
                number = number + 1 if conv == current else 0
                turns, size = [], 0
            current = conv
            turns.append((role or "", text or ""))
            size += len(text or "")
    if turns:
        rows.append(piece(current, number, turns))
    if rows:
        yield packed(rows, kind)


def format_chats(
    turns: DataFrame, tokenizer: str, segment: int | None = None, pattern: str = public_tokenizers.PATTERN,
    key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Rendered conversations in pieces of whole turns (one piece for all but the longest).

    Columns: conv_id, piece, turns, formatted, ids, and the loss mask: ``loss`` (number of the token),
    ``starts`` and ``ends`` (the characters of the piece under that token's mask).
    """
    prepare(turns.sparkSession)
    kind = turns.schema[key].dataType.simpleString()
    rows = turns.select(F.col(key).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    most = segment or SEGMENT
    return rows.mapInArrow(
        lambda b: _pieces(b, tokenizer, pattern, most),
        f"conv_id {kind}, piece bigint, turns bigint, formatted string, ids array<int>, loss array<int>, "
        "starts array<int>, ends array<int>",
    )
