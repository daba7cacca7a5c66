"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole by a template, encoded once with character offsets, and the sorted spans of its turns are
intersected with the sorted spans of its tokens by binary search: a token is under the loss if it lies in an assistant's text.

Template, per turn: ``<|turn|>`` role ``<|text|>`` text ``<|end|>``. The markers are tokens of their own (ids after the
vocabulary's last), so no token ever reaches over the edge of a text. Control strings inside roles and texts are
escaped: ``\\`` is doubled, and ``\\`` is put after the first character of any of ``CONTROL``. ``unescaped`` undoes exactly
that, so texts come back as they were.

Rows are brought together by conversation and streamed in turn order. A conversation is rendered in blocks of at most
``block_chars`` that end with a turn; as markers are never merged with text, the blocks' tokens are those of the whole, and memory stays
bounded however long a conversation is.

Defined results: a null text is empty, a null role is the empty role; turns are ordered by turn (null first), then role,
then text, so repeated rows and ties give one result; a null conversation id is a conversation of its own;
an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, text_or_empty

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that some chat template or tokenizer treats as control; none is left whole inside a text.
CONTROL = ["<|", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<pad>", "<unk>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
    """Formatted text; starts and ends (characters) of the turns' texts."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
        starts.append(at + len(head))
        ends.append(at + len(head) + len(body))
        parts += (head, body, END)
        at = ends[-1] + len(END)
    return "".join(parts), np.array(starts, np.int64), np.array(ends, np.int64)


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, unescaped."""
    out = []
    for piece in formatted.split(TURN)[1:]:
        role, _, text = piece.partition(TEXT)
        out.append((unescaped(role), unescaped(text[:-len(END)])))
    return out


@lru_cache(maxsize=2)
def chat_tokenizer(path: str | None):
    import public_tokenizers
    from tokenizers import AddedToken, Tokenizer, processors

    whole = Tokenizer.from_file(str(path or public_tokenizers.path("byte_bpe_50k.json")))
    whole.post_processor = processors.ByteLevel(trim_offsets=False)
    whole.add_special_tokens([AddedToken(t, normalized=False, special=True) for t in (TURN, TEXT, END)])
    return whole


def loss_mask(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """True for tokens that lie in a learned turn's text. ``spans``: (n, 2) sorted offsets; starts and ends: sorted turns."""
    turn = np.searchsorted(starts, spans[:, 0], side="right") - 1
    inside = (turn >= 0) & (spans[:, 1] > spans[:, 0])
    turn = np.maximum(turn, 0)
    return inside & (spans[:, 1] <= ends[turn]) & learned[turn] if len(starts) else inside


def format_block(turns: list[tuple[str, str]], path: str | None, learn: tuple[str, ...] = ("assistant",)) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """Formatted text, token ids, offsets (n, 2), loss mask."""
    text, starts, ends = rendered(turns)
    encoding = chat_tokenizer(path).encode(text, add_special_tokens=False)
    spans = np.array(encoding.offsets, np.int64).reshape(-1, 2)
    learned = np.array([role in learn for role, _ in turns], bool)
    return text, np.array(encoding.ids, np.int32), spans, loss_mask(spans, starts, ends, learned)


def learned_text(text: str, spans: np.ndarray, mask: np.ndarray) -> list[str]:
    """What stands under the mask, piece by piece, still escaped. Tokens of parts of one character share its span."""
    under = spans[mask]
    if not len(under):
        return []
    cut = np.flatnonzero(under[1:, 0] > np.maximum.accumulate(under[:, 1])[:-1]) + 1
    return [text[g[0, 0]:g[:, 1].max()] for g in np.split(under, cut)]


def _by_conversation(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    slim = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), text_or_empty(F.col(role)).alias("role"), text_or_empty(F.col(text)).alias("text"))
    return slim.repartition(shuffle_partitions(rows.sparkSession), "conv").sortWithinPartitions("conv", "turn", "role", "text")


def _blocks(batches: Iterator[pa.RecordBatch], block_chars: int) -> Iterator[tuple]:
    """(conversation, turns of a block, whether it ends the conversation), in order."""
    turns, size, now, begun = [], 0, None, False
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
            if begun and conv != now:
                yield now, turns, True
                turns, size = [], 0
            elif begun and size >= block_chars:
                yield now, turns, False
                turns, size = [], 0
            now, begun = conv, True
            turns.append((role, text))
            size += len(text) + len(role)
    if begun:
        yield now, turns, True


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         tokenizer_path: str | None = None, block_chars: int = 1 << 20, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per block of a conversation: conv, block (from 0), formatted, ids, mask, offsets (flat pairs of characters)."""
    def run(batches):
        block = 0
        for now, turns, ends in _blocks(batches, block_chars):
            formatted, ids, spans, mask = format_block(turns, tokenizer_path, learn)
            yield pa.RecordBatch.from_pydict({"conv": pa.array([now]), "block": [block], "formatted": [formatted], "ids": pa.array([ids], pa.list_(pa.int32())),
                                              "mask": pa.array([mask], pa.list_(pa.bool_())), "offsets": pa.array([spans.ravel()], pa.list_(pa.int64()))})
            block = 0 if ends else block + 1

    slim = _by_conversation(rows, conv, turn, role, text)
    kind = slim.schema["conv"].dataType.simpleString()
    return slim.mapInArrow(run, f"conv {kind}, block bigint, formatted string, ids array<int>, mask array<boolean>, offsets array<bigint>").withColumnRenamed("conv", conv)


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Digests of what the formatted blocks hold, one row per conversation: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_tokens, loss_tokens. Blocks are streamed in order, never gathered."""
    def run(batches):
        now, begun, state = None, False, None
        out = []

        def fresh():
            return {"turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "tokens": 0, "loss_tokens": 0}

        def row():
            return (now, state["turns"], state["all"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"], state["tokens"], state["loss_tokens"])

        kind = None
        for batch in batches:
            kind = batch.schema.field(conv).type
            for r in range(batch.num_rows):
                c = batch.column(conv)[r].as_py()
                if not begun or c != now or batch.column("block")[r].as_py() == 0:
                    if begun:
                        out.append(row())
                    now, begun, state = c, True, fresh()
                text = batch.column("formatted")[r].as_py()
                mask = np.array(batch.column("mask")[r].as_py(), bool)
                spans = batch.column("offsets")[r].values.to_numpy().reshape(-1, 2)
                for role, said in parsed(text):
                    state["turns"] += 1
                    state["all"].update(f"{role}\n{said}\n".encode())
                for piece in learned_text(text, spans, mask):
                    said = unescaped(piece)
                    state["loss"].update(said.encode())
                    state["loss_chars"] += len(said)
                state["chars"] += len(text)
                state["tokens"] += len(mask)
                state["loss_tokens"] += int(mask.sum())
            if len(out) >= 1000:
                yield _digests(out, conv, kind)
                out = []
        if begun:
            out.append(row())
        if out:
            yield _digests(out, conv, kind)

    kind = formatted.schema[conv].dataType.simpleString()
    return formatted.mapInArrow(run, f"`{conv}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_tokens bigint, loss_tokens bigint")


def _digests(rows: list[tuple], conv: str, kind: pa.DataType) -> pa.RecordBatch:
    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens", "loss_tokens"]
    types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
