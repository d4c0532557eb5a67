"""Chat formatting with loss masks from offsets.

A conversation is rendered as a whole; its turns' texts are known as spans of characters.  The
whole is encoded once, with the character offsets of every token, and each assistant span is
met with the sorted token spans by binary search, which gives ranges of tokens under the loss.

Template, per turn: ``<|im_start|>role<|im_sep|>text<|im_end|>``.  These strings are control
tokens of their own behind the vocabulary's ids, so no token crosses a text's edge.  Inside roles
and texts each ``<``, any number of backslashes and ``|`` gets one more backslash; taking it away
again gives the text back, and no control string can appear within it.

Turns are ordered by turn, role and text, null first; null role or text is empty.  Repeated
rows are turns of their own.  Rows without a conversation's id form one conversation.  An empty
table gives no conversation; other columns are not read.  The turns of a conversation make one
string, so a conversation must fit into a row; partial lists are made before the shuffle.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, processors

from aerolith.llm.tokens import VOCABULARY

OPEN, SEP, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", re.DOTALL)
FORMATTED = (
    "conv_id long, n_turns long, formatted string, input_ids array<int>, "
    "loss_tokens array<struct<first:int,last:int>>, loss_chars array<struct<first:int,last:int>>"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text) if "<" in text else text


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The whole conversation, and the spans of the assistant's texts in it."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{SEP}", escape(text)
        at += len(head)
        if role == "assistant" and body:
            spans.append((at, at + len(body)))
        out += [head, body, CLOSE]
        at += len(body) + len(CLOSE)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a rendered conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


@lru_cache(maxsize=2)
def chat_tokenizer(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets keep leading spaces
    tokenizer.add_special_tokens([AddedToken(t, normalized=False, special=True) for t in (OPEN, SEP, CLOSE)])
    return tokenizer


def token_ranges(offsets: np.ndarray, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """For each character span the range [first, last) of tokens that lie within it; both sorted."""
    s = np.array(spans, np.int64).reshape(-1, 2)
    first = np.searchsorted(offsets[:, 0], s[:, 0], "left")
    last = np.searchsorted(offsets[:, 1], s[:, 1], "right")
    return list(zip(first.tolist(), last.tolist(), strict=True))


def format_conversations(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per conversation: the rendered text, token ids, and the assistant's texts as ranges of tokens.

    ``loss_chars`` are the characters of ``formatted`` that the tokens under the loss cover.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = chat_tokenizer(vocabulary)
        pair = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pair, pair]
        names = ["conv_id", "n_turns", "formatted", "input_ids", "loss_tokens", "loss_chars"]
        for batch in batches:
            for conv_id, turns in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                said = [(t["role"] or "", t["text"] or "") for t in turns.as_py()]
                formatted, spans = render(said)
                encoded = tokenizer.encode(formatted, add_special_tokens=False)
                offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
                ranges = token_ranges(offsets, spans)
                chars = [(int(offsets[i, 0]), int(offsets[j - 1, 1])) for i, j in ranges]
                values = (
                    conv_id, len(said), formatted, encoded.ids,
                    [{"first": i, "last": j} for i, j in ranges], [{"first": i, "last": j} for i, j in chars],
                )
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    turn = F.struct("turn", F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id"))
    listed = grouped.agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return listed.mapInArrow(run, FORMATTED)


def digests(formatted: DataFrame) -> DataFrame:
    """What ``format_conversations`` gave, read back: digests of the turns and of all text under the loss mask."""
    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv_id, text, spans in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[s["first"] : s["last"]]) for s in spans)
                said = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append(
                    (conv_id, len(turns), sha256(said.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest(), len(text))
                )
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) or [()] * 6
            names = [c.split()[0] for c in kind.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return formatted.select("conv_id", "formatted", "loss_chars").mapInArrow(run, kind)
