"""Conversations as one text with token ids and a loss mask over them.

A turn is written as ``<|role|>``, the role, ``<|text|>``, the text, ``<|end|>``. Inside roles and
texts ``\\`` becomes ``\\b`` and ``<`` becomes ``\\l``, so that no mark can occur there, and reading
back is exact. The marks are special tokens, so no token spans the border of a text. The whole
conversation is encoded once with offsets, and each token's span is looked up among the sorted
spans of the turns by binary search.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import worker_state

ROLE, TEXT, END = "<|role|>", "<|text|>", "<|end|>"
LOSS_ROLE = "assistant"
_TURN = re.compile(r"<\|role\|>([^<]*)<\|text\|>([^<]*)<\|end\|>")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def escaped(text: str) -> str:
    return text.replace("\\", "\\b").replace("<", "\\l")


def unescaped(text: str) -> str:
    return text.replace("\\l", "<").replace("\\b", "\\")


def render(turns: list[tuple[str, str]], loss_role: str = LOSS_ROLE) -> tuple[str, list[int], list[int]]:
    """The conversation's text, and starts and ends of the texts under the loss."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{ROLE}{escaped(role)}{TEXT}", escaped(text)
        if role == loss_role and body:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), starts, ends


def overlap(token_spans: np.ndarray, starts: list[int], ends: list[int]) -> np.ndarray:
    """For each token the part of its span under the loss; empty where there is none."""
    spans = np.asarray(token_spans, np.int64).reshape(-1, 2)
    if not starts or not len(spans):
        return np.zeros_like(spans)
    begin, end = np.asarray(starts), np.asarray(ends)
    turn = np.maximum(np.searchsorted(begin, spans[:, 0], "right") - 1, 0)  # the last that begins before
    later = np.minimum(turn + 1, len(begin) - 1)
    turn = np.where((end[turn] <= spans[:, 0]) & (begin[later] < spans[:, 1]), later, turn)
    low, high = np.maximum(spans[:, 0], begin[turn]), np.minimum(spans[:, 1], end[turn])
    return np.where((low < high)[:, None], np.stack([low, high], 1), 0)


def loader(path: str):
    """The worker's tokenizer for ``path``, with the marks as special tokens and offsets not trimmed."""
    loaded = worker_state().setdefault("chat", {})
    if path not in loaded:
        from tokenizers import Tokenizer, processors

        tokenizer = Tokenizer.from_file(path)
        tokenizer.add_special_tokens([ROLE, TEXT, END])
        tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        loaded[path] = tokenizer
    return loaded[path]


FORMATTED = "conv_id long, formatted string, token_ids array<int>, token_starts array<int>, token_ends array<int>, loss_mask array<boolean>"


def format_conversations(conversations: DataFrame, tokenizer: str | None = None, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted, token_ids, token_starts, token_ends, loss_mask.

    ``token_starts`` and ``token_ends`` are offsets into ``formatted`` in code points, cut to the
    text under the loss where ``loss_mask`` is true. Turns are ordered by turn, role and text, so
    that ties and repeated rows have one order; a null turn comes first. Null roles and texts are
    empty; each row without a conv_id is a conversation of its own. Other columns are ignored. An
    empty table gives no rows. A conversation is one record and has to fit into a task.
    """
    path = tokenizer or default_tokenizer()
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"))
    whole = rows.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    whole = whole.unionByName(rows.where("conv_id is null").select("conv_id", F.array("turn").alias("turns")))

    def form(batches):
        encoder = loader(path)
        for batch in batches:
            out = []
            for conv_id, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                text, starts, ends = render([(t["role"], t["text"]) for t in turns], loss_role)
                encoding = encoder.encode(text, add_special_tokens=False)
                spans = np.asarray(encoding.offsets, np.int64).reshape(-1, 2)
                cut = overlap(spans, starts, ends)
                under = cut[:, 0] < cut[:, 1]
                spans = np.where(under[:, None], cut, spans).astype(np.int32)
                out.append((conv_id, text, encoding.ids, spans[:, 0], spans[:, 1], under))
            kinds = [pa.int64(), pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.bool_())]
            names = ["conv_id", "formatted", "token_ids", "token_starts", "token_ends", "loss_mask"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 6, kinds)], names)

    return whole.mapInArrow(form, FORMATTED)


def loss_text(formatted: str, starts, ends, mask) -> str:
    """The text under the mask. Tokens of one character share its span, so each span counts once."""
    parts, at = [], 0
    for start, end in zip(starts[mask].tolist(), ends[mask].tolist()):
        if end > at:
            parts.append(formatted[max(start, at) : end])
            at = end
    return unescaped("".join(parts))


def read_back(formatted: DataFrame) -> DataFrame:
    """From formatted conversations: conv_id, formatted, turns (role and text), loss_text."""

    def read(batches):
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            texts, turns, losses = batch.column("formatted").to_pylist(), [], []
            for i, text in enumerate(texts):
                turns.append([{"role": unescaped(r), "text": unescaped(t)} for r, t in _TURN.findall(text)])
                spans = [
                    batch.column(c)[i].values.to_numpy(zero_copy_only=False)
                    for c in ("token_starts", "token_ends", "loss_mask")
                ]
                losses.append(loss_text(text, *spans))
            yield pa.record_batch(
                [batch.column("conv_id"), pa.array(texts, pa.string()), pa.array(turns, kind), pa.array(losses, pa.string())],
                ["conv_id", "formatted", "turns", "loss_text"],
            )

    return formatted.mapInArrow(
        read, "conv_id long, formatted string, turns array<struct<role string, text string>>, loss_text string"
    )
