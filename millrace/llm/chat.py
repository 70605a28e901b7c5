"""Chat formatting by token-level assembly.

Every role and text is encoded by itself and put between reserved ids, which lie beyond the
vocabulary, so no content can produce them. The loss mask follows from prefix sums of the segments'
lengths. For use as plain text the same conversation is also rendered with control strings; where a
role or text contains one, or the escape character, it is escaped, so `parse` gives the turns back.

Token layout of a turn: TURN, ids of the role, SAYS, ids of the text, END. The mask is 1 on the ids of
an assistant's text only. Text layout: `<turn>role:\\n`, the text, `</turn>\\n`.

Defined results: a null text or role is empty; turns of equal number keep the order role, text; a
conversation whose id is null is one conversation; repeated rows are turns of their own; texts of any length
are taken whole; extra columns are left out; an empty table gives an empty result. A conversation is a
row of the output, so its turns are gathered in one task; tasks work on SLICE bytes of conversations at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bpe import tokenizer
from millrace.llm.common import list_array, portions, spread, with_columns

OPEN, SHUT, ESCAPE = "<turn>", "</turn>", "\\"
#: A control string is escaped by a backslash before it; so is every backslash.
CONTROL = regex.compile(r"<turn>|</turn>|\\")
ESCAPED = regex.compile(r"\\(<turn>|</turn>|\\)")
#: In a role, what ends it is escaped as well.
ROLE_CONTROL, ROLE_ESCAPED = regex.compile(r"<turn>|</turn>|\\|:\n"), regex.compile(r"\\(<turn>|</turn>|\\|:\n)")
SHOWN = regex.compile(r"<turn>((?:\\(?:<turn>|</turn>|\\|:\n)|[^\\<:]++|<(?!/?turn>)|:(?!\n))*+):\n((?:\\(?:<turn>|</turn>|\\)|[^\\<]++|<(?!/?turn>))*+)</turn>\n")
SLICE = 2_000_000
TURN, SAYS, END = 0, 1, 2  # added to the vocabulary's size

SCHEMA = "conv_id long, ids array<int>, loss_mask array<byte>, formatted string"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: ESCAPE + m[0], text) if "<" in text or ESCAPE in text else text


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text) if ESCAPE in text else text


def render(role: str, text: str) -> str:
    """A turn as plain text."""
    return f"{OPEN}{ROLE_CONTROL.sub(lambda m: ESCAPE + m[0], role)}:\n{escape(text)}{SHUT}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of a rendered conversation; ValueError if it isn't one."""
    turns, at = [], 0
    while at < len(formatted):
        m = SHOWN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((ROLE_ESCAPED.sub(lambda x: x[1], m[1]), unescape(m[2])))
        at = m.end()
    return turns


def _is_loss(roles: list[str]) -> np.ndarray:
    return np.array([r == "assistant" for r in roles], bool)


def assemble(bpe, roles: list[str], words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, mask and the ids' count of every turn."""
    segments = [s for pair in zip(roles, words) for s in (pair[0], escape(pair[1]))]
    # an added token's string inside a text is plain text here, not the token
    flat, lens = bpe.encode_plain(segments)
    role_len, text_len = lens[0::2], lens[1::2]
    size = role_len + text_len + 3
    end = np.cumsum(size)
    start = end - size
    ids = np.zeros(end[-1] if len(end) else 0, np.int32)
    fixed = np.zeros(len(ids), bool)
    for at, kind in ((start, TURN), (start + role_len + 1, SAYS), (end - 1, END)):
        ids[at] = bpe.n + kind
        fixed[at] = True
    ids[~fixed] = flat
    # +1 where a text that counts begins and -1 where it ends; the running sum is the mask
    edge = np.zeros(len(ids) + 1, np.int8)
    counts = _is_loss(roles)
    np.add.at(edge, (start + role_len + 2)[counts], 1)
    np.add.at(edge, (end - 1)[counts], -1)
    return ids, np.cumsum(edge)[:-1].astype(np.int8), size


def format_chats(turns: DataFrame, path: str) -> DataFrame:
    """conv_id, turn, role, text -> a row for each conversation: ids, loss_mask, formatted."""
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(said)).alias("said"))
    grouped = grouped.select("conv_id", F.col("said.role").alias("roles"), F.col("said.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for whole in batches:
            size = pa.compute.binary_length(whole.column(2).flatten()).to_numpy()
            ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(pa.compute.list_value_length(whole.column(2)).to_numpy())])]
            for batch in portions(whole, np.diff(ends) + 1, SLICE):
                per = pa.compute.list_value_length(batch.column(1)).to_numpy()
                roles, words = batch.column(1).flatten().to_pylist(), batch.column(2).flatten().to_pylist()
                ids, mask, size = assemble(bpe, roles, words)
                bounds = np.concatenate([[0], np.cumsum(per)])
                total = np.concatenate([[0], np.cumsum(size)])[bounds]
                shown = [render(r, w) for r, w in zip(roles, words)]
                text = ["".join(shown[x:y]) for x, y in zip(bounds, bounds[1:])]
                lens = np.diff(total)
                yield pa.RecordBatch.from_arrays([batch.column(0), list_array(ids, lens), list_array(mask, lens), pa.array(text)], names=["conv_id", "ids", "loss_mask", "formatted"])

    return grouped.mapInArrow(run, SCHEMA)


def read_back(chats: DataFrame, path: str) -> DataFrame:
    """chats without ids and mask, with roles, texts and the texts under the mask, recovered from those two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for whole in batches:
            for batch in portions(whole, pa.compute.list_value_length(whole.column(whole.schema.get_field_index("ids"))).to_numpy() * 4, SLICE):
                ids_of, mask_of = (batch.column(batch.schema.get_field_index(n)) for n in ("ids", "loss_mask"))
                ids, mask = ids_of.flatten().to_numpy().astype(np.int64), mask_of.flatten().to_numpy().astype(bool)
                ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(ids_of).to_numpy())])
                first, says, last = (np.flatnonzero(ids == bpe.n + k) for k in (TURN, SAYS, END))
                roles, words = _segments(bpe, ids, first, says), [unescape(t) for t in _segments(bpe, ids, says, last)]
                # the mask's runs: each lies between a SAYS and an END
                up = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8)])) == 1)
                down = np.flatnonzero(np.diff(np.concatenate([mask.astype(np.int8), [0]])) == -1)
                loss = [unescape(t) for t in _segments(bpe, ids, up - 1, down + 1)]
                turn_at, loss_at = np.searchsorted(first, ends).tolist(), np.searchsorted(up, ends).tolist()
                cut = lambda x, at: [x[i:j] for i, j in zip(at, at[1:])]
                new = {n: pa.array(cut(x, at), pa.list_(pa.string())) for n, x, at in (("roles", roles, turn_at), ("texts", words, turn_at), ("loss_texts", loss, loss_at))}
                yield with_columns(batch, ("ids", "loss_mask"), **new)

    strings = T.ArrayType(T.StringType())
    kept = [f for f in chats.schema.fields if f.name not in ("ids", "loss_mask", "roles", "texts", "loss_texts")]
    return chats.mapInArrow(run, T.StructType([*kept, *(T.StructField(n, strings) for n in ("roles", "texts", "loss_texts"))]))


def _segments(bpe, ids: np.ndarray, before: np.ndarray, after: np.ndarray) -> list[str]:
    """The texts of the ids strictly between pairs of positions."""
    lens = after - before - 1
    return bpe.decode(ids[spread(before + 1, lens)], lens)
