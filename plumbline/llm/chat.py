"""Chat formatting with a loss mask that is aligned by offsets.

A conversation is rendered whole: ``<turn role>\\n text </turn>\\n`` for each turn, with ``\\``, ``<`` and ``>`` inside
roles and texts escaped by a backslash, so an unescaped ``<`` is always the template's and rendering can be undone.
The rendered text is encoded once, with offsets. The spans of the assistant texts are sorted, and so are the tokens, so
binary search finds the tokens that meet a span. A token that also covers template characters is masked for its
part inside the span only; ``loss_spans`` has those parts, in code points of the rendered text.

Null role or text: empty. Turns are ordered by turn, role, text (null first); equal rows are kept as often as they
stand there. An empty text has an empty span and no masked token. An empty table gives an empty result; further
columns are ignored. A rendered conversation is one value, so one conversation must fit a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SCHEMA = ("conv_id bigint, formatted string, token_ids array<int>, loss_mask array<boolean>, "
          "loss_spans array<struct<start:int,end:int>>")
TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>\n((?:[^\\<>]|\\.)*)</turn>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def _escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([\\<>])", r"\\$1")


def render(turns: DataFrame) -> DataFrame:
    """conv_id, formatted: one text for each conversation."""
    turn = F.concat(F.lit("<turn "), _escaped(F.col("role")), F.lit(">\n"), _escaped(F.col("text")), F.lit("</turn>\n"))
    rows = turns.select("conv_id", F.struct("turn", "role", "text", turn.alias("out")).alias("t"))
    return (rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
            .select("conv_id", F.array_join("t.out", "").alias("formatted")))


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """role, text, and the span of the escaped text, of every turn."""
    return [(ESCAPED.sub(r"\1", m[1]), ESCAPED.sub(r"\1", m[2]), m.start(2), m.end(2)) for m in TURN.finditer(formatted)]


def align(offsets: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Token mask and the covered parts of the spans; ``offsets`` (start, end) are sorted.

    Several tokens can stand for one character; their parts are merged so that each character counts once.
    """
    mask, parts = np.zeros(len(offsets), bool), []
    if len(offsets) == 0:
        return mask, parts
    starts, ends = offsets[:, 0], offsets[:, 1]
    for start, end in spans:
        low, high = np.searchsorted(ends, start, "right"), np.searchsorted(starts, end, "left")
        mask[low:high] = True
        at = start
        for s, e in zip(np.maximum(starts[low:high], start), np.minimum(ends[low:high], end)):
            s = max(int(s), at)
            if e <= s:
                continue
            if parts and parts[-1][1] == s and s > start:
                parts[-1] = (parts[-1][0], int(e))
            else:
                parts.append((s, int(e)))
            at = int(e)
    return mask, parts


def format_conversations(turns: DataFrame, tokenizer: str = TOKENIZER, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, token_ids, loss_mask (one flag a token), loss_spans."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer)
        model.encode_special_tokens = True
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.iloc[lo:lo + 256]
                rows = []
                for text, code in zip(part["formatted"], model.encode_batch(list(part["formatted"]), add_special_tokens=False)):
                    spans = [(s, e) for role, _, s, e in parse(text) if role == loss_role]
                    mask, parts = align(np.array(code.offsets, dtype=np.int64).reshape(-1, 2), spans)
                    rows.append((code.ids, mask.tolist(), [{"start": s, "end": e} for s, e in parts]))
                yield pd.DataFrame({"conv_id": part["conv_id"], "formatted": part["formatted"], "token_ids": [r[0] for r in rows],
                                    "loss_mask": [r[1] for r in rows], "loss_spans": [r[2] for r in rows]})

    return render(turns).select("conv_id", "formatted").mapInPandas(encode, SCHEMA)
