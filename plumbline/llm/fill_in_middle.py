"""Fill-in-middle texts assembled by a secondary sort, with digests of the output and of the text restored from it.

Every text is cut at two places drawn from its id, and leaves its row as pieces of at most ``CHUNK`` code points, each
keyed by row and by its place in the output; marks are pieces too. Pieces are dealt to partitions by row and sorted inside
them (``repartitionAndSortWithinPartitions`` in its DataFrame form), so each output streams by in order: one incremental
digest, never a whole text. Reading the stream, marks tell which segment a piece belongs to; the pieces are then sorted again
by segment, inside the partitions they are already in, and stream into the digest of the restored text. One shuffle in all.

``transformed`` returns the output texts themselves, ``digests`` streams. Form: plain if the text is empty or has one of the
marks in it or the draw says so, else suffix-first (spm) or prefix-first (psm).

Null text: like an empty one, plain. A null id draws like the empty string. Repeated rows (equal ids, or equal rows) are
rows of their own: the key of a row is its place in the input, so the input has to read back in the same order (files do; write
other tables out first). Ties do not arise. Empty tables give empty results; further columns are kept by ``transformed`` (one named
like a result column is replaced) and ignored by ``digests``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
CHUNK = 16_384
PLAIN_FROM, SPM_BELOW = 90, 20
#: pieces handed over at a time, in code points
BATCH = 4_000_000

SEGMENTS = {"plain": ("text",), "psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
MARK_OF = {"prefix": PREFIX, "middle": MIDDLE, "suffix": SUFFIX}
#: order of the segments in the restored text
PLACE = {"text": 0, "prefix": 0, "middle": 1, "suffix": 2}


def _drawn(doc_id: Column, group: int, seed: str) -> Column:
    """The ``group``-th eight hex digits of the digest of seed and id, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * group - 7, 8), 16, 10).cast("long")


def plan(text: Column, doc_id: Column, seed: str = "1") -> dict[str, Column]:
    """n, form, and the ends of prefix and middle, in code points."""
    body = F.coalesce(text, F.lit(""))
    n = F.length(body).cast("long")
    one, two, three, four = (_drawn(doc_id, g, seed) for g in (1, 2, 3, 4))
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.contains(body, F.lit(mark))
    return {
        "n": n,
        "form": F.when((n == 0) | marked | (three % 100 >= PLAIN_FROM), "plain").when(four % 100 < SPM_BELOW, "spm").otherwise("psm"),
        "prefix_end": F.least(one % (n + 1), two % (n + 1)), "middle_end": F.greatest(one % (n + 1), two % (n + 1))}


def transformed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: str = "1", out: str = "fim_text") -> DataFrame:
    """``docs`` with ``fim_form`` and the transformed text, built in one row each: for texts that fit one."""
    own = plan(docs[text], docs[doc_id], seed)
    body, a, b = F.coalesce(docs[text], F.lit("")), own["prefix_end"].cast("int"), own["middle_end"].cast("int")
    part = {"prefix": F.substring(body, F.lit(1), a), "middle": F.substring(body, a + 1, b - a), "suffix": F.substring(body, b + 1, own["n"].cast("int") - b)}
    whole = {form: F.concat(*[x for s in SEGMENTS[form] for x in (F.lit(MARK_OF[s]), part[s])]) for form in ("spm", "psm")}
    kept = [docs[c] for c in docs.columns if c not in ("fim_form", out)]
    return docs.select(*kept, own["form"].alias("fim_form"),
                       F.when(own["form"] == "plain", body).when(own["form"] == "spm", whole["spm"]).otherwise(whole["psm"]).alias(out))


PIECES = "row bigint, at bigint, piece string, doc_id {id}, n bigint, form string, prefix_chars bigint, middle_chars bigint"


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows to pieces. Facts of the row travel with its first piece only."""
    for batch in batches:
        out, size = [], 0
        for row, doc_id, text, form, a, b in zip(batch["row"], batch["doc_id"], batch["text"], batch["form"], batch["prefix_end"], batch["middle_end"]):
            text = text or ""
            ends = {"text": (0, len(text)), "prefix": (0, a), "middle": (a, b), "suffix": (b, len(text))}
            plain = form == "plain"
            facts = (doc_id, len(text), form, None if plain else a, None if plain else b - a)
            at = 0
            for segment in SEGMENTS[form]:
                start, end = ends[segment]
                if not plain:
                    out.append((row, at, MARK_OF[segment], *facts))
                    at, facts = at + 1, (None,) * 5
                for k in range(start, max(end, start + plain), CHUNK):  # an empty plain text is one empty piece
                    out.append((row, at, text[k:min(k + CHUNK, end)], *facts))
                    at, facts = at + 1, (None,) * 5
                    size += CHUNK if end - k > CHUNK else end - k
                    if size >= BATCH:
                        yield _frame(out)
                        out, size = [], 0
        if out:
            yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["row", "at", "piece", "doc_id", "n", "form", "prefix_chars", "middle_chars"], dtype=object)
    for c in ("n", "prefix_chars", "middle_chars"):
        frame[c] = frame[c].astype("Int64")
    return frame


def _assembled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces in output order: the digest of each output, and the pieces with their place in the restored text.

    A piece is a mark only if the form has marks and the piece reads like one: texts with a mark in them are plain.
    """
    row, digest, form, segment, facts = None, None, None, None, None

    def closing():
        return (row, 3, 0, None, *facts[:5], digest.hexdigest())

    for batch in batches:
        out = []
        for own, at, piece, *given in batch[["row", "at", "piece", "doc_id", "n", "form", "prefix_chars", "middle_chars"]].itertuples(index=False, name=None):
            if own != row:
                if row is not None:
                    out.append(closing())
                row, digest, facts, form, segment = own, hashlib.sha256(), given, given[2], "text"
            digest.update(piece.encode())
            if form != "plain" and piece in MARKS:
                segment = next(s for s, m in MARK_OF.items() if m == piece)
            else:
                out.append((row, PLACE[segment], at, piece, *(None,) * 5, None))
        yield _with_digest(out)
    if row is not None:
        yield _with_digest([closing()])


def _with_digest(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["row", "place", "at", "piece", "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"], dtype=object)
    for c in ("n", "prefix_chars", "middle_chars"):
        frame[c] = frame[c].astype("Int64")
    return frame


def _restored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces in the order of the restored text; the row of facts comes last and closes the text."""
    digest = hashlib.sha256()
    for batch in batches:
        out = []
        for place, piece, *facts in batch[["place", "piece", "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]].itertuples(index=False, name=None):
            if place == 3:
                out.append((*facts, digest.hexdigest()))
                digest = hashlib.sha256()
            else:
                digest.update(piece.encode())
        frame = pd.DataFrame(out, columns=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"], dtype=object)
        for c in ("n", "prefix_chars", "middle_chars"):
            frame[c] = frame[c].astype("Int64")
        yield frame


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: str = "1") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256: one row for each row of ``docs``."""
    kind = docs.schema[doc_id].dataType.simpleString()
    named = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    own = plan(F.col("text"), F.col("doc_id"), seed)
    rows = named.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("string").alias("doc_id"), "text", own["form"].alias("form"),
                        own["prefix_end"].alias("prefix_end"), own["middle_end"].alias("middle_end"))
    pieces = rows.mapInPandas(_cut, PIECES.format(id="string"))
    facts = "doc_id string, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string"
    sent = pieces.repartition("row").sortWithinPartitions("row", "at")
    out = sent.mapInPandas(_assembled, f"row bigint, place int, at bigint, piece string, {facts}").sortWithinPartitions("row", "place", "at")
    done = out.mapInPandas(_restored, f"{facts}, restored_sha256 string")
    return done.withColumn("doc_id", F.col("doc_id").cast(kind))
