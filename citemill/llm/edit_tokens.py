"""Token counts that follow edits: only what an edit touches is encoded again.

A text is the chain of its segments, the runs between spaces and line feeds; the
tokenizer drops white space, so tokens never cross a segment. The counts of the
segments are the leaves of a tree of sums. An edit (replace the code points
``start`` to ``end`` by a new text) touches the segments it overlaps and, as
boundary context, those it adjoins; these are encoded again, the first of them
takes the new sum, the others nothing, and the sums above them are updated. All
other segments keep their counts.

Edits of a document refer to the original text. Those that touch a common
segment are done together; an edit that overlaps an earlier one (by start, end,
text) is left out and counted.

Defined cases: a null or empty text has no segment and no token; a null
replacement is empty; an edit beyond the end is cut to the text; a document
without edits keeps its count; edits of an unknown document are ignored; a null
id has no edits; rows with equal ids get the same edits each; empty tables give
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.llm.common import as_bytes, map_arrow
from citemill.llm.packing import Encoder, encoder

SCHEMA = (
    "doc_id long, n_segments long, n_tokens long, n_edits long, n_skipped long, n_reencoded long, n_tokens_after long"
)


class SumTree:
    """A segment tree of sums in one array: leaves at the end, parents at half the index."""

    def __init__(self, leaves: np.ndarray):
        self.size = 1 << max(0, int(len(leaves) - 1).bit_length())
        self.sums = np.zeros(2 * self.size, dtype=np.int64)
        self.sums[self.size : self.size + len(leaves)] = leaves
        width = self.size
        while width > 1:
            level = self.sums[width : 2 * width]
            self.sums[width // 2 : width] = level[0::2] + level[1::2]
            width //= 2

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def change(self, first: int, last: int, count: int) -> None:
        """Leaf ``first`` becomes ``count``, those up to ``last`` zero; sums above follow."""
        low, high = self.size + first, self.size + last
        self.sums[low : high + 1] = 0
        self.sums[low] = count
        while low > 1:
            low, high = low // 2, high // 2
            span = self.sums[2 * low : 2 * high + 2]
            self.sums[low : high + 1] = span[0::2] + span[1::2]


class CountedText:
    """A text with the token counts of its segments."""

    def __init__(self, text: str, encode: Encoder):
        self.text, self.encode = text, encode
        parts = text.replace("\n", " ").split(" ")
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        #: Where each segment starts; segments may be empty (between two spaces).
        self.starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        self.ends = self.starts + sizes
        self.tree = SumTree(encode.counts(parts))
        self.segments = int((sizes > 0).sum())
        self.before = self.tree.total

    def touched(self, start: int, end: int) -> tuple[int, int]:
        """First and last segment an edit overlaps or adjoins."""
        first = int(np.searchsorted(self.ends, start))
        last = int(np.searchsorted(self.starts, end, side="right")) - 1
        return first, max(first, last)

    def apply(self, edits: list[tuple[int, int, str]]) -> tuple[int, int, int]:
        """(edits made, edits left out, segments encoded again)."""
        done, skipped, again, position = 0, 0, 0, 0
        groups: list[list] = []  # first segment, last segment, edits
        n = len(self.text)
        for start, end, new in sorted(edits):
            start, end = min(max(0, start), n), min(max(0, end), n)
            if start < position or end < start:
                skipped += 1
                continue
            position = end
            first, last = self.touched(start, end)
            if groups and first <= groups[-1][1]:
                groups[-1][1] = max(last, groups[-1][1])
                groups[-1][2].append((start, end, new))
            else:
                groups.append([first, last, [(start, end, new)]])
            done += 1
        for first, last, changes in groups:
            pieces, at = [], int(self.starts[first])
            for start, end, new in changes:
                pieces += [self.text[at:start], new]
                at = end
            pieces.append(self.text[at : int(self.ends[last])])
            parts = "".join(pieces).replace("\n", " ").split(" ")
            again += sum(map(bool, parts))
            self.tree.change(first, last, int(self.encode.counts(parts).sum()))
        return done, skipped, again


def count(
    docs: DataFrame, edits: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token counts before and after the edits ``doc_id, start, end, replacement``.

    The edits of a document are one bounded list; they move to the documents'
    side of one join. Where edits are many, texts move too.
    """
    own = F.struct(
        F.col("start").cast("long").alias("start"),
        F.col("end").cast("long").alias("end"),
        F.coalesce(F.col("replacement").cast("string"), F.lit("")).alias("new"),
    )
    listed = edits.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.collect_list(own).alias("edits"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    return apply_listed(rows.join(listed, rows.doc_id == listed._id, "left").select("doc_id", "edits", "text"), tokenizer_path)


def apply_listed(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """:func:`count` for rows ``doc_id, edits, text`` (bytes) that carry their edits."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode, out = encoder(tokenizer_path), []
        texts = [(t or b"").decode("utf-8", "replace") for t in batch.column(2).to_pylist()]
        encode.learn(texts)
        for ident, edits, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            counted = CountedText(text, encode)
            done, skipped, again = counted.apply([(e["start"], e["end"], e["new"]) for e in edits or []])
            out.append((ident, counted.segments, counted.before, done, skipped, again, counted.tree.total))
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*out)], names=names)

    return map_arrow(rows, run, SCHEMA)


def revisions(docs: DataFrame) -> DataFrame:
    """The documents with edits made from their own rows: a second revision of the table.

    A word is put in at one place, up to 40 code points are cut at another and a
    third stretch is replaced by the document's source and language.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.char_length(text).cast("long")
    place = lambda salt: F.pmod(F.xxhash64(F.lit(salt), "doc_id"), size + 1)
    edit = lambda at, length, new: F.struct(
        at.alias("start"), F.least(at + length, size).alias("end"), F.coalesce(new, F.lit("")).alias("new")
    )
    label = F.concat_ws(" ", F.lit(" revised by"), F.col("source").cast("string"), F.col("lang").cast("string"))
    edits = F.array(
        edit(place(1), F.lit(0), F.lit("inserted")),
        edit(place(2), F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(41)), F.lit("")),
        edit(place(3), F.lit(12), label),
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), edits.alias("edits"), as_bytes("text").alias("text"))
