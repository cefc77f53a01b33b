"""Ranked lexical search: item vocabulary tiles times document impact tiles.

Every row of ``documents`` is ranked for every benchmark item by a sum of term
weights times term impacts. Three passes:

1. documents become rows of (term number, count) over the words of the items,
   and are written so;
2. document frequencies, the number of documents and of words are summed from
   there, one partial sum per task;
3. items are dealt into tiles. A tile has a vocabulary of its own, the few
   hundred words its items use, so both matrices stay compact and dense: a batch
   of documents is spread into float64 impacts over those words and multiplied
   (BLAS) with the weights of the items. A weight is below ``MAX_WEIGHT``, an
   impact below a million; a tile is no wider than keeps every partial sum below
   2**53, so float64 holds each of them exactly whatever order BLAS adds in.
   Sums over tiles are 64-bit integers. Of each product only rows that reach the
   task's current k-th score stay, equal scores included, until ids settle them.

A task passes on at most k rows per item; they are cut to k in slices and then
for the item as a whole, so no task sees the rows of all others for one item at
once. Items are the query set: they go through the driver in blocks of
``BLOCK_TERMS`` words, and each block has passes of its own over the documents.

Defined cases: a null or empty text has no terms, counts in no statistic and is
never found; an item without terms finds nothing; equal rows of documents are
ranked each on its own, equal items answered each on its own; of equal scores
the smaller id comes first and a null id last; an empty table on either side
gives an empty result; other columns are not read. Terms are compared by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citemill.llm.common import as_bytes, hash_spans, map_arrow, small_batches, tidy
from citemill.shared import materialise

K = 50
# Fixed values of the ranking: length damping and scales.
FLOOR, SPREAD, SCALE, LENGTH_SCALE = 50, 50, 1000, 20
IMPACT = 1_000_000_000
MAX_IMPACT = IMPACT // SCALE
# Words of items that one pass over the documents serves.
BLOCK_TERMS = 2_000_000
ITEM_TILE = 32
VOCABULARY_TILE = 1024
DOC_TILE = 512
SLICES = 32

SEPARATES = np.zeros(256, dtype=bool)
SEPARATES[:128] = True
SEPARATES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

EXACT = 1 << 53


class Terms:
    """The terms of several texts: a hash each, and the text it belongs to."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts).lower(), dtype=np.uint8)
        edges = np.flatnonzero(np.diff(~SEPARATES[data], prepend=False, append=False))
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        firsts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        self.hashes = hash_spans(data, edges[0::2], edges[1::2])
        self.text = np.searchsorted(firsts, edges[0::2], side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts)).astype(np.int64)


def texts_of(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()]


def lists(counts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, terms``: the distinct terms of every item, as hashes."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        terms = Terms(texts_of(batch))
        pairs = np.unique(np.rec.fromarrays([terms.text, terms.hashes.view(np.int64)], names="text,hash"))
        counts = np.bincount(pairs.text, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), lists(counts, pairs.hash, pa.int64())], names=["item_id", "terms"]
        )

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), as_bytes(text_col).alias("text"))
    return map_arrow(rows, run, "item_id long, terms array<long>")


def blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[int | None, list[int]]]]:
    """The items with terms, in lists of at most ``limit`` terms (or one item)."""
    block, held = [], 0
    for row in items.filter(F.size("terms") > 0).toLocalIterator():
        if block and held + len(row.terms) > limit:
            yield block
            block, held = [], 0
        block.append((row.item_id, row.terms))
        held += len(row.terms)
    if block:
        yield block


def term_counts(docs: DataFrame, vocabulary: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, terms, tfs``: words of each document, and how often it holds which words of the vocabulary.

    ``vocabulary`` is sorted. Most words are in no item: two bytes of the hash
    tell most of these before the vocabulary is searched.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        terms = Terms(texts_of(batch))
        likely = np.zeros(1 << 16, dtype=bool)
        likely[(vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        kept = np.flatnonzero(likely[(terms.hashes & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.minimum(np.searchsorted(vocabulary, terms.hashes[kept]), len(vocabulary) - 1)
        found = vocabulary[place] == terms.hashes[kept]
        pairs = terms.text[kept[found]] * len(vocabulary) + place[found]
        pairs, tfs = np.unique(pairs, return_counts=True)
        counts = np.bincount(pairs // len(vocabulary), minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(terms.counts),
                lists(counts, (pairs % len(vocabulary)).astype(np.int32), pa.int32()),
                lists(counts, tfs.astype(np.int32), pa.int32()),
            ],
            names=["doc_id", "n", "terms", "tfs"],
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    return map_arrow(rows, run, "doc_id long, n long, terms array<int>, tfs array<int>")


def statistics(counted: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """Documents holding each term, documents with a term at all, words of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, words = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=size)
            n = batch.column(0).to_numpy(zero_copy_only=False)
            docs, words = docs + int((n > 0).sum()), words + int(n.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([-2, -1], held))), pa.array(np.concatenate(([docs, words], df[held])))],
            names=["term", "total"],
        )

    sums = counted.select("n", "terms").mapInArrow(tidy(run), "term long, total long").groupBy("term").agg(F.sum("total"))
    df = np.zeros(size, dtype=np.int64)
    found = {row[0]: row[1] for row in sums.collect()}  # one row per word of the block
    docs, words = found.pop(-2, 0), found.pop(-1, 0)
    df[list(found)] = list(found.values())
    return df, docs, words


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    """Weight of each term: floor(1000 ln((2N+2) / (2df+1)))."""
    return np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64)


def impacts(tfs: np.ndarray, n: np.ndarray, docs: int, words: int) -> np.ndarray:
    """Impact of terms occurring ``tfs`` times in documents of ``n`` words."""
    if len(n) and SPREAD * docs * int(n.max()) >= 1 << 63:
        length = np.array([(SPREAD * docs * int(v)) // words for v in n], dtype=np.int64)
    else:
        length = (SPREAD * docs * n) // words
    tfs = tfs.astype(np.int64)
    return (IMPACT * tfs) // (SCALE * tfs + LENGTH_SCALE * (FLOOR + length))


class Tile:
    """Some items over some words: weights, and the place of each word of the block in the tile."""

    def __init__(self, first: int, matrix: np.ndarray, local: np.ndarray):
        self.first, self.matrix, self.local = first, matrix, local


def tiles(of_items: list[np.ndarray], weight: np.ndarray, width: int = VOCABULARY_TILE) -> list[Tile]:
    """Items in tiles of ``ITEM_TILE``, each over its own words; wider ones are parted by words.

    No partial sum of a tile reaches 2**53: it has at most ``width`` addends,
    each below the largest weight times ``MAX_IMPACT``.
    """
    width = max(1, min(width, (EXACT - 1) // (MAX_IMPACT * max(1, int(weight.max(initial=0))))))
    out = []
    for first in range(0, len(of_items), ITEM_TILE):
        held = of_items[first : first + ITEM_TILE]
        used = np.unique(np.concatenate(held))
        for start in range(0, len(used), width):
            part = used[start : start + width]
            local = np.full(len(weight), -1, dtype=np.int32)
            local[part] = np.arange(len(part))
            matrix = np.zeros((len(part), len(held)))
            for i, terms in enumerate(held):
                own = local[terms]
                matrix[own[own >= 0], i] = weight[part[own[own >= 0]]]
            out.append(Tile(first, matrix, local))
    return out


def products(n_docs: int, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_items: int, parts: list[Tile]):
    """Scores (documents x items) as 64-bit integers; ``row`` is ascending."""
    scores = np.zeros((n_docs, n_items), dtype=np.int64)
    for tile in parts:
        place = tile.local[term]
        inside = np.flatnonzero(place >= 0)
        dense = np.zeros((n_docs, tile.matrix.shape[0]))
        dense[row[inside], place[inside]] = impact[inside]
        scores[:, tile.first : tile.first + tile.matrix.shape[1]] += (dense @ tile.matrix).astype(np.int64)
    return scores


class Best:
    """The k best documents of each item seen so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.ones(n_items, dtype=np.int64)  # a score of 0 is no result
        self.item = self.score = self.doc = np.empty(0, dtype=np.int64)
        self.null = np.empty(0, dtype=bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """Rows that reach an item's k-th score, equal ones too, compete by score and id."""
        row, item = np.nonzero(scores >= self.least)
        if not len(row):
            return
        item = np.concatenate((self.item, item))
        score = np.concatenate((self.score, scores[row, item[len(self.item) :]]))
        doc, null = np.concatenate((self.doc, doc[row])), np.concatenate((self.null, null[row]))
        order = np.lexsort((doc, null, -score, item))
        item = item[order]
        begins = np.flatnonzero(np.diff(item, prepend=-1))
        place = np.arange(len(item)) - np.repeat(begins, np.diff(np.append(begins, len(item))))
        kept = order[place < self.k]
        self.item, self.score, self.doc, self.null = item[place < self.k], score[kept], doc[kept], null[kept]
        last = place[place < self.k] == self.k - 1
        self.least[self.item[last]] = self.score[last]


def best_of_tasks(
    counted: DataFrame, of_items: list[np.ndarray], weight: np.ndarray, docs: int, words: int, k: int, first_item: int
) -> DataFrame:
    """``item, doc_id, score``: the k best of every task for every item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, best = tiles(of_items, weight), Best(len(of_items), k)
        for batch in batches:
            for start in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(start, DOC_TILE)
                sizes = pa.compute.list_value_length(part.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(part.num_rows), sizes)
                n = part.column(1).to_numpy(zero_copy_only=False)
                impact = impacts(part.column(3).flatten().to_numpy(), n[row], docs, words)
                term = part.column(2).flatten().to_numpy()
                scores = products(part.num_rows, row, term, impact, len(of_items), parts)
                ids = part.column(0)
                null = ids.is_null().to_numpy(zero_copy_only=False)
                best.add(scores, ids.fill_null(0).to_numpy(zero_copy_only=False), null)
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.item + first_item), pa.array(best.doc, mask=best.null), pa.array(best.score)],
            names=["item", "doc_id", "score"],
        )

    small_batches(counted.sparkSession)
    return counted.mapInArrow(tidy(run), "item long, doc_id long, score long")


def cut(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    doc_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of every item with a score above 0."""
    spark = docs.sparkSession
    listed = materialise(item_terms(items, item_col, item_text_col), "item-terms")
    out, first = None, 0
    for block in blocks(listed, block_terms):
        hashed = [np.array(terms, dtype=np.int64).view(np.uint64) for _, terms in block]
        vocabulary = np.unique(np.concatenate(hashed))
        of_items = [np.searchsorted(vocabulary, h) for h in hashed]
        counted = materialise(term_counts(docs, vocabulary, doc_col, text_col), "term-counts")
        df, n_docs, n_words = statistics(counted, len(vocabulary))
        if not n_docs:
            break
        some = best_of_tasks(counted, of_items, weights(df, n_docs), n_docs, n_words, k, first)
        ids = spark.createDataFrame([(first + i, block[i][0]) for i in range(len(block))], "item long, item_id long")
        # Salted first: an item's rows from all tasks would be one window otherwise.
        some = cut(some.withColumn("slice", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SLICES))), ["item", "slice"], k)
        ranked = cut(some.drop("rank", "slice"), ["item"], k).join(F.broadcast(ids), "item")
        ranked = ranked.select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
        first += len(block)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
