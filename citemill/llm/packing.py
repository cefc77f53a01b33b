"""Hierarchical packing into sequences of several lengths, without padding but for one sequence per task.

A document (its tokens and an end mark) is routed to the smallest tier that
holds it; whole windows of the longest tier are cut off first. Each tier is
packed on its own: a sequence opens with a document of its tier, its gap is
filled with the longest documents of shorter tiers that fit, and what is still
free then takes the beginning of another document, whose rest stays for a later
sequence. Tiers are powers of two, so full sequences need no padding. Sequences
of a tier are dealt into step groups of equal size, largest attention cost first
and back and forth, so that the steps of a group of workers take like times.

Tokens never leave the task that made them: there is no shuffle, and a task
holds a pool of bounded size. Sequence and group ids begin with the number of the
partition, so a recomputed task gives the same ids.

Tokens come from a file of the ``tokenizers`` library, many texts at once
(:mod:`token_runs`).

Defined cases: a null or empty text is the end mark alone; a null id stays null;
rows with equal ids are packed one by one; an empty table gives an empty result;
other columns are not read; a document may be longer than any sequence.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.llm.common import as_bytes, pieces, small_batches, tidy
from citemill.llm.token_runs import run_encoder

TIERS = [256, 512, 1024, 2048]
END_MARK = np.array([1], dtype="<u4").tobytes()
# Tokens of pending documents: packing starts above the first, stops below the second.
POOL_HIGH = 1 << 20
POOL_LOW = 1 << 18
# Text that is encoded in one go.
ENCODED_BYTES = 2 << 20
# Tokens of a step group, and how many groups are balanced against each other.
STEP_TOKENS = 1 << 16
STEP_GROUPS = 8
REMEMBERED = 400_000
LONG_PART = 64
WORDS_AT_ONCE = 500
END_OF_WORD = "</w>"
# Punctuation that joins no word (no apostrophe), and letters whose lower case is one letter.
PUNCTUATION = '.,;:!?#*$%&|()"/+=<>@~^_[]{}-'
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " tier long, step_group long"
)
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit numbers.

    Most parts are a word of Latin letters with punctuation behind it, which the
    pre-tokeniser separates. Such words are remembered in lower case and encoded
    many at a time; their last token carries the end-of-word mark, which tells
    them apart again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(END_OF_WORD)]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def _plain(self, parts: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return {p: np.array(e.ids, dtype="<u4").tobytes() for p, e in zip(parts, found)}

    def _words(self, words: list[str]) -> dict[str, bytes]:
        chunks = [words[i : i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE)]
        found, out = self.tokenizer.encode_batch_fast([" ".join(c) for c in chunks], add_special_tokens=False), {}
        for chunk, encoded in zip(chunks, found):
            ids = np.array(encoded.ids, dtype="<u4")
            last = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            data = ids.tobytes()
            out.update((w, data[a:b]) for w, a, b in zip(chunk, [0, *last], last, strict=False))
        return out

    def _encode(self, parts: list[str]) -> dict[str, bytes]:
        simple, odd = [], [] if self.ends.any() else parts
        for p in parts if odd is not parts else ():
            word = p.rstrip(PUNCTUATION)
            if word.isalpha() and (word.isascii() or LATIN.fullmatch(word)):
                simple.append((p, word.lower(), p[len(word) :]))
            else:
                odd.append(p)
        out = self._plain(odd)
        if len(self.words) + len(simple) > REMEMBERED:
            self.words = {}
        if len(self.marks) > LONG_PART**2:
            self.marks = {"": b""}
        words, marks = self.words, self.marks
        words |= self._words(list({w for _, w, _ in simple if w not in words}))
        marks |= self._plain(list({m for _, _, m in simple if m not in marks}))
        for p, word, mark in simple:
            out[p] = words[word] + marks[mark] if mark else words[word]
        return out

    def learn(self, texts: list[str]) -> None:
        """Encode the parts of some texts in one go."""
        seen = set().union(*(t.replace("\n", " ").split(" ") for t in texts))
        if len(self.known) + len(seen) > REMEMBERED:
            self.known = {"": b""}
        if new := [p for p in seen if p not in self.known and len(p) <= LONG_PART]:
            self.known |= self._encode(new)

    def parts(self, parts: list[str]) -> list[bytes]:
        """The ids of each part."""
        try:
            return list(map(self.known.__getitem__, parts))
        except KeyError:
            new = {p for p in parts if p not in self.known}
            own = self._encode(list(new))
            return [own[p] if p in own else self.known[p] for p in parts]

    def counts(self, parts: list[str]) -> np.ndarray:
        """Number of tokens of each part."""
        found = self.parts(parts)
        return np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4

    def __call__(self, texts: list[str]) -> list[bytes]:
        self.learn(texts)
        return [b"".join(self.parts(t.replace("\n", " ").split(" "))) for t in texts]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Part:
    """A run of a document's tokens: the document, their place and bytes, and the tokens of the whole."""

    __slots__ = ("doc", "start", "ids", "total", "length")

    def __init__(self, doc, start: int, ids: bytes, total: int):
        self.doc, self.start, self.ids, self.total, self.length = doc, start, ids, total, len(ids) // 4

    def cut(self, n: int) -> tuple[Part, Part]:
        head, rest = self.ids[: 4 * n], self.ids[4 * n :]
        return Part(self.doc, self.start, head, self.total), Part(self.doc, self.start + n, rest, self.total)

    def row(self) -> tuple:
        return self.doc, self.start, self.length, zlib.crc32(self.ids), self.total


class Packer:
    """Packs the documents of one task."""

    def __init__(self, prefix: int, tiers: list[int] = TIERS, high: int = POOL_HIGH, low: int = POOL_LOW):
        self.tiers, self.high, self.low = sorted(tiers), high, low
        self.sequences = self.groups = prefix << 32
        # Pending parts by length, the latest last among equals.
        self.pool: list[tuple[int, int, Part]] = []
        self.tokens = self.numbered = 0
        self.waiting: dict[int, list[tuple[int, int, list]]] = {t: [] for t in self.tiers}

    def put(self, part: Part) -> None:
        self.numbered += 1
        insort(self.pool, (part.length, self.numbered, part))
        self.tokens += part.length

    def take(self, i: int) -> Part:
        part = self.pool.pop(i)[2]
        self.tokens -= part.length
        return part

    def tier(self, length: int) -> int:
        return next(t for t in self.tiers if length <= t)

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        """Take a document in; give the rows of sequences that are complete."""
        longest, n = self.tiers[-1], len(ids) // 4
        whole = n - n % longest
        for start in range(0, whole, longest):
            yield from self.emit(longest, [Part(doc, start, ids[4 * start : 4 * (start + longest)], n)])
        if n > whole:
            self.put(Part(doc, whole, ids[4 * whole :], n))
        if self.tokens > self.high:
            yield from self.pack(self.low)

    def pack(self, until: int) -> Iterator[tuple]:
        while self.tokens > until:
            yield from self.sequence()

    def sequence(self) -> Iterator[tuple]:
        """One sequence that begins with the longest pending part."""
        parts = [self.take(-1)]
        size = self.tier(parts[0].length)
        gap = size - parts[0].length
        while gap and self.pool:
            i = bisect_left(self.pool, (gap + 1,))  # so many parts fit
            part = self.take(max(0, i - 1))
            if part.length > gap:
                part, rest = part.cut(gap)
                self.put(rest)
            parts.append(part)
            gap -= part.length
        yield from self.emit(size, parts)

    def emit(self, size: int, parts: list[Part]) -> Iterator[tuple]:
        rows, offset = [], 0
        for part in parts:
            rows.append((*part.row(), self.sequences, offset))
            offset += part.length
        waiting = self.waiting[size]
        waiting.append((-sum(p.length**2 for p in parts), self.sequences, rows))
        self.sequences += 1
        if len(waiting) * size >= STEP_TOKENS * STEP_GROUPS:
            yield from self.deal(size)

    def deal(self, size: int) -> Iterator[tuple]:
        """Deal a tier's waiting sequences into step groups of like cost."""
        waiting, self.waiting[size] = self.waiting[size], []
        room = max(1, STEP_TOKENS // size)
        n = -(-len(waiting) // room)
        groups = [(0, 0, self.groups + g) for g in range(n)]
        heapq.heapify(groups)
        self.groups += n
        for cost, _, rows in sorted(waiting, key=lambda w: w[:2]):
            total, held, group = heapq.heappop(groups)
            if held + 1 < room:
                heapq.heappush(groups, (total - cost, held + 1, group))
            for row in rows:
                yield (*row, size, group)

    def finish(self) -> Iterator[tuple]:
        yield from self.pack(0)
        for size in self.tiers:
            yield from self.deal(size)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*rows)], names=COLUMNS)


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", tiers: list[int] = TIERS
) -> DataFrame:
    """One row per piece of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, rows = run_encoder(tokenizer_path), Packer(TaskContext.get().partitionId(), tiers), []
        for batch in batches:
            for piece in pieces(batch, ENCODED_BYTES):
                ids, bounds = encode([t or b"" for t in piece.column(1).to_pylist()])
                for doc, start, end in zip(piece.column(0).to_pylist(), bounds, bounds[1:]):
                    rows.extend(packer.add(doc, ids[start:end].tobytes() + END_MARK))
                if len(rows) >= 10_000:
                    yield as_batch(rows)
                    rows = []
        rows.extend(packer.finish())
        if rows:
            yield as_batch(rows)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col).alias("text"))
    small_batches(docs.sparkSession)
    return rows.mapInArrow(tidy(run), SCHEMA)
