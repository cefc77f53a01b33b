"""Finding dictionary terms in texts: a trie of words, walked from every word of a batch of texts at once.

A word of a text is spelled as the dictionary spells it (lower case, some
punctuation left out) and hashed; a run of words is known by the hash of its
words' hashes. The trie holds these hashes level by level as sorted arrays: one
step looks up all runs that are still in the trie, extended by a word each, so
the work follows the terms that begin in the text and no n-gram is ever built.
Hashes are 128 bits wide.

A dictionary that is too big for every executor is replaced by a Bloom filter of
its terms and their beginnings; what passes it is then looked up by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citemill.functions.text import REMOVED_PUNCTUATION, WORD_SPACES
from citemill.shared import give_back

# Characters worked on in one go, and hashed in one go.
PIECE = 1 << 18
HASHED = 1 << 18
BLOOM_BITS_PER_ENTRY = 16
BLOOM_PROBES = 3
BLOOM_MOST_BITS = 1 << 28
# Bits of one row of Spark's bitmap aggregates.
BITMAP_BITS = 32_768

_MIX = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]
# Two independent hashes: bases for characters, multipliers for words.
_BASES = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]
_STEPS = [np.uint64(0xDA942042E4DD58B5), np.uint64(0xAEF17502108EF2D9)]
# The one capital whose lower case is two characters.
DOTTED_I, DOTTED_I_LOWER = 0x130, (0x69, 0x307)


def _table(chars: str, size: int = 256) -> np.ndarray:
    out = np.zeros(size, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


SPACES, REMOVED = _table(WORD_SPACES), _table(REMOVED_PUNCTUATION)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    steps = np.full(HASHED + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_UP = [_powers(b) for b in _BASES]
_DOWN = [_powers(pow(b, -1, 1 << 64)) for b in _BASES]
_CODES = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64) * np.uint64(_BASES[0]))

Hashes = tuple[np.ndarray, np.ndarray]


def in_class(chars: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(chars, 255)] & (chars < 256)


def hash_runs(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Hashes:
    """Two 64-bit hashes of runs of characters (in order, not overlapping)."""
    out = np.zeros(len(starts), dtype=np.uint64), np.zeros(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASHED, side="right")))
        low, high = int(starts[i]), int(ends[j - 1])
        if high - low > HASHED:  # one very long word: piece by piece
            for k in (0, 1):
                total = 0
                for at in range(low, high, HASHED):
                    own = _codes(chars[at : min(at + HASHED, high)])
                    total = total * int(_STEPS[k]) + int((own * _UP[k][: len(own)]).sum(dtype=np.uint64))
                out[k][i] = total % (1 << 64)
        else:
            codes = _codes(chars[low:high])
            sums = np.zeros(len(codes) + 1, dtype=np.uint64)
            a, b = starts[i:j] - low, ends[i:j] - low
            for k in (0, 1):
                np.cumsum(codes * _UP[k][: len(codes)], out=sums[1:])
                out[k][i:j] = (sums[b] - sums[a]) * _DOWN[k][a]
        i = j
    size = (ends - starts).astype(np.uint64)
    return mix(out[0] + size * _MIX[0]), mix(out[1] + size * _MIX[1])


def _codes(chars: np.ndarray) -> np.ndarray:
    codes = _CODES[np.minimum(chars, 0xFFFF)]
    wide = chars > 0xFFFF
    if wide.any():
        codes[wide] = mix((chars[wide].astype(np.uint64) + np.uint64(1)) * np.uint64(_BASES[0]))
    return codes


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def lower(text: str) -> str:
    """Lower case of the same length: the dotted capital I is left for later."""
    capital = chr(DOTTED_I)
    return capital.join(part.lower() for part in text.split(capital)) if capital in text else text.lower()


class Words:
    """The words of several texts: where they are, what text they are of, and their hashes as spelled."""

    def __init__(self, texts: list[str]):
        self.text = "\n".join(texts)
        self.chars = code_points(self.text)
        spelled = code_points(lower(self.text))
        spaces = in_class(self.chars, SPACES)
        edges = np.flatnonzero(np.diff(~spaces, prepend=False, append=False))
        self.starts, self.ends = edges[0::2], edges[1::2]
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1])).astype(np.int64)
        self.owner = np.searchsorted(self.text_starts, self.starts, side="right") - 1
        self.removed = in_class(self.chars, REMOVED)
        kept = ~(spaces | self.removed)
        width = kept.astype(np.int8)
        dotted = spelled == DOTTED_I
        if dotted.any():
            width[dotted] = 2
            spelled = np.repeat(spelled, width)
            first = np.flatnonzero(spelled == DOTTED_I)[0::2]
            spelled[first], spelled[first + 1] = DOTTED_I_LOWER
        else:
            spelled = spelled[kept]
        place = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
        #: The words as spelled lie side by side, from ``spell_starts`` to ``spell_ends``.
        self.spelled, self.spell_starts, self.spell_ends = spelled, place[self.starts], place[self.ends]
        self.hashes = hash_runs(spelled, self.spell_starts, self.spell_ends)

    def surfaces(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of runs of words without the punctuation around them."""
        start, end = self.starts[first], self.ends[last]
        inner = np.append(np.flatnonzero(~self.removed), len(self.chars))
        start = np.minimum(inner[np.searchsorted(inner, start)], end)
        before = np.searchsorted(inner, end) - 1
        end = np.maximum(np.where(before >= 0, inner[before] + 1, 0), start)
        return start, end


def extended(runs: Hashes, words: Hashes, last: np.ndarray) -> Hashes:
    """Hashes of runs with one more word each."""
    return tuple(mix(h * step + w[last]) for h, w, step in zip(runs, words, _STEPS))


def walk(words: Words, keep) -> None:
    """Extend runs from every word as long as ``keep(n, first words, hashes)`` says which go on."""
    first = np.arange(len(words.starts))
    runs = tuple(np.zeros(len(first), dtype=np.uint64) for _ in _STEPS)
    n = 0
    while len(first):
        inside = np.flatnonzero(first + n < len(words.starts))
        inside = inside[words.owner[first[inside] + n] == words.owner[first[inside]]]
        first, runs = first[inside], tuple(h[inside] for h in runs)
        runs = extended(runs, words.hashes, first + n)
        n += 1
        goes_on = keep(n, first, runs)
        if goes_on is None:
            return
        first, runs = first[goes_on], tuple(h[goes_on] for h in runs)


def term_paths(terms: list[str]) -> Iterator[tuple[np.ndarray, Hashes]]:
    """Level by level: the terms of at least so many words, and the hashes of their first words."""
    split = [t.split(" ") for t in terms]
    sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    flat = [w for words in split for w in words]
    ends = np.cumsum(np.fromiter(map(len, flat), dtype=np.int64, count=len(flat)))
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64) if len(flat) else ends
    words = hash_runs(code_points("".join(flat)), starts, ends)
    first = np.cumsum(sizes) - sizes
    members = np.arange(len(terms))
    runs = tuple(np.zeros(len(terms), dtype=np.uint64) for _ in _STEPS)
    for n in range(int(sizes.max(initial=0))):
        longer = sizes[members] > n
        members, runs = members[longer], tuple(h[longer] for h in runs)
        runs = extended(runs, words, first[members] + n)
        yield members, runs


@dataclass
class Level:
    """Runs of one length: sorted hashes, the rows of the terms that end here, and whether longer terms begin so."""

    key: np.ndarray
    check: np.ndarray
    first: np.ndarray
    rows: np.ndarray
    goes_on: np.ndarray


class Trie:
    """Dictionary rows (term, label) by the words of their terms."""

    def __init__(self, terms: list[str], labels: list[str]):
        self.terms, self.labels = np.array(terms, dtype=object), np.array(labels, dtype=object)
        sizes = np.array([t.count(" ") + 1 for t in terms], dtype=np.int64)
        self.levels: list[Level] = []
        for n, (members, (one, two)) in enumerate(term_paths(terms), 1):
            key, at = np.unique(one, return_index=True)
            node = np.searchsorted(key, one)
            final = sizes[members] == n
            ending = np.flatnonzero(final)[np.argsort(node[final], kind="stable")]
            goes_on = np.zeros(len(key), dtype=bool)
            goes_on[node[~final]] = True
            first = np.searchsorted(node[ending], np.arange(len(key) + 1))
            self.levels.append(Level(key, two[at], first, members[ending], goes_on))

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, last word, dictionary row) of every term in the texts."""
        out = []

        def keep(n: int, first: np.ndarray, runs: Hashes):
            if n > len(self.levels):
                return None
            level = self.levels[n - 1]
            node = np.minimum(np.searchsorted(level.key, runs[0]), len(level.key) - 1)
            known = (level.key[node] == runs[0]) & (level.check[node] == runs[1])
            count = np.where(known, level.first[node + 1] - level.first[node], 0)
            begin = np.repeat(first, count)
            within = np.arange(len(begin)) - np.repeat(np.cumsum(count) - count, count)
            out.append((begin, begin + n - 1, level.rows[np.repeat(level.first[node], count) + within]))
            return known & level.goes_on[node]

        walk(words, keep)
        none = np.empty(0, dtype=np.int64)
        return tuple(np.concatenate(c) for c in zip((none, none, none), *out))


class Bloom:
    """The terms of a dictionary, and their beginnings, as bits."""

    def __init__(self, bits: np.ndarray, size: int):
        self.bits, self.size = bits, size

    def holds(self, positions: np.ndarray) -> np.ndarray:
        return (self.bits[positions >> 3] >> (positions & 7).astype(np.uint8) & 1).astype(bool)

    def any_of(self, runs: Hashes, whole: bool) -> np.ndarray:
        out = np.ones(len(runs[0]), dtype=bool)
        for probe in range(BLOOM_PROBES):
            out[out] = self.holds(bloom_positions(tuple(h[out] for h in runs), whole, probe, self.size))
        return out

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, last word) of all runs that are probably terms."""
        out = []

        def keep(n: int, first: np.ndarray, runs: Hashes):
            hit = first[self.any_of(runs, True)]
            out.append((hit, hit + n - 1))
            return self.any_of(runs, False)

        walk(words, keep)
        none = np.empty(0, dtype=np.int64)
        return tuple(np.concatenate(c) for c in zip((none, none), *out))


def bloom_positions(runs: Hashes, whole: bool, probe: int, size: int) -> np.ndarray:
    """Bits of runs as whole terms or as beginnings of longer ones."""
    salt = np.uint64(2 * probe + whole + 1)
    return (mix(runs[0] + salt * runs[1]) & np.uint64(size - 1)).astype(np.int64)


def bloom_of(table: DataFrame) -> Bloom:
    """Bits of all terms of a dictionary table, set by bitmap aggregates; ``BLOOM_MOST_BITS`` bounds them."""
    entries = table.agg(F.sum("n")).first()[0] or 1
    size = min(BLOOM_MOST_BITS, max(BITMAP_BITS, 1 << int(entries * BLOOM_BITS_PER_ENTRY - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, positions = batch.column(0).to_pylist(), []
            sizes = np.array([t.count(" ") + 1 for t in terms], dtype=np.int64)
            for n, (members, runs) in enumerate(term_paths(terms), 1):
                final = sizes[members] == n
                for whole in (True, False):
                    own = tuple(h[final == whole] for h in runs)
                    positions += [bloom_positions(own, whole, probe, size) for probe in range(BLOOM_PROBES)]
            if positions:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(positions)))], names=["bit"])

    # Spark counts bits from 1.
    bit = F.col("bit") + 1
    rows = table.select("term").mapInArrow(run, "bit long").groupBy(F.bitmap_bucket_number(bit).alias("bucket"))
    bits = np.zeros(size // 8, dtype=np.uint8)
    for row in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).toLocalIterator():
        at = (row["bucket"] - 1) * BITMAP_BITS // 8
        bits[at : at + BITMAP_BITS // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return Bloom(bits, size)


def pieces(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in groups of about ``PIECE`` characters, or of one."""
    group, held = [], 0
    for scalar in texts:
        text = scalar.as_py() or ""
        if group and held + len(text) > PIECE:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def spans(words: Words, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[int], list[int], list[str]]:
    """Text, start, end and surface of runs of words."""
    start, end = words.surfaces(first, last)
    owner = words.owner[first]
    surface = [words.text[a:b] for a, b in zip(start.tolist(), end.tolist())]
    base = words.text_starts[owner]
    return owner, (start - base).tolist(), (end - base).tolist(), surface


def trie_spans(trie: Trie, texts: list[str], settle: bool) -> list[list[dict]]:
    """The terms of each text; ``settle``: overlaps go, see :func:`leftmost_longest`."""
    words = Words(texts)
    first, last, row = trie.found(words)
    owner, start, end, surface = spans(words, first, last)
    out: list[list[dict]] = [[] for _ in texts]
    labels, terms = trie.labels[row], trie.terms[row]
    for o, a, b, label, s, term in zip(owner.tolist(), start, end, labels, surface, terms):
        out[o].append({"start": a, "end": b, "label": label, "surface": s, "term": term})
    return [leftmost_longest(own) for own in out] if settle else out


def leftmost_longest(found: list[dict]) -> list[dict]:
    """From left to right, the longest at each start (then by label); what begins inside a taken one goes."""
    taken, reached = [], 0
    for span in sorted(found, key=lambda s: (s["start"], -s["end"], s["label"], s["surface"])):
        if span["start"] >= reached:
            taken.append(span)
            reached = span["end"]
    return taken


def bloom_spans(bloom: Bloom, texts: list[str]) -> list[list[dict]]:
    """Runs that are probably terms, with their spelling."""
    words = Words(texts)
    first, last = bloom.found(words)
    owner, start, end, surface = spans(words, first, last)
    spelled = words.spelled.tobytes().decode("utf-32-le", "surrogatepass")
    cuts = list(zip(words.spell_starts.tolist(), words.spell_ends.tolist()))
    out: list[list[dict]] = [[] for _ in texts]
    for o, a, b, s, i, j in zip(owner.tolist(), start, end, surface, first.tolist(), last.tolist()):
        term = " ".join(spelled[x:y] for x, y in cuts[i : j + 1])
        out[o].append({"start": a, "end": b, "surface": s, "term": term})
    return out


def scanner(find, fields: str):
    """``find(texts)`` as a column function from text to an array of structs.

    What a group of texts holds becomes an Arrow array before the next group is
    scanned: a span takes far more memory as a Python object.
    """

    def scan(column: pa.Array) -> pa.Array:
        found = [pa.array(find(group), type=kind) for group in pieces(column)]
        out = pa.concat_arrays(found or [pa.array([], type=kind)])
        give_back()
        return out

    names = [f.split() for f in fields.split(", ")]
    kind = pa.list_(pa.struct([(n, {"int": pa.int32(), "string": pa.string()}[k]) for n, k in names]))
    return F.arrow_udf(scan, f"array<struct<{', '.join(f'{n}: {k}' for n, k in names)}>>")
