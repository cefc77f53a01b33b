"""Text normalisation and tokens (all JVM expressions)."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Punctuation that survives normalisation (fixed values).
KEPT_PUNCTUATION = "()[]{}-%"
REMOVED_PUNCTUATION = "".join(c for c in string.punctuation if c not in KEPT_PUNCTUATION)

# The 29 characters Python's str.strip() takes off, by code point (fixed values).
STRIPPED_SPACES = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)

# Of these, the Latin-1 ones separate two words when spans are looked for in raw
# text. A regular expression tests them with one bit set; with the others in the
# class it takes many times as long.
WORD_SPACES = "".join(c for c in STRIPPED_SPACES if ord(c) < 256)


def preprocess_text(text: Column) -> Column:
    """Strip, lower-case, turn newline and tab into a space, drop punctuation.

    Brackets, dash and percent stay. Inner runs of spaces are not collapsed.
    """
    stripped = F.btrim(text, F.lit(STRIPPED_SPACES))
    return F.translate(F.lower(stripped), "\n\t" + REMOVED_PUNCTUATION, "  ")


def tokens(text: Column) -> Column:
    """Space-separated tokens of preprocessed text (may hold empty strings)."""
    return F.split(preprocess_text(text), " ")


def surface(text: Column, start: Column, end: Column) -> Column:
    """The characters of ``text`` in the half-open range [start, end)."""
    return F.substring(text, start + 1, end - start)


def file_number(name: Column) -> Column:
    """Last four characters before ``.xml`` or ``.xml.gz``; empty if there are none."""
    return F.regexp_extract(name, r"(.{4})\.xml(\.gz)?$", 1)


def stem(name: Column) -> Column:
    """File name without folders and without its last extension."""
    base = F.regexp_extract(name, r"([^/]*)$", 1)
    return F.regexp_replace(base, r"^(\.*[^.].*)\.[^.]*$", "$1")


def none_to_null(value: Column) -> Column:
    """Text form of a value, with the literal text ``None`` read as null."""
    return F.nullif(value.cast("string"), F.lit("None"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def in_blocks(values: Column, block: int = 16) -> Column:
    """Cut an array without nulls into an array of arrays of ``block`` elements.

    Elements are fetched one by one; ``slice`` would copy the whole array for
    every block.
    """
    def part(b: Column) -> Column:
        return F.array_compact(F.array(*[F.get(values, b * block + k) for k in range(block)]))

    last = F.floor(F.size(values) / block).cast("int")
    return F.transform(F.sequence(F.lit(0), last), part)


def prefix_sums(numbers: Column, levels: int = 3) -> Column:
    """Sum of all earlier elements, for every element of an integer array.

    Eight neighbours at a time are added up into a shorter array whose prefix
    sums come first; an element then adds at most seven of its own block. The
    last, shortest level is a plain running sum.
    """
    if levels == 0:
        return running_sums(numbers)

    def spread(values: Column, before: Column) -> Column:
        def earlier(_: Column, i: Column) -> Column:
            found, past = F.get(before, F.shiftright(i, 3)), i.bitwiseAND(7)
            for k in range(1, 8):
                found = found + F.when(past >= k, F.get(values, i - k)).otherwise(0)
            return found

        return F.transform(values, earlier)

    def body(values: Column) -> Column:
        sums = eights(F.size(values), lambda i: F.get(values, i))
        return let(prefix_sums(sums, levels - 1), lambda before: spread(values, before))

    return let(numbers, body)


def eights(size: Column, value) -> Column:
    """Sums of ``value(i)`` over eight neighbouring indexes each."""
    def total(block: Column) -> Column:
        terms = [F.coalesce(value(F.shiftleft(block, 3) + k), F.lit(0)) for k in range(8)]
        return reduce(lambda a, b: a + b, terms)

    return F.transform(F.sequence(F.lit(0), F.shiftright(size, 3)), total)


def running_sums(numbers: Column) -> Column:
    """The same by one pass that appends to its result; for short arrays."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("seen"))
    return F.aggregate(
        numbers,
        start,
        lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"),
            F.concat(acc["seen"], F.array(acc["sum"])).alias("seen"),
        ),
    )["seen"]
