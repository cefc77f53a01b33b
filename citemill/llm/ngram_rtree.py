"""Jaccard join of word n-gram sets with trees over group counts.

A document is the set of its distinct shingles. Equal sets are one class, and
only classes are compared. The hashed shingles of a set are dealt into groups;
the numbers per group are a point, and the intersection of two sets is at most
the sum over groups of the smaller coordinate. Trees of bounding boxes over such
points (R-trees, packed by sorting) give the pairs whose bound still allows the
similarity; the sets of these pairs are then compared exactly.

One tree over everything would prune little: at similarity 0.9 boxes in many
dimensions all touch. So there is a forest, one tree for each bucket of sets that
hold exactly the same shingles in one of K fine groups. Two sets within the
threshold differ in at most ``t`` shingles, so of any ``t + 1`` groups of a set one
is untouched and the pair meets in its bucket. ``K`` follows from the set size:
sizes are cut into bands, a set is filed in its own band and in the next smaller
one if a partner may lie there. Groups with at most one shingle are common to many
sets and are left out as buckets if ``t + 1`` others remain, empty ones if ``t + 1``
with a shingle remain; otherwise the set is filed under all its groups. Of two
partners the one that leaves out more has the untouched group, and the other files
it too, so no pair is lost. Sets so small that they differ in at most one shingle
from a partner (under 18 shingles at 90 percent, under 8 at 80) are filed under the
set itself and the set without each shingle instead.

Shingle length and percentage are arguments; ``SHINGLE`` and ``PERCENT`` are those
of op5.

Only links that matter for components are verified, in three rounds. In the first,
small buckets give all their pairs, and some of the larger ones, cut into blocks,
give each set's nearest neighbour in its own and the bucket's first block: linear
in the bucket. The others look at buckets that are not in one component yet, in
blocks of ``BLOCK`` sets: sets outside the bucket's largest component meet all sets
of the bucket. In the second round each of them gives its likeliest partner of
another component in a block, since one link is enough to join it; in the third,
what is still open is joined by trees, and every pair whose bound allows a link is
given. So a bucket that variants of one text fill costs its size times the few that
the rounds before left out, not its square, and no link is lost. Two sets meet in
every bucket they share; in the third round each carries its ``LISTED`` smallest
buckets, and a pair is given in the smallest bucket on both lists only (in all of
its buckets if the lists have none in common).

The keys of a set are many, about three for ten shingles. They are stored once, with
the row, and moved once, with the number of the row: a bucket counts its members
where its rows meet, and only buckets of several sets leave that step.

Defined cases: a null or empty text, or one without words, has an empty set and
is linked with nothing; copies are one class and linked; rows with equal ids but
different texts are different sets; a null id is never a component's id (a
component of null ids alone has a null id); an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citemill.llm.common import Words, as_bytes, join_rows, map_arrow, mix, small_batches, tidy
from citemill.llm.components import components
from citemill.shared import fits_broadcast, materialise

SHINGLE = 3
# Linked when PERCENT_OF * intersection >= percent * union.
PERCENT, PERCENT_OF = 90, 100
GROUPS = 128
BLOCK = 1024
# Buckets of up to so many sets give all their pairs at once.
SMALL_BUCKET = 12
# In the first round one in so many of the others is looked at, in blocks of this size.
FIRST_SHARE = 16
FIRST_BLOCK = 256
LEAF = 16
# Pairs of boxes opened at once; each gives up to LEAF * LEAF pairs of points.
NODE_PAIRS = 512
# Pairs a task remembers so as not to give them again.
GIVEN = 50_000
# Buckets of a set that its rows carry in the third round.
LISTED = 16
BAND_RATIO = 1.4

_GROUP_SALT = np.uint64(0xA0761D6478BD642F)


def most_different(total: int, percent: int = PERCENT) -> int:
    """The largest symmetric difference of linked sets whose sizes add up to ``total``."""
    # D = U - I and U + I = total; PERCENT_OF * I >= percent * U.
    return total * (PERCENT_OF - percent) // (PERCENT_OF + percent)


def largest_partner(n: int, percent: int = PERCENT) -> int:
    return n * PERCENT_OF // percent


@lru_cache(maxsize=None)
def deletion_below(percent: int = PERCENT) -> int:
    """Sets of under so many shingles are filed by deletion of one shingle."""
    n = 1
    while percent < PERCENT_OF and most_different(n + largest_partner(n, percent), percent) <= 1:
        n += 1
    return n


@lru_cache(maxsize=None)
def band(number: int, percent: int = PERCENT) -> tuple[int, int, int]:
    """(smallest, largest size, groups) of a band of sizes."""
    if number == 0 and deletion_below(percent) > 1:
        low, high = 1, deletion_below(percent) - 1
    else:
        low = band(number - 1, percent)[1] + 1 if number else 1
        # At least as wide as partners may lie apart; wider where they lie far apart, so that few sets have two bands.
        high = max(low, int(low * max(BAND_RATIO, (PERCENT_OF / percent) ** 3)))
    t = most_different(high + largest_partner(high, percent), percent)
    slack = 2 + t * 3 // 100
    # The fewest groups of which enough hold two shingles, by a Poisson law; at low percentages more than t + 1.
    k = np.arange(t + 1 + slack, max(t + 1 + slack, high) + 1)
    strong = k * (1 - np.exp(-high / k) * (1 + high / k))
    enough = strong >= t + 1 + slack / 2
    return low, high, int(k[np.argmax(enough) if enough.any() else np.argmax(strong)])


@lru_cache(maxsize=100_000)
def band_of(n: int, percent: int = PERCENT) -> int:
    number = 0
    while band(number, percent)[1] < n:
        number += 1
    return number


def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    words = Words(texts, lower=True)
    grams, first = words.grams(n)
    bounds = np.searchsorted(words.text[first], np.arange(len(texts) + 1))
    out = []
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if a == b and words.counts[i]:
            at = words.firsts[i]
            whole = blake2b(words.hashes[at : at + words.counts[i]].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(whole, dtype=np.uint64))
        else:
            out.append(np.unique(grams[a:b]))
    return out


def group_counts(shingles: np.ndarray) -> bytes:
    """The set as a point; larger counts than a byte holds are cut (see :func:`overlap_bound`)."""
    counts = np.bincount((shingles & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def bucket_keys(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The buckets a set is filed in."""
    n = len(shingles)
    if n == 0 or percent >= PERCENT_OF:  # only equal sets are linked, and these are one class
        return np.empty(0, dtype=np.int64)
    own, sums = band_of(n, percent), np.zeros(n + 1, dtype=np.uint64)
    spread = mix(shingles ^ _GROUP_SALT)
    np.cumsum(spread, out=sums[1:])
    keys = []
    numbers = [own] if own == 0 or n * percent > band(own - 1, percent)[1] * PERCENT_OF else [own, own - 1]
    for number in numbers:
        if number == 0 and deletion_below(percent) > 1:
            if most_different(n + largest_partner(n, percent), percent):
                keys.append(mix(np.append(sums[-1] - spread, sums[-1])))
            continue
        _, high, k = band(number, percent)
        group = ((shingles >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)  # rises with the hash
        bounds = np.searchsorted(group, np.arange(k + 1, dtype=np.uint64))
        counts = np.diff(bounds)
        content = sums[bounds[1:]] - sums[bounds[:-1]]
        marks = mix(np.arange(k, dtype=np.uint64) + np.uint64(number << 32))
        found = mix(content + marks)
        # A partner filed here is of this band, or of the next larger one if this set is of this band.
        partner = largest_partner(n, percent) if number == own else high
        t = most_different(n + partner, percent)
        kept = next((m for m in (counts > 1, counts > 0) if m.sum() > t), slice(None))
        keys.append(found[kept])
    return np.unique(np.concatenate(keys)).view(np.int64) if keys else np.empty(0, dtype=np.int64)


def points(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """Per row: id, size, class (digest of the set), counts, bucket keys and a number of its own."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = [t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()]
        sets = shingle_sets(texts, n)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([len(s) for s in sets], type=pa.int64()),
                pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], type=pa.binary()),
                pa.array([group_counts(s) for s in sets], type=pa.binary()),
                pa.array([bucket_keys(s, percent) for s in sets], type=pa.list_(pa.int64())),
            ],
            names=["id", "key", "n", "cls", "counts", "keys"],
        )

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("key"),
        as_bytes(text_col).alias("text"),
    )
    found = map_arrow(rows, run, "id long, key long, n long, cls binary, counts binary, keys array<long>")
    return found.withColumn("row", F.monotonically_increasing_id())


# --- trees ---------------------------------------------------------------------------


class Points:
    """Counts of several sets, with the sizes and what the cut counts leave out."""

    def __init__(self, counts: list[bytes], sizes: list[int]):
        self.counts = np.frombuffer(b"".join(counts), dtype=np.uint8).reshape(len(sizes), GROUPS)
        self.sizes = np.asarray(sizes, dtype=np.int64)
        self.excess = self.sizes - self.counts.sum(axis=1, dtype=np.int64)


def needed(total: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The smallest intersection of linked sets whose sizes add up to ``total``."""
    return -(-total * percent // (percent + PERCENT_OF))


def overlap_bound(a: np.ndarray, b: np.ndarray, excess_a: np.ndarray, excess_b: np.ndarray) -> np.ndarray:
    """At most so many shingles are common: the sum of the smaller coordinates.

    Counts cut at 255 are made up for by the smaller of the two rests.
    """
    return np.minimum(a, b).sum(axis=-1, dtype=np.int64) + np.minimum(excess_a, excess_b)


class Tree:
    """Bounding boxes over points: leaves of ``LEAF`` points, ``LEAF`` boxes to a box above."""

    def __init__(self, p: Points, members: np.ndarray):
        # Packed along the size, then along the two coordinates that vary most.
        counts = p.counts[members]
        widest = np.argsort(-counts.var(axis=0), kind="stable")[:2]
        slab = np.lexsort((counts[:, widest[1]], counts[:, widest[0]] // 4, p.sizes[members] // 8))
        self.order = members[slab]
        self.levels = []
        high, smallest, rest = p.counts[self.order], p.sizes[self.order], p.excess[self.order]
        while True:
            cuts = np.arange(0, len(high), LEAF)
            high = np.maximum.reduceat(high, cuts, axis=0)
            smallest, rest = np.minimum.reduceat(smallest, cuts), np.maximum.reduceat(rest, cuts)
            self.levels.append((high, smallest, rest))
            if len(cuts) == 1:
                break

    def size(self, level: int) -> int:
        """Entries of a level; level -1 are the points."""
        return len(self.order) if level < 0 else len(self.levels[level][1])


def children(nodes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All entries below some nodes, and which of the nodes each belongs to."""
    sizes = np.minimum((nodes + 1) * LEAF, count) - nodes * LEAF
    owner = np.repeat(np.arange(len(nodes)), sizes)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return nodes[owner] * LEAF + within, owner


def tree_pairs(
    p: Points, left: Tree, right: Tree, same: bool, percent: int = PERCENT
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of points whose bound allows a link, in batches. ``same``: one tree with itself."""
    top = max(len(left.levels), len(right.levels)) - 1
    work = [(top, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while work:
        level, u, v = work.pop()
        if len(u) > NODE_PAIRS:
            half = len(u) // 2
            work += [(level, u[:half], v[:half]), (level, u[half:], v[half:])]
            continue
        if level >= 0:
            (hu, su, eu), (hv, sv, ev) = (t.levels[min(level, len(t.levels) - 1)] for t in (left, right))
            keep = overlap_bound(hu[u], hv[v], eu[u], ev[v]) >= needed(su[u] + sv[v], percent)
            u, v = u[keep], v[keep]
            if not len(u):
                continue
            # A tree that has no such level yet stays at its root.
            if level < len(left.levels):
                u, owner = children(u, left.size(level - 1))
                v = v[owner]
            if level < len(right.levels):
                v, owner = children(v, right.size(level - 1))
                u = u[owner]
            if same:
                keep = u <= v
                u, v = u[keep], v[keep]
            work.append((level - 1, u, v))
            continue
        a, b = left.order[u], right.order[v]
        keep = (a != b) & (
            overlap_bound(p.counts[a], p.counts[b], p.excess[a], p.excess[b]) >= needed(p.sizes[a] + p.sizes[b], percent)
        )
        if keep.any():
            yield a[keep], b[keep]


def nearest_earlier(p: Points, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """For each point the nearest one among those closer to the middle, if the bound allows a link."""
    middle = np.median(p.counts, axis=0)
    order = np.argsort(np.abs(p.counts - middle).sum(axis=1), kind="stable")
    counts, a, b = p.counts[order], [], []
    for i in range(1, len(order)):
        # An intersection bound high for the sizes: the likeliest partner.
        bound = overlap_bound(counts[:i], counts[i], p.excess[order[:i]], p.excess[order[i]])
        spare = bound - needed(p.sizes[order[:i]] + p.sizes[order[i]], percent)
        j = int(np.argmax(spare))
        if spare[j] >= 0:
            a.append(order[i])
            b.append(order[j])
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def likeliest_outside(
    p: Points, blocks: np.ndarray, roots: list[bytes], percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """For each point outside the largest component (block 0 or above) the likeliest one of another component."""
    numbers = {}
    component = np.array([numbers.setdefault(r, len(numbers)) for r in roots])
    a, b = [], []
    for i in np.flatnonzero(blocks >= 0):
        others = np.flatnonzero(component != component[i])
        if not len(others):
            continue
        bound = overlap_bound(p.counts[others], p.counts[i], p.excess[others], p.excess[i])
        spare = bound - needed(p.sizes[others] + p.sizes[i], percent)
        j = int(np.argmax(spare))
        if spare[j] >= 0:
            a.append(i)
            b.append(others[j])
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def bucket_pairs(rows: list[tuple], number: int, percent: int = PERCENT) -> Iterator[tuple[bytes, bytes]]:
    """Pairs of classes to verify from one bucket or pair of blocks, in round ``number``.

    Rows: (block, class, size, counts, component or None, blocks i and j).
    """
    p = Points([r[3] for r in rows], [r[2] for r in rows])
    i, j = rows[0][5], rows[0][6]
    blocks = np.array([r[0] for r in rows])
    if number == 1 and len(rows) > SMALL_BUCKET:
        found = [nearest_earlier(p, percent)]
    elif number == 2:
        found = [likeliest_outside(p, blocks, [r[4] for r in rows], percent)]
    else:
        here = np.flatnonzero(blocks == i)
        left = Tree(p, here)
        if i == j:
            found = tree_pairs(p, left, left, same=True, percent=percent)
        else:
            there = np.flatnonzero(blocks == j)
            both = len(there) and len(here)
            found = tree_pairs(p, left, Tree(p, there), same=False, percent=percent) if both else []
    for a, b in found:
        for x, y in zip(a.tolist(), b.tolist()):
            if rows[x][4] is None or rows[x][4] != rows[y][4]:
                yield (rows[x][1], rows[y][1]) if rows[x][1] < rows[y][1] else (rows[y][1], rows[x][1])


def hub_cells(filed: DataFrame) -> DataFrame:
    """First round: a block of a bucket meets the bucket's first block only, so rows grow with the bucket."""
    blocks = F.ceil(F.col("members") / FIRST_BLOCK).cast("int")
    block = F.pmod(F.hash("cls"), blocks)
    last = blocks - 1
    met = F.when(block > 0, F.array(block)).otherwise(F.sequence(F.least(last, F.lit(1)), last))
    return filed.select("bucket", block.alias("block"), "cls", "n", "counts", "root", "listed", F.lit(0).alias("i"),
                        F.explode(met).alias("j"))


def open_cells(filed: DataFrame) -> DataFrame:
    """Later rounds: rows outside a bucket's largest component meet all rows of the bucket.

    Blocks of the largest component have negative numbers; they do not meet each other.
    """
    sizes = filed.groupBy("bucket", "root").agg(F.count("*").alias("size"))
    top = sizes.groupBy("bucket").agg(
        F.max(F.struct("size", "root")).alias("top"), F.sum("size").alias("all")
    ).select("bucket", F.col("top.root").alias("top"), F.col("top.size").alias("inside"), "all")
    rows = filed.join(top, "bucket")
    own, others = (F.ceil(c / BLOCK).cast("int") for c in (F.col("inside"), F.col("all") - F.col("inside")))
    number = F.hash("cls")
    block = F.when(F.col("root") == F.col("top"), -1 - F.pmod(number, own)).otherwise(F.pmod(number, others))
    cell = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    each_other = F.sequence(F.lit(0), F.col("others") - 1)
    b = F.col("block")
    outside = F.concat(
        F.transform(F.sequence(F.lit(1), F.col("own")), lambda g: cell(-g, b)),
        F.transform(each_other, lambda o: cell(F.least(b, o), F.greatest(b, o))),
    )
    met = F.when(b < 0, F.transform(each_other, lambda o: cell(b, o))).otherwise(outside)
    rows = rows.select(
        "bucket", block.alias("block"), own.alias("own"), others.alias("others"), "cls", "n", "counts", "root", "listed"
    )
    return rows.withColumn("cell", F.explode(met)).select(
        "bucket", "block", "cls", "n", "counts", "root", "listed", "cell.i", "cell.j"
    )


def given_elsewhere(bucket: int, a: set[int], b: set[int]) -> bool:
    """Whether another bucket, the smallest of both lists, gives the pair."""
    common = a & b
    return bool(common) and min(common) != bucket


def candidates(filed: DataFrame, number: int, percent: int = PERCENT) -> DataFrame:
    """Distinct pairs ``a, b`` of classes from rows ``bucket, members, cls, n, counts, root, listed``.

    ``listed``: in the third round, buckets of the class that this round looks at
    if the class has a partner of another component there.
    """
    cells = hub_cells(filed) if number == 1 else open_cells(filed)
    cells = cells.select("bucket", "i", "j", "block", "cls", "n", "counts", "root", "listed")
    ordered = cells.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        out, given = [], set()
        for (bucket, i, j), group in groupby(rows, key=lambda r: r[:3]):
            group = list(group)
            members = [(*r[3:8], i, j) for r in group]
            listed = {r[4]: set(r[8] or ()) for r in group}
            if len(members) > 1:
                for pair in bucket_pairs(members, number, percent):
                    if pair not in given and not given_elsewhere(bucket, listed[pair[0]], listed[pair[1]]):
                        given.add(pair)
                        out.append(pair)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.binary()) for c in zip(*out)], names=["a", "b"])
                out = []
            if len(given) > GIVEN:
                given = set()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.binary()) for c in zip(*out)], names=["a", "b"])

    small_batches(filed.sparkSession)
    return ordered.mapInArrow(tidy(run), "a binary, b binary").distinct()


# --- verification ----------------------------------------------------------------------


def sets_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``cls, shingles`` for the classes in ``chosen`` (id, key, cls of one row each)."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("key"),
        as_bytes(text_col).alias("text"),
    )
    rows = join_rows(rows, chosen, small=fits_broadcast(chosen)).select("cls", "text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = shingle_sets([t or b"" for t in batch.column(1).to_pylist()], n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([s.tobytes() for s in sets], type=pa.binary())], names=["cls", "shingles"]
        )

    return map_arrow(rows, run, "cls binary, shingles binary").dropDuplicates(["cls"])


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return PERCENT_OF * common >= percent * (len(a) + len(b) - common)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose sets are really linked."""
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (2, 3)]
            keep = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(*columns)]
            yield batch.select([0, 1]).filter(pa.array(keep, type=pa.bool_()))

    small_batches(pairs.sparkSession)
    return both.mapInArrow(tidy(run), "a binary, b binary")


def membership(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``id, key, n, cls, root``: class and component (root: a class) of every row."""
    rows = materialise(points(docs, id_col, text_col, n, percent), "points")
    filled = rows.filter("n > 0")
    one = filled.groupBy("cls").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "row")).alias("r"), F.count("*").alias("rows")
    )
    several = one.filter("rows > 1").select("cls", F.col("r.row").alias("first"))
    copies = filled.select("cls", "row").join(several.hint("merge"), "cls").filter("row <> first")
    copies = materialise(copies.select("row"), "copies")
    classes = filled.join(F.broadcast(copies) if fits_broadcast(copies) else copies.hint("merge"), "row", "left_anti")

    # One shuffle of the keys: a bucket's members are counted where they meet.
    keyed = classes.select("row", F.explode("keys").alias("bucket"))
    met = keyed.withColumn("members", F.count("*").over(Window.partitionBy("bucket"))).filter("members > 1")
    of_class = met.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("bucket", "members"))).alias("buckets"))
    filed = classes.select("row", "cls", "n", "counts").join(of_class.hint("merge"), "row").drop("row")
    filed = materialise(filed, "filed")
    large = F.filter("buckets", lambda b: b["members"] > SMALL_BUCKET)
    listed = F.transform(F.slice(large, 1, LISTED), lambda b: b["bucket"])

    ids = classes.select("cls", "id", "key")
    links = None
    for number in (1, 2, 3):
        if number == 1:
            # Large buckets of one group have much the same members: some of them tell most links.
            some = (F.col("members") <= SMALL_BUCKET) | (F.pmod(F.xxhash64("bucket"), F.lit(FIRST_SHARE)) == 0)
            asked = filed.select("cls", "n", "counts", F.inline("buckets")).filter(some)
            asked = asked.withColumn("root", F.lit(None).cast("binary"))
        else:
            # Buckets that are small, or in one component as a whole, are settled.
            known = materialise(components(links), "known")
            asked = filed.select("cls", "n", "counts", listed.alias("listed"), large.alias("large")).filter(
                F.size("large") > 0
            ).join(known.withColumnRenamed("node", "cls"), "cls", "left")
            asked = asked.select("cls", "n", "counts", "listed", F.coalesce("root", "cls").alias("root"), F.inline("large"))
            open_ones = asked.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"))
            asked = asked.join(open_ones.filter("x <> y").select("bucket"), "bucket", "left_semi")
        if number < 3:
            asked = asked.withColumn("listed", F.lit(None).cast("array<long>"))
        pairs = materialise(candidates(asked, number, percent), "pairs")
        wanted = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
        chosen = materialise(ids.join(wanted, "cls", "left_semi"), "wanted")
        found = verified(pairs, sets_of(docs, chosen, id_col, text_col, n), percent)
        if number > 1:
            # The stars of the rounds before stand for their links.
            found = found.unionByName(known.select(F.col("node").alias("a"), F.col("root").alias("b")))
        links = materialise(found, "verified")
    roots = components(links)
    roots = materialise(roots.withColumnRenamed("node", "cls"), "roots")
    side = F.broadcast(roots) if fits_broadcast(roots) else roots
    out = rows.select("id", "key", "n", "cls").join(side, "cls", "left")
    return out.select("id", "key", "n", "cls", F.coalesce("root", "cls").alias("root"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: one row per row of ``docs``."""
    found = materialise(membership(docs), "membership")
    smallest = found.filter("n > 0").groupBy("root").agg(F.min("id").alias("component_id"))
    side = F.broadcast(smallest) if fits_broadcast(smallest) else smallest
    return found.join(side, "root", "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of every component: the smallest id, then the smallest text hash.

    Rows with an empty set are all kept.
    """
    found = materialise(membership(docs, id_col, text_col, n, percent), "membership")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    first = found.filter("n > 0").groupBy("root").agg(F.min(order).alias("f"))
    first = first.select("root", F.col("f.id").alias("first_id"), F.col("f.key").alias("first_key"))
    others = found.filter("n > 0").join(first, "root").filter(
        ~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key")))
    )
    others = materialise(others.select(F.col("id").alias("_id"), F.col("key").alias("_key")).distinct(), "others")
    side = F.broadcast(others) if fits_broadcast(others) else others
    text = F.col(text_col).cast("string")
    mine = F.col(id_col).cast("long").eqNullSafe(side._id) & (F.xxhash64(text) == side._key)
    kept = docs.join(side, mine, "left_anti")
    repeated = found.filter("n > 0").groupBy("id", "key").count().filter("count > 1").select(
        F.col("id").alias("_id"), F.col("key").alias("_key")
    )
    if repeated.isEmpty():
        return kept
    # Whole rows that occur several times: one of each stays.
    repeated = materialise(repeated, "repeated")
    twice = docs[id_col].cast("long").eqNullSafe(repeated._id) & (F.xxhash64(text) == repeated._key)
    single = kept.join(repeated, twice, "left_anti")
    return single.unionByName(kept.join(repeated, twice, "left_semi").dropDuplicates([id_col, text_col]))
