"""N-gram Jaccard join by grouped prefixes.

The shingles of a document are put into one global order, rarest first. Two sets with
a Jaccard similarity of at least t share a shingle among the first ``n - ceil(t n) + 1``
of each, their prefixes. Documents of equal sets form a class, classes of equal size
and prefix a group; group pairs are filtered by size and by what their prefixes share,
and only the members of the groups that are left are compared.

Groups are dealt into blocks of similar documents. Blocks meet, in a task of their own,
if their prefixes share enough shingles, and bring those members that share enough with
the other block. A set so travels once per partner block instead of once per candidate,
and a task holds two blocks, whatever the size of a family of near copies; what it
returns is one row per document, not per pair.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, prepare, read, stored, texts_of
from .components import components
from .tokens import WORD_BASE, Block, mix, span_hashes

SHINGLE = 5
PERCENT = 80
# Counters of the frequency sketch, two rows of them: the size is fixed, so that what is
# merged and broadcast does not grow with the documents.
SLOTS = 1 << 19
SLICE = 1 << 14
# Documents and shingles of a block that meets others in one task.
BLOCK_DOCUMENTS = 256
BLOCK_SHINGLES = 1_000_000
# Bits of the filters that spare most shingles and sets without a partner a shuffle; a
# filter lets more of them through as it fills up and never drops one that is wanted.
FILTER_BITS = 1 << 26
COLUMNS_AT_ONCE = 4096
# Pairs of blocks (48 bytes each) that are broadcast; more of them are joined.
BROADCAST_PAIRS = 300_000

_OTHER = np.uint64(0xA0761D6478BD642F)


def shingle_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block of texts, and the first one of each text; a text
    of fewer words has its whole sequence."""
    n = np.where(block.n_words >= SHINGLE, block.n_words - SHINGLE + 1, block.n_words > 0)
    first = np.concatenate(([0], np.cumsum(n)))
    starts = np.arange(first[-1]) + np.repeat(block.first[:-1] - first[:-1], n)
    ends = np.minimum(starts + SHINGLE, np.repeat(block.first[1:], n))
    return span_hashes(block.word_hashes(), starts, ends, WORD_BASE), first


def prefix_size(n: np.ndarray | int) -> np.ndarray | int:
    return n + 1 + (-n * PERCENT) // 100


def least_shared(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Fewest shingles that sets of sizes n and m must share to be linked."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(SLOTS - 1)
    return (hashes & mask).astype(np.int64), (hashes >> np.uint64(40) & mask).astype(np.int64)


def _lowered(batch: pa.RecordBatch) -> list[bytes]:
    return [text.lower() for text in texts_of(batch)]  # of bytes: A to Z only


def frequency_classes(docs: DataFrame) -> np.ndarray:
    """A byte for each counter of the sketch: a quarter of a power of two of how far the
    shingles counted there exceed the average counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros((2, SLOTS), np.uint64)
        for batch in batches:
            texts = _lowered(batch)
            for start, end in blocks(texts):
                hashes, _ = shingle_hashes(Block(texts[start:end]))
                for row, slots in zip(counters, _slots(hashes)):
                    row += np.bincount(slots, minlength=SLOTS).astype(np.uint64)
        if counters.any():
            yield _slices(counters.ravel())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            found = zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist())
            for k, raw in found:
                counts = np.frombuffer(zlib.decompress(raw), "<u4").astype(np.uint64)
                sums[k] = sums[k] + counts if k in sums else counts
        for k, counts in sums.items():
            yield _slices(counts, k)

    spark, schema = docs.sparkSession, "slice int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema)
    merged = parts.repartition("slice").mapInArrow(add, schema)
    total = np.zeros(2 * SLOTS, np.uint32)
    # As many rows as there are slices, whatever the documents.
    for row in stored(merged, "jaccard-sketch").toLocalIterator():
        low = row["slice"] * SLICE
        total[low : low + SLICE] = np.frombuffer(zlib.decompress(row["counts"]), "<u4")
    total = total.reshape(2, SLOTS).astype(np.float64)
    above = np.maximum(total - total.mean(axis=1, keepdims=True), 1)
    return np.minimum(np.rint(4 * np.log2(above)), 255).astype(np.uint8)


def _slices(counters: np.ndarray, first: int = 0) -> pa.RecordBatch:
    """Rows of ``SLICE`` counters; those beyond 32 bits stay at the largest number."""
    counters = np.minimum(counters, np.uint64(0xFFFFFFFF)).astype("<u4")
    raw = [zlib.compress(counters[i : i + SLICE].tobytes(), 1) for i in range(0, len(counters), SLICE)]
    numbers = pa.array(range(first, first + len(raw)), pa.int32())
    return pa.RecordBatch.from_arrays([numbers, pa.array(raw, pa.binary())], names=["slice", "counts"])


def _ordered_sets(texts: list[bytes], classes: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, rare ones first."""
    hashes, first = shingle_hashes(Block(texts))
    ones, others = _slots(hashes)
    rank = np.minimum(classes[0][ones], classes[1][others]).astype(np.uint64) << np.uint64(56)
    rank |= hashes >> np.uint64(8)
    for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
        own, at = np.unique(hashes[low:high], return_index=True)
        yield own[np.argsort(rank[low:high][at], kind="stable")]


def _key(ordered: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    sums = [mix(ordered).sum(dtype=np.uint64), mix(ordered ^ _OTHER).sum(dtype=np.uint64)]
    return np.array(sums, "<u8").tobytes()


def prefixes(docs: DataFrame, classes) -> DataFrame:
    """(doc_id, n, key, family, alike, near, prefix) of each document.

    ``key`` tells sets apart and ``family`` groups of one size and prefix. ``alike`` and
    ``near`` are the least of two hashes over the more frequent half of the set, which
    near copies mostly have in common.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _lowered(batch)
            for start, end in blocks(texts):
                rows = []
                for own in _ordered_sets(texts[start:end], classes.value):
                    n = len(own)
                    if not n:
                        rows.append((0, None, None, None, None, None))
                        continue
                    prefix = own[: prefix_size(n)]
                    family = hashlib.blake2b(prefix.tobytes(), digest_size=16, salt=n.to_bytes(8))
                    common = own[n // 2 :]
                    marks = [int(x.min().view(np.int64)) for x in (mix(common ^ _OTHER), mix(~common))]
                    rows.append((n, _key(own), family.digest(), *marks, prefix.view(np.int64)))
                ids = batch.column("doc_id").slice(start, end - start)
                columns = [pa.array(x, t) for x, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *names])

    names = ["n", "key", "family", "alike", "near", "prefix"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {id_type}, n long, key binary, family binary, alike long, near long, "
        "prefix array<long>",
    )


def in_blocks(found: DataFrame) -> DataFrame:
    """``found`` with a short ``id`` of the key and the ``block`` of each document that has
    shingles.

    Documents with one ``alike`` make a block; too large ones are told apart by ``near``
    and then by their key. Only the few large ones are listed for that, by counts of
    classes, so the rows of ``found`` stay where they are.
    """
    found = found.filter("n > 0")
    classes = found.groupBy("key", "alike", "near", "n").agg(F.lit(1).alias("one"))
    sizes = classes.groupBy("alike", "near").agg(
        F.count("*").alias("classes"), F.sum("n").alias("shingles")
    )
    sizes = stored(sizes, "jaccard-sizes")
    needed = F.ceil(
        F.greatest(F.sum("classes") / BLOCK_DOCUMENTS, F.sum("shingles") / BLOCK_SHINGLES)
    ).cast("int")
    large = sizes.groupBy("alike").agg(needed.alias("parts")).filter("parts > 1")
    larger = sizes.groupBy("alike", "near").agg(needed.alias("pieces")).filter("pieces > 1")
    large, larger = stored(large, "jaccard-large"), stored(larger, "jaccard-larger")
    is_large = F.col("parts").isNotNull()
    piece = F.when(is_large & F.col("pieces").isNotNull(), F.pmod(F.xxhash64("key"), "pieces"))
    block = F.xxhash64("alike", F.when(is_large, F.col("near")), piece)
    joined = found.join(large, "alike", "left").join(larger, ["alike", "near"], "left")
    return joined.select(*found.columns, F.xxhash64("key").alias("id"), block.alias("block"))


def shared_shingles(placed: DataFrame, members: DataFrame) -> DataFrame:
    """(shingle, id, block, n): the classes whose prefixes have a shingle that another
    class has in its prefix too.

    A shingle in two places gives its classes straight from the counting; only those in
    more places are looked up again, by a filter that leaves few others to be shuffled.
    """
    firsts = placed.select("id", F.explode("prefix").alias("shingle"))
    counted = firsts.groupBy("shingle").agg(
        F.count("*").alias("places"), F.min("id").alias("one"), F.max("id").alias("two")
    )
    counted = stored(counted.filter("one < two"), "jaccard-shared")
    many = stored(counted.filter("places > 2").select("shingle"), "jaccard-many")
    pairs = counted.filter("places = 2").select("shingle", F.explode(F.array("one", "two")).alias("id"))
    bits = filter_bits(many, F.col("shingle").bitwiseAND(F.lit(FILTER_BITS - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            shingles = lists.flatten().to_numpy()
            slots = shingles & (FILTER_BITS - 1)
            kept = np.flatnonzero(bits.value[slots >> 6] >> (slots & 63) & 1)
            of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[kept]
            columns = [pa.array(shingles[kept]), batch.column("id").take(pa.array(of))]
            yield pa.RecordBatch.from_arrays(columns, names=["shingle", "id"])

    likely = placed.select("id", "prefix").mapInArrow(run, "shingle long, id long").distinct()
    found = pairs.unionByName(likely.join(many, "shingle").select("shingle", "id"))
    return stored(found.join(members.select("id", "block", "n"), "id"), "jaccard-hits")


def meetings(hits: DataFrame) -> DataFrame:
    """(low, high, block, id): the classes that are to be compared in the meeting of two
    blocks, or of a block with itself (``low = high``).

    What two linked classes share in their prefixes is among what their blocks share and
    among what one of them shares with the other's block, so the bound on it (see
    :func:`group_pairs`) holds for both counts, with the sizes for which it is least.
    """
    blocks_of = stored(
        hits.groupBy("shingle", "block").agg(
            F.count("*").alias("size"), F.min("n").alias("least"), F.max("n").alias("most")
        ),
        "jaccard-postings",
    )
    sides = [
        blocks_of.select(
            "shingle", F.col("block").alias(side), F.col("least").alias(f"least_{side}"),
            F.col("most").alias(f"most_{side}"), F.col("size").alias(f"size_{side}"),
        )
        for side in ("low", "high")
    ]
    fits = (F.col("most_low") * 100 >= F.col("least_high") * PERCENT) & (
        F.col("most_high") * 100 >= F.col("least_low") * PERCENT
    )
    apart = (F.col("low") < F.col("high")) | ((F.col("low") == F.col("high")) & (F.col("size_low") > 1))
    met = stored(sides[0].join(sides[1], "shingle").filter(apart & fits), "jaccard-meetings")
    pairs = met.groupBy("low", "high").agg(
        F.count("*").alias("shared"),
        *(F.min(f"least_{x}").alias(f"least_{x}") for x in ("low", "high")),
        *(F.max(f"most_{x}").alias(f"most_{x}") for x in ("low", "high")),
    )
    enough = (F.col("shared") >= _needed("most_low", "least_high")) | (
        F.col("shared") >= _needed("most_high", "least_low")
    )
    pairs = stored(pairs.filter(enough).drop("shared"), "jaccard-pairs")
    if pairs.count() <= BROADCAST_PAIRS:
        pairs = F.broadcast(pairs)
    # Both sides of a meeting, each with the sizes of the other one.
    ends = met.select("shingle", "low", "high").join(pairs, ["low", "high"])
    other = {"low": "high", "high": "low"}
    of_sides = [
        ends.select(
            "shingle", "low", "high", F.col(side).alias("block"),
            F.col(f"least_{other[side]}").alias("least"), F.col(f"most_{other[side]}").alias("most"),
        ).filter(F.lit(side == "low") | (F.col("low") < F.col("high")))
        for side in ("low", "high")
    ]
    members = of_sides[0].unionByName(of_sides[1]).join(hits, ["shingle", "block"])
    counted = members.groupBy("low", "high", "block", "id", "n", "least", "most").agg(
        F.count("*").alias("shared")
    )
    enough = (F.col("shared") >= _needed("n", "least")) | (F.col("shared") >= _needed("most", "n"))
    return counted.filter(enough).select("low", "high", "block", "id")


def _needed(largest: str, smallest: str) -> Column:
    """Fewest shingles that the prefixes of linked sets share, if the larger set has at
    most ``largest`` and the smaller one at least ``smallest``: the bound is least for the
    largest set and the smallest one that fits it."""
    m = F.col(largest)
    n = F.greatest(F.ceil(m * PERCENT / 100), F.least(F.col(smallest), m))
    shared = F.ceil((n + m) * PERCENT / (100 + PERCENT))
    return F.greatest(F.lit(1), shared - (F.ceil(m * PERCENT / 100) - 1))


def filter_bits(wanted: DataFrame, slot: Column) -> Broadcast:
    """A bit for each slot of ``wanted``; of fixed size, so it can be broadcast."""
    words = (
        wanted.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(pmod(slot, 64) as int))) AS bits"))
        .toArrow()
    )
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return wanted.sparkSession.sparkContext.broadcast(bits)


def sets_of(docs: DataFrame, wanted: DataFrame, classes) -> DataFrame:
    """(key, shingles): the ordered set of every ``wanted`` key, once."""
    shared = filter_bits(wanted, F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            texts = _lowered(batch)
            for start, end in blocks(texts):
                found = {}
                for own in _ordered_sets(texts[start:end], classes.value):
                    if len(own):
                        key = _key(own)
                        # As the JVM's xxhash64: seed 42, and pmod of a signed number.
                        at = xxhash.xxh64_intdigest(key, 42) % FILTER_BITS
                        if shared.value[at >> 6] >> (at & 63) & 1:
                            found[key] = own.astype("<u8").tobytes()
                columns = [pa.array(x, pa.binary()) for x in (found.keys(), found.values())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "shingles"])

    made = docs.select("text").mapInArrow(run, "key binary, shingles binary")
    return made.dropDuplicates(["key"])


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each array of ``left`` has in common with each of ``right``."""
    if len(left) == len(right) == 1:
        return np.array([[len(np.intersect1d(left[0], right[0], assume_unique=True))]])
    sides = [np.concatenate(x) for x in (left, right)]
    common = np.intersect1d(np.unique(sides[0]), np.unique(sides[1]), assume_unique=True)
    counts = np.zeros((len(left), len(right)), np.float32)
    if not len(common):
        return counts.astype(np.int64)
    entries = []
    for side, arrays in zip(sides, (left, right)):
        at = np.searchsorted(common, side)
        hit = common[np.minimum(at, len(common) - 1)] == side
        entries.append((np.repeat(np.arange(len(arrays)), list(map(len, arrays)))[hit], at[hit]))
    for low in range(0, len(common), COLUMNS_AT_ONCE):
        parts = []
        for (row, column), arrays in zip(entries, (left, right)):
            here = (column >= low) & (column < low + COLUMNS_AT_ONCE)
            width = min(COLUMNS_AT_ONCE, len(common) - low)
            part = np.zeros((len(arrays), width), np.float32)
            part[row[here], column[here] - low] = 1
            parts.append(part)
        counts += parts[0] @ parts[1].T
    return counts.astype(np.int64)


class Members:
    """The classes of one block in a task, collected into groups."""

    def __init__(self, rows: list[tuple[bytes, int, bytes]]):
        self.keys = [key for key, _, _ in rows]
        self.copies = np.array([copies for _, copies, _ in rows], np.int64)
        self.sets = [np.frombuffer(raw, "<u8") for _, _, raw in rows]
        self.n = np.array([len(x) for x in self.sets], np.int64)
        places: dict[tuple[int, bytes], int] = {}
        groups, firsts = [], []
        for own in self.sets:
            prefix = own[: prefix_size(len(own))]
            group = places.setdefault((len(own), prefix.tobytes()), len(places))
            if group == len(firsts):
                firsts.append(prefix)
            groups.append(group)
        self.group, self.prefixes = np.array(groups), firsts
        self.group_n = np.array([n for n, _ in places], np.int64)


def group_pairs(left: Members, right: Members) -> np.ndarray:
    """Which groups of both sides may hold linked members.

    Sizes must fit. What two sets share lies in both prefixes up to the end of the one
    that ends first in the global order, and beyond it at most the rest of that set.
    """
    n, m = left.group_n[:, None], right.group_n[None, :]
    fits = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
    shared = shared_counts(left.prefixes, right.prefixes)
    rest = np.maximum(n - prefix_size(n), m - prefix_size(m))
    return fits & (shared > 0) & (shared + rest >= least_shared(n, m))


def linked(left: Members, right: Members) -> np.ndarray:
    """Which members of both sides are linked."""
    pairs = group_pairs(left, right)[left.group][:, right.group]
    rows, columns = np.flatnonzero(pairs.any(1)), np.flatnonzero(pairs.any(0))
    if len(rows):
        shared = shared_counts([left.sets[i] for i in rows], [right.sets[j] for j in columns])
        together = left.n[rows][:, None] + right.n[columns][None, :] - shared
        pairs[np.ix_(rows, columns)] &= 100 * shared >= PERCENT * together
    return pairs


def _roots(links: np.ndarray, n: int) -> list[int]:
    """The least node of the component of each of ``n`` nodes."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in links.tolist():
        i, j = root(i), root(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
    return [root(i) for i in range(n)]


def meet(low: list[tuple], high: list[tuple] | None) -> list[tuple[bytes, int, bytes]]:
    """(key, links, root) of the linked members of two blocks, or of one with itself."""
    left = Members(low)
    right = left if high is None else Members(high)
    found = linked(left, right)
    keys = left.keys if high is None else left.keys + right.keys
    if high is None:
        np.fill_diagonal(found, False)
        links = found @ left.copies
        pairs = np.argwhere(np.triu(found))
    else:
        links = np.concatenate((found @ right.copies, found.T @ left.copies))
        pairs = np.argwhere(found) + [0, len(left.keys)]
    roots = _roots(pairs, len(keys))
    return [(keys[i], int(links[i]), keys[roots[i]]) for i in np.flatnonzero(links)]


def compare(sets: DataFrame, members: DataFrame, met: DataFrame) -> DataFrame:
    """(key, links, root) of the linked classes of every meeting ``met`` of two blocks."""
    tasks = (
        met.join(members.select("id", "key", "copies"), "id")
        .join(sets, "key")
        .select("low", "high", "block", "key", "copies", "shingles")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            found = []
            for low, high, block, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (low, high) != current:
                    found += _task(current, rows)
                    current, rows = (low, high), []
                rows.append((block, *row))
            yield _rows(found)
        yield _rows(_task(current, rows))

    return (
        tasks.repartition("low", "high").sortWithinPartitions("low", "high")
        .mapInArrow(run, "key binary, links long, root binary")
    )


def _task(pair: tuple[int, int] | None, rows: list[tuple]) -> list[tuple[bytes, int, bytes]]:
    if not pair:
        return []
    low, high = pair
    sides = [sorted(row[1:] for row in rows if row[0] == block) for block in pair]
    if not all(sides):
        return []
    return meet(sides[0], None if low == high else sides[1])


def _rows(found: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[], [], []]
    types = [pa.binary(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip(columns, types)], names=["key", "links", "root"]
    )


def jaccard_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) of each document.

    Documents whose distinct five-word shingles have a Jaccard similarity of at least
    0.8 are linked; ``n_links`` counts the other rows a row is linked with, and
    component_id is the smallest doc_id that links reach. Words are runs of bytes other
    than ASCII blanks with A to Z in lower case; a text of one to four words has its
    whole sequence. A NULL text or one without words has no shingles and no links. Rows
    that repeat are documents of their own, so linked with each other; a row without
    doc_id counts but names no component, unless none of its component has one. An empty
    table gives no rows, further columns are ignored, and texts of any length are
    compared whole. Shingles are told apart by 64 bits.
    """
    prepare(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    classes = context.broadcast(frequency_classes(docs))
    found = stored(prefixes(docs, classes), "jaccard-prefixes")
    placed = in_blocks(found)
    members = placed.groupBy("id", "key", "n", "block").agg(F.count("*").alias("copies"))
    members = stored(members, "jaccard-members")
    met = stored(meetings(shared_shingles(placed, members)), "jaccard-tasks")
    wanted = members.join(met.select("id").distinct(), "id", "left_semi")
    sets = sets_of(docs, stored(wanted.select("key"), "jaccard-wanted"), classes)
    compared = stored(compare(sets, members, met), "jaccard-links")
    roots = components(compared.select(F.col("key").alias("a"), F.col("root").alias("b")))

    ids = found.select("doc_id", "n", "key")
    degree = compared.groupBy("key").agg(F.sum("links").alias("links"))
    by_class = (
        ids.filter("n > 0").groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"))
        .join(degree, "key", "left")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    by_class = stored(by_class, "jaccard-linked")
    # Only classes with a link share a component; the others are their own.
    shared = by_class.filter("links > 0").groupBy("root").agg(F.min("least").alias("first"))
    by_class = by_class.join(shared, "root", "left").select(
        F.col("key").alias("of"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("first", "least").alias("component_id"),
    )
    return ids.join(by_class, F.col("key") == F.col("of"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op11_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read(spark, sf_dir, "documents"))
