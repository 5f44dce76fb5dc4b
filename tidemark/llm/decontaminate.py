"""Benchmark decontamination by edit distance.

A CGK random walk reads a window word by word: at each step it writes the word under
its pointer, and a random bit of (step, word) says whether the pointer moves on. Two
windows a few edits apart fall back in step, so their walks differ in few places: edit
distance has become Hamming distance. Keys made of a few sampled places, repeated,
find the windows that resemble an item; an exact edit distance verifies them.

A q-gram count comes first and is lossless: a window within d edits of an item keeps
all but 2 d of its word pairs, so only windows with enough pairs are embedded.

Long items are searched by their pieces, since walks through long windows part for good.
A copy within the rate of edits has a piece within it; the whole item is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import blocks, prepare, read, release, stored, texts_of

# Edits per word of an item up to which a passage counts as a copy of it.
EDIT_RATE = 0.2
MIN_ITEM_WORDS = 5
# Items up to this much longer than the shortest of their class share its window size.
CLASS_GROWTH = 1.1
REPETITIONS = 64
SAMPLED = 3
# One bit per class and slot. The tables grow with the benchmark up to the larger size;
# beyond it they let more windows through, and lose none.
PAIR_SLOTS = 1 << 22, 1 << 24
KEY_SLOTS = 1 << 20, 1 << 24
# Windows walked together.
WALKED = 256
# Words of items verified together.
VERIFIED = 1 << 17
# Items of twice as many words or more are cut into even pieces of at least as many.
PIECE_WORDS = 32

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def max_edits(n_words: int) -> int:
    return int(n_words * EDIT_RATE)


def size_classes() -> list[int]:
    """Smallest size of each class of items or pieces, and one beyond the last class."""
    sizes = [MIN_ITEM_WORDS]
    while sizes[-1] < 2 * PIECE_WORDS:
        sizes.append(max(sizes[-1] + 1, int(np.ceil(sizes[-1] * CLASS_GROWTH))))
    return sizes


SIZES = size_classes()


def class_of(n_words: int) -> int:
    return int(np.searchsorted(SIZES, n_words, "right")) - 1


def class_edits(number: int) -> int:
    """Edits that the longest item of a class may have."""
    return max_edits(SIZES[number + 1] - 1)


def pieces(words: np.ndarray) -> list[np.ndarray]:
    """An item as a whole or, if it is long, in even parts. An edit falls into one part,
    so a copy with at most EDIT_RATE edits per word has a part with no more either."""
    n = max(1, len(words) // PIECE_WORDS)
    return [words[len(words) * i // n : len(words) * (i + 1) // n] for i in range(n)]


def words_block(texts: list[bytes]) -> tuple[tokens.Block, np.ndarray]:
    """Words of lower-case texts without ASCII punctuation, and their hashes."""
    block = tokens.Block([t.translate(None, _PUNCTUATION) for t in texts])
    return block, block.word_hashes()


def pair_slots(hashes: np.ndarray, slots: int) -> np.ndarray:
    """Slot of each pair of neighbouring words."""
    pairs = tokens.mix(hashes[:-1] * np.uint64(tokens.BASE) + hashes[1:])
    return (pairs % np.uint64(slots)).astype(np.int64)


def table_size(entries: int, least: int, most: int) -> int:
    """Slots for a table of ``entries``, a power of two."""
    return min(max(least, 1 << (16 * entries).bit_length()), most)


@lru_cache(maxsize=256)
def _walk(number: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled steps of each walk, and an odd factor for each step of it. The walks are
    ordered by their last step, so that those under way are the last ones."""
    steps = 2 * size
    rng = np.random.default_rng(1000 + number)
    picked = np.sort(
        np.array([rng.choice(steps, min(SAMPLED, steps), False) for _ in range(REPETITIONS)]), 1
    )
    picked = picked[np.argsort(picked[:, -1], kind="stable")]
    return picked, rng.integers(0, 1 << 63, (steps, REPETITIONS), dtype=np.uint64) | np.uint64(1)


def walk_keys(windows: np.ndarray, number: int) -> np.ndarray:
    """LSH keys (windows, REPETITIONS) of windows of the size of a class."""
    n, size = windows.shape
    picked, factors = _walk(number, size)
    padded = np.column_stack([windows, np.zeros((n, size + 1), np.uint64)]).ravel()
    at = np.repeat(np.arange(n)[:, None] * (2 * size + 1), REPETITIONS, 1)
    keys = tokens.mix(
        np.arange(REPETITIONS, dtype=np.uint64) + np.uint64(number * REPETITIONS + 1)
    )[None, :].repeat(n, 0)
    for step in range(picked.max() + 1):
        begin = int(np.searchsorted(picked[:, -1], step))
        word = padded[at[:, begin:]]
        use = np.flatnonzero((picked[begin:] == step).any(1))
        if len(use):
            now = keys[:, begin + use] * np.uint64(tokens.BASE) + word[:, use]
            keys[:, begin + use] = tokens.mix(now)
        at[:, begin:] += ((word * factors[step, begin:]) >> np.uint64(63)).astype(np.int64)
    return keys


def edit_distances(items: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Least edit distance of each item to any window of its region, in words."""
    n, m = items.shape[1], regions.shape[1]
    steps = np.arange(m + 1)
    row = np.zeros((len(items), m + 1), np.int32)
    for i in range(n):
        best = np.empty_like(row)
        best[:, 0] = i + 1
        change = row[:, :-1] + (regions != items[:, i : i + 1])
        best[:, 1:] = np.minimum(change, row[:, 1:] + 1)
        # A run of inserted words: the least of best[k] + (j - k) over k up to j.
        row = np.minimum.accumulate(best - steps, 1) + steps
    return row.min(1)


# Digests (32 bytes each) of contaminated texts that are broadcast.
BROADCAST_HITS = 500_000


@dataclass
class Screen:
    """For each word pair slot, a mask of the classes with an item that has the pair."""

    masks: np.ndarray
    classes: list[int]
    # Which slots of a key belong to an item.
    keys: np.ndarray
    # Words of the longest item with a piece in the class, 0 without pieces.
    longest: dict[int, int]

    def windows(self, hashes: np.ndarray, block: tokens.Block) -> list[tuple[int, np.ndarray]]:
        """(class, first words) of all windows with enough pairs of their class."""
        if len(hashes) < 2 or not self.classes:
            return []
        pairs = self.masks[pair_slots(hashes, len(self.masks))]
        at = np.arange(len(hashes))
        last = block.first[1:][block.word_text()] - 1  # of the text of each word
        found = []
        for number in self.classes:
            size = SIZES[number]
            has = (pairs >> np.uint64(number)) & np.uint64(1)
            total = np.concatenate(([0], np.cumsum(has.astype(np.int64))))
            # Windows may run over the end of a text, as a damaged copy can be shorter, but
            # nothing of the next text counts.
            count = total[np.minimum(at + size - 1, last)] - total[at]
            enough = np.flatnonzero(count >= max(1, size - 1 - 2 * class_edits(number)))
            if len(enough):
                found.append((number, enough))
        return found

    def items_keys(self, keys: np.ndarray) -> np.ndarray:
        """Which keys an item may have; never False for a key of one."""
        return self.keys[(keys & np.uint64(len(self.keys) - 1)).astype(np.int64)]


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item_id, class, words, keys, n_words, whole) of the pieces of the items with enough
    words; the first piece of an item carries all its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, hashes = words_block(texts_of(batch, lower=True))
            rows = []
            for i, item in enumerate(batch.column("item_id").to_pylist()):
                words = hashes[block.first[i] : block.first[i + 1]]
                if len(words) >= MIN_ITEM_WORDS:
                    for k, piece in enumerate(pieces(words)):
                        number = class_of(len(piece))
                        keys = walk_keys(piece[None, : SIZES[number]], number)[0].view(np.int64)
                        whole = None if k else words.view(np.int64)
                        rows.append(
                            (item, number, piece.view(np.int64), keys, len(words), whole)
                        )
            names = ["item_id", "class", "words", "keys", "n_words", "whole"]
            columns = list(zip(*rows)) or [[]] * 6
            many = pa.list_(pa.int64())
            types = [batch.schema.field("item_id").type, pa.int32(), many, many, pa.int32(), many]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

    id_type = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", "text").mapInArrow(
        run,
        f"item_id {id_type}, class int, words array<long>, keys array<long>, n_words int, "
        "whole array<long>",
    )


def build_screen(items: DataFrame) -> Screen:
    """Masks of all items' word pairs and slots of all their keys; as many rows as the
    tables have slots reach the driver at most."""
    sizes = items.agg(F.sum(F.size("words")), F.sum(F.size("keys"))).first()
    slots = table_size(sizes[0] or 0, *PAIR_SLOTS)
    keys = np.zeros(table_size(sizes[1] or 0, *KEY_SLOTS), bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers = [], []
            for number, words in zip(batch.column("class").to_pylist(), batch.column("words")):
                own = pair_slots(np.array(words.as_py(), np.int64).view(np.uint64), slots)
                at.append(own)
                numbers.append(np.full(len(own), 1 << number if number < 63 else -(1 << 63)))
            if at:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(at)), pa.array(np.concatenate(numbers))],
                    names=["slot", "mask"],
                )

    masks = np.zeros(slots, np.uint64)
    table = (
        items.select("class", "words").mapInArrow(run, "slot long, mask long")
        .groupBy("slot").agg(F.bit_or("mask").alias("mask")).toPandas()
    )
    masks[table["slot"].to_numpy(int)] = table["mask"].to_numpy(np.int64).view(np.uint64)
    own = (
        items.select(F.explode("keys").alias("key"))
        .select(F.col("key").bitwiseAND(F.lit(len(keys) - 1)).alias("slot")).distinct().toPandas()
    )
    keys[own["slot"].to_numpy(int)] = True
    is_piece = F.col("n_words") > F.size("words")
    longest = items.groupBy("class").agg(F.max(F.when(is_piece, F.col("n_words")).otherwise(0)))
    found = dict(map(tuple, longest.collect()))
    return Screen(masks, sorted(found), keys, found)


def suspicious_windows(docs: DataFrame, screen: Screen) -> DataFrame:
    """(doc_id, class, region, keys) of the windows that pass the screen and have a key
    that an item may have; neighbouring ones, up to the size of a window or of the longest
    item in pieces apart, are one row with the words around all and the keys of any."""
    shared = docs.sparkSession.sparkContext.broadcast(screen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            texts, ids = texts_of(batch, lower=True), batch.column("doc_id")
            for start, end in blocks(texts):
                block, hashes = words_block(texts[start:end])
                for number, places in shared.value.windows(hashes, block):
                    at, keys = _matching_keys(shared.value, hashes, block, number, places)
                    if not len(at):
                        continue
                    of = np.searchsorted(block.first, at, "right") - 1
                    longest = shared.value.longest[number]
                    cell = (at - block.first[of]) // max(SIZES[number], longest)
                    new = np.flatnonzero(np.diff(of) | np.diff(cell)) + 1
                    heads, ends = np.append(0, new), np.append(new, len(at))
                    left, right = _reach(number, longest)
                    begins = np.maximum(at[heads] - left, block.first[of[heads]])
                    stops = np.minimum(at[ends - 1] + right, block.first[of[heads] + 1])
                    regions = [hashes[b:e].view(np.int64) for b, e in zip(begins, stops)]
                    own = [np.unique(keys[b:e]).view(np.int64) for b, e in zip(heads, ends)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(start + of[heads])),
                            pa.array(np.full(len(heads), number, np.int32)),
                            pa.array(regions, pa.list_(pa.int64())),
                            pa.array(own, pa.list_(pa.int64())),
                        ],
                        names=["doc_id", "class", "region", "keys"],
                    )
            release()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, class int, region array<long>, keys array<long>"
    )


def _matching_keys(
    screen: Screen, hashes: np.ndarray, block: tokens.Block, number: int, places: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Window starts and keys, one of each per key that an item may have."""
    size = SIZES[number]
    last = block.first[np.searchsorted(block.first, places, "right")]
    together = max(1, min(WALKED, (1 << 22) // size))
    starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for low in range(0, len(places), together):
        part = places[low : low + together]
        cells = part[:, None] + np.arange(size)
        inside = cells < last[low : low + together, None]
        window = np.where(inside, hashes[np.minimum(cells, len(hashes) - 1)], np.uint64(0))
        keys = walk_keys(window, number)
        rows, columns = np.nonzero(screen.items_keys(keys))
        starts.append(part[rows])
        found.append(keys[rows, columns])
    return np.concatenate(starts), np.concatenate(found)


def _reach(number: int, longest: int) -> tuple[int, int]:
    """Words before and after a window's start in which a copy of an item can lie, also
    of one of up to ``longest`` words of which the window is a piece."""
    edits = class_edits(number)
    margin = edits + SIZES[number] // 4
    rest = longest + max_edits(longest)
    return margin + rest, SIZES[number + 1] - 1 + edits + margin + rest


def _alike(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Rows with items of one size, about VERIFIED words of items at a time."""
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield from np.split(rows, np.arange(0, len(rows), max(1, VERIFIED // size))[1:])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, item_words, edits): documents with a passage within
    EDIT_RATE edits per word of a benchmark item, and the least edits found.

    Words are compared without case and ASCII punctuation. Items with fewer than
    MIN_ITEM_WORDS words, also NULL and empty ones, are no identifiable passage and
    match nothing; a NULL or empty text has no passage. Several hits of a pair are one
    row, so repeated rows and items give no more; an empty table gives none; columns
    other than ids and texts are ignored.
    """
    prepare(docs.sparkSession)
    items = stored(item_words(benchmark), "decontaminate-items")
    found = suspicious_windows(docs, build_screen(items))
    windows = stored(
        found.select(F.monotonically_increasing_id().alias("window"), "*"), "decontaminate-windows"
    )
    item_keys = items.select("item_id", "class", F.explode("keys").alias("key"))
    pairs = (
        windows.select("window", "class", F.explode("keys").alias("key"))
        .join(item_keys, ["class", "key"])
        .select("window", "item_id")
        .distinct()
    )
    wholes = items.filter("whole IS NOT NULL").select("item_id", F.col("whole").alias("words"))
    near = (
        pairs.join(windows.select("window", "doc_id", "region"), "window")
        .join(wholes, "item_id")
        .select("doc_id", "item_id", "words", "region")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.values.to_numpy() for w in batch.column("words")]
            regions = [r.values.to_numpy() for r in batch.column("region")]
            sizes = np.array([len(w) for w in words], np.int32)
            edits = np.zeros(len(words), np.int32)
            for rows in _alike(sizes):
                wide = max(len(regions[i]) for i in rows)
                # Regions are padded with 0, which stands for no word.
                padded = np.zeros((len(rows), wide), np.int64)
                for k, i in enumerate(rows):
                    padded[k, : len(regions[i])] = regions[i]
                edits[rows] = edit_distances(np.stack([words[i] for i in rows]), padded)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item_id"), pa.array(sizes), pa.array(edits)],
                names=["doc_id", "item_id", "item_words", "edits"],
            )

    ids = ", ".join(
        f"{name} {df.schema[name].dataType.simpleString()}"
        for name, df in (("doc_id", docs), ("item_id", benchmark))
    )
    verified = near.mapInArrow(verify, f"{ids}, item_words int, edits int")
    return (
        verified.filter(F.col("edits") <= F.floor(F.col("item_words") * EDIT_RATE))
        .groupBy("doc_id", "item_id")
        .agg(F.max("item_words").alias("item_words"), F.min("edits").alias("edits"))
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns, in which no item is found. Texts are judged
    by themselves, known by their digests, so rows without doc_id or with one that others
    have too stay or go on their own.

    Up to ``BROADCAST_HITS`` digests are broadcast, so that the texts stay in place; more
    of them are joined by a shuffle."""
    digest = F.unhex(F.sha2("text", 256))
    hits = contaminated(docs.select(digest.alias("doc_id"), "text"), benchmark)
    hits = stored(hits.select(F.col("doc_id").alias("_hit")).distinct(), "decontaminate-hits")
    if hits.count() <= BROADCAST_HITS:
        hits = F.broadcast(hits)
    return docs.join(hits, digest == F.col("_hit"), "left_anti")


def op3_edit_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
