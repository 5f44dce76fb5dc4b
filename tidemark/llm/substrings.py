"""Removal of repeated passages, by super-k-mer partitioning.

A window is 20 consecutive words. Its minimiser is the least hash among its runs of 5
words; consecutive windows with the same minimiser travel as one packed string to the
bucket of that minimiser, so all occurrences of a window meet in one bucket. There
sorting brings equal windows together, and all but the earliest are repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from . import tokens
from .common import blocks, read, prepare, stored, texts_of

WINDOW = 20
MINIMISER = 5
# Packed text per bucket, which sets the number of buckets.
BUCKET_BYTES = 2 << 20
# Text of super-k-mers that a task gathers before it packs them; the number of packs is
# that of the gatherings times that of the buckets, and at most that of the super-k-mers.
GATHER_BYTES = 24 << 20
# A super-k-mer carries about this many times the text of its windows.
EXPANSION = 3
# Minimisers with more occurrences are counted by window instead; at most HOT_LIST of
# them can exist, since the limit grows with the total.
HOT_OCCURRENCES = 5_000
HOT_LIST = 100_000

# Stands for a NULL doc_id: rows without an id come last.
NO_ID = (1 << 63) - 1


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, doc, and a digest of the text; doc is a number in the order of the
    ids, an integer id itself."""
    number = F.col("doc_id").cast("long")
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        docs, number = docs.select("doc_id", "text"), F.col("number")
        ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
        ids = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        ids = ids.withColumn("number", F.monotonically_increasing_id())
        docs = docs.join(stored(ids, "substrings-ids"), "doc_id", "left")
    return docs.select(
        "doc_id", "text", F.coalesce(number, F.lit(NO_ID)).alias("doc"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("text_digest"),
    )


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text, doc and twin: (doc, twin) is a document, that is a text with its id.

    Different texts with one id, or without any, are told apart by the twin, a number in
    the order of their digests; where the id is enough it is 0. Only the numbers of such
    texts are stored, so the texts stay in place while these are few.
    """
    keyed = _keyed(docs)
    distinct = stored(keyed.select("doc", "text_digest").distinct(), "substrings-documents")
    several = distinct.groupBy("doc").count().filter("count > 1").select("doc")
    ordered = (
        distinct.join(several, "doc").repartitionByRange("doc", "text_digest")
        .sortWithinPartitions("doc", "text_digest")
    )
    twins = stored(
        ordered.select("doc", "text_digest", F.monotonically_increasing_id().alias("number")),
        "substrings-twins",
    )
    return keyed.join(twins, ["doc", "text_digest"], "left").select(
        "doc_id", "text", "doc", F.coalesce("number", F.lit(0).cast("long")).alias("twin")
    )


def _minimisers(block: tokens.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, their minimisers, and the windows' hashes."""
    hashes, first = block.word_hashes(), block.windows(WINDOW)
    at = np.arange(max(len(hashes) - MINIMISER + 1, 0))
    runs = tokens.span_hashes(hashes, at, at + MINIMISER, tokens.WORD_BASE)
    if len(first):
        span = WINDOW - MINIMISER + 1
        least = np.lib.stride_tricks.sliding_window_view(runs, span)[first].min(1)
    else:
        least = np.zeros(0, np.uint64)
    return first, least, tokens.span_hashes(hashes, first, first + WINDOW, tokens.WORD_BASE)


def _runs(first: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of consecutive windows that agree in ``same``."""
    new = np.ones(len(first), bool)
    new[1:] = first[1:] != first[:-1] + 1
    for values in same:
        new[1:] |= values[1:] != values[:-1]
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(first)))


def _window_bytes(block: tokens.Block, word: int) -> bytes:
    return block.raw[block.starts[word] : block.ends[word + WINDOW - 1]]


def repeats(
    block: tokens.Block, first: np.ndarray, hashes: np.ndarray, docs: np.ndarray,
    twins: np.ndarray, places: np.ndarray,
) -> np.ndarray:
    """Which windows have an equal one with a smaller (doc, twin, place).

    Windows are sorted by hash, document and place; neighbours with equal hashes are
    compared byte by byte (words are single-spaced), so the hash decides nothing.
    """
    order = np.lexsort((places, twins, docs, hashes))
    ranked = hashes[order]
    same = np.zeros(len(order), bool)
    same[1:] = ranked[1:] == ranked[:-1]
    for i in np.flatnonzero(same).tolist():
        if _window_bytes(block, first[order[i]]) != _window_bytes(block, first[order[i - 1]]):
            return _repeats_by_bytes(block, first, docs, twins, places)
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    leader = order[head]
    found = np.zeros(len(order), bool)
    for values in (docs, twins, places):
        found[order] |= values[leader] != values[order]
    return found


def _repeats_by_bytes(
    block: tokens.Block, first: np.ndarray, docs: np.ndarray, twins: np.ndarray, places: np.ndarray
) -> np.ndarray:
    """The same when two different windows share a hash, which is next to impossible."""
    earliest: dict[bytes, tuple[int, ...]] = {}
    at = zip(docs.tolist(), twins.tolist(), places.tolist())
    keys = [(_window_bytes(block, w), key) for w, key in zip(first, at)]
    for window, at in keys:
        earliest[window] = min(earliest.get(window, at), at)
    return np.array([earliest[window] < at for window, at in keys], bool)


def frequent_minimisers(docs: DataFrame) -> tuple[list[int], int]:
    """Minimisers that occur too often for one bucket, and the bytes of all texts.

    A task reports those it sees twice or more, so one that is missed occurs at most
    once per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, total, seen = 0, 0, []
        for batch in batches:
            texts = texts_of(batch)
            for start, end in blocks(texts):
                block = tokens.Block(texts[start:end])
                first, least, _ = _minimisers(block)
                starts, _ = _runs(first, least)
                seen.append(least[starts])
                size, total = size + len(block.raw), total + len(starts)
        keys, n = np.unique(np.concatenate(seen) if seen else np.zeros(0, np.uint64), return_counts=True)
        keys, n = keys[n > 1].view(np.int64).tolist(), n[n > 1].tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(["bytes", "runs"] + ["key"] * len(n)), pa.array([0, 0] + keys, pa.int64()),
             pa.array([size, total] + n, pa.int64())],
            names=["what", "key", "n"],
        )

    counted = stored(
        docs.select("text").mapInArrow(run, "what string, key long, n long")
        .groupBy("what", "key").agg(F.sum("n").alias("n")),
        "substrings-minimisers",
    )
    totals = {r["what"]: r["n"] for r in counted.filter("what <> 'key'").collect()}
    limit = max(HOT_OCCURRENCES, (totals.get("runs") or 0) // HOT_LIST)
    hot = counted.filter((F.col("what") == "key") & (F.col("n") > limit)).select("key").collect()
    return sorted(r[0] for r in hot), totals.get("bytes") or 0


_ROWS = "bucket long, blob binary, digest binary, doc long, twin long, place long, size long"


def _batch(n: int, **columns: object) -> pa.RecordBatch:
    types = {"bucket": pa.int64(), "blob": pa.binary(), "digest": pa.binary(), "doc": pa.int64(),
             "twin": pa.int64(), "place": pa.int64(), "size": pa.int64()}
    values = [
        pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind)
        for name, kind in types.items()
    ]
    return pa.RecordBatch.from_arrays(values, names=list(types))


def packed_runs(docs: DataFrame, hot: list[int], n_buckets: int) -> DataFrame:
    """Rows for the buckets: packs of super-k-mers, windows of frequent minimisers, and
    repeats that a block of texts shows by itself.

    Copies inside a block are settled there: only the earliest of its equal windows is
    sent on, which keeps a passage in very many documents small before the shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.array(hot, np.int64).view(np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        size = 0
        for batch in batches:
            texts = texts_of(batch)
            ids, numbers = batch.column("doc").to_numpy(), batch.column("twin").to_numpy()
            for start, end in blocks(texts):
                block = tokens.Block([b" ".join(t.split()) for t in texts[start:end]])
                first, least, hashes = _minimisers(block)
                if not len(first):
                    continue
                of = np.searchsorted(block.first, first, "right") - 1
                doc, twin = ids[start:end][of], numbers[start:end][of]
                place = first - block.first[of]
                local = repeats(block, first, hashes, doc, twin, place)
                starts, sizes = _runs(first[local], of[local])
                yield _batch(
                    len(starts), bucket=(doc + twin)[local][starts] % n_buckets,
                    doc=doc[local][starts], twin=twin[local][starts],
                    place=place[local][starts], size=sizes,
                )
                sent = np.flatnonzero(~local)
                often = np.isin(least[sent], shared.value)
                yield from _hot_windows(block, first, doc, twin, place, sent[often], hashes)
                sent = sent[~often]
                starts, sizes = _runs(first[sent], of[sent], least[sent])
                lead = sent[starts]
                bucket = (tokens.mix(least[lead]) % np.uint64(n_buckets)).astype(np.int64)
                begin = block.starts[first[lead]]
                stop = block.ends[first[lead] + sizes + WINDOW - 2]
                waiting.append((block.raw, bucket, begin, stop, doc[lead], twin[lead], place[lead]))
                size += int((stop - begin).sum())
                if size >= GATHER_BYTES:
                    yield _packs(waiting)
                    waiting, size = [], 0
        if waiting:
            yield _packs(waiting)

    return docs.mapInArrow(run, _ROWS)


def _packs(waiting: list[tuple]) -> pa.RecordBatch:
    """One compressed pack per bucket of the super-k-mers of some blocks, given as spans
    of each block's bytes with their buckets, documents and places."""
    squeeze = zstandard.ZstdCompressor(level=3).compress
    raws = [block[0] for block in waiting]
    of = np.repeat(np.arange(len(waiting)), [len(block[1]) for block in waiting]).tolist()
    bucket, begin, stop, doc, twin, place = (np.concatenate(part) for part in list(zip(*waiting))[1:])
    begin, stop = begin.tolist(), stop.tolist()
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    blobs, numbers = [], []
    for group in np.split(order, cuts) if len(order) else []:
        strings = b"\n".join([raws[of[i]][begin[i] : stop[i]] for i in group.tolist()])
        heads = np.stack([doc[group], twin[group], place[group]]).astype("<i8").tobytes()
        blobs.append(squeeze(np.array([len(group)], "<i8").tobytes() + heads + strings))
        numbers.append(int(bucket[group[0]]))
    return _batch(len(blobs), bucket=numbers, blob=blobs)


def _hot_windows(
    block: tokens.Block, first: np.ndarray, doc: np.ndarray, twin: np.ndarray, place: np.ndarray,
    sent: np.ndarray, hashes: np.ndarray,
) -> Iterator[pa.RecordBatch]:
    """Windows of frequent minimisers, by a 256-bit digest of their words."""
    if len(sent):
        digests = [sha256(_window_bytes(block, w)).digest() for w in first[sent].tolist()]
        yield _batch(
            len(sent), bucket=(hashes[sent] >> np.uint64(1)).astype(np.int64), digest=digests,
            doc=doc[sent], twin=twin[sent], place=place[sent], size=np.ones(len(sent), np.int64),
        )


def _unpacked(blobs: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Super-k-mers, and the documents, twins and places of each."""
    strings, heads = [], []
    for blob in map(zstandard.ZstdDecompressor().decompress, blobs):
        n = int(np.frombuffer(blob, "<i8", 1)[0])
        heads.append(np.frombuffer(blob, "<i8", 3 * n, 8).reshape(3, n))
        strings += blob[8 + 24 * n :].split(b"\n")
    return strings, np.concatenate(heads, 1)


def _bucket_repeats(blobs: list[bytes]) -> pa.RecordBatch:
    strings, heads = _unpacked(blobs)
    block = tokens.Block(strings)
    first, _, hashes = _minimisers(block)
    of = np.searchsorted(block.first, first, "right") - 1
    doc, twin, place = heads[:, of]
    place = place + first - block.first[of]
    found = repeats(block, first, hashes, doc, twin, place)
    starts, sizes = _runs(first[found], of[found])
    return _batch(
        len(starts), doc=doc[found][starts], twin=twin[found][starts],
        place=place[found][starts], size=sizes,
    )


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc, twin, place, size): runs of repeated windows of ``numbered`` texts, by first
    word and number of windows."""
    hot, size = frequent_minimisers(docs)
    rows = packed_runs(docs.select("doc", "twin", "text"), hot, max(1, -(-size * EXPANSION // BUCKET_BYTES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blobs = None, []
        for batch in batches:
            plain = batch.filter(pc.is_null(batch.column("blob")))
            if plain.num_rows:
                yield plain
            packed = batch.filter(pc.is_valid(batch.column("blob")))
            for number, blob in zip(
                packed.column("bucket").to_pylist(), packed.column("blob").to_pylist()
            ):
                if number != bucket:
                    if blobs:
                        yield _bucket_repeats(blobs)
                    bucket, blobs = number, []
                blobs.append(blob)
        if blobs:
            yield _bucket_repeats(blobs)

    counted = stored(
        rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _ROWS)
        .drop("bucket", "blob"),
        "substrings-repeats",
    )
    known = counted.filter("digest IS NULL").select("doc", "twin", "place", "size")
    windows = counted.filter("digest IS NOT NULL").select("digest", "doc", "twin", "place", "size")
    at = F.struct("doc", "twin", "place")
    earliest = windows.groupBy("digest").agg(F.min(at).alias("earliest"))
    late = windows.join(earliest, "digest").filter(at > F.col("earliest"))
    return known.unionByName(late.select("doc", "twin", "place", "size"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept, the words left joined by one space.

    A word goes if a window that covers it also starts earlier: in a document with a
    smaller doc_id, or earlier in the same one. Windows are judged on the input. A NULL
    or empty text, or one of fewer than 20 words, loses nothing. Rows with the same
    doc_id and text are repetitions of one document and are treated alike; different texts
    with one doc_id are documents of their own, in the order of their digests, as are those
    without one, which come last. Ids may be of any type that sorts. An empty table gives
    no rows; columns other than doc_id and text are ignored.
    """
    prepare(docs.sparkSession)
    keyed = numbered(docs)
    ranges = (
        repeated_runs(keyed).groupBy("doc", "twin").agg(F.collect_list(F.struct("place", "size")).alias("cut"))
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            cuts = batch.column("cut").to_pylist()
            for start, end in blocks(texts):
                counts, removed, kept = [], [], []
                for text, cut in zip(texts[start:end], cuts[start:end]):
                    words = text.split()
                    counts.append(len(words))
                    if cut:
                        steps = np.zeros(len(words) + 1, np.int64)
                        np.add.at(steps, [min(c["place"], len(words)) for c in cut], 1)
                        ends = [min(c["place"] + c["size"] + WINDOW - 1, len(words)) for c in cut]
                        np.add.at(steps, ends, -1)
                        left = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
                        removed.append(len(words) - len(left))
                        words = [words[i] for i in left.tolist()]
                    else:
                        removed.append(0)
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, end - start),
                     pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept)],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    joined = keyed.join(ranges, ["doc", "twin"], "left").select("doc_id", "text", "cut")
    return joined.mapInArrow(run, f"doc_id {id_type}, n_words long, n_removed long, kept string")


def op5_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    )
