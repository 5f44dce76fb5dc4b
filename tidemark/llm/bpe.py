"""Byte-level BPE over documents of any length.

Long texts are cut into overlapping chunks that are pre-tokenised in parallel.
Two neighbouring chunks are stitched where their pre-token boundaries agree in the
overlap; the pieces between such places are encoded on their own. Decoding lays the
raw bytes of the tokens end to end.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare, read, release, stored

CHUNK = 1 << 15  # code points
OVERLAP = 512
# A token that ends closer than this to a chunk's end may continue in the whole text
# (the longest contraction has three characters).
MARGIN = 4
# Texts whose tokens are held at a time; bounds a Python worker's memory.
ROWS_AT_ONCE = 256


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _table(ranks: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}


@lru_cache(maxsize=1)
def _encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "own", pat_str=pattern, mergeable_ranks=_table(ranks), special_tokens={}
    )


@lru_cache(maxsize=1)
def _token_bytes(ranks: bytes) -> list[bytes]:
    table = _table(ranks)
    by_id = [b""] * (max(table.values()) + 1)
    for raw, rank in table.items():
        by_id[rank] = raw
    return by_id


def boundaries(
    text: str, start: int, pattern: regex.Pattern, chunk: int = CHUNK, overlap: int = OVERLAP
) -> tuple[list, list, list, list]:
    """Pre-token boundaries of a chunk in its first and last overlap, as positions in
    the whole text; the second and fourth list have those between a word and a blank,
    which are boundaries wherever the chunk starts."""
    head, head_sure, tail, tail_sure = [], [], [], []
    limit = len(text) - MARGIN
    for match in pattern.finditer(text):
        at = match.start()
        if at > limit:
            break
        if overlap < at < chunk:
            continue
        sure = at > 0 and text[at].isspace() and not text[at - 1].isspace()
        if at <= overlap:
            head.append(start + at)
            if sure:
                head_sure.append(start + at)
        if at >= chunk:
            tail.append(start + at)
            if sure:
                tail_sure.append(start + at)
    return head, head_sure, tail, tail_sure


def pieces(
    docs: DataFrame, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(row, doc_id, piece, text): long texts cut where cutting changes no pre-token."""
    size = F.char_length("text")
    cuts = F.sequence(F.lit(0), F.ceil(size / chunk).cast("int") - 1)
    chunks = (
        docs.filter(size > chunk)
        .select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
        .select("row", "doc_id", "text", F.explode(cuts).alias("k"))
        .select(
            "row", "doc_id", "k",
            F.substring("text", F.col("k") * chunk + 1, F.lit(chunk + overlap)).alias("text"),
        )
    )
    chunks = stored(chunks, "bpe-chunks")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = regex.compile(pattern)
        for batch in batches:
            numbers = batch.column("k").to_pylist()
            found = [
                boundaries(text, k * chunk, compiled, chunk, overlap)
                for k, text in zip(numbers, batch.column("text").to_pylist())
            ]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in zip(*found)] if found else [
                pa.array([], pa.list_(pa.int64()))] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("k"), *lists],
                names=["row", "k", "head", "head_sure", "tail", "tail_sure"],
            )

    lists = "head array<long>, head_sure array<long>, tail array<long>, tail_sure array<long>"
    found = (
        chunks.select("row", "k", "text").repartition("row", "k")
        .mapInArrow(find, f"row long, k int, {lists}")
    )
    order = Window.partitionBy("row").orderBy("k")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    met = found.select(
        "row", "k",
        F.array_min(F.array_intersect(F.lag("tail").over(order), "head")).alias("agreed"),
        F.array_min(F.array_intersect(F.lag("tail_sure").over(order), "head_sure")).alias("sure"),
    )
    # A boundary both chunks have is right if the left chunk is in step by then: from
    # the start of the text or a sure boundary on, without a gap in between.
    in_step = F.max(F.when((F.col("k") == 0) | F.col("sure").isNotNull(), F.col("k"))).over(so_far)
    gap = F.max(F.when((F.col("k") > 0) & F.col("agreed").isNull(), F.col("k"))).over(so_far)
    cut = (
        F.when(F.col("k") == 0, F.lit(0).cast("long"))
        .when(F.col("sure").isNotNull(), F.col("sure"))
        .when(F.col("agreed").isNotNull() & (in_step > F.coalesce(gap, F.lit(-1))), F.col("agreed"))
    )
    met = met.select("row", "k", cut.alias("cut"))
    met = met.select(
        "row", "k", "cut",
        F.count("cut").over(so_far).alias("piece"),
        F.lead("cut").over(order).alias("next_cut"),
        F.lead("k").over(order).isNull().alias("is_last"),
    )
    start = F.col("k").cast("long") * chunk
    begin = F.coalesce(F.col("cut") - start, F.lit(0).cast("long"))
    end = F.when(F.col("is_last"), F.char_length("text").cast("long")).otherwise(
        F.coalesce(F.col("next_cut") - start, F.lit(chunk).cast("long"))
    )
    part = F.substring("text", (begin + 1).cast("int"), (end - begin).cast("int"))
    return (
        chunks.join(met, ["row", "k"])
        .select("row", "doc_id", "piece", F.struct("k", part.alias("text")).alias("part"))
        .groupBy("row", "doc_id", "piece")
        .agg(F.array_sort(F.collect_list("part")).alias("parts"))
        .select("row", "doc_id", "piece", F.array_join("parts.text", "").alias("text"))
    )


def _per_row(
    df: DataFrame, work: Callable[[object], bytes], source: str, target: str
) -> DataFrame:
    """``df`` with a binary column made from each value of ``source``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                made = [work(value) for value in part.column(source).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(made, pa.binary())], names=[*part.schema.names, target]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{schema}, {target} binary")


def encode(
    docs: DataFrame,
    vocabulary: str | None = None,
    pattern: str | None = None,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(doc_id, ids): tokens of every whole text as little-endian unsigned 32-bit ids.

    ``vocabulary`` is the path of a rank file and is read on the driver; executors get
    its bytes. A NULL text counts as empty and has no tokens; repeated rows are encoded
    each; an empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession)
    pattern = pattern or default_pattern()
    with open(vocabulary or default_vocabulary(), "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def tokens(text: str) -> bytes:
        encoding = _encoding(ranks.value, pattern)
        return encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    whole = _per_row(docs.filter(F.char_length("text") <= chunk), tokens, "text", "ids")
    cut = _per_row(pieces(docs, pattern, chunk, overlap), tokens, "text", "ids").drop("text")
    joined = F.aggregate(
        F.array_sort(F.collect_list(F.struct("piece", "ids"))),
        F.lit(b""),
        lambda all_ids, part: F.concat(all_ids, part["ids"]),
    )
    long = cut.groupBy("row", "doc_id").agg(joined.alias("ids")).select("doc_id", "ids")
    return whole.select("doc_id", "ids").unionByName(long)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids end to end."""
    prepare(encoded.sparkSession)
    with open(vocabulary or default_vocabulary(), "rb") as file:
        ranks = encoded.sparkSession.sparkContext.broadcast(file.read())

    def raw(ids: bytes) -> bytes:
        by_id = _token_bytes(ranks.value)
        return b"".join([by_id[i] for i in np.frombuffer(ids, "<u4").tolist()])

    return _per_row(encoded, raw, "ids", "decoded")


def round_trip(
    docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None
) -> DataFrame:
    """(doc_id, ids, decoded) as :func:`encode` and :func:`decode` give them, with one
    Python step for both, which takes one worker per task instead of two."""
    prepare(docs.sparkSession)
    pattern = pattern or default_pattern()
    with open(vocabulary or default_vocabulary(), "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, by_id = _encoding(ranks.value, pattern), _token_bytes(ranks.value)
        for batch in batches:
            names = [n for n in batch.schema.names if n != "text"]
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                ids, decoded = [], []
                for text in part.column("text").to_pylist():
                    found = encoding.encode_to_numpy(text, disallowed_special=())
                    ids.append(found.astype("<u4").tobytes())
                    decoded.append(b"".join([by_id[i] for i in found.tolist()]))
                kept = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())],
                    names=[*names, "ids", "decoded"],
                )
        release()

    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    both = "ids binary, decoded binary"
    whole = docs.filter(F.char_length("text") <= CHUNK).mapInArrow(run, f"doc_id {id_type}, {both}")
    cut = pieces(docs, pattern).mapInArrow(run, f"row long, doc_id {id_type}, piece long, {both}")
    parts = F.array_sort(F.collect_list(F.struct("piece", "ids", "decoded")))

    def joined(name: str) -> Column:
        return F.aggregate("parts", F.lit(b""), lambda start, part: F.concat(start, part[name]))

    long = (
        cut.groupBy("row", "doc_id").agg(parts.alias("parts"))
        .select("doc_id", joined("ids").alias("ids"), joined("decoded").alias("decoded"))
    )
    return whole.unionByName(long)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(decode(encode(read(spark, sf_dir, "documents"))))


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
