"""Alignment of two tokenizers over the same bytes, by sparse incidence matrices.

A token covers a run of bytes, so the tokens of a text are the rows of a token-byte
incidence matrix. With A and B the matrices of two tokenizers, the product A·Bᵀ has a
link for each pair of tokens that overlap, weighted by the bytes they share. Places
where tokens of both end cut them into groups; with G and H the group-token matrices,
Gᵀ·H links all pairs that share a group. Matrices are in compressed row form, built and
multiplied here row by row as in Gustavson's method, a slab of rows at a time.

A single blank between two words is where both tokenizers begin anew, so the matrices of
a text are block-diagonal: each distinct word of a block of texts is encoded and
multiplied once, and the texts are put together from their words.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, prepare, read, stored, texts_of
from .tokens import sums_between

# Texts whose words are aligned together, in bytes.
BLOCK_BYTES = 4_000_000
# Single blanks between words, where both tokenizers begin anew.
CUT = re.compile(r" (?=\S)(?<=\S )")
# Characters that are encoded, and products that are gathered, at a time.
CHARACTERS = 1 << 18
JOINED = 1000  # words
PRODUCTS = 1 << 20
# Pairs of ids that are looked up in a broadcast table (16 bytes each); more are joined.
BROADCAST_PAIRS = 2_000_000
KINDS = ("end", "overlap", "group")


def default_byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Csr:
    """A sparse matrix in compressed row form; without ``data`` all entries are one."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, width: int, data=None):
        self.starts, self.columns, self.width, self.data = starts, columns, width, data

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def entries(self) -> np.ndarray:
        return np.ones(len(self.columns), np.int64) if self.data is None else self.data

    def rows(self) -> np.ndarray:
        """Row of each entry."""
        return np.repeat(np.arange(self.height), np.diff(self.starts))

    def transpose(self) -> Csr:
        order = np.argsort(self.columns, kind="stable")
        starts = np.zeros(self.width + 1, np.int64)
        np.cumsum(np.bincount(self.columns, minlength=self.width), out=starts[1:])
        data = None if self.data is None else self.data[order]
        return Csr(starts, self.rows()[order], self.height, data)

    def slabs(self, other: Csr, limit: int = PRODUCTS) -> Iterator[tuple[int, Csr]]:
        """(first row, rows of ``self`` times ``other``), about ``limit`` products each."""
        sizes = np.diff(other.starts)[self.columns]
        total = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=total[1:])
        by_row = total[self.starts]
        first = 0
        while first < self.height:
            last = int(np.searchsorted(by_row, by_row[first] + limit, "right")) - 1
            last = min(max(last, first + 1), self.height)
            yield first, self._times(other, first, last, sizes, total)
            first = last

    def _times(self, other: Csr, first: int, last: int, sizes, total) -> Csr:
        """Row products of rows ``first`` to ``last``: every entry (i, k) brings row k of
        ``other`` along, and equal columns of a row are added up."""
        low, high = self.starts[first], self.starts[last]
        own = sizes[low:high]
        begin = other.starts[self.columns[low:high]]
        skipped = begin - (total[low:high] - total[low])
        at = np.repeat(skipped, own) + np.arange(total[high] - total[low])
        columns = other.columns[at]
        entry_rows = np.repeat(np.arange(last - first), np.diff(self.starts[first : last + 1]))
        values = np.repeat(self.entries()[low:high], own) * other.entries()[at]
        keys = np.repeat(entry_rows, own) * np.int64(other.width) + columns
        if len(keys) and (keys[1:] < keys[:-1]).any():
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        heads = np.flatnonzero(new)
        sums = np.add.reduceat(values, heads) if len(heads) else values
        rows, columns = np.divmod(keys[heads], max(other.width, 1))
        starts = np.zeros(last - first + 1, np.int64)
        np.cumsum(np.bincount(rows, minlength=last - first), out=starts[1:])
        return Csr(starts, columns, other.width, sums)


def runs(ends: np.ndarray, width: int) -> Csr:
    """Incidence of rows that cover consecutive runs of columns."""
    return Csr(np.concatenate(([0], ends)).astype(np.int64), np.arange(width), width)


class Vocabulary:
    """The bytes of every token of a tokenizer."""

    def __init__(self, tokens: list[bytes]):
        self.size = len(tokens)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        ends = np.cumsum(length)
        skipped = np.repeat(self.at[ids] - (ends - length), length)
        return self.flat[skipped + np.arange(len(skipped))]


def byte_alphabet() -> dict[str, int]:
    """Characters that byte-level vocabularies write for bytes: printable ones stand for
    themselves, the others follow from U+0100 on in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Tokenizer A: byte-level BPE from a JSON file, over a space and the text."""

    def __init__(self, source: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(source)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        table = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            # Added tokens are never produced; their names need not be byte-level.
            table[i] = bytes([alphabet.get(c, 0) for c in token])
        self.vocabulary = Vocabulary(table)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words end to end, and how many each has.

        Words are encoded many at a time with one blank between them and told apart by
        their bytes, but for those that begin or end with a blank of their own.
        """
        apart = np.array([not w or w[0].isspace() or w[-1].isspace() for w in words], bool)
        order = np.concatenate((np.flatnonzero(~apart), np.flatnonzero(apart)))
        joined, n = [words[i] for i in order.tolist()], len(words) - int(apart.sum())
        texts = [" " + " ".join(joined[i : min(i + JOINED, n)]) for i in range(0, n, JOINED)]
        texts += [" " + w for w in joined[n:]]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = _flat([encoding.ids for encoding in found])
        word_ends = np.cumsum([len(w.encode()) + 1 for w in joined])
        first = _closed(np.searchsorted(np.cumsum(self.vocabulary.length[ids]), word_ends) + 1)
        size, place = np.diff(first), np.argsort(order)
        skipped = first[:-1][place] - _sums(size[place])[:-1]
        return ids[np.repeat(skipped, size[place]) + np.arange(len(ids))], size[place]


class Pieces:
    """Tokenizer B: SentencePiece, which adds the space before the text itself."""

    def __init__(self, source: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=source)
        model, table = self.model, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            raw = piece.replace("▁", " ").encode()
            table.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else raw)
        self.vocabulary = Vocabulary(table)
        # No merge crosses a blank unless a piece goes on behind one.
        self.can_cut = not any(b" " in raw.lstrip(b" ") for raw in table)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.model.encode(words, num_threads=1) if words else []
        return _flat(ids), np.fromiter(map(len, ids), np.int64, len(ids))


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))


class Alignment:
    """The tokens of some words by both tokenizers, laid end to end, and their groups.

    Words whose tokens do not give a space and the word are left without tokens.
    """

    def __init__(self, words: list[str], a: ByteLevel, b: Pieces):
        raw = [b" " + w.encode() for w in words]
        sides = (a, b)
        found = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
        n = [np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)]
        self.fits = np.ones(len(words), bool)
        for start, end in blocks(raw, CHARACTERS):
            for side, tokenizer in enumerate(sides):
                flat, size = tokenizer.encode(words[start:end])
                self.fits[start:end] &= _faithful(raw[start:end], flat, size, tokenizer.vocabulary)
                found[side].append(flat)
                n[side][start:end] = size
        flat = [np.concatenate(f) for f in found]
        self.ids = [f[np.repeat(self.fits, size)] for f, size in zip(flat, n)]
        self.n = [np.where(self.fits, size, 0) for size in n]
        self.before = [_sums(size) for size in self.n]  # tokens before each word
        self.ends = [np.cumsum(t.vocabulary.length[x]) for t, x in zip(sides, self.ids)]
        self.width = int(self.ends[0][-1]) if len(self.ends[0]) else 0
        marks = np.zeros((2, self.width + 1), bool)
        for mark, ends in zip(marks, self.ends):
            mark[ends] = True
        cuts = np.flatnonzero(marks[0] & marks[1])  # ends of the groups
        # Tokens before each group on either side, and all of them at the end.
        self.first = [_closed(np.searchsorted(e, cuts, "right")) for e in self.ends]
        self.groups_before = np.searchsorted(self.first[0], self.before[0])

    def links(self, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place of the A token, place of the B token, weight) of all links, in slabs.

        ``overlap``: tokens that share bytes, weighted by their number. ``end``: those of
        them that end together. ``group``: tokens of one group, with weight 1.
        """
        if kind == "group":
            groups = [Csr(f, np.arange(len(x)), len(x)) for f, x in zip(self.first, self.ids)]
            left, right = groups[0].transpose(), groups[1]
        else:
            left = runs(self.ends[0], self.width)
            right = runs(self.ends[1], self.width).transpose()
        for first, slab in left.slabs(right):
            i, j, weight = slab.rows() + first, slab.columns, slab.entries()
            if kind == "end":
                together = self.ends[0][i] == self.ends[1][j]
                i, j, weight = i[together], j[together], weight[together]
            yield i, j, weight

    def written(self) -> list[str]:
        """The groups of each word as ``a1,a2|b1;a3|b2,b3``."""
        ids, first, size = self.ids, self.first, [np.diff(f) for f in self.first]
        order = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        mark = np.zeros(len(order), np.int8)
        at = [
            np.arange(len(ids[0])) + np.repeat(first[1][:-1], size[0]),
            np.arange(len(ids[1])) + np.repeat(first[0][1:], size[1]),
        ]
        for side in (0, 1):
            order[at[side]] = ids[side]
            mark[at[side][first[side][1:] - 1]] = side + 1
        bounds = self.before[0] + self.before[1]
        mark[bounds[1:][np.diff(bounds) > 0] - 1] = 3
        names = _names(int(order.max()) + 1 if len(order) else 0)[mark, order].tolist()
        return ["".join(names[i:j]) for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _sums(sizes: np.ndarray) -> np.ndarray:
    return _closed(np.cumsum(sizes))


def _closed(ends: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), ends))


def _faithful(
    raw: list[bytes], ids: np.ndarray, n: np.ndarray, vocabulary: Vocabulary
) -> np.ndarray:
    """Whether the ``n`` tokens of each word give its bytes."""
    made = vocabulary.bytes_of(ids).tobytes()
    at = _sums(vocabulary.length[ids])[_sums(n)].tolist()
    return np.array([made[i:j] == r for i, j, r in zip(at, at[1:], raw)], bool)


_written: list[np.ndarray] = []


def _names(size: int) -> np.ndarray:
    """Ids in decimal with what follows them: comma, bar, semicolon or nothing."""
    if not _written or _written[0].shape[1] < size:
        found = np.empty((4, size), object)
        for row, mark in enumerate([",", "|", ";", ""]):
            found[row] = [f"{i}{mark}" for i in range(size)]
        _written[:] = [found]
    return _written[0]


class Texts:
    """Texts put together from the alignment of their distinct words."""

    def __init__(self, texts: list[bytes], a: ByteLevel, b: Pieces):
        places: dict[str, int] = {}
        words, self.n_words = [], np.zeros(len(texts), np.int64)
        for i, raw in enumerate(texts):
            if raw:
                text = raw.decode()
                parts = CUT.split(text) if b.can_cut else [text]
                words += [places.setdefault(w, len(places)) for w in parts]
                self.n_words[i] = len(parts)
        self.aligned = Alignment(list(places), a, b)
        words = np.array(words, np.int64)
        # A text has tokens if all its words give their bytes.
        lost = sums_between(~self.aligned.fits[words], _sums(self.n_words)) > 0
        self.words = words[~np.repeat(lost, self.n_words)]
        self.n_words[lost] = 0
        self.at = _sums(self.n_words)  # first word of each text

    def total(self, of_word: np.ndarray) -> np.ndarray:
        """Sum over the words of each text."""
        return sums_between(of_word[self.words], self.at)

    def written(self) -> Iterator[str]:
        names = np.array([*self.aligned.written(), ""], object)[:-1]
        for i, j in zip(self.at[:-1].tolist(), self.at[1:].tolist()):
            yield ";".join(names[self.words[i:j]].tolist())

    def links(self, kind: str) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, place of A, place of B, A id, B id, weight) of all links, in slabs; the
        places count from the start of the text."""
        aligned = self.aligned
        before = [_sums(n[self.words]) for n in aligned.n]  # tokens before each word
        for word, i, j, weight in self._gathered(kind):
            text = np.searchsorted(self.at, word, "right") - 1
            own = self.words[word]
            places = [
                x - side[own] + here[word] - here[self.at[text]]
                for x, side, here in zip((i, j), aligned.before, before)
            ]
            yield text, *places, aligned.ids[0][i], aligned.ids[1][j], weight

    def _gathered(self, kind: str) -> Iterator[tuple[np.ndarray, ...]]:
        """(word of a text, A token, B token, weight) of the links of a slab of words."""
        i, j, weight = (np.concatenate(x) for x in zip(*_slabs(self.aligned.links(kind))))
        first = np.searchsorted(i, self.aligned.before[0])
        size = np.diff(first)[self.words]
        total, low = _sums(size), 0
        while low < len(size):
            high = max(int(np.searchsorted(total, total[low] + PRODUCTS, "right")) - 1, low + 1)
            own = size[low:high]
            skipped = np.repeat(first[self.words[low:high]] - total[low:high] + total[low], own)
            at = skipped + np.arange(len(skipped))
            yield np.repeat(np.arange(low, high), own), i[at], j[at], weight[at]
            low = high


def _slabs(found: Iterator[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
    return [tuple(np.zeros(0, np.int64) for _ in range(3)), *found]


@lru_cache(maxsize=1)
def _pair(byte_bpe: bytes, pieces: bytes) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(byte_bpe), Pieces(pieces)


def _by_block(
    docs: DataFrame,
    work: Callable[[Texts, pa.Array], Iterator[pa.RecordBatch]],
    schema: str,
    byte_bpe: str | None,
    pieces: str | None,
) -> DataFrame:
    """What ``work`` makes of each block of texts and its doc_ids.

    The vocabulary files are read on the driver; executors get their bytes.
    """
    prepare(docs.sparkSession)
    sources = []
    for path in (byte_bpe or default_byte_bpe(), pieces or default_pieces()):
        with open(path, "rb") as file:
            sources.append(file.read())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sources))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            found = texts_of(batch)
            for start, end in blocks(found, BLOCK_BYTES):
                more = sum(map(len, found[start:end]))
                if texts and size + more > BLOCK_BYTES:
                    yield from work(Texts(texts, *_pair(*shared.value)), pa.concat_arrays(ids))
                    ids, texts, size = [], [], 0
                ids.append(batch.column("doc_id").slice(start, end - start))
                texts += found[start:end]
                size += more
        if texts:
            yield from work(Texts(texts, *_pair(*shared.value)), pa.concat_arrays(ids))

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def token_links(
    docs: DataFrame, kind: str = "end", byte_bpe: str | None = None, pieces: str | None = None
) -> DataFrame:
    """(doc_id, a_place, b_place, a_id, b_id, weight): one row for each link.

    ``kind`` is one of ``KINDS``, see :meth:`Alignment.links`. Texts without tokens (see
    :func:`alignments`) have no links.
    """
    if kind not in KINDS:
        raise ValueError(f"kind {kind!r} is none of {KINDS}")
    names = ["a_place", "b_place", "a_id", "b_id", "weight"]

    def work(texts: Texts, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        for text, *columns in texts.links(kind):
            of_rows = ids.take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [of_rows, *map(pa.array, columns)], names=["doc_id", *names]
            )

    schema = f"doc_id {_id_type(docs)}, {', '.join(f'{n} long' for n in names)}"
    return _by_block(docs, work, schema, byte_bpe, pieces)


def _counts(texts: Texts) -> dict[str, np.ndarray]:
    aligned = texts.aligned
    return {
        "n_a": texts.total(aligned.n[0]),
        "n_b": texts.total(aligned.n[1]),
        "n_groups": texts.total(np.diff(aligned.groups_before)),
    }


def alignments(
    docs: DataFrame, byte_bpe: str | None = None, pieces: str | None = None
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups) of each document.

    ``groups`` has the ids of both tokenizers as ``a1,a2|b1;a3|b2,b3``. The paths of the
    vocabulary files are parameters. A NULL or empty text, and one whose tokens of
    either kind do not give a space and the text, has no tokens: zeros and empty groups.
    Rows that repeat or share a doc_id, or have none, are aligned each; an empty table
    gives no rows; further columns are ignored. Texts of any length are aligned whole;
    one without blanks is a single word and multiplied in slabs of its rows.
    """

    def work(texts: Texts, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        counts = _counts(texts)
        columns = [ids, *map(pa.array, counts.values()), pa.array(texts.written(), pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *counts, "groups"])

    schema = f"doc_id {_id_type(docs)}, n_a long, n_b long, n_groups long, groups string"
    return _by_block(docs, work, schema, byte_bpe, pieces)


_PER_DOC = ["n_a", "n_b", "n_groups", "n_links"]


def packed(docs: DataFrame, byte_bpe: str | None = None, pieces: str | None = None) -> DataFrame:
    """One row per block of texts: its documents' counts and digests as arrays, the id
    pairs that its links hold (``a_id * 2**32 + b_id``), how many hold each, and the pair
    of every link as a little-endian number of 16 or 32 bits."""

    def work(texts: Texts, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        aligned = texts.aligned
        i, j, _ = (np.concatenate(x) for x in zip(*_slabs(aligned.links("end"))))
        pairs, of_link = np.unique(aligned.ids[0][i] << 32 | aligned.ids[1][j], return_inverse=True)
        first = np.searchsorted(i, aligned.before[0])
        n_links = np.diff(first)
        size = n_links[texts.words]
        skipped = np.repeat(first[texts.words] - _sums(size)[:-1], size)
        links = of_link[skipped + np.arange(len(skipped))]
        counts = {**_counts(texts), "n_links": texts.total(n_links)}
        digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in texts.written()]
        lists = [
            ids, *map(pa.array, counts.values()), pa.array(digests, pa.string()),
            pa.array(pairs), pa.array(np.bincount(links, minlength=len(pairs))),
        ]
        rows = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
        raw = links.astype("<u2" if len(pairs) <= 1 << 16 else "<u4").tobytes()
        names = ["doc_id", *_PER_DOC, "groups_sha256", "pairs", "times", "links"]
        yield pa.RecordBatch.from_arrays([*rows, pa.array([raw], pa.binary())], names=names)

    schema = (
        f"doc_id array<{_id_type(docs)}>, {', '.join(f'{n} array<long>' for n in _PER_DOC)}, "
        "groups_sha256 array<string>, pairs array<long>, times array<long>, links binary"
    )
    return _by_block(docs, work, schema, byte_bpe, pieces)


def pair_counts(blocks_of_links: DataFrame) -> DataFrame:
    """(pair, links, best): how many links of all documents hold an id pair, and whether
    no other pair of its B id is held by more."""
    pairs = (
        blocks_of_links.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.times").alias("links"))
    )
    counts = stored(pairs, "alignment-counts").withColumn(
        "b_id", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    )
    highest = counts.groupBy("b_id").agg(F.max("links").alias("highest"))
    return counts.join(highest, "b_id").select(
        "pair", "links", (F.col("links") == F.col("highest")).alias("best")
    )


def with_counts(blocks_of_links: DataFrame) -> DataFrame:
    """The documents of stored :func:`packed` rows, with n_best and count_sum.

    n_best counts the links whose pair is held most often among those of its B id, ties
    included; count_sum adds up how often the pairs of the links are held. The pairs are
    bounded by the vocabularies, not by the documents; up to ``BROADCAST_PAIRS`` of them
    are broadcast, and beyond that each block's pairs are joined with their counts.
    """
    spark = blocks_of_links.sparkSession
    counts = stored(pair_counts(blocks_of_links), "alignment-pairs")
    id_type = blocks_of_links.schema["doc_id"].dataType.elementType.simpleString()
    schema = (
        f"doc_id {id_type}, {', '.join(f'{n} long' for n in _PER_DOC)}, groups_sha256 string, "
        "n_best long, count_sum long"
    )
    if counts.count() <= BROADCAST_PAIRS:
        table = counts.sort("pair").toArrow()
        columns = [table.column(c).to_numpy() for c in ("pair", "links", "best")]
        shared = spark.sparkContext.broadcast(columns)

        def looked_up(row: dict[str, pa.Array]) -> tuple[np.ndarray, np.ndarray]:
            pair, links, best = shared.value
            at = np.searchsorted(pair, row["pairs"].to_numpy())
            return links[at], best[at]

        joined = blocks_of_links
    else:
        numbered = blocks_of_links.withColumn("block", F.expr("uuid()"))
        numbered = stored(numbered, "alignment-blocks")
        of_block = (
            numbered.select("block", F.posexplode("pairs").alias("at", "pair"))
            .join(counts, "pair")
            .groupBy("block")
            .agg(F.array_sort(F.collect_list(F.struct("at", "links", "best"))).alias("found"))
            .select("block", F.col("found.links").alias("counts"), F.col("found.best").alias("best"))
        )
        joined = numbered.join(of_block, "block", "left").drop("block")

        def looked_up(row: dict[str, pa.Array]) -> tuple[np.ndarray, np.ndarray]:
            return row["counts"].to_numpy(), row["best"].to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [n for n in batch.schema.names if n != "links"]
            for k in range(batch.num_rows):
                row = {n: batch.column(n).slice(k, 1).flatten() for n in lists}
                raw = batch.column("links")[k].as_py()
                at = _sums(row["n_links"].to_numpy())
                pair = np.frombuffer(raw, f"<u{len(raw) // int(at[-1]) if at[-1] else 2}")
                links, best = looked_up(row) if len(pair) else (np.zeros(1, np.int64),) * 2
                sums = [sums_between(x.astype(np.int64)[pair], at) for x in (best, links)]
                names = ["doc_id", *_PER_DOC, "groups_sha256"]
                yield pa.RecordBatch.from_arrays(
                    [*(row[n] for n in names), *map(pa.array, sums)],
                    names=[*names, "n_best", "count_sum"],
                )

    return joined.mapInArrow(run, schema)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_counts(stored(packed(read(spark, sf_dir, "documents")), "alignment"))
