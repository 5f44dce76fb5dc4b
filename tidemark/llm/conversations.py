"""Conversation structure repair by scalar big-integer weights.

Every conversation is repaired by the cheapest edits that bring its role initials to
``(s?(ua)+)?``. A path through the edits has one integer as its weight: the high
digits carry the cost, and below them a fixed number of three-bit digits holds the
letters of the edits from the left, with zeros as padding after the last one. The
smallest integer is therefore the cheapest path and, among equals, the one whose
letters come first in ASCII; nothing but integer minima over an acyclic graph of
(rows read, roles so far) decides.

Inserts stand before the row that follows them, so two paths at one node never have
letters of which one is the beginning of the other, and padding cannot confuse them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import prepare, read

COST = {"K": 0, "R": 2, "D": 3, "I": 2}
TRUNCATED_COST = 1
LETTERS = "DIKR"  # digits 1 to 4, in ASCII order
BITS = 3
WIDTH = 64  # letters the low digits have room for at first

# Roles so far: none, one system row, ending with a user, ending with an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT_ROLE = {EMPTY: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\v\f\r"
FAULTS = ["blank", "duplicate", "truncated"]
COUNTS = ["gaps", *FAULTS, "illegal", "cost"]


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with the faults of the contract planted.

    By crc32 of ``conv_id:turn`` modulo 20: 0 marks the row ``dropped``, 1 empties its
    text, 2 takes its ``.!?``, 3 gives it twice, 4 makes it the user's. NULL in any of
    the columns counts as one space (a NULL conv_id or turn stays NULL as a value).
    """
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.encode(F.concat_ws(":", shown("conv_id"), shown("turn")), "UTF-8")) % 20
    copies = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(shown("text"), ".!?", ""))
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(fault != 0, F.when(fault == 4, "user").otherwise(shown("role"))).alias("role"),
        F.when(fault != 0, text.otherwise(shown("text"))).alias("text"),
        (fault == 0).alias("dropped"),
        F.explode(copies).alias("copy"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """Rows of each conversation together, by turn, with their first ``fault``.

    One shuffle by conversation serves both sorts; they and the window spill, so a
    conversation of any length takes a bounded share of memory. A NULL turn comes
    first; rows of one turn follow each other by role and text.
    """
    rest = F.rtrim(F.col("text"), F.lit(BLANKS))
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(
        F.col("turn").asc_nulls_first(), "copy"
    )
    fault = (
        F.when(rest == "", 1)
        .when(F.row_number().over(same) > 1, 2)
        .when(~F.substring(rest, -1, 1).isin(".", "!", "?"), 3)
        .otherwise(0)
    )
    return (
        rows.repartition("conv_id")
        .withColumn("fault", fault)
        .sortWithinPartitions(
            "conv_id", "dropped", F.col("turn").asc_nulls_first(), "role", "text", "copy"
        )
        .select("conv_id", "turn", "role", "text", "dropped", "fault")
    )


@lru_cache(maxsize=None)
def _edges(initial: str, must_go: bool, truncated: bool) -> list[tuple]:
    """Ways past a row: (roles before, roles after, cost, letters as digits, their
    number, inserted role, role kept or "" for its own or None if deleted).

    At most one insert stands before a row: two would lead back to roles from which the
    same rows are legal, at a higher cost.
    """
    found = []
    for before in range(4):
        for inserted in (None, NEXT_ROLE[before]):
            at = AFTER[inserted[0]] if inserted else before
            edits = [("D", at, None)]
            if not must_go:
                edits.append(("R", AFTER[NEXT_ROLE[at][0]], NEXT_ROLE[at]))
                if initial == NEXT_ROLE[at][0] or (initial == "s" and at == EMPTY):
                    edits.append(("K", AFTER[initial], ""))
            for letter, after, role in edits:
                letters = ("I" if inserted else "") + letter
                cost = sum(COST[x] for x in letters) + TRUNCATED_COST * (
                    truncated and letter != "D"
                )
                digits = 0
                for x in letters:
                    digits = digits << BITS | LETTERS.index(x) + 1
                found.append((before, after, cost, digits, len(letters), inserted, role))
    return found


def _close(before: int) -> list[str] | None:
    """Roles to insert at the end of a conversation."""
    return {EMPTY: [], SYSTEM: ["user", "assistant"], USER: ["assistant"], ASSISTANT: []}[before]


class Repair:
    """The repair of one conversation, row by row.

    Holds one path for each of the four states of the roles so far: its weight, its
    number of letters, and a digest of the text it gives. Letters all paths share at
    the front are settled and leave the integers, which so stay short however long the
    conversation is.
    """

    def __init__(self) -> None:
        self.width = WIDTH
        self.settled: list[str] = []
        self.paths = {EMPTY: (0, 0, hashlib.sha256())}
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal = self.distinct = 0
        self.first = self.last = self.initial = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.distinct = turn, self.distinct + 1
        if fault:
            self.counts[FAULTS[fault - 1]] += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        self._make_room()
        least: dict[int, tuple] = {}
        low = BITS * self.width
        for edge in _edges(initial, fault in (1, 2), fault == 3):
            before, after, cost, digits, n, _, _ = edge
            if before in self.paths:
                weight, letters, _ = self.paths[before]
                weight += (cost << low) + (digits << BITS * (self.width - letters - n))
                if after not in least or weight < least[after][0]:
                    least[after] = (weight, letters + n, edge)
        paths = {}
        for after, (weight, letters, edge) in least.items():
            before, _, _, _, _, inserted, kept = edge
            digest = self.paths[before][2].copy()
            roles_before = before != EMPTY
            if inserted:
                digest.update((("\n" if roles_before else "") + inserted + ":").encode())
                roles_before = True
            if kept is not None:
                line = ("\n" if roles_before else "") + (kept or role) + ":" + text
                digest.update(line.encode("utf-8", "surrogatepass"))
            paths[after] = (weight, letters, digest)
        self.paths = paths

    def _make_room(self) -> None:
        """Room for the letters of one more row and of the end."""
        if max(letters for _, letters, _ in self.paths.values()) + 4 <= self.width:
            return
        low = BITS * self.width
        mask = (1 << low) - 1
        weights = [weight for weight, _, _ in self.paths.values()]
        apart = 0
        for weight in weights[1:]:
            apart |= (weight ^ weights[0]) & mask
        shared = (low - apart.bit_length()) // BITS
        shared = min(shared, *(letters for _, letters, _ in self.paths.values()))
        if shared * 2 < self.width:  # little is settled: widen the low digits
            self.paths = {
                state: (weight << low, letters, digest)
                for state, (weight, letters, digest) in self.paths.items()
            }
            self.width *= 2
            return
        self.settled.append(_letters(weights[0], self.width, shared))
        self.paths = {
            state: (
                weight >> low << low | (weight << BITS * shared) & mask,
                letters - shared,
                digest,
            )
            for state, (weight, letters, digest) in self.paths.items()
        }

    def result(self) -> dict[str, object]:
        low = BITS * self.width
        least = None
        for before, (weight, letters, digest) in self.paths.items():
            roles = _close(before)
            for k, _ in enumerate(roles):
                digit = LETTERS.index("I") + 1 << BITS * (self.width - letters - k - 1)
                weight += (COST["I"] << low) + digit
            if least is None or weight < least[0]:
                least = (weight, letters + len(roles), digest, roles)
        weight, letters, digest, roles = least
        for role in roles:
            digest.update(f"\n{role}:".encode())
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.distinct
        return {
            "gaps": gaps,
            **self.counts,
            "illegal": self.illegal,
            "cost": weight >> low,
            "audit": "".join(self.settled) + _letters(weight, self.width, letters),
            "repaired_sha256": digest.hexdigest(),
        }


def _letters(weight: int, width: int, n: int) -> str:
    """The first ``n`` letters of a weight."""
    part = (weight & (1 << BITS * width) - 1) >> BITS * (width - n)
    return "".join([LETTERS[int(d) - 1] for d in f"{part:0{n}o}"]) if n else ""


def repair(rows: DataFrame, damaged: bool = False) -> DataFrame:
    """(conv_id, counts of faults, cost, audit, repaired_sha256) of each conversation.

    ``rows`` has conv_id, turn, role and text, or with ``damaged`` the columns that
    :func:`damage` gives. A NULL role or text counts as one space, rows without
    conv_id are one conversation, and a role with another or no initial is never kept
    as it is. Repeated rows are duplicates, rows of one turn are taken by role and text, a
    conversation whose rows are all dropped has zeros, an empty table gives no rows, and
    further columns are ignored. Texts of any length pass as they are. A conversation is
    read by one task as a sorted stream: its audit and digest are sequential, but neither
    its rows nor its texts are held.
    """
    prepare(rows.sparkSession)
    if not damaged:
        space = F.lit(" ")
        rows = rows.select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", space).alias("role"),
            F.coalesce("text", space).alias("text"),
            F.lit(False).alias("dropped"),
            F.lit(1).alias("copy"),
        )

    id_type = rows.schema["conv_id"].dataType
    schema = (
        f"conv_id {id_type.simpleString()}, {', '.join(f'{c} long' for c in COUNTS)}, "
        "audit string, repaired_sha256 string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple[object, Repair] | None = None
        for batch in batches:
            done = []
            ids = batch.column("conv_id")
            rest = [batch.column(c).to_pylist() for c in batch.schema.names[1:]]
            for conv, turn, role, text, dropped, fault in zip(ids.to_pylist(), *rest):
                if current is None or conv != current[0]:
                    if current:
                        done.append((current[0], current[1].result()))
                    current = (conv, Repair())
                if not dropped:
                    current[1].add(turn, role, text, fault)
            yield _batch(done, ids.type)
        if current:
            yield _batch([(current[0], current[1].result())], ids.type)

    return in_order(rows).mapInArrow(run, schema)


def _batch(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = {c: pa.array([r[c] for _, r in done], pa.int64()) for c in COUNTS}
    for name in ("audit", "repaired_sha256"):
        columns[name] = pa.array([r[name] for _, r in done], pa.string())
    ids = pa.array([conv for conv, _ in done], id_type)
    return pa.RecordBatch.from_arrays([ids, *columns.values()], names=["conv_id", *columns])


def op13_scalar_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(read(spark, sf_dir, "conversations")), damaged=True)
