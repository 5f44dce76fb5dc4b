"""State that is read and rewritten by the same job.

A new state goes to its own ``version=<n>`` folder and counts once its
``_SUCCESS`` file is there; the state it was computed from stays untouched. A
repeated run of the same version replaces only its own folder.

A large state is kept in parts. A version then holds the parts that a batch touched,
and its parts list, written last, says which version each part of the state is in. The
list is put in place by a rename, which is atomic on HDFS and local file systems; an
object store needs a committer or a store with atomic puts in its place.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PREFIX = "version="

# Codec of stored states and of the staged copies they are made from.
CODEC = "zstd"


def _folder(spark: SparkSession, path: str):
    """File system and path object of a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def count_files(spark: SparkSession, pattern: str) -> int:
    """Files whose path matches a pattern."""
    fs, path = _folder(spark, pattern)
    return len(fs.globStatus(path) or ())


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, folder = _folder(spark, path)
    return fs.getContentSummary(folder).getLength()


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def finished_versions(spark: SparkSession, root: str, before: int | None = None) -> list[int]:
    """Versions written to the end, oldest first, optionally older than ``before``."""
    fs, base = _folder(spark, root)
    if not fs.exists(base):
        return []
    names = (entry.getPath().getName() for entry in fs.listStatus(base))
    versions = (int(name[len(_PREFIX) :]) for name in names if name.startswith(_PREFIX))
    return sorted(
        v
        for v in versions
        if (before is None or v < before)
        and folder_exists(spark, f"{version_path(root, v)}/_SUCCESS")
    )


def version_path(root: str, version: int) -> str:
    return f"{root}/{_PREFIX}{version:012d}"


def current_version(spark: SparkSession, root: str, before: int | None = None) -> int | None:
    """Newest finished version, optionally older than ``before``."""
    done = finished_versions(spark, root, before)
    return done[-1] if done else None


def read_current(
    spark: SparkSession, root: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """Newest finished state, or an empty frame before the first one."""
    version = current_version(spark, root, before)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(root, version))


def publish(df: DataFrame, root: str, version: int) -> DataFrame:
    """Write a state as ``version`` and return it as read back."""
    path = version_path(root, version)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_view(spark: SparkSession, name: str, root: str) -> None:
    """Point a catalog view at the newest finished version."""
    version = current_version(spark, root)
    if version is None:
        raise ValueError(f"nothing published under {root}")
    path = version_path(root, version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def drop_old_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the newest ``keep`` finished versions of a state without parts."""
    if keep < 1:
        raise ValueError("the current version cannot be dropped")
    for version in finished_versions(spark, root)[:-keep]:
        remove_folder(spark, version_path(root, version))


# States in parts.

PART = "state_part"
# A part of a state that is dealt by a hash of its key is named by the leading bits of
# the hashes in it, ALL_KEYS alone when there is one part. A part that has grown beyond
# PART_BYTES is split by the next bits when a batch rewrites it, so the number of parts
# follows the size of the state, and what a batch rewrites follows the batch.
PART_BYTES = 256 << 20
ALL_KEYS = "p"
# A batch that makes so many parts at most writes them from the tasks that merged it: a file
# per task and part is then few enough to need no shuffle that gathers the parts. A part is
# replaced as a whole, so its files do not add up over batches; a later batch gathers its parts
# all the same if they are small, so that they stay in few files.
FEW_PARTS = 8
SMALL_BYTES = 32 << 20
NOWHERE = -1  # version of a part without rows


@dataclass(frozen=True)
class State:
    """Schema of a state in parts, the version that holds each part and its bytes there,
    and the schemas of the versions."""

    schema: T.StructType
    parts: dict[str, int]
    sizes: dict[str, int] = field(default_factory=dict)
    schemas: dict[int, T.StructType] = field(default_factory=dict)


def with_part(df: DataFrame, key: str, parts: Collection[str]) -> DataFrame:
    """``df`` with the part, out of ``parts`` that cover all hashes, of each row's key."""
    bits = F.lpad(F.bin(F.xxhash64(key)), 64, "0")
    depths = sorted({len(p) - len(ALL_KEYS) for p in parts})
    if depths == [0]:
        return df.withColumn(PART, F.lit(ALL_KEYS))
    names = [F.concat(F.lit(ALL_KEYS), F.substring(bits, 1, d)) for d in depths]
    if len(names) == 1:
        return df.withColumn(PART, names[0])
    # A row per part of a state: small, and its join must not shuffle the rows.
    listed = df.sparkSession.range(1).select(
        F.explode(F.split(F.lit(",".join(parts)), ",")).alias(PART)
    )
    found = df.withColumn(PART, F.explode(F.array(*names))).join(F.broadcast(listed), PART)
    return found.select(*df.columns, PART)


def parts_of(df: DataFrame, key: str, parts: Collection[str]) -> list[str]:
    """The parts that the keys of ``df`` lie in."""
    return [r[0] for r in with_part(df.select(key), key, parts).select(PART).distinct().collect()]


def split(part: str, size: int, part_bytes: int) -> list[str]:
    """The parts that take the place of one of ``size`` bytes."""
    extra = max(0, -(-size // part_bytes) - 1).bit_length()
    return [part + (f"{i:0{extra}b}" if extra else "") for i in range(1 << extra)]


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, a measure for how many parts it needs."""
    spark, total = df.sparkSession, 0
    for name in df.inputFiles():
        fs, path = _folder(spark, name)
        total += fs.getFileStatus(path).getLen()
    return total


def _list_path(root: str, version: int) -> str:
    return f"{root}/_parts-{version:012d}.json"


# Whether a version counts.
Valid = Callable[[int], bool]


def state_versions(spark: SparkSession, root: str, valid: Valid | None = None) -> list[int]:
    """Versions with a parts list, oldest first, only ``valid`` ones if given."""
    fs, base = _folder(spark, root)
    if not fs.exists(base):
        return []
    names = (entry.getPath().getName() for entry in fs.listStatus(base))
    found = (int(n[7:-5]) for n in names if n.startswith("_parts-") and n.endswith(".json"))
    return sorted(v for v in found if valid is None or valid(v))


def load_state(spark: SparkSession, root: str, valid: Valid | None = None) -> State | None:
    """Newest parts list, only of ``valid`` versions if given."""
    done = state_versions(spark, root, valid)
    return _load(spark, root, done[-1]) if done else None


def _load(spark: SparkSession, root: str, version: int) -> State:
    fs, path = _folder(spark, _list_path(root, version))
    stream = fs.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    kinds = [T.StructType.fromJson(kind) for kind in found["kinds"]]
    schemas = {int(v): kinds[k] for v, k in found["schemas"].items()}
    return State(T.StructType.fromJson(found["schema"]), found["parts"], found["sizes"], schemas)


def _as_json(state: State) -> str:
    kinds: list[T.StructType] = []
    for schema in state.schemas.values():
        if schema not in kinds:
            kinds.append(schema)
    return json.dumps({
        "schema": state.schema.jsonValue(),
        "parts": state.parts,
        "sizes": state.sizes,
        "kinds": [kind.jsonValue() for kind in kinds],
        "schemas": {v: kinds.index(schema) for v, schema in state.schemas.items()},
    })


def read_parts(
    spark: SparkSession, root: str, state: State | None, schema: T.StructType | None = None,
    only: Iterable[str] | None = None,
) -> DataFrame:
    """Rows of a state, of some of its parts if ``only`` is given; empty without a state.

    Parts written with a narrower schema are cast to ``schema`` (that of the state by
    default), with NULL in the columns they were written without.
    """
    schema = schema or state.schema
    chosen = set(state.parts if state else ())
    if only is not None:
        chosen &= set(only)
    by_schema: dict[str, tuple[T.StructType, list[str]]] = {}
    for part in sorted(chosen):
        version = state.parts[part]
        if version != NOWHERE:
            own = state.schemas[version]
            path = f"{version_path(root, version)}/{PART}={part}"
            by_schema.setdefault(own.json(), (own, []))[1].append(path)
    found = [
        widened(spark.read.schema(own).parquet(*paths), schema)
        for own, paths in by_schema.values()
    ]
    if found:
        return reduce(DataFrame.unionAll, found)
    # Known to be empty before it runs, so that a merge with it is no join.
    return spark.createDataFrame([], schema).filter(F.lit(False))


def write_parts(
    df: DataFrame, root: str, version: int, part: Column | None, base: State | None = None,
    replaced: Iterable[str] | None = None, cover: Iterable[str] = (), order: Iterable[str] = (),
) -> State:
    """Write ``df`` as the parts ``replaced`` of a state, taking the others from ``base``.

    Without ``replaced``, ``df`` is the whole state; without ``part``, its column PART says
    where each row goes. Parts of ``cover`` stay in the list though they have no rows.
    ``rebalance`` evens out the files: a dominant part is split, small ones are packed; it
    is left out where ``cover`` tells that there are few, of some size. Rows lie in their file
    by ``order``, in the one sort that writing by part takes anyway: near values compress better.
    The list is written under another name and renamed, so a reader sees the old state or the
    new one.
    """
    spark, path = df.sparkSession, version_path(root, version)
    placed, cover = df if part is None else df.withColumn(PART, part), list(cover)
    gone = set(replaced or ())
    large = base is None or sum(base.sizes.get(p, 0) for p in gone) > SMALL_BYTES
    few = large and 0 < len(cover) <= FEW_PARTS
    dealt = placed if few else placed.hint("rebalance", PART)
    (
        dealt.sortWithinPartitions(PART, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PART)
        .parquet(path, compression=CODEC)
    )
    fs, folder = _folder(spark, path)
    sizes = {}
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        if name.startswith(f"{PART}="):
            sizes[name[len(PART) + 1 :]] = fs.getContentSummary(entry.getPath()).getLength()
    kept = State(placed.drop(PART).schema, {}) if replaced is None or base is None else base
    parts = dict.fromkeys(cover, NOWHERE) | {p: v for p, v in kept.parts.items() if p not in gone}
    parts |= dict.fromkeys(sizes, version)
    schema = placed.drop(PART).schema
    schemas = {**kept.schemas, version: schema}
    state = State(
        schema, parts,
        {p: n for p, n in {**kept.sizes, **sizes}.items() if parts.get(p, NOWHERE) != NOWHERE},
        {v: s for v, s in schemas.items() if v in set(parts.values())},
    )
    _, target = _folder(spark, _list_path(root, version))
    _, draft = _folder(spark, f"{root}/_draft-{version:012d}.json")
    stream = fs.create(draft, True)
    stream.write(bytearray(_as_json(state), "utf-8"))
    stream.close()
    fs.delete(target, False)
    fs.rename(draft, target)
    return state


def merge_parts(
    spark: SparkSession, root: str, version: int, source: DataFrame, key: str,
    merge: Callable[[DataFrame, DataFrame], DataFrame], base: State | None,
    schema: T.StructType, part_bytes: int = PART_BYTES, keys: DataFrame | None = None,
    order: Iterable[str] = (),
) -> State:
    """Merge ``source`` into the parts of a state that its keys lie in; the others stay.

    ``keys`` is a stored frame with the keys of ``source``, repeated or not; without it
    ``source`` itself should be stored, as it is read twice. ``schema`` is that of the
    state; where it is wider than before, stored rows are cast to it and have NULL in the
    new columns. A batch of k keys rewrites k parts at most; those of them that have become
    too large are split on the way. Files are in the order of ``key``, then of ``order``.
    """
    keys = source if keys is None else keys
    if base is None:
        leaves = touched = split(ALL_KEYS, stored_bytes(keys), part_bytes)
        cover = leaves
    else:
        touched = parts_of(keys, key, base.parts)
        cover = [n for p in touched for n in split(p, base.sizes.get(p, 0), part_bytes)]
        leaves = [p for p in base.parts if p not in set(touched)] + cover
    stored = read_parts(spark, root, base, schema, touched)
    merged = with_part(merge(stored, source), key, leaves)
    return write_parts(merged, root, version, None, base, touched, cover, [key, *order])


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in its types, NULL where it has none."""
    known = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *(
            (F.col(f.name) if known.get(f.name) == f.dataType
             else F.col(f.name).cast(f.dataType).alias(f.name) if f.name in known
             else F.lit(None).cast(f.dataType).alias(f.name))
            for f in schema.fields
        )
    )


# Types that take every value of another one without a change.
_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
WIDER = {
    **{small: _INTEGERS[i + 1 :] for i, small in enumerate(_INTEGERS)},
    T.FloatType(): (T.DoubleType(),),
    T.DateType(): (T.TimestampNTZType(), T.TimestampType()),
}
for _small in _INTEGERS[:3]:
    WIDER[_small] += (T.DoubleType(),)


def wider_type(name: str, first: T.DataType, second: T.DataType) -> T.DataType:
    """The one of two types that takes the values of both; an error if neither does."""
    if first == second or first in WIDER.get(second, ()):
        return first
    if second in WIDER.get(first, ()):
        return second
    raise TypeError(f"{name}: neither {first} nor {second} takes the values of both")


def union_schema(first: T.StructType, second: T.StructType) -> T.StructType:
    """Fields of both, those of ``first`` leading, each in the wider of its two types."""
    known = {f.name: f.dataType for f in first.fields}
    for field_ in second.fields:
        own = known.setdefault(field_.name, field_.dataType)
        known[field_.name] = wider_type(field_.name, own, field_.dataType)
    return T.StructType([T.StructField(name, kind) for name, kind in known.items()])


def drop_newer(spark: SparkSession, root: str, version: int) -> None:
    """Remove everything after ``version``, parts lists first: what a batch that did not
    finish has left."""
    fs, base = _folder(spark, root)
    if not fs.exists(base):
        return
    names = sorted(entry.getPath().getName() for entry in fs.listStatus(base))
    for name in names:
        digits = name.removeprefix("_parts-").removeprefix(_PREFIX).removesuffix(".json")
        if digits.isdigit() and int(digits) > version:
            remove_folder(spark, f"{root}/{name}")


def drop_old_states(spark: SparkSession, root: str, keep: int) -> None:
    """Remove the parts lists before the newest ``keep`` and all parts that none of those
    kept refers to."""
    if keep < 1:
        raise ValueError("the current state cannot be dropped")
    done = state_versions(spark, root)
    used = {
        (version, part)
        for v in done[-keep:]
        for part, version in _load(spark, root, v).parts.items()
    }
    for v in done[:-keep]:
        fs, path = _folder(spark, _list_path(root, v))
        fs.delete(path, False)
    newest = done[-keep:][0] if done else 0
    fs, base = _folder(spark, root)
    if not fs.exists(base):
        return
    names = [entry.getPath().getName() for entry in fs.listStatus(base)]
    for number in sorted(int(n[len(_PREFIX) :]) for n in names if n.startswith(_PREFIX)):
        if number >= newest:
            continue
        mine = {part for version, part in used if version == number}
        if not mine:
            remove_folder(spark, version_path(root, number))
            continue
        _, folder = _folder(spark, version_path(root, number))
        for entry in fs.listStatus(folder):
            name = entry.getPath().getName()
            if name.startswith(f"{PART}=") and name[len(PART) + 1 :] not in mine:
                remove_folder(spark, f"{version_path(root, number)}/{name}")
