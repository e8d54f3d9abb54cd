"""Stored layout: clustering for file skipping, and small-file compaction."""

from __future__ import annotations

import bisect
import json
import os.path
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.session import session_with
from lakestrata.sources import fs
from lakestrata.sources.tables import publish

TARGET_BYTES = 512 * 1024 * 1024
#: ranks a clustering column is cut into, as a power of two, and the accuracy of their boundaries
RANK_BITS = 8
RANK_ACCURACY = 20_000
#: characters of a text that decide its rank, beyond the start that all values share
TEXT_BYTES = 7


def file_count(bytes_in: int, target_bytes: int) -> int:
    if target_bytes < 1:
        raise ValueError("target_bytes must be at least 1")
    return max(1, -(-bytes_in // target_bytes))


def clustered(df: DataFrame, by: Sequence[str], files: int) -> DataFrame:
    """``df`` in ``files`` sorted key ranges, so that a reader skips files by min/max.

    Equal keys stay in one range; for stored data with hot keys use ``recluster``.
    """
    return df.repartitionByRange(files, *by).sortWithinPartitions(*by)


def recluster(spark: SparkSession, source: str, root: str, folder: str, by: Sequence[str],
              target_bytes: int = TARGET_BYTES) -> str:
    """Rewrite a Parquet folder clustered by ``by`` into ``root/folder``.

    The range key ends with each row's place in its source file, which is unique and fixed: a key
    value that holds a third of all rows, copies included, still splits into equal files.
    """
    stored = spark.read.parquet(source)
    placed = stored.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_place"))
    files = file_count(fs.size(spark, source), target_bytes)
    ranged = placed.repartitionByRange(files, *by, "_place").sortWithinPartitions(*by).drop("_place")
    publish(ranged, root, folder)
    return f"{root}/{folder}"


def recluster_curve(spark: SparkSession, source: str, root: str, folder: str, by: Sequence[str],
                    target_bytes: int = TARGET_BYTES) -> str:
    """Rewrite a Parquet folder into ``root/folder`` so that a filter on any of ``by`` skips files.

    Rows are ordered along Hilbert's curve over the ranks of the columns, so that all of them, not
    only the first, have narrow ranges in every file. As ranks, not values, are interleaved, skewed
    columns share the files evenly. Equal rows are split by their place in the source, as in ``recluster``.
    """
    stored = spark.read.parquet(source)
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    placed = with_curve(stored.select("*", place.alias("_place")), by, "_curve")
    files = file_count(fs.size(spark, source), target_bytes)
    ranged = placed.repartitionByRange(files, "_curve", "_place").sortWithinPartitions("_curve", *by)
    publish(ranged.drop("_place", "_curve"), root, folder)
    return f"{root}/{folder}"


def with_curve(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """``df`` and, as a long, each row's place on Hilbert's curve through the ranks of ``by``.

    NULL ranks beside the lowest values. Boundaries of ranks come from one aggregation over ``df`` (and one more
    for the shared start of texts); they are fewer than ``2**RANK_BITS`` numbers a column, however large ``df`` is.
    """
    if not 1 <= len(by) <= 7:
        raise ValueError("a curve needs one to seven columns")
    bits = min(RANK_BITS, 62 // len(by))
    shared = _shared_starts(df, [c for c in by if isinstance(df.schema[c].dataType, T.StringType)])
    numbers = [_as_number(df.schema[c].dataType, c, shared.get(c, "")) for c in by]
    steps = [n / 2**bits for n in range(1, 2**bits)]
    cuts = df.agg(*(F.percentile_approx(n, steps, RANK_ACCURACY).alias(f"c{i}") for i, n in enumerate(numbers))).first()
    axes = [f"{name}_{i}" for i in range(len(by))]
    ranked = df.withColumns({axis: _rank(n, cut) for axis, n, cut in zip(axes, numbers, cuts)})
    turned = _along_hilbert(ranked, axes, bits)
    position = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for axis in axes:
            position = F.shiftleft(position, 1).bitwiseOR(F.shiftright(axis, bit).bitwiseAND(F.lit(1)))
    return turned.withColumn(name, position).drop(*axes)


def _along_hilbert(df: DataFrame, axes: Sequence[str], bits: int) -> DataFrame:
    """``df`` with ``axes`` so turned that their bits, taken in turns, number the cells along the curve.

    From the highest bit down, each half of a cube is mirrored or its axes swapped, as the curve
    enters it; a Gray code over the axes then numbers the halves (Skilling 2004).
    """
    first = F.col(axes[0])
    for bit in reversed(range(1, bits)):
        half = F.lit(2**bit - 1).cast("long")
        for axis in axes:
            own = F.col(axis)
            upper = F.shiftright(axis, bit).bitwiseAND(F.lit(1)) == 1
            if axis == axes[0]:
                df = df.withColumn(axis, F.when(upper, own.bitwiseXOR(half)).otherwise(own))
            else:
                swap = first.bitwiseXOR(own).bitwiseAND(half)
                df = df.withColumns({
                    axes[0]: F.when(upper, first.bitwiseXOR(half)).otherwise(first.bitwiseXOR(swap)),
                    axis: F.when(upper, own).otherwise(own.bitwiseXOR(swap)),
                })
    for before, axis in zip(axes, axes[1:]):
        df = df.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    mirrored = F.lit(0).cast("long")
    for bit in range(1, bits):
        upper = F.shiftright(axes[-1], bit).bitwiseAND(F.lit(1)) == 1
        mirrored = mirrored.bitwiseXOR(F.when(upper, F.lit(2**bit - 1).cast("long")).otherwise(F.lit(0).cast("long")))
    return df.withColumns({axis: F.col(axis).bitwiseXOR(mirrored) for axis in axes})


def _rank(number: Column, cuts: Sequence[float] | None) -> Column:
    """How many of the ascending ``cuts``, one less than a power of two, the number has reached; 0 for NULL."""
    none = F.lit(0).cast("long")
    if not cuts:
        return none
    ascending = F.array(*map(F.lit, cuts))

    def halve(rank: Column, step: Column) -> Column:
        return rank + F.when(F.get(ascending, (rank + step - 1).cast("int")) <= number, step).otherwise(none)

    halves = [2**b for b in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(F.array(*(F.lit(h).cast("long") for h in halves)), none, halve)


def _shared_starts(df: DataFrame, texts: Sequence[str]) -> dict[str, str]:
    """Per text column what all its values start with, found from the least and the greatest."""
    if not texts:
        return {}
    ends = df.agg(*(f(F.substring(F.col(c), 1, 256)).alias(f"{n}_{i}") for i, c in enumerate(texts) for n, f in (("a", F.min), ("b", F.max)))).first()
    return {c: os.path.commonprefix([ends[f"a_{i}"] or "", ends[f"b_{i}"] or ""]) for i, c in enumerate(texts)}


def _as_number(kind: T.DataType, name: str, shared: str) -> Column:
    """A double or long that never falls while the column rises."""
    value = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        rest = F.hex(F.encode(F.substr(value, F.lit(len(shared) + 1)), "UTF-8"))
        return F.conv(F.rpad(F.substring(rest, 1, 2 * TEXT_BYTES), 2 * TEXT_BYTES, "0"), 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(value)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_date(value.cast("date")) * 86400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return value.cast("double") if isinstance(kind, (T.FractionalType, T.DecimalType)) else value.cast("long")
    raise ValueError(f"{name} has no order that ranks can follow: {kind.simpleString()}")


def compact(spark: SparkSession, source: str, root: str, folder: str, target_bytes: int = TARGET_BYTES) -> str:
    """Rewrite a folder of small files into files of about ``target_bytes``, without a shuffle.

    Spark already packs small files into scan tasks; here a task takes ``target_bytes`` of input
    and writes one file. The settings belong to a session of their own.
    """
    if target_bytes < 1:
        raise ValueError("target_bytes must be at least 1")
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    publish(own.read.parquet(source), root, folder)
    return f"{root}/{folder}"


@dataclass(frozen=True)
class Compaction:
    """Files left alone, small files replaced, and the files they became."""

    kept: int
    replaced: int
    written: int


def compact_in_place(spark: SparkSession, folder: str, target_bytes: int = TARGET_BYTES, small: float = 0.75) -> Compaction:
    """Merge the small files of a Parquet folder; files of ``small * target_bytes`` or more stay as they are.

    Small files are dealt into bins of at most ``target_bytes``, largest first; a file alone in its
    bin stays too, so a second run finds nothing to do. Each folder of a ``key=value`` tree is packed by itself.
    Only sizes and names are seen on the driver, one scan task merges one bin file by file. New files are written
    whole before a plan names them and what they replace; a run that is cut short after that is
    finished by the next one. Between the two a reader that starts could see rows twice, so let compaction
    and readers take turns, as with any change in place.
    """
    if target_bytes < 1 or not 0 < small <= 1:
        raise ValueError("target_bytes must be at least 1 and small above 0, at most 1")
    _carry_out(spark, folder)
    sizes = {n: b for n, b in fs.list_files(spark, folder).items() if n.endswith(".parquet") and not fs.hidden(n)}
    by_place: dict[str, dict[str, int]] = {}
    for name, size in sizes.items():
        if size < small * target_bytes:
            by_place.setdefault(os.path.dirname(name), {})[name] = size
    places = sorted(by_place)
    bins = [(n, b) for n, place in enumerate(places) for b in bins_of(by_place[place], target_bytes) if len(b) > 1]
    replaced = [name for _, names in bins for name in names]
    if not bins:
        return Compaction(len(sizes), 0, 0)
    run = f"_staging/compact-{uuid.uuid4().hex}"
    _merge_bins(spark, folder, bins, f"{folder}/{run}")
    moves = {}
    for name in fs.list_files(spark, f"{folder}/{run}"):
        if name.endswith(".parquet"):
            number, file = name.split("/")
            moves[f"{run}/{name}"] = f"{places[int(number.split('=')[1])]}/{file}".lstrip("/")
    fs.write_text(spark, f"{folder}/{_PLAN}", json.dumps({"run": run, "moves": moves, "replaced": replaced}))
    _carry_out(spark, folder)
    return Compaction(len(sizes) - len(replaced), len(replaced), len(moves))


#: bins that one job merges, and folders of a tree that are merged side by side
BINS_A_JOB, PLACES_AT_ONCE = 64, 8
_PLAN = "_staging/_compaction.json"


def bins_of(sizes: dict[str, int], capacity: int) -> list[list[str]]:
    """The names in bins of at most ``capacity``: largest first, each into the fullest bin it fits.

    A name larger than ``capacity`` has a bin of its own.
    """
    free: list[tuple[int, int]] = []  # ascending (room, bin)
    bins: list[list[str]] = []
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        at = bisect.bisect_left(free, (sizes[name], -1))
        if at < len(free):
            room, number = free.pop(at)
        else:
            room, number = capacity, len(bins)
            bins.append([])
        bins[number].append(name)
        if room > sizes[name]:
            bisect.insort(free, (room - sizes[name], number))
    return bins


def _merge_bins(spark: SparkSession, folder: str, bins: list[tuple[int, list[str]]], staged: str) -> None:
    """One file per bin, below ``_place=n`` for its place.

    A task reads the files of its bin one after the other and writes as it reads: it holds no more of a
    bin than a few row groups, whatever the target, and no row is shuffled or sorted. Rows keep their
    order within a file, and so what clustering they have.
    """
    paths = {name: fs.escape_glob(f"{folder}/{name}") for _, names in bins for name in names}
    schema = spark.read.option("mergeSchema", "true").parquet(*paths.values()).schema
    # all files of a read are one scan task, and none is split
    whole = {"files.maxPartitionBytes": str(1 << 60), "files.minPartitionNum": "1"}
    read = session_with(spark, **whole).read.schema(schema)
    by_place: dict[int, list[list[str]]] = {}
    for place, names in bins:
        by_place.setdefault(place, []).append(names)

    def merge(place: int) -> None:
        own = by_place[place]
        for at in range(0, len(own), BINS_A_JOB):
            parts = [read.parquet(*(paths[n] for n in names)) for names in own[at : at + BINS_A_JOB]]
            reduce(DataFrame.union, parts).write.mode("append").parquet(f"{staged}/_place={place}")

    with ThreadPoolExecutor(PLACES_AT_ONCE) as pool:
        list(pool.map(merge, by_place))


def _carry_out(spark: SparkSession, folder: str) -> None:
    """Do what the plan of an earlier or this run says, from wherever it stopped."""
    if not fs.exists(spark, f"{folder}/{_PLAN}"):
        return
    plan = json.loads(fs.read_text(spark, f"{folder}/{_PLAN}"))
    for old, new in plan["moves"].items():
        if not fs.exists(spark, f"{folder}/{new}"):
            fs.rename(spark, f"{folder}/{old}", f"{folder}/{new}")
    for name in plan["replaced"]:
        fs.delete(spark, f"{folder}/{name}")
    fs.delete(spark, f"{folder}/{plan['run']}")
    fs.delete(spark, f"{folder}/{_PLAN}")
