"""Helpers of the corpus operators: staged tables, components of a graph, words as numbers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallystone.sources.files import stage

__all__ = ["WORD_TABLE", "about", "components", "fold", "lean", "packed", "read", "ship", "stage", "text_of", "with_columns_of", "word_hashes"]

# A-Z become a-z, 0-9, a-z and all non-ASCII bytes stay, anything else is a blank.
WORD_TABLE = bytes(
    b + 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256)
)
_KEEPS = np.frombuffer(WORD_TABLE, np.uint8) != 32
_LOWER = np.frombuffer(WORD_TABLE, np.uint8).astype(np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20
#: Powers of the base and of its inverse, for one piece of text.
_powers: dict[int, np.ndarray] = {}


_shipped: set[str] = set()
#: Rows of a batch that goes to a Python worker: what worker and JVM hold of long texts at once.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable in the tasks of the session, wherever they run, and bound the
    batches that go to Python workers."""
    context = spark.sparkContext
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def lean(run):
    """A function of batches that keeps its worker small: large arrays are the machine's as soon as they
    are dropped, and what else it used goes back when it ends, since the worker waits for the next task
    with all it holds."""

    def wrapped(batches):
        _no_hoarding()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped


def _libc(name: str):
    """A function of the GNU C library; None elsewhere."""
    import ctypes

    return getattr(ctypes.CDLL(None), name, None)


def _no_hoarding() -> None:
    import pyarrow as pa

    pa.set_memory_pool(pa.system_memory_pool())
    set_option = _libc("mallopt")
    if set_option:
        set_option(-3, 1 << 20)  # M_MMAP_THRESHOLD: from 1 MB on, memory of its own


def _give_back() -> None:
    import gc

    gc.collect()
    trim = _libc("malloc_trim")
    if trim:
        trim(0)


def packed(docs: DataFrame) -> DataFrame:
    """All columns in one struct named row, so that no name can clash with an added column."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def with_columns_of(docs: DataFrame, *more: tuple[str, str]) -> StructType:
    """Schema of packed(docs) with more (name, type) columns."""
    schema = packed(docs).schema
    for name, kind in more:
        schema = StructType([*schema.fields, *StructType.fromDDL(f"{name} {kind}").fields])
    return schema


def text_of(column, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column of an Arrow batch, or of a struct's field; null is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if pa.types.is_struct(column.type):
        column = pc.struct_field(column, name)
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def fold(name: str, divisor: int):
    """crc32 of the id as text, modulo divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % divisor


def about(hashed, wanted: int, total: int):
    """True for about `wanted` of `total` rows (a binomial draw), told by a hash of the row's id."""
    return F.pmod(hashed, F.lit(1 << 40)) < F.lit(int(min(1.0, wanted / max(total, 1)) * (1 << 40)))


def _power(base: int) -> np.ndarray:
    if base not in _powers:
        with np.errstate(over="ignore"):
            steps = np.full(_PIECE + 1, base, np.uint64)
            steps[0] = 1
            _powers[base] = np.multiply.accumulate(steps)
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _hash_piece(piece: bytes) -> np.ndarray:
    raw = np.frombuffer(piece, np.uint8)
    inside = _KEEPS[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_LOWER[raw] * _power(_BASE)[: len(raw)], out=sums[1:])
        word = (sums[ends] - sums[starts]) * _power(_BASE_INVERSE)[starts]
        return mix(word + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit number per word, in order; equal words have equal numbers on every machine.

    Words are maximal runs of a-z (A-Z lower-cased), 0-9 and bytes beyond ASCII. Long texts
    are worked off in pieces that end at a blank, so scratch memory does not grow with them.
    """
    if len(text) <= _PIECE:
        return _hash_piece(text)
    out, at, flat = [], 0, text.translate(WORD_TABLE)
    while at < len(flat):
        end = min(len(flat), at + _PIECE)
        if end < len(flat):
            cut = flat.rfind(b" ", at, end)
            if cut < 0:  # a word longer than a piece: taken whole, by its digest
                import hashlib

                end = flat.find(b" ", end)
                end = len(flat) if end < 0 else end
                word = flat[at:end].split()[0]
                out.append(np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), np.uint64))
                at = end
                continue
            end = cut + 1
        out.append(_hash_piece(flat[at:end]))
        at = end
    return np.concatenate(out)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components: (id, root), root the smallest id, for each id of an edge (a, b).

    Alternating large-star and small-star steps, each a grouping and a join, until the edges
    no longer change; every round is a table in the shared folder. Nothing reaches the driver
    but a count and a sum per round.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    before = None
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Stored, so that the join has two plain shuffles and Spark can split the one of a hub.
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), label)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, label)
        least = stage(large.groupBy("u").agg(F.min("v").alias("m")), label)
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        now = stage(small.distinct(), label)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("root"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).unionAll(roots)
