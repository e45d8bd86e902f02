"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from vantage.session import scratch_path


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per Spark application."""
    done = os.environ.get("VANTAGE_SHIPPED")
    if done == spark.sparkContext.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    to = Path(tempfile.mkdtemp(prefix="vantage-code-")) / "vantage_code.zip"
    with zipfile.ZipFile(to, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, f"{root.name}/{p.relative_to(root)}")
    spark.sparkContext.addPyFile(str(to))
    os.environ["VANTAGE_SHIPPED"] = spark.sparkContext.applicationId


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared checkpoint folder and read it back.

    Executors may be lost afterwards without recomputing what led here, and Catalyst knows the table's size."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks_for(files: DataFrame, pieces: int, total_bytes: int, bytes_each: int = 64 << 20) -> int:
    """How many tasks should read that much: a task per ``bytes_each``, at least one per core, none without a piece.

    Given to ``repartition`` as a number, which adaptive execution leaves alone; of a list of paths it would make one task,
    since it goes by the size of the list."""
    cores = files.sparkSession.sparkContext.defaultParallelism
    return max(1, min(pieces, max(cores, -(-total_bytes // bytes_each))))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores appended until no column of ``df`` has that name (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def col(name: str) -> Column:
    """A column by its exact top-level name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


_RESIDENT: dict[tuple[str, object], object] = {}


def resident(owner: str, key: object, make: Callable[[], object]) -> object:
    """An object that this worker process keeps for later tasks of the same operator, one at a time."""
    if (owner, key) not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[owner, key] = make()
    return _RESIDENT[owner, key]


def settle_in(owner: str) -> None:
    """At a task's start: drop what other operators keep in this worker, and give free memory back to the system."""
    for k in [k for k in _RESIDENT if k[0] != owner]:
        del _RESIDENT[k]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


@contextlib.contextmanager
def uncollected():
    """No garbage collection within: what runs there makes no cycles, and the collector would walk large caches again and
    again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def batch_udf(make: Callable[[], Callable[..., pa.Array]], returns: str | DataType):
    """An Arrow UDF over one column. ``make()`` runs once per task and gives the function applied to each batch.

    Non-deterministic for the optimiser only, so that a filter on its result doesn't evaluate it a second time."""

    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        settle_in(make.__module__)
        work = make()
        for batch in batches:
            yield work(batch)

    ship(SparkSession.active())
    apply.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(apply, returns).asNondeterministic()


def slices(batch: pa.Array, most_bytes: int = 8 << 20) -> Iterator[pa.Array]:
    """Consecutive parts of a text batch of about ``most_bytes`` each (one row at least)."""
    if len(batch) == 0:
        return
    start = size = 0
    for i, n in enumerate(lengths(batch)):
        if size and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    yield batch.slice(start)


def lengths(batch: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(batch), 0).to_pylist()


def raw(batch: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string batch."""
    return batch.cast(pa.large_binary() if pa.types.is_large_string(batch.type) else pa.binary()).to_pylist()


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Default place of a public vocabulary file; every operator takes the path as a parameter."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


_WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                    for b in range(256))


def plain_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text with A-Z lower-cased; none of a null."""
    return text.translate(_WORD_BYTES).split() if text else []


def filesystem(path: str):
    """(file system, path within it) of a URI or an absolute path: local, HDFS or an object store."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def publish(store, made: str, place: str) -> None:
    """Give a finished file its name. A repeated task finds its own earlier file there and replaces it."""
    try:
        store.move(made, place)
    except OSError:
        store.delete_file(place)
        store.move(made, place)


def task_name() -> tuple[int, str]:
    """This task's partition and a suffix that no other attempt has."""
    from pyspark import TaskContext

    task = TaskContext.get()
    return task.partitionId(), f"{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
