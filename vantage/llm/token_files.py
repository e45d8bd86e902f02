"""Token counts by a separator scan over flat, unindexed token files.

A token file is nothing but little-endian token ids, each document followed by the end-of-document id. Files are read
in blocks of fixed size by many tasks. Within a block numpy finds all separators at once; a document that crosses blocks
is stitched by a prefix scan over the blocks of a file: the running greatest separator position before a block is where
its first document begins, the running sum of separators gives the document's number in the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vantage.llm.common import filesystem, fresh_path, publish, settle, settle_in, ship, task_name, tasks_for, tokenizer_path

WIDTHS = {"uint16": 2, "uint32": 4}


def _load(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def write(docs: DataFrame, root: str, path: str | None = None, separator: int = 50256, dtype: str = "uint16",
          file_bytes: int = 1 << 30) -> DataFrame:
    """Tokenise (doc_id, text) into files under ``root``; returns the settled list (doc_id, file, ordinal).

    Each task writes files of its own, closed at ``file_bytes``; a file gets its name when it is whole, so a repeated
    task replaces what it wrote. A null or empty text is a document of no tokens. ``path`` is the vocabulary file."""
    ship(docs.sparkSession)
    vocabulary = path or tokenizer_path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle_in(__name__)
        encoding = _load(vocabulary)
        store, base = filesystem(root)
        store.create_dir(base, recursive=True)
        part, attempt = task_name()
        out, number, size, ordinal = None, 0, 0, 0

        def close() -> None:
            out.close()
            publish(store, f"{base}/.{name}.{attempt}", f"{base}/{name}")

        for batch in batches:
            files, ordinals = [], []
            for text in batch.column(1).to_pylist():
                if out is None:
                    name, size, ordinal = f"tokens-{part:06d}-{number:04d}.bin", 0, 0
                    out = store.open_output_stream(f"{base}/.{name}.{attempt}")
                ids = encoding.encode_ordinary(text) if text else []
                ids.append(separator)
                data = np.array(ids, np.dtype(dtype).newbyteorder("<")).tobytes()
                out.write(data)
                size += len(data)
                files.append(name)
                ordinals.append(ordinal)
                ordinal += 1
                if size >= file_bytes:
                    close()
                    out, number = None, number + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(files, pa.string()),
                                              pa.array(ordinals, pa.int64())], ["doc_id", "file", "ordinal"])
        if out is not None:
            close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return settle(rows.mapInArrow(run, "doc_id long, file string, ordinal long"), "token-manifest")


def files(spark: SparkSession, root: str) -> DataFrame:
    """(path, bytes) of the token files under ``root``, listed by Spark; their contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(root)
            .select("path", F.col("length").alias("bytes")))


def scan(token_files: DataFrame, separator: int = 50256, dtype: str = "uint16", block_bytes: int = 4 << 20) -> DataFrame:
    """From (path, bytes) to (file, ordinal, first, n_tokens, closed), one row per document of every file.

    ``first`` is the document's first token in the file; the separator doesn't count. Tokens after a file's last
    separator are one more document with ``closed`` false. An empty file has no document; a file whose size is no
    multiple of the token width is an error. Each block is one row of bounded size, whatever the document's length."""
    width = WIDTHS[dtype]
    if block_bytes % width:
        raise ValueError("a block holds whole tokens")
    ship(token_files.sparkSession)
    found = token_files.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / block_bytes)), F.lit(0)).cast("long").alias("blocks"),
                            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    tasks = tasks_for(token_files, found.blocks, found.bytes)
    bad = F.raise_error(F.concat(F.lit("not a multiple of the token width: "), "path"))
    blocks = (token_files.where("bytes > 0")
              .withColumn("bytes", F.when(F.col("bytes") % width == 0, F.col("bytes")).otherwise(bad.cast("long")))
              .select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1,
                                                            F.lit(block_bytes).cast("long"))).alias("start"))
              .repartition(tasks, "path", "start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, place = filesystem(row["path"])
                with store.open_input_file(place) as f:
                    data = f.read_at(min(block_bytes, row["bytes"] - row["start"]), row["start"])
                ids = np.frombuffer(data, np.dtype(dtype).newbyteorder("<"))
                at = np.flatnonzero(ids == separator) + row["start"] // width
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"].rsplit("/", 1)[-1]]), pa.array([row["start"]], pa.int64()),
                     pa.array([row["bytes"] // width], pa.int64()), pa.array([at.tolist()], pa.list_(pa.int64()))],
                    ["file", "start", "total", "ends"])

    found = settle(blocks.mapInArrow(run, "file string, start long, total long, ends array<long>"), "separator-blocks")
    narrow = found.select("file", "start", F.array_max("ends").alias("last"), F.size("ends").alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    prefix = narrow.select("file", "start", F.coalesce(F.max("last").over(before), F.lit(-1)).alias("previous"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    closed = (found.select("file", "start", "ends").join(prefix, ["file", "start"])
              .select("file", "base", F.concat(F.array("previous"), "ends").alias("bounds"), F.posexplode("ends"))
              .select("file", (F.col("base") + F.col("pos")).alias("ordinal"),
                      (F.element_at("bounds", F.col("pos") + 1) + 1).alias("first"),
                      (F.col("col") - F.element_at("bounds", F.col("pos") + 1) - 1).alias("n_tokens"),
                      F.lit(True).alias("closed")))
    tails = (narrow.join(found.select("file", "start", "total"), ["file", "start"]).groupBy("file")
             .agg(F.coalesce(F.max("last"), F.lit(-1)).alias("last"), F.sum("n").cast("long").alias("ordinal"),
                  F.max("total").alias("total"))
             .where("total > last + 1")
             .select("file", "ordinal", (F.col("last") + 1).alias("first"),
                     (F.col("total") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed")))
    return closed.unionByName(tails)


def count_documents(docs: DataFrame, path: str | None = None, file_bytes: int = 1 << 30,
                    block_bytes: int = 4 << 20) -> DataFrame:
    """Write the token files of ``docs``, scan them and give doc_id, n_tokens, file, ordinal, first. Repeated rows are
    documents of their own; an empty table gives no rows."""
    spark = docs.sparkSession
    root = fresh_path(spark, "token-files")
    manifest = write(docs, root, path, file_bytes=file_bytes)
    if manifest.isEmpty():
        return manifest.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), "file", "ordinal",
                               F.lit(0).cast("long").alias("first"))
    found = scan(files(spark, root), block_bytes=block_bytes)
    return manifest.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "first")
