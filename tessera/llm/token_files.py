"""Token ids as flat binary files with 64-bit document offsets, memory-mapped when read."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import pick, ship
from .tokenizing import ByteBpeEncoder, shared

ship(__name__)

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Rows encoded and written at once.
ROWS = 1000


def _filesystem(folder: str):
    """The file system of a folder and the folder's path on it (local path, file://, hdfs://, s3:// ...)."""
    from pyarrow import fs
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text (null: empty) plus ``end_id`` and write the ids in ascending doc_id order.

    Texts are range-partitioned by (doc_id, text hash, row position), so repeated ids and copies spread
    too, and each sorted partition writes one shard: ``.ids`` (unsigned little-endian integers, the
    narrowest width that holds the vocabulary), ``.offsets`` (signed 64-bit, first id of each document
    and the end, within the shard) and ``.docs`` (64-bit doc_ids).  A shard is written under a name of
    its own per attempt; the returned manifest, a committed table in ``folder``, names the attempt that
    counts, so a lost or repeated task leaves no trace.  Null doc_ids come first (``n_null`` of them)."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"),
        F.monotonically_increasing_id().alias("at"))
    dealt = rows.repartitionByRange("doc_id", "h", "at").sortWithinPartitions("doc_id", "h", "at")
    numbered = dealt.select(F.spark_partition_id().alias("shard"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = shared(("ids", tokenizer), lambda: ByteBpeEncoder(tokenizer))
        end = np.array([end_id], enc.dtype).tobytes()
        files, path = _filesystem(folder)
        name, shard, at, nulls = uuid.uuid4().hex, None, [0], 0
        out = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            if shard is None:
                shard = b.column(0)[0].as_py()
                out = {k: files.open_output_stream(f"{path}/{name}.{k}") for k in ("ids", "docs", "offsets")}
            for lo in range(0, b.num_rows, ROWS):
                raws = enc.encode_all([t or "" for t in b.column(2).slice(lo, ROWS).to_pylist()])
                out["ids"].write(b"".join(x for raw in raws for x in (raw, end)))
                for raw in raws:
                    at.append(at[-1] + len(raw) // enc.dtype.itemsize + 1)
            nulls += b.column(1).null_count
            out["docs"].write(b.column(1).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            out["offsets"].write(np.array(at[:-1], "<i8").tobytes())
            at = at[-1:]
        if shard is not None:
            out["offsets"].write(np.array(at, "<i8").tobytes())
            for f in out.values():
                f.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([name]), pa.array([at[-1]], pa.int64()),
                 pa.array([nulls], pa.int64()), pa.array([enc.dtype.itemsize], pa.int32())],
                names=["shard", "name", "n_ids", "n_null", "width"])

    files, path = _filesystem(folder)
    files.create_dir(path, recursive=True)
    manifest = numbered.mapInArrow(run, "shard int, name string, n_ids long, n_null long, width int")
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """The manifest with ``base``: ids in all shards before, a prefix sum over its few rows (one per shard)."""
    spark = manifest.sparkSession
    rows, base, out = sorted(manifest.collect(), key=lambda r: r.shard), 0, []
    for r in rows:
        out.append((*r, base))
        base += r.n_ids
    return spark.createDataFrame(out, manifest.schema.simpleString()[len("struct<"):-1] + ",base bigint")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the memory-mapped files.

    One task per shard maps its files (a store without local paths is read into memory instead);
    start = the shard's base plus the document's offset; the checksum is over the ids as
    little-endian unsigned 32-bit integers."""
    manifest = with_bases(spark.read.parquet(f"{folder}/manifest"))
    # a count of one's own: adaptive execution would put the few manifest rows, so all files, into one task
    shards = manifest.repartitionByRange(max(1, manifest.count()), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        files, path = _filesystem(folder)

        def mapped(name: str, kind: str) -> np.ndarray:
            if isinstance(files, fs.LocalFileSystem):
                return np.memmap(f"{path}/{name}", dtype=kind, mode="r")
            with files.open_input_file(f"{path}/{name}") as f:
                return np.frombuffer(f.read(), dtype=kind)

        for b in batches:
            for r in b.to_pylist():
                ids = mapped(f"{r['name']}.ids", f"<u{r['width']}")
                docs, at = mapped(f"{r['name']}.docs", "<i8"), mapped(f"{r['name']}.offsets", "<i8")
                for lo in range(0, len(docs), 10_000):
                    hi = min(lo + 10_000, len(docs))
                    crc = [zlib.crc32(ids[at[i]:at[i + 1]].astype("<u4").tobytes()) for i in range(lo, hi)]
                    null = np.arange(lo, hi) < r["n_null"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(docs[lo:hi]), pa.int64(), mask=null), pa.array(at[lo:hi] + r["base"]),
                         pa.array(np.diff(at[lo:hi + 1])), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str = TOKENIZER, folder: str | None = None) -> DataFrame:
    """Write the files of a documents table (into the shared checkpoint folder unless one is named) and read them back.
    An empty table writes no shard and gives no rows."""
    spark = docs.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/token_files/{uuid.uuid4().hex}"
    write_token_files(docs, folder, tokenizer)
    return read_token_files(spark, folder)
