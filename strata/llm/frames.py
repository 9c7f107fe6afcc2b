"""Token ids in seekable files: independent zstandard frames, a document index and a trailing seek table.

File layout (little-endian; the data part and the seek table follow the public zstandard seekable format, so
``zstd -d`` gives all ids of a file):

* data frames: each decompresses on its own to whole documents, unsigned 32-bit ids end to end;
* one skippable frame 0x184D2A50 with a zstandard-compressed document index: per document its id, whether the
  id is NULL, its frame and its number of tokens, in file order;
* one skippable frame 0x184D2A5E, the seek table: per frame the compressed size, the decompressed size and the low
  32 bits of the XXH64 of the decompressed bytes, then the number of frames, a descriptor byte (0x80: with
  checksums) and 0x8F92EAB1.

``write`` sorts by id over range partitions, one or more files each, and returns the manifest (one row per file).  A
file is written under a temporary name and moved into place, so a repeated task replaces its own file.
``read`` distributes the files; a reader asked for some documents fetches only their frames.

Defined results: NULL text is empty; NULL ids come first; equal ids are ordered by text hash; an empty document is its
end token alone (or nothing without an end token); an empty table gives an empty manifest; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import map_arrow, stored
from strata.llm.encode import encoder

INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1  # fixed values of the format
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_DOC = np.dtype([("doc_id", "<i8"), ("none", "u1"), ("frame", "<u4"), ("tokens", "<u8")])
MANIFEST = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("file_no", T.IntegerType()),
    T.StructField("path", T.StringType()), T.StructField("n_docs", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("bytes", T.LongType())])


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of ``path`` (any scheme Arrow knows) and the path inside it."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


# ------------------------------------------------------------------ one file
class FrameFile:
    """Writes one file; ``add`` documents in order, then ``close``."""

    def __init__(self, path: str, frame_bytes: int, level: int):
        import zstandard

        self.path, self._frame_bytes = path, frame_bytes
        self._fs, self._at = _filesystem(path)
        self._fs.create_dir(self._at.rpartition("/")[0], recursive=True)
        context = TaskContext.get()
        self._temporary = f"{self._at}.{context.taskAttemptId() if context else 0}.tmp"
        self._out = self._fs.open_output_stream(self._temporary, compression=None)
        self._zstd = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=True)
        self._open: list[bytes] = []
        self._open_bytes = 0
        self._entries: list[tuple[int, int, int]] = []
        self._docs: list[tuple[int, int, int, int]] = []
        self.tokens = self.bytes = 0

    @property
    def documents(self) -> int:
        return len(self._docs)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self._open and self._open_bytes + len(ids) > self._frame_bytes:
            self._flush()
        self._docs.append((doc_id or 0, doc_id is None, len(self._entries), len(ids) // 4))
        self._open.append(ids)
        self._open_bytes += len(ids)
        self.tokens += len(ids) // 4

    def _flush(self) -> None:
        import xxhash

        raw = b"".join(self._open)
        packed = self._zstd.compress(raw)
        self._out.write(packed)
        self._entries.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self._open, self._open_bytes = [], 0
        self.bytes += len(packed)

    def close(self) -> None:
        if self._open:
            self._flush()
        index = self._zstd.compress(np.array(self._docs, dtype=_DOC).tobytes())
        table = np.array(self._entries, dtype=_ENTRY).tobytes() + struct.pack(
            "<IBI", len(self._entries), 0x80, FOOTER_MAGIC)
        tail = struct.pack("<II", INDEX_MAGIC, len(index)) + index + struct.pack("<II", TABLE_MAGIC, len(table)) + table
        self._out.write(tail)
        self._out.close()
        self.bytes += len(tail)
        self._fs.move(self._temporary, self._at)


class FrameReader:
    """Random access to one file: the index is read once, then only the frames that are asked for."""

    def __init__(self, path: str):
        import zstandard

        self.path = path
        fs, at = _filesystem(path)
        self._in = fs.open_input_file(at)
        self._zstd = zstandard.ZstdDecompressor()
        end = self._in.size()
        frames, descriptor, magic = struct.unpack("<IBI", self._in.read_at(9, end - 9))
        if magic != FOOTER_MAGIC or descriptor != 0x80:
            raise ValueError(f"{path}: no seek table")
        table = end - 9 - frames * _ENTRY.itemsize
        self._entries = np.frombuffer(self._in.read_at(frames * _ENTRY.itemsize, table), dtype=_ENTRY)
        ends = np.cumsum(self._entries["packed"].astype(np.int64))
        self._starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if frames else ends
        data_end = int(ends[-1]) if frames else 0
        magic, size = struct.unpack("<II", self._in.read_at(8, data_end))
        if magic != INDEX_MAGIC or data_end + 16 + size != table:
            raise ValueError(f"{path}: no document index")
        self.docs = np.frombuffer(self._zstd.decompress(self._in.read_at(size, data_end + 8)), dtype=_DOC)
        before = np.cumsum(self.docs["tokens"].astype(np.int64))
        self._frame_first = np.searchsorted(self.docs["frame"], np.arange(frames))
        self.starts = before - self.docs["tokens"].astype(np.int64)

    def frame(self, number: int) -> bytes:
        import xxhash

        entry = self._entries[number]
        raw = self._zstd.decompress(self._in.read_at(int(entry["packed"]), int(self._starts[number])),
                                    max_output_size=int(entry["size"]))
        if len(raw) != entry["size"] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != entry["check"]:
            raise ValueError(f"{self.path}: frame {number} is damaged")
        return raw

    def documents(self, wanted=None):
        """``(doc_id, start in file, ids as bytes)`` in order; with ``wanted`` (a set of ids) only their frames."""
        held, raw = -1, b""
        for i, (doc_id, none, frame, tokens) in enumerate(self.docs.tolist()):
            if wanted is not None and (None if none else doc_id) not in wanted:
                continue
            if frame != held:
                held, raw = frame, self.frame(frame)
            at = 4 * int(self.starts[i] - self.starts[self._frame_first[frame]])
            yield None if none else doc_id, int(self.starts[i]), raw[at:at + 4 * tokens]


# ------------------------------------------------------------------ operator
def write(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = 1, id_col: str = "doc_id",
          text_col: str = "text", frame_bytes: int = 1 << 18, file_bytes: int = 1 << 28, level: int = 3) -> DataFrame:
    """Encodes and writes all documents below ``path`` in ascending id order; returns the stored manifest."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keys = ["doc_id", F.xxhash64("text")]  # the hash splits an id that many rows share
    ordered = (source.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
               .sortWithinPartitions(*keys))
    end = b"" if end_id is None else np.uint32(end_id).astype("<u4").tobytes()
    root = path.rstrip("/")

    def put(batches):
        enc, part, number, file = encoder(vocabulary, keep_space=False), TaskContext.get().partitionId(), 0, None

        def done():
            file.close()
            return pa.RecordBatch.from_pylist([{
                "part": part, "file_no": number, "path": file.path, "n_docs": file.documents, "n_tokens": file.tokens,
                "bytes": file.bytes}], schema=pa.schema([
                    ("part", pa.int32()), ("file_no", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                    ("n_tokens", pa.int64()), ("bytes", pa.int64())]))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                if file and file.bytes >= file_bytes:
                    yield done()
                    file, number = None, number + 1
                if not file:
                    file = FrameFile(f"{root}/ids-{part:06d}-{number:04d}.zst", frame_bytes, level)
                file.add(doc_id.as_py(), enc.encode(text.as_py()) + end)
        if file:
            yield done()

    return stored(map_arrow(ordered, put, MANIFEST), "manifest")


def read(spark: SparkSession, manifest: DataFrame, wanted: DataFrame | None = None, keep_ids: bool = True) -> DataFrame:
    """Documents of the files: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``), checked frame by frame.

    ``start`` counts the ids of all documents before it in all files.  ``wanted``, a DataFrame with ``doc_id`` that
    names a bounded set of documents, makes each task decompress only their frames.
    """
    # One row per file, so the running sum over files is small beside the data.
    before = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", "bytes", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    files = files.repartition(max(1, files.sparkSession.sparkContext.defaultParallelism * 4))
    chosen = None if wanted is None else {r[0] for r in wanted.select("doc_id").distinct().collect()}
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
              *([("ids", pa.binary())] if keep_ids else [])]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")

    def get(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                rows, size = [], 0
                for doc_id, start, ids in FrameReader(path).documents(chosen):
                    rows.append((doc_id, base + start, len(ids) // 4, zlib.crc32(ids), ids)[:len(fields)])
                    size += len(ids) * keep_ids
                    if len(rows) >= 10_000 or size >= 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(zip(*rows), fields)],
                                                         names=[f[0] for f in fields])
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(zip(*rows), fields)],
                                                     names=[f[0] for f in fields])

    return map_arrow(files.select("path", "base"), get, schema)
