"""Token ids in seekable files: independent zstandard frames, a table of documents, a seek table at the end.

A file holds the documents of one range of ids in ascending order:

    frame, frame, ...        zstandard frames of little-endian ids, whole documents only, each with its own content checksum
    skippable frame          the table of documents as an Arrow stream: id, first token in the file, tokens, frame
    skippable frame          compressed size, size and checksum (low half of XXH64) of each frame, then their number,
                             a byte that tells of the checksums, and a mark; the public seekable format of zstandard

Any zstandard tool unpacks the ids of a whole file, as skippable frames are passed
over. A reader begins at the end, and reads and unpacks only the frames of the
documents that it wants.

Spark deals the documents by ranges of ids and sorts each range; a task writes one
file under a name of its own. The manifest names the files of the tasks that
counted, with the number of tokens before each, and is written last: what lost
tasks have left is in no manifest.
"""

from __future__ import annotations

import bisect
import io
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.dataset
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import packing, textops
from .common import prepare_python, utf8_size

#: Bytes of texts for a file, and of ids for a frame; a longer text has a frame of its own.
FILE, FRAME = 64 << 20, 128 << 10
LEVEL = 3
#: Fixed values of the public format: skippable frames (index, seek table), the mark at the end, the bit that tells of checksums.
INDEX_MAGIC, TABLE_MAGIC, END_MAGIC, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_END = struct.Struct("<IBI")


def _checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class Writer:
    """Writes the file of one range of documents into a binary stream."""

    def __init__(self, out: BinaryIO, id_type: pa.DataType, width: int):
        self.out, self.id_type, self.width = out, id_type, width
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.held, self.size = [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[pa.Array] = []
        self.tokens: list[np.ndarray] = []
        self.frame_of: list[np.ndarray] = []

    def add(self, doc_ids: pa.Array, ids: np.ndarray, at: np.ndarray) -> None:
        """Documents in ascending order; the ids of document i are ids[at[i] : at[i + 1]]."""
        sizes = np.diff(at)
        frame_of, low = np.empty(len(sizes), np.int32), 0
        for i, size in enumerate((sizes * self.width).tolist()):
            if self.size and self.size + size > FRAME:
                self._hold(ids[at[low] : at[i]])
                self._close()
                low = i
            frame_of[i] = len(self.frames)
            self.size += size
        self._hold(ids[at[low] : at[-1]])
        self.ids.append(doc_ids)
        self.tokens.append(sizes)
        self.frame_of.append(frame_of)

    def _hold(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(f"<u{self.width}").tobytes())

    def _close(self) -> None:
        raw = b"".join(self.held)
        packed = self.pack.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), _checksum(raw)))
        self.held, self.size = [], 0

    def close(self) -> pa.Table:
        """Write the rest and both tables; returns the table of documents."""
        if self.size:
            self._close()
        tokens = np.concatenate([np.zeros(0, np.int64), *self.tokens])
        index = pa.table(
            {"doc_id": pa.chunked_array(self.ids, self.id_type), "start": np.cumsum(tokens) - tokens, "tokens": tokens, "frame": np.concatenate([np.zeros(0, np.int32), *self.frame_of])},
            metadata={"width": str(self.width)},
        ).combine_chunks()
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, index.schema) as stream:
            stream.write_table(index)
        body = sink.getvalue()
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(body)) + body)
        rows = [*self.frames, (8 + len(body), 0, _checksum(b""))]
        table = b"".join(struct.pack("<III", *row) for row in rows) + _END.pack(len(rows), WITH_CHECKSUMS, END_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)
        return index


class Reader:
    """Reads documents from a seekable binary stream; only its end and the frames asked for are read."""

    def __init__(self, file: BinaryIO):
        self.file = file
        size = file.seek(0, 2)
        count, told, magic = _END.unpack(self._read(size - _END.size, _END.size))
        if magic != END_MAGIC or told != WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end")
        rows = np.frombuffer(self._read(size - _END.size - 12 * count, 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.place = np.concatenate(([0], np.cumsum(rows[:, 0])))
        self.raw, self.sums = rows[:, 1], rows[:, 2]
        index = self._read(int(self.place[-2]) + 8, int(rows[-1, 0]) - 8)
        self.index = pa.ipc.open_stream(index).read_all().combine_chunks()
        self.width = int(self.index.schema.metadata[b"width"])
        self.unpack = zstandard.ZstdDecompressor()
        self.start, self.tokens, self.frame_of = (self.index.column(k).to_numpy() for k in ("start", "tokens", "frame"))

    def _read(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def frame(self, k: int) -> np.ndarray:
        raw = self.unpack.decompress(self._read(int(self.place[k]), int(self.place[k + 1] - self.place[k])))
        if len(raw) != self.raw[k] or _checksum(raw) != self.sums[k]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def read(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
        """For each frame that one of the rows (ascending, of the table of documents) lies in: those rows, and their ids as unsigned 32-bit numbers."""
        for part in np.split(rows, np.flatnonzero(np.diff(self.frame_of[rows])) + 1) if len(rows) else []:
            k = int(self.frame_of[part[0]])
            ids, first = self.frame(k), int(self.start[np.searchsorted(self.frame_of, k)])
            yield part, [ids[a : a + n].tobytes() for a, n in zip((self.start[part] - first).tolist(), self.tokens[part].tolist(), strict=True)]


def _opened(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder)


def _write(tokenizer: str, end_id: int, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next(batches, None)
        if batch is None:
            return
        shard, words, (store, path) = TaskContext.get().partitionId(), packing.worker(tokenizer), _opened(folder)
        width = 2 if max(words.tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else 4
        name = f"ids-{shard:06d}-{uuid.uuid4().hex}.zst"
        with store.open_output_stream(f"{path}/{name}", compression=None) as out:
            writer = Writer(out, batch.schema.field("doc_id").type, width)
            while batch is not None:
                texts = textops.as_bytes(batch.column("text"))
                for low, high in textops.packets(texts):
                    ids, at = words.encode([t or b"" for t in texts[low:high]])
                    ids = np.insert(ids, at[1:], end_id)
                    writer.add(batch.column("doc_id").slice(low, high - low), ids, at + np.arange(len(at)))
                batch = next(batches, None)
            index = writer.close()
            size = out.tell()
        known, n = index.column("doc_id"), len(index)
        row = [pa.array([shard], pa.int32()), pa.array([name]), known.slice(0, 1).combine_chunks(), known.slice(n - 1).combine_chunks(), *(pa.array([x], pa.int64()) for x in (n, int(sum(map(int, index.column("tokens").to_numpy()))), size))]
        row = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in row]
        yield pa.RecordBatch.from_arrays(row, names=["shard", "name", "first_id", "last_id", "documents", "tokens", "bytes"])

    return run


def write_ids(docs: DataFrame, folder: str, *, tokenizer: str | None = None, end_id: int = 2, file_bytes: int = FILE) -> DataFrame:
    """Encode all documents of docs (doc_id, text), write them in ascending order of doc_id, and return the manifest.

    folder: a new folder that driver and executors share, in any store that Arrow
    opens (file:, s3:, gs:, hdfs:). The manifest lies in it as Parquet, a row per
    file: shard, name, first_id, last_id, documents, tokens, bytes, base (tokens
    before the file). A null or empty text is the end id alone; null ids come
    first; rows with one id are ordered by a hash of their text, and repeated rows
    are written as often as they occur. An empty table gives an empty manifest.
    Other columns are ignored. A task holds a packet of texts and the table of its
    documents; a file has one range of rows, so one id on many rows fills many
    files.
    """
    spark = docs.sparkSession
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    prepare_python(spark)
    store, path = _opened(folder)
    store.create_dir(path)
    rows = docs.select("doc_id", "text")
    size = rows.agg(F.sum(utf8_size(F.col("text")) + 16)).first()[0] or 0
    order = [F.col("doc_id"), F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_row")]
    ranges = rows.select(*order, "text").repartitionByRange(max(1, -(-size // file_bytes)), "doc_id", "_hash", "_row").sortWithinPartitions("doc_id", "_hash", "_row")
    kind = docs.schema["doc_id"].dataType.simpleString()
    files = ranges.select("doc_id", "text").mapInArrow(
        textops.released(_write(tokenizer, end_id, folder)), f"shard int, name string, first_id {kind}, last_id {kind}, documents long, tokens long, bytes long"
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def _documents(reader: Reader, base: int, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    for part, ids in reader.read(rows):
        doc_ids = reader.index.column("doc_id").take(pa.array(part)).combine_chunks()
        doc_ids = doc_ids.chunk(0) if isinstance(doc_ids, pa.ChunkedArray) else doc_ids
        yield pa.RecordBatch.from_arrays([doc_ids, pa.array(reader.start[part] + base), pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"])


def _read_all(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{path}/{row['name']}") as file:
                    reader = Reader(file)
                    yield from _documents(reader, row["base"], np.arange(len(reader.index)))

    return run


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of the files of a folder: doc_id, start (tokens of all documents before it), ids (little-endian unsigned 32-bit numbers)."""
    prepare_python(spark)
    files = manifest(spark, folder)
    kind = files.schema["first_id"].dataType.simpleString()
    files = files.select("shard", "name", "base").repartitionByRange(max(1, files.count()), "shard")
    return files.select("name", "base").mapInArrow(textops.released(_read_all(folder)), f"doc_id {kind}, start long, ids binary")


def _files_of(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _opened(folder)
        files = pa.dataset.dataset(f"{path}/manifest", filesystem=store, format="parquet", ignore_prefixes=["_", "."]).to_table(columns=["shard", "first_id", "last_id"])
        files = files.sort_by("shard").filter(pa.compute.is_valid(pa.dataset.field("last_id")))  # files of nulls alone
        shards, first, last = (files.column(k).to_pylist() for k in ("shard", "first_id", "last_id"))
        for batch in batches:
            wanted, at, found = batch.column("doc_id"), [], []
            for i, x in enumerate(wanted.to_pylist()):
                k = bisect.bisect_left(last, x)
                while k < len(last) and (first[k] is None or first[k] <= x):
                    at.append(i)
                    found.append(shards[k])
                    k += 1
            yield pa.RecordBatch.from_arrays([wanted.take(pa.array(at, pa.int32())), pa.array(found, pa.int32())], names=["doc_id", "shard"])

    return run


def _read_wanted(folder: str):
    def run(group: pa.Table) -> pa.Table:
        store, path = _opened(folder)
        with store.open_input_file(f"{path}/{group.column('name')[0].as_py()}") as file:
            reader = Reader(file)
            there = pa.compute.is_in(reader.index.column("doc_id"), value_set=group.column("doc_id").combine_chunks())
            rows = np.flatnonzero(there.to_numpy() & reader.index.column("doc_id").is_valid().to_numpy())
            schema = pa.schema([("doc_id", group.schema.field("doc_id").type), ("start", pa.int64()), ("ids", pa.binary())])
            return pa.Table.from_batches(_documents(reader, group.column("base")[0].as_py(), rows), schema)

    return run


def look_up(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The documents whose ids are in wanted (doc_id), as read_ids() gives them.

    Ids meet the files whose range they lie in; of these files only the frames
    with a wanted document are read. Null and unknown ids give no row, repeated
    ones one. A task holds the wanted documents of one file.
    """
    prepare_python(spark)
    files = manifest(spark, folder).select("shard", "name", "base")
    kind = manifest(spark, folder).schema["first_id"].dataType.simpleString()
    ids = wanted.select(F.col("doc_id").cast(kind).alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    dealt = ids.mapInArrow(textops.released(_files_of(folder)), f"doc_id {kind}, shard int").join(files, "shard")
    return dealt.groupBy("shard").applyInArrow(_read_wanted(folder), f"doc_id {kind}, start long, ids binary")


def sweep(spark: SparkSession, folder: str) -> int:
    """Delete the files that lost tasks have left, once the manifest is there; returns how many."""
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"))
    stray = there.join(manifest(spark, folder), "name", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _opened(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                store.delete_file(f"{path}/{name}")
            yield batch

    return stray.mapInArrow(run, "name string").count()
