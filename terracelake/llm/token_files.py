"""Token ids in files of compressed planes.

A file holds the ids of consecutive documents. Ids are cut into blocks of a fixed number;
a block of n ids of w bytes is turned into w byte planes (the first bytes of all ids, then
the second ones, ...) or 8w bit planes, and each plane is compressed by itself: high bytes
of ids are alike and shrink well, low ones don't and are kept apart from them.

    file   = magic, blocks, index, tail
    block  = its planes one after another, each a zstandard frame
    index  = one zstandard frame: for each block its place, number of ids and length of each
             plane; for each document its id, whether it has one, and its number of ids
    tail   = length of index, crc32 of index, number of blocks, number of documents, ids in a
             block, bytes of an id, planes of a block, magic

All numbers are little-endian. A block can be read without the others.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terracelake.llm.common import prepare, store, text_of
from terracelake.llm.tokens import ByteIds, encoder
from terracelake.session import scratch_path

MAGIC = b"IDPLANE1"
TAIL = struct.Struct("<QIQQIII8s")
MANIFEST = "part int, file string, n_docs long, n_ids long, n_bytes long"
BATCH = 1 << 20  # ids handed over at a time


def to_planes(ids: np.ndarray, width: int, bits: bool) -> list[bytes]:
    if len(ids) and int(ids.max()) >> 8 * width:
        raise ValueError(f"id {int(ids.max())} does not fit in {width} bytes")
    octets = ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    if not bits:
        return [np.ascontiguousarray(octets[:, i]).tobytes() for i in range(width)]
    every = np.unpackbits(octets, axis=1, bitorder="little").T
    return [np.packbits(plane, bitorder="little").tobytes() for plane in every]


def from_planes(planes: list[bytes], n: int, width: int) -> np.ndarray:
    if len(planes) == width:
        octets = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        every = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        octets = np.packbits(every, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view(f"<u{width}").reshape(-1).astype("<u4")


class Writer:
    def __init__(self, stream, block: int, width: int, bits: bool, level: int):
        self.stream, self.block, self.width, self.bits = stream, block, width, bits
        self.press = zstandard.ZstdCompressor(level=level)
        self.waiting: list[bytes] = []
        self.n_waiting = 0
        self.docs: list[tuple[int | None, int]] = []
        self.blocks: list[list[int]] = []
        self.place = stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian unsigned 32-bit integers."""
        self.docs.append((doc_id, len(ids) // 4))
        self.waiting.append(ids)
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= self.block:
            self._flush(self.n_waiting - self.n_waiting % self.block)

    def _flush(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        for at in range(0, n, self.block):
            own = ids[at:at + self.block][: n - at]
            frames = [self.press.compress(p) for p in to_planes(own, self.width, self.bits)]
            self.blocks.append([self.place, len(own), *map(len, frames)])
            for frame in frames:
                self.place += self.stream.write(frame)
        self.waiting, self.n_waiting = [ids[n:].tobytes()], len(ids) - n

    def close(self) -> int:
        """Writes what waits, the index and the tail. Gives the file's bytes."""
        if self.n_waiting:
            self._flush(self.n_waiting)
        planes = self.width * (8 if self.bits else 1)
        index = self.press.compress(
            np.array(self.blocks, "<u8").tobytes()
            + np.array([d or 0 for d, _ in self.docs], "<i8").tobytes()
            + np.array([d is not None for d, _ in self.docs], np.uint8).tobytes()
            + np.array([n for _, n in self.docs], "<u8").tobytes())
        self.stream.write(index)
        tail = TAIL.pack(len(index), zlib.crc32(index), len(self.blocks), len(self.docs), self.block,
                         self.width, planes, MAGIC)
        self.stream.write(tail)
        return self.place + len(index) + len(tail)


class Reader:
    """Reads the index of an open file; blocks are read as they are asked for."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        stream.seek(size - TAIL.size)
        length, crc, n_blocks, n_docs, _, self.width, planes, magic = TAIL.unpack(stream.read(TAIL.size))
        stream.seek(size - TAIL.size - length)
        index = stream.read(length)
        if magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError("not a file of id planes, or its index is damaged")
        index = zstandard.ZstdDecompressor().decompress(index)
        at = 8 * n_blocks * (2 + planes)
        self.blocks = np.frombuffer(index[:at], "<u8").reshape(n_blocks, 2 + planes)
        ids = np.frombuffer(index[at:at + 8 * n_docs], "<i8").tolist()
        known = index[at + 8 * n_docs:at + 9 * n_docs]
        self.doc_ids = [d if k else None for d, k in zip(ids, known)]
        self.lengths = np.frombuffer(index[at + 9 * n_docs:], "<u8").astype(np.int64)

    def read(self, block: int) -> np.ndarray:
        place, n, *sizes = self.blocks[block].tolist()
        self.stream.seek(place)
        unpress = zstandard.ZstdDecompressor()
        return from_planes([unpress.decompress(self.stream.read(s)) for s in sizes], n, self.width)

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, ids before it in the file, its ids as little-endian unsigned 32-bit integers)."""
        have, block, start = b"", 0, 0
        for doc_id, n in zip(self.doc_ids, self.lengths.tolist()):
            parts, size = [have], len(have)
            while size < 4 * n:
                parts.append(self.read(block).tobytes())
                size += len(parts[-1])
                block += 1
            have = b"".join(parts)
            yield doc_id, start, have[:4 * n]
            have, start = have[4 * n:], start + n


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        folder = "file://" + os.path.abspath(folder)
    return pyarrow.fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/")
                                          and not folder.startswith("file://") else folder)


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 0, block: int = 1 << 16,
                      width: int = 2, bits: bool = False, level: int = 3) -> DataFrame:
    """Writes the ids of all texts, each followed by ``end_id``, in ascending order of doc_id.

    ``folder`` is one that Arrow can open on every executor, such as file:, hdfs: or s3:.
    Documents are dealt into ranges of doc_id, one file each. Gives the manifest, stored
    when all files are written: part, file, n_docs, n_ids, n_bytes. A task that is run again
    writes a file of another name, and only files of the manifest count.

    An id that does not fit in ``width`` bytes is an error.

    A null text is empty. Rows without doc_id come first; rows with the same doc_id, equal
    ones too, follow one another. An empty table gives no files. Other columns are not read.
    """
    prepare(docs.sparkSession)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(ByteIds, path), np.array([end_id], "<u4").tobytes()
        part, writer = TaskContext.get().partitionId(), None
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if writer is None:
                    fs, base = _open(folder)
                    fs.create_dir(base)
                    name = f"{part:06d}-{uuid.uuid4().hex}.planes"
                    stream = fs.open_output_stream(f"{base}/{name}")
                    writer = Writer(stream, block, width, bits, level)
                writer.add(doc_id, ids_of(text) + end)
        if writer is not None:
            size = writer.close()
            stream.close()
            counts = [len(writer.docs), sum(n for _, n in writer.docs), size]
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([name]),
                                   *(pa.array([c], pa.int64()) for c in counts)],
                                  ["part", "file", "n_docs", "n_ids", "n_bytes"])

    # The row's number divides rows of one doc_id, however many, between ranges.
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                          F.monotonically_increasing_id().alias("tie"))
    return store(ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
                 .mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (packed) from the files of a manifest."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            columns = zip(*rows)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.binary()))],
                                   ["doc_id", "start", "ids"])
        for files in batches:
            for name, before in zip(files.column("file").to_pylist(), files.column("before").to_pylist()):
                with fs.open_input_file(f"{base}/{name}") as stream:
                    for doc_id, start, ids in Reader(stream).documents():
                        rows.append((doc_id, before + start, ids))
                        size += len(ids) // 4
                        if size >= BATCH:
                            yield batch()
                            rows, size = [], 0
        if rows:
            yield batch()

    running = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(running), F.lit(0)).alias("before"))
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks).mapInArrow(read, "doc_id long, start long, ids binary")


def new_folder(spark: SparkSession) -> str:
    """A folder in the shared one that nothing has used before."""
    return scratch_path(spark, "token_files")
