"""Token ids of documents in binary files of patched blocks, written and read by Spark tasks.

A file holds consecutive documents in order of doc_id: magic, blocks, an index of where each block
starts, the documents' ids and lengths, and a footer. Every number is little-endian:

    magic (8 bytes) | blocks | block starts (u64 each, and the end of the last) |
    doc_id (i64 each) | doc_id is null (u8 each) | lengths (u64 each) |
    footer: ids, documents, place of the block starts, place of the documents (u64 each), magic
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeflow.llm import patched_blocks as pb
from tradeflow.llm import text_arrays as ta
from tradeflow.llm.storage import Store
from tradeflow.llm.tokens import tokenizer_path
from tradeflow.llm.word_tokens import WORD_TOKENIZER, word_encoder

END_ID = 1
MAGIC = b"PFORIDS1"
FOOTER = struct.Struct("<QQQQ8s")
#: Text that goes into one file, about; and ids that a task encodes or decodes at a time.
FILE_BYTES = 64 << 20
LEAST_FILES = 12
STEP = 1 << 18
ROWS_A_BATCH = 4096

MANIFEST = "part int, path string, ids long, documents long"


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The store that a path names: a local path, or a URI that Arrow can open (file, hdfs, s3, gs)."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class IdFileWriter:
    """Writes one file: ids in any number of pieces, a document ends where ``end_document`` says."""

    def __init__(self, path: str):
        store, place = _filesystem(path)
        store.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(place)
        self.out.write(MAGIC)
        self.at, self.starts = len(MAGIC), [len(MAGIC)]
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        """Whole documents, one after the other."""
        self.doc_ids += doc_ids
        self.lengths += lengths.tolist()
        self.waiting.append(ids)
        self.held += len(ids)
        self.ids += len(ids)
        if self.held >= STEP:
            self._write(self.held - self.held % pb.BLOCK)

    def _write(self, number: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for first in range(0, number, STEP):
            for block in pb.encode(ids[first : min(first + STEP, number)]):
                self.out.write(block)
                self.at += len(block)
                self.starts.append(self.at)
        self.waiting, self.held = [ids[number:]], len(ids) - number

    def close(self) -> None:
        self._write(self.held)
        documents = self.at + 8 * len(self.starts)
        null = [i is None for i in self.doc_ids]
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array([i or 0 for i in self.doc_ids], "<i8").tobytes() + np.array(null, np.uint8).tobytes())
        self.out.write(np.array(self.lengths, "<u8").tobytes())
        self.out.write(FOOTER.pack(self.ids, len(self.doc_ids), self.at, documents, MAGIC))
        self.out.close()


class IdFile:
    """Reads any run of ids of a file through its index; nothing but the index and the documents is held."""

    def __init__(self, path: str):
        store, place = _filesystem(path)
        self.file = store.open_input_file(place)
        size = self.file.size()
        self.ids, documents, index, place, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        self.starts = np.frombuffer(self._read(index, place - index), "<u8").astype(np.int64)
        raw = self._read(place, 17 * documents)
        null = np.frombuffer(raw, np.uint8, documents, 8 * documents).astype(bool)
        self.doc_ids = pa.array(np.frombuffer(raw, "<i8", documents), mask=null)
        self.lengths = np.frombuffer(raw, "<u8", documents, 9 * documents).astype(np.int64)

    def _read(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start)

    def between(self, first: int, last: int) -> np.ndarray:
        """Ids from ``first`` up to ``last``; reads only the blocks that hold them."""
        if last <= first:
            return np.zeros(0, np.uint32)
        a, b = first // pb.BLOCK, -(-last // pb.BLOCK)
        raw = self._read(int(self.starts[a]), int(self.starts[b] - self.starts[a]))
        cuts = (self.starts[a : b + 1] - self.starts[a]).tolist()
        ids = pb.decode([raw[p:q] for p, q in zip(cuts, cuts[1:])])
        return ids[first - a * pb.BLOCK : last - a * pb.BLOCK]


def write_ids(docs: DataFrame, store: Store, tokenizer: str | None = None, end_id: int = END_ID, name: str = "token-ids") -> DataFrame:
    """Write the ids of all ``docs`` (doc_id, text) in order of doc_id; returns the manifest (part, path, ids, documents, start).

    Documents are dealt into files by ranges of doc_id (null first); rows with equal doc_id are ordered by a
    hash of their text, and rows equal in both may stand in several files. A file's name is new for every
    attempt of a task, and only those of attempts that Spark accepted are in the manifest, so a lost executor
    or a second attempt leaves at most a file that nobody reads. ``start`` counts the ids of all earlier files.
    """
    path = tokenizer or tokenizer_path(WORD_TOKENIZER)
    base = f"{store.base}/{name}-files"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place, writer = TaskContext.get().partitionId(), "", None
        for batch in batches:
            doc_ids, column = batch.column(0).to_pylist(), ta.as_large(batch.column(1))
            done = 0
            for ids, offsets in word_encoder(path).row_ids(column):
                rows = len(offsets) - 1
                if writer is None:
                    place = f"{base}/{part:06d}-{uuid.uuid4().hex}.ids"
                    writer = IdFileWriter(place)
                lengths = np.diff(offsets) + 1
                ended = np.insert(ids, offsets[1:], np.uint32(end_id))
                writer.add(doc_ids[done : done + rows], lengths, ended)
                done += rows
        ta.give_back()
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [place], "ids": [writer.ids], "documents": [len(writer.lengths)]})

    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    files = max(LEAST_FILES, -(-size // FILE_BYTES))
    order = [F.col("doc_id"), F.xxhash64("text")]
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = keyed.repartitionByRange(files, *order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    written = store.keep(dealt.mapInArrow(write, MANIFEST), name)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))


class Document(NamedTuple):
    """A document of a file: its place there, and its ids in pieces of bounded length."""

    row: int
    first: int
    pieces: Iterator[np.ndarray]


def documents_of(file: IdFile) -> Iterator[Document]:
    """The documents of a file, decoded ``STEP`` ids at a time; a longer document comes in several pieces."""
    ends = np.cumsum(file.lengths)
    row = 0
    while row < len(ends):
        first = int(ends[row] - file.lengths[row])
        until = max(int(np.searchsorted(ends, first + STEP, side="right")), row + 1)
        if until == row + 1:
            yield Document(row, first, (file.between(a, min(a + STEP, int(ends[row]))) for a in range(first, int(ends[row]), STEP)))
        else:
            ids = file.between(first, int(ends[until - 1]))
            for k in range(row, until):
                a = int(ends[k] - file.lengths[k])
                yield Document(k, a, iter((ids[a - first : int(ends[k]) - first],)))
        row = until


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            file = IdFile(path)
            first, checks = np.zeros(len(file.lengths), np.int64), np.zeros(len(file.lengths), np.int64)
            for document in documents_of(file):
                check = 0
                for ids in document.pieces:
                    check = zlib.crc32(ids.astype("<u4", copy=False).tobytes(), check)
                first[document.row], checks[document.row] = start + document.first, check
            yield pa.RecordBatch.from_arrays([file.doc_ids, pa.array(first), pa.array(file.lengths), pa.array(checks)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            file = IdFile(path)
            for document in documents_of(file):
                ids = np.concatenate(list(document.pieces))
                yield pa.RecordBatch.from_arrays([file.doc_ids[document.row : document.row + 1], pa.array([ids.tolist()], pa.list_(pa.int64()))], ["doc_id", "ids"])


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id and ids (with the end id) of every document of the files."""
    return manifest.mapInArrow(_ids, "doc_id long, ids array<long>")


def read_report(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone. One task reads one file."""
    spread = manifest.select("path", "start").repartition(max(manifest.count(), 1))
    return spread.mapInArrow(_report, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, store: Store, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row of ``docs``, read back from the files that it writes.

    A null or empty text has only the end id. Null doc_ids come first. Rows with equal doc_id keep a row
    each, in order of a hash of their texts; of rows equal in both, which one starts where does not matter,
    as their ids are equal. An empty table gives no files and no rows. Texts of any length are encoded whole;
    ids are written and read in steps of bounded length. Other columns are not read.
    """
    return read_report(write_ids(docs, store, tokenizer))
