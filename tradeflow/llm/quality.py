"""Quality rules: repetition and length, then a log-likelihood ratio of hashed n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm import text_arrays as ta
from tradeflow.llm.storage import free_name

LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: Buckets of hashed grams follow the bytes of text, which bound the number of different grams, between these powers of two.
FEWEST_BITS, MOST_BITS = 14, 24
BYTES_PER_BUCKET = 4
SLICE = 1 << 14
#: Text that a worker looks at together, and buckets that it lets wait before it sums them; they bound what it holds.
BLOCK_BYTES = 1 << 19
MERGED = 1 << 19
#: A gram counts as found this often among trusted documents and as often expected there, besides what was counted.
PRIOR = 32.0
LEAST_RATIO = -0.05
#: Ids of trusted documents are broadcast up to this number; beyond it the marks are joined by a shuffle.
BROADCAST_IDS = 2_000_000

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double"


class GramModel(NamedTuple):
    """Counts per bucket of hashed words and word pairs, in all documents and in the trusted ones, and their sums.

    Counts are held as logarithms in steps of 1/2048 of an octave, two bytes each: a count is right to 0.02 %.
    """

    corpus: np.ndarray
    trusted: np.ndarray
    corpus_grams: float
    trusted_grams: float

    @property
    def bits(self) -> int:
        return len(self.corpus).bit_length() - 1


STEPS = 2048.0


def as_logs(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(np.log2(counts + 1.0) * STEPS), 65535).astype(np.uint16)


def as_counts(logs: np.ndarray) -> np.ndarray:
    return np.exp2(logs / STEPS) - 1.0


class PackedModel(NamedTuple):
    """A ``GramModel`` as compressed slices, as the driver holds it and tasks receive it."""

    bits: int
    slices: list[tuple[int, bytes]]
    corpus_grams: float
    trusted_grams: float

    def unpacked(self) -> GramModel:
        logs = np.zeros((2, 1 << self.bits), np.uint16)
        for k, packed in self.slices:
            part = pa.decompress(packed, 4 * SLICE, "zstd")
            logs[:, k * SLICE : (k + 1) * SLICE] = np.frombuffer(part, np.uint16).reshape(2, -1)
        return GramModel(logs[0], logs[1], self.corpus_grams, self.trusted_grams)


class BucketCounts:
    """Sums per bucket of what a task has met: the buckets in order, and their counts in all and in trusted documents."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = []
        self.waiting = 0

    def add(self, bucket: np.ndarray, known: np.ndarray) -> None:
        self.parts.append(_summed(np.stack([bucket, np.ones_like(bucket), known]).astype(np.uint32)))
        self.waiting += self.parts[-1].shape[1]
        if len(self.parts) > 1 and self.waiting > max(MERGED, 2 * self.parts[0].shape[1]):
            self.merge()

    def merge(self) -> np.ndarray:
        if len(self.parts) != 1:
            self.parts = [_summed(np.concatenate(self.parts, axis=1))] if self.parts else [np.zeros((3, 0), np.uint32)]
        self.waiting = self.parts[0].shape[1]
        return self.parts[0]


def _summed(rows: np.ndarray) -> np.ndarray:
    """(bucket, count, count) columns summed per bucket, in order of bucket."""
    if not rows.shape[1]:
        return rows
    rows = rows[:, np.argsort(rows[0], kind="stable")]
    first = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
    return np.concatenate([rows[:1, first], np.add.reduceat(rows[1:], first, axis=1, dtype=rows.dtype)])


def with_trust(docs: DataFrame, labels: DataFrame, output: str) -> DataFrame:
    """``docs`` with a boolean: the document is labelled good."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("_good")).distinct()
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    marked = docs.join(good, docs["doc_id"].cast("long") == F.col("_good"), "left")
    return marked.select(*[docs[c] for c in docs.columns], F.col("_good").isNotNull().alias(output))


def bucket_bits(docs: DataFrame) -> int:
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return min(max(ceil(log2(max(size / BYTES_PER_BUCKET, 1))), FEWEST_BITS), MOST_BITS)


def gram_model(docs: DataFrame, labels: DataFrame, bits: int | None = None) -> PackedModel:
    """Counts of every word and word pair of all documents, and of all documents labelled good.

    Each task sends the buckets it has met, in compressed slices, so what moves grows with the different grams
    and not with the buckets; what reaches the driver is their sums, at most 4 bytes a bucket.
    """
    bits = bucket_bits(docs) if bits is None else bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = BucketCounts()
        for batch in batches:
            column, known = ta.as_large(batch.column(0)), np.asarray(batch.column(1))
            for start, end in ta.blocks(column, BLOCK_BYTES):
                row, bucket = _buckets(ta.Words(column.slice(start, end - start)), bits)
                counts.add(bucket, known[start:end][row])
        found = counts.merge()
        cuts = np.searchsorted(found[0], np.arange(0, (1 << bits) + 1, SLICE))
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            part = found[:, cuts[k] : cuts[k + 1]]
            # Neighbouring buckets differ by little, which compresses well.
            raw = np.concatenate([np.diff(part[0], prepend=np.uint32(k * SLICE)), part[1], part[2]])
            packed = pa.compress(raw.tobytes(), "zstd", asbytes=True)
            columns = [pa.array([k], pa.int32()), pa.array([part.shape[1]], pa.int32()), pa.array([packed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["slice", "buckets", "counts"])
        del counts, found
        ta.give_back()

    def add(slices: pa.Table) -> pa.Table:
        total = np.zeros((2, SLICE))
        for number, packed in zip(slices["buckets"].to_pylist(), slices["counts"]):
            steps, every, known = np.frombuffer(pa.decompress(packed.as_py(), 12 * number, "zstd"), np.uint32).reshape(3, -1)
            at = np.cumsum(steps)
            total[0, at] += every
            total[1, at] += known
        packed, grams = pa.compress(as_logs(total).tobytes(), "zstd", asbytes=True), total.sum(axis=1)
        return pa.table({"slice": slices["slice"][:1], "counts": pa.array([packed], pa.binary()), "corpus": grams[:1], "trusted": grams[1:]})

    marked = with_trust(docs.select("doc_id", "text"), labels, "trusted").select("text", "trusted")
    parts = marked.mapInArrow(count, "slice int, buckets int, counts binary").groupBy("slice")
    added = parts.applyInArrow(add, "slice int, counts binary, corpus double, trusted double").collect()
    return PackedModel(bits, [(r[0], bytes(r[1])) for r in added], sum(r[2] for r in added), sum(r[3] for r in added))


def _buckets(words: ta.Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every word and every pair of neighbouring words."""
    row, pair = words.grams(2)
    every = np.concatenate([words.hash, pair])
    return np.concatenate([words.row_of_word(), row]), (every >> np.uint64(64 - bits)).astype(np.int64)


def ratios(words: ta.Words, trusted: np.ndarray, model: GramModel) -> np.ndarray:
    """Mean log-ratio of each row's grams: found in trusted documents over expected there, both plus ``PRIOR``.

    Expected is the bucket's share of the corpus times all grams of trusted documents. A row's own counts are
    left out of the corpus and, where it is trusted, of the trusted documents. Buckets of which little is
    expected, and so all of them with few labels, have ratios near 0.
    """
    row, bucket, times = ta.counted(*_buckets(words, model.bits))
    grams = np.bincount(row, times, minlength=words.rows)
    found = np.maximum(as_counts(model.trusted[bucket]) - times * trusted[row], 0.0)
    all_found = np.maximum(model.trusted_grams - grams * trusted, 0.0)
    rest = np.maximum(model.corpus_grams - grams, 1.0)
    expected = np.maximum(as_counts(model.corpus[bucket]) - times, 0.0) * (all_found / rest)[row]
    ratio = np.log((found + PRIOR) / (expected + PRIOR))
    return np.bincount(row, times * ratio, minlength=words.rows) / np.maximum(grams, 1)


def measure(column: pa.Array, trusted: np.ndarray, model: GramModel) -> pa.StructArray:
    """The measures of each text; see ``judge_quality``."""
    parts = []
    for start, end in ta.blocks(column, BLOCK_BYTES):
        words = ta.Words(column.slice(start, end - start))
        sums = lambda inside: np.diff(np.concatenate([[0], np.cumsum(inside)])[words.offsets])
        letters = ((words.data & 0xC0) != 0x80) & ~ta.is_space(words.data)
        parts.append(
            [
                words.count,
                sums(letters),
                sums(np.isin(words.data, np.frombuffer(SYMBOLS, np.uint8))),
                _repeated_lines(words),
                _repeated_words(words),
                ratios(words, trusted[start:end], model),
            ]
        )
    names = [field.split()[0] for field in MEASURES.split(", ")]
    joined = [np.concatenate(p) for p in zip(*parts)] if parts else [np.zeros(0)] * len(names)
    kinds = [pa.int64()] * (len(names) - 1) + [pa.float64()]
    return pa.StructArray.from_arrays([pa.array(x.astype(k.to_pandas_dtype()), k) for x, k in zip(joined, kinds)], names)


def _repeated_lines(words: ta.Words) -> np.ndarray:
    starts, ends = ta.runs(words.data != 10, words.offsets)
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[has_word], ends[has_word]
    row = np.searchsorted(words.offsets, starts, side="right") - 1
    distinct, _, _ = ta.counted(row, ta.span_hashes(words.data, starts, ends))
    return np.bincount(row, minlength=words.rows) - np.bincount(distinct, minlength=words.rows)


def _repeated_words(words: ta.Words) -> np.ndarray:
    """Words that lie in a window of ``WINDOW`` words found at least twice in their text."""
    starts, value = words.windows(WINDOW)
    row = words.row_of_word()
    order = np.lexsort((value, row[starts]))
    by_value, by_row = value[order], row[starts][order]
    same = (by_value[1:] == by_value[:-1]) & (by_row[1:] == by_row[:-1])
    repeated = np.zeros(len(starts), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    edge = np.zeros(len(words.hash) + 1, np.int64)
    edge[starts[repeated]] += 1
    np.subtract.at(edge, starts[repeated] + WINDOW, 1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(row[covered], minlength=words.rows)


def with_quality(docs: DataFrame, labels: DataFrame, model: PackedModel, least_ratio: float = LEAST_RATIO, output: str = "_quality") -> DataFrame:
    """``docs`` with a struct of the measures, ``base_failed`` and ``kept``. Texts stay where they are."""

    @F.arrow_udf(MEASURES)
    def measures(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        counts = model.unpacked()
        for text, trusted in batches:
            yield measure(ta.as_large(text), np.asarray(trusted), counts)
        del counts
        ta.give_back()

    trusted = free_name(docs, "_trusted")
    q = F.col(output)
    failed = (q["n_words"] < LEAST_WORDS) | (100 * q["n_repeat_words"] > MOST_REPEATED_PERCENT * q["n_words"])
    return (
        with_trust(docs, labels, trusted)
        .withColumn(output, measures("text", trusted))
        .drop(trusted)
        .withColumn(output, q.withField("base_failed", failed))
        .withColumn(output, q.withField("kept", ~q["base_failed"] & (q["ratio"] >= least_ratio)))
    )


def judge_quality(docs: DataFrame, labels: DataFrame, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """doc_id, the measures, base_failed and kept for every row of ``docs``.

    A document fails the base rules with fewer than 20 words, or when more than 30 % of its words lie in
    8-word windows that occur twice. The others are kept when the mean log-likelihood ratio of their
    words and word pairs, between documents labelled good and all documents, is at least ``least_ratio``;
    see ``ratios``. All labelled documents count.

    A null or empty text has no words, so it fails. Equal rows get equal verdicts, and each counts in the
    corpus model. An empty table gives no rows. Without labels only the base rules decide. Texts of any
    length are measured whole, in blocks of rows of bounded bytes.
    """
    judged = with_quality(docs.select("doc_id", "text"), labels, gram_model(docs, labels), least_ratio)
    names = [field.split()[0] for field in MEASURES.split(", ")] + ["base_failed", "kept"]
    return judged.select("doc_id", *[F.col("_quality")[n].alias(n) for n in names])
