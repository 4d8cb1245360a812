"""Packing by concatenating and cutting.

All documents, each followed by the end id, form one long run of ids, cut into windows of `window` ids. Two passes:
the first encodes every document and writes its ids with the partition and the document's start within it; then the
totals of the partitions (one number each) are summed up on the driver, and the second pass gives each document its
global start and cuts it at the multiples of `window`. A boundary record per piece says which document, which part of
it, which sequence and where in it. Only the last sequence can be short.

A null text counts as empty: its document is the end id alone. Repeated rows are packed as often as they stand there;
a null doc_id is kept. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.llm.bpe import MEMO, encoder, lexicon_blob
from facetry.llm.common import written


def tokenised(docs: DataFrame, blob: bytes, end_id: int, id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO) -> DataFrame:
    """The first pass: doc_id, ids (with the end id), n, the partition, and the start within it."""
    sent = docs.sparkSession.sparkContext.broadcast(blob)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(sent.value, memo), TaskContext.get().partitionId(), 0
        kind = "<u2" if len(enc.tokens) <= 1 << 16 else "<u4"
        for b in batches:
            row = 0
            for ids, ends in enc.columns(b.column(1)):
                n = np.diff(ends, prepend=0) + 1
                to = np.cumsum(n)
                data = np.insert(ids, ends, end_id).astype(kind)
                cuts = np.concatenate([[0], to]) * data.itemsize
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(row, len(n)), blobs, pa.array(n, pa.int64()), pa.array(np.full(len(n), part), pa.int64()), pa.array(at + to - n, pa.int64())], ["doc_id", "ids", "n", "part", "start_in_part"])
                row += len(n)
                at += int(to[-1])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, n long, part long, start_in_part long")


def pack(docs: DataFrame, vocabulary: str, *, window: int = 4096, end_id: int = 2, lexicon_words: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, blob: bytes | None = None, memo: int = 250_000) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]: one row per piece.

    `memo` bounds what a worker remembers of chunks seen before (about 0.5 kB an entry): more is faster, the result is the same.
    """
    blob = blob or lexicon_blob(docs, vocabulary, lexicon_words, text_col)
    first = written(tokenised(docs, blob, end_id, id_col, text_col, memo), "ids")
    totals = {r.part: r.n for r in first.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one row per partition
    base, at = {}, 0
    for part in sorted(totals):
        base[part], at = at, at + totals[part]
    sent = docs.sparkSession.sparkContext.broadcast(base)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets = sent.value
        for b in batches:
            rows: list[tuple] = []
            blobs = []
            for doc, ids, n, part, start in zip(*(c.to_pylist() for c in b.columns)):
                wide = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                begin, done = offsets[part] + start, 0
                while done < n:
                    seq, off = divmod(begin + done, window)
                    k = min(n - done, window - off)
                    piece = wide[done : done + k].tobytes()
                    rows.append((doc, done, k, zlib.crc32(piece), n, seq, off))
                    if keep_ids:
                        blobs.append(piece)
                    done += k
            if rows:
                cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(blobs, pa.binary())] if keep_ids else []), names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * keep_ids
    ddl = ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in names)
    return first.select("doc_id", "ids", "n", "part", "start_in_part").mapInArrow(cut, ddl)
