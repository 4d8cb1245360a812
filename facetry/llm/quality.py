"""Quality classifier by importance resampling.

Two generative models over hashed n-grams: one of the target text (labelled documents of good quality), one of the raw
text (all documents). Words and runs of punctuation are unigrams, neighbours are bigrams, both hashed into `buckets`; a
word that follows itself counts in a bucket of its own. A document's log ratio is the sum over its n-grams, its log weight
adds `allowance` for each n-gram and for `prior` more: text may be that much less likely in the target than in the raw
model, for the raw text is target text for the most part, and short texts are not judged on chance. Documents are drawn
without replacement in proportion to their weights, by Gumbel top-k: log weight + Gumbel noise, the k largest. Without a
given k it is the number of documents with a weight of at least 1, so mostly target-like documents are drawn, and chance
decides near the line. `sharpness` multiplies log weights (1: in proportion to the weights).

The raw model, the scores and the draw cover all documents. The target model uses at most about `fit_rows` labelled rows
(chosen by a hash of the id). Each text is cut twice, once for the models and once for its score, and the scores are
written. The k-th largest key is found by counting in ever finer intervals, not by sorting.

Defined cases: null and empty texts have log ratio 0; the noise hangs on the id, so repeated rows stay or go together
(null ids too); ties of keys at the line all stay; documents with contradicting labels are not target; without labels
every ratio is 0; an empty table gives an empty table. All columns pass through; log_ratio, log_weight, gumbel_key and
keep are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetry.llm.bpe import Memo, release, slices
from facetry.llm.common import written

_TOKENS = re.compile(r"[^\W_]+|[^\w\s]+|_+").findall
#: Bounds of a worker's memory: chunks in each generation of the memo, and characters of the longest chunk in it.
_MEMO, _KEPT = 80_000, 48
#: Bytes of text worked on at once.
_SLICE = 2 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Grams:
    """Hashed n-grams of texts, with a memo from chunks between white space to the hashes of their tokens."""

    def __init__(self, buckets: int):
        if buckets & (buckets - 1):
            raise ValueError("buckets has to be a power of two")
        self.shift, self.memo = np.uint64(64 - (buckets.bit_length() - 1)), Memo(_MEMO)

    def _hashes(self, chunks: list[str]) -> list[bytes]:
        young, old, out = self.memo.young, self.memo.old, []
        for c in chunks:
            if (h := young.get(c)) is None:
                if (h := old.get(c)) is None:
                    h = b"".join([xxhash.xxh64_digest(t, 7) for t in _TOKENS(c)])
                if len(c) <= _KEPT:
                    young[c] = h
            out.append(h)
        self.memo.turn()
        return out

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of all n-grams of some texts, and the row that each belongs to."""
        chunks = pc.utf8_split_whitespace(texts)
        rows = chunks.offsets.to_numpy().astype(np.int64)
        coded = chunks.flatten().dictionary_encode()
        which, hashes = coded.indices.to_numpy(), self._hashes(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        flat = np.frombuffer(b"".join(hashes), "<u8")
        size = np.fromiter(map(len, hashes), np.int64, len(hashes)) >> 3
        start, n = np.cumsum(size) - size, size[which]
        end = np.cumsum(n)
        h = flat[np.repeat(start[which] - end + n, n) + np.arange(end[-1] if len(end) else 0)]
        tokens = np.diff(np.concatenate([[0], end])[rows - rows[0]])
        row = np.repeat(np.arange(len(tokens)), tokens)
        same = np.flatnonzero(row[1:] == row[:-1])
        first, second = h[same], h[same + 1]
        # bucket 0 is for words that follow themselves
        two = np.where(first == second, np.uint64(0), (first * _A + second * _B) >> self.shift)
        return np.concatenate([(h * _A) >> self.shift, two]).astype(np.int64), np.concatenate([row, row[same]])


@dataclass
class Model:
    log_ratio: np.ndarray
    target_rows: int


def fit(docs: DataFrame, labels: DataFrame, *, buckets: int = 1 << 14, fit_rows: int = 50_000, smoothing: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> Model:
    labels = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    n = labels.count()
    share = min(1.0, fit_rows / max(n, 1))
    chosen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    target = frozenset(r.doc_id for r in chosen.select("doc_id").collect())  # about fit_rows ids at most
    sent = docs.sparkSession.sparkContext.broadcast(target)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        grams, good = Grams(buckets), sent.value
        raw, tgt = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            at = 0
            for texts in slices(b.column(1), _SLICE):
                g, row = grams.of(texts)
                raw += np.bincount(g, minlength=buckets)
                mine = np.array([i in good for i in b.column(0).slice(at, len(texts)).to_pylist()])
                at += len(texts)
                if mine.any():
                    tgt += np.bincount(g[mine[row]], minlength=buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets)), pa.array(raw), pa.array(tgt)], ["bucket", "raw", "target"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    got = rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # one row per bucket
    raw, tgt = np.zeros(buckets), np.zeros(buckets)
    for r in got:
        raw[r.bucket], tgt[r.bucket] = r.raw, r.target
    if not tgt.sum():
        return Model(np.zeros(buckets), 0)
    ratio = np.log((tgt + smoothing) / (tgt.sum() + smoothing * buckets)) - np.log((raw + smoothing) / (raw.sum() + smoothing * buckets))
    return Model(ratio, len(target))


def scores(docs: DataFrame, model: Model, text: Column) -> Column:
    """A struct of the log ratio of the models for the text, and the number of its n-grams."""
    sent = docs.sparkSession.sparkContext.broadcast(model.log_ratio)

    @F.arrow_udf("struct<log_ratio: double, n: long>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        ratio = sent.value
        grams = Grams(len(ratio))
        for texts in batches:
            total, count = [np.zeros(0)], [np.zeros(0, np.int64)]
            for part in slices(texts, _SLICE):
                g, row = grams.of(part)
                total.append(np.bincount(row, ratio[g], len(part)))
                count.append(np.bincount(row, minlength=len(part)))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(total)), pa.array(np.concatenate(count), pa.int64())], ["log_ratio", "n"])

    return score(text.cast("string"))


def gumbel(ident: Column, seed: int) -> Column:
    """Standard Gumbel noise that hangs on the id."""
    u = (F.pmod(F.xxhash64(ident, F.lit(seed)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, column: str, k: int, cells: int = 4096) -> float:
    """The k-th largest value, exactly: counts per cell of ever finer grids, then the few values of the last cell."""
    span = keys.agg(F.min(column).alias("a"), F.max(column).alias("b"), F.count(column).alias("n")).first()
    if k >= span.n:
        return span.a if span.n else float("-inf")
    low, high, above = span.a, span.b, 0
    for _ in range(4):
        width = (high - low) / cells
        if width <= 0 or low + width == low:
            break
        cell = F.least(F.floor((F.col(column) - low) / width), F.lit(cells - 1)).cast("int")
        inside = keys.where((F.col(column) >= low) & (F.col(column) <= high))
        counts = sorted(((r.c, r.n, r.a, r.b) for r in inside.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("a"), F.max(column).alias("b")).collect()), reverse=True)
        for _, n, a, b in counts:
            if above + n >= k:
                low, high = a, b
                break
            above += n
        if n <= 1000:
            break
    rows = keys.where((F.col(column) >= low) & (F.col(column) <= high)).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc(column)).limit(100_000)
    for r in rows.collect():
        above += r.n
        if above >= k:
            return r[0]
    return low


def draw(docs: DataFrame, labels: DataFrame, *, k: int | None = None, allowance: float = 0.2, prior: float = 20.0, sharpness: float = 1.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True, model: Model | None = None) -> DataFrame:
    """The drawn documents with all their columns (the text only if keep_text), and log_ratio, log_weight, gumbel_key, keep (true)."""
    model = model or fit(docs, labels, id_col=id_col, text_col=text_col)
    found = docs.drop("log_ratio", "log_weight", "gumbel_key", "keep").withColumn("_score", scores(docs, model, F.col(text_col)))
    # without a target model no document is told from another, and all have the weight 1
    weight = F.col("_score.log_ratio") + allowance * (F.col("_score.n") + prior) if model.target_rows else F.lit(0.0)
    found = found.withColumns({"log_ratio": F.col("_score.log_ratio"), "log_weight": weight}).drop("_score", *([] if keep_text else [text_col]))
    scored = written(found.withColumn("gumbel_key", F.lit(sharpness) * F.col("log_weight") + gumbel(F.col(id_col), seed)), "scored")
    wanted = k if k is not None else scored.where("log_weight >= 0").count()
    if wanted <= 0:
        return scored.where("false").withColumn("keep", F.lit(True))
    return scored.where(F.col("gumbel_key") >= kth_largest(scored, "gumbel_key", wanted)).withColumn("keep", F.lit(True))
