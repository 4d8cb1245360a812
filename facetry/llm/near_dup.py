"""SimHash near-dedup with the generalised pigeonhole principle.

Fingerprints: every run of `words` words is hashed by XXH64 and votes on 64 bits, once for each time it stands there.
Search: the bits are dealt into `parts` partitions, correlated bits into the same one, and each partition gets a threshold
of its own by dynamic programming over estimated candidate counts, so that the thresholds + 1 add up to radius + 1. Two
fingerprints within the radius then agree in at least one partition up to its threshold: they share a key made of that
partition with as many positions left out. Keys are shuffled, and the fingerprints under one key are compared in full.

Under a key, small groups are compared pair by pair; large ones are searched breadth first, which yields edges that
connect just what all pairs within the radius would connect, one edge for each member at most; groups of many thousands
are first cut again by the pigeonhole principle. No link is lost and no group is emitted as all its pairs. Exact copies
share a fingerprint and go through the search once.

Statistics (how often bits are set, and set together) come from all distinct fingerprints: 4,160 sums to the driver.

Defined cases: null and empty texts, and such without words, have the fingerprint of zeros, which is linked like any
other; fewer words than `words` are one term; rows with equal ids are rows of their own; null ids take part, and a
component of null ids only has a null id. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import join_spread, written
from facetry.operators.graph import connected_components

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SMALL, _LARGE = 32, 20_000


def term_hashes(text: bytes | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of words; bytes.split() cuts at [\\x20\\x09-\\x0D] just as asked."""
    w = (text or b"").translate(_LOWER).split()
    if not w:
        return np.zeros(0, np.uint64)
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    if len(w) <= words:
        return np.array([digest(b" ".join(w))], np.uint64)
    runs = zip(*(w[i:] for i in range(words)))
    return np.fromiter(map(digest, map(b" ".join, runs)), np.uint64, len(w) - words + 1)


def bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 255 * 64):
        bits = np.unpackbits(h[at : at + 255 * 64].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        if whole:
            total += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        total += bits[whole:].sum(0, dtype=np.uint8)
    return total


def voted(h: np.ndarray) -> int:
    """The fingerprint as a signed 64-bit integer; none of the hashes: zero."""
    if not len(h):
        return 0
    return int(np.packbits(2 * bit_counts(h) > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [voted(term_hashes(t, words, seed)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def bit_statistics(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and how often bits i and j are both set (the diagonal: bit i), over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((64, 64)), 0
        for b in batches:
            bits = np.unpackbits(b.column(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(np.append(both.ravel(), n).astype(np.int64))], ["k", "v"])

    got = {r.k: r.v for r in distinct.select("fp").mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v")).collect()}
    return int(got.get(4096, 0)), np.array([got.get(k, 0) for k in range(4096)], float).reshape(64, 64)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of the bits: each begins with the bit that is most correlated to the rest, and takes in what correlates most with it."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    tied = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(tied, 0)
    left, out = list(range(64)), []
    for i in range(parts):
        size = len(left) // (parts - i)
        part = [max(left, key=lambda b: (tied[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < size:
            part.append(b := max(left, key=lambda b: (tied[b, part].sum(), -b)))
            left.remove(b)
        out.append(sorted(part))
    return out


def allocate(n: int, both: np.ndarray, parts: list[list[int]], radius: int) -> list[int]:
    """Thresholds, -1 for a partition that isn't probed, with the least estimated cost of keys and candidates.

    A pair's distance in a partition is a sum of bits that differ with chance 2 p (1 - p) each.
    """
    p = np.diag(both) / max(n, 1)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in parts:
        within = np.zeros(radius + 1)
        within[0] = 1.0
        for b in part:
            q = 2 * p[b] * (1 - p[b])
            within = within * (1 - q) + np.concatenate([[0.0], within[:-1]]) * q
        within = np.cumsum(within)
        nxt: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, ts) in best.items():
            for t in range(-1, radius + 1 - used):
                more = 0.0 if t < 0 else n * comb(len(part), min(t, len(part))) + 0.25 * n * (n - 1) / 2 * within[t]
                if (k := used + t + 1) not in nxt or cost + more < nxt[k][0]:
                    nxt[k] = (cost + more, [*ts, t])
        best = nxt
    return best[radius + 1][1]


def masks(parts: list[list[int]], thresholds: list[int]) -> list[int]:
    """The bits that each kind of key keeps: a partition without some `threshold` of its positions."""
    out = []
    for part, t in zip(parts, thresholds):
        if t >= 0:
            out += [sum(1 << b for b in part if b not in gone) for gone in combinations(part, min(t, len(part)))]
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def connect(fps: np.ndarray, radius: int, free: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges between distinct fingerprints within the radius that connect what all such pairs connect.

    free: the bits in which they may differ; a large group is cut by blocks of these.
    """
    if len(fps) > _LARGE:
        if free is None:
            free = np.array([b for b in range(64) if len(np.unique((fps >> np.uint64(b)) & np.uint64(1))) > 1])
        if len(free) >= 4 * (radius + 1):
            out = []
            for block in np.array_split(free, radius + 1):
                mask = np.uint64(sum(1 << int(b) for b in block))
                order = np.argsort(fps & mask, kind="stable")
                cuts = np.flatnonzero(np.diff((fps & mask)[order])) + 1
                for group in np.split(fps[order], cuts):
                    if len(group) > 1:
                        out += connect(group, radius, np.setdiff1d(free, block))
            return out
    out, rest = [], fps
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            f = frontier.pop()
            hit = np.bitwise_count(rest ^ f) <= radius
            if hit.any():
                got = rest[hit]
                out.append((np.full(len(got), f), got))
                frontier.extend(got)
                rest = rest[~hit]
    return out


def _edges_in(keys: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges among rows sorted by key."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    small = np.repeat((sizes > 1) & (sizes <= _SMALL), sizes)
    k, f, out = keys[small], fps[small], []
    for d in range(1, _SMALL):
        same = np.flatnonzero(k[d:] == k[:-d]) if len(k) > d else []
        if not len(same):
            break
        hit = same[np.bitwise_count(f[same] ^ f[same + d]) <= radius]
        if len(hit):
            out.append((f[hit], f[hit + d]))
    for i in np.flatnonzero(sizes > _SMALL):
        out += connect(fps[starts[i] : starts[i] + sizes[i]], radius)
    return out


def _split_large(keyed: DataFrame, radius: int) -> DataFrame:
    """Keys with more than _LARGE rows are cut by the pigeonhole principle into radius + 1 keys for each row, over all 64 bits."""
    large = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > _LARGE), "large")
    many = large.count()  # at most one in _LARGE rows
    if not many:
        return keyed
    side = F.broadcast(large.select("key")) if many < 100_000 else large.select("key")
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    parts = [F.xxhash64("key", F.lit(i), F.shiftrightunsigned("fp", cuts[i]).bitwiseAND(F.lit((1 << (cuts[i + 1] - cuts[i])) - 1))) for i in range(radius + 1)]
    return keyed.join(side, "key", "left_anti").unionByName(keyed.join(side, "key").select(F.explode(F.array(*parts)).alias("key"), "fp"))


def links(distinct: DataFrame, radius: int = 3, parts: int = 2) -> DataFrame:
    """Edges (a, b) of fingerprints within the radius, as many as it takes to connect what is connected."""
    n, both = bit_statistics(distinct)
    dealt = group_bits(n, both, parts)
    kept = masks(dealt, allocate(n, both, dealt, radius))
    each = distinct.select("fp", F.posexplode(F.array(*[F.lit(_signed(m)).cast("long") for m in kept])).alias("kind", "mask"))
    keyed = each.select(F.xxhash64(F.col("fp").bitwiseAND(F.col("mask")), "kind").alias("key"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k: list[np.ndarray] = []
        held_f: list[np.ndarray] = []

        def out(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(k) > 1 and (found := _edges_in(k, f, radius)):
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(k):
                continue
            first = int(np.searchsorted(k, k[-1]))  # the last key's rows wait for the next batch
            if first or (held_k and held_k[0][0] != k[0]):
                yield from out(np.concatenate([*held_k, k[:first]]), np.concatenate([*held_f, f[:first]]))
                held_k, held_f = [], []
            held_k.append(k[first:])
            held_f.append(f[first:])
        if held_k:
            yield from out(np.concatenate(held_k), np.concatenate(held_f))

    keyed = _split_large(keyed, radius)
    count = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(count, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def components(docs: DataFrame, *, words: int = 3, radius: int = 3, parts: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id: the smallest id that links of at most `radius` differing bits reach."""
    prints = written(fingerprints(docs, words=words, id_col=id_col, text_col=text_col), "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "distinct")
    found = connected_components(links(distinct, radius, parts), "a", "b")
    placed = written(distinct.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first_id", "n", F.coalesce("component", "fp").alias("c")), "placed")
    ids = written(placed.groupBy("c").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("m")), "ids")
    named = written(join_spread(placed, ids, ["c"], placed.count(), "m").select("fp", "n", "component_id"), "named")
    return join_spread(prints, named, ["fp"], prints.count()).select("doc_id", "fp", "component_id")
