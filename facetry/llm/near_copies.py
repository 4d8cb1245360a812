"""The SimHash near-dedup operator for looser similarity: one document of each group of near copies stays.

Fingerprints of 64 bits that differ in three at most are found by near_dup's own search, the generalised pigeonhole
principle. At 0.8 Jaccard similarity over runs of five words, though, 15 % of the bits of two fingerprints differ. No cut
of 64 bits finds that by the pigeonhole principle without comparing a share of all pairs, so a document also has one wide
fingerprint, whose first 64 bits are the other, and fingerprints of segments of its terms, by which more candidates meet. A segment is the terms
whose hash falls into one of 2 ** k classes, with k from the document's length, so a segment has a few terms, whatever
the length; copies of other lengths meet because each document is cut for two neighbouring k. Of each cut
`segments` classes are taken, the same ones in every document; a short document, which has fewer, is cut by several
hashes. Documents with a segment in common are candidates if their wide fingerprints lie within a radius that has four
deviations to spare; as in near_dup, large groups are searched breadth first and are not emitted as all their pairs. A group
of more than `group_rows` documents is dealt by a hash into blocks of about half as many, and each two blocks meet in a
group of their own: a task holds two blocks at most, and no pair is lost.

Fingerprints decide nothing: within each component of candidates, the term sets are compared, and only pairs of at least
the asked Jaccard similarity are edges. A component of more than `group_terms` terms is dealt into blocks likewise. Copies
are what such edges connect, so the ends of a chain of copies may be less alike than that.

A pair at similarity 0.8 has a segment in common with a chance of over 0.99; the tests measure it.

Defined cases: null and empty texts are copies of each other; fewer words than `words` are one term; documents without
an id stay; of equal rows with an id one stays; rows with one id and different texts are documents of their own. Among
copies with the smallest id one with the smallest hash stays. All columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.llm.common import join_spread, text_or_empty, written
from facetry.llm.near_dup import bit_counts, links, term_hashes
from facetry.operators.graph import connected_components

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def wide_print(terms: np.ndarray, lanes: int) -> bytes:
    """lanes * 64 signed votes over distinct terms."""
    out = []
    for lane in range(lanes):
        h = terms if not lane else _mixed(terms + np.uint64(lane * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        out.append(np.packbits(2 * bit_counts(h) > len(h), bitorder="little").tobytes())
    return b"".join(out)


def segment_keys(terms: np.ndarray, segments: int, mean: int = 4, least: int = 3) -> list[int]:
    """Keys of the segments of distinct terms; a segment of fewer than `least` terms is too common, but for short texts."""
    n = len(terms)
    if not n:
        return []
    k = max(0, (n // mean).bit_length() - 1)
    out = []
    for level in (k, k + 1):
        wide = 1 << level
        cuts = -(-segments // wide) if level else 1
        spread = _mixed(terms + (np.arange(cuts, dtype=np.uint64) * _STEP)[:, None])
        cls = (spread & np.uint64(wide - 1)).astype(np.int64) + np.arange(cuts)[:, None] * wide
        mine = cls < segments
        cls, kept = cls[mine], spread[mine]
        size = np.bincount(cls, minlength=min(segments, cuts * wide))
        total = np.zeros(len(size), np.uint64)
        np.add.at(total, cls, _mixed(kept ^ _MIX))
        full = np.flatnonzero(size >= (least if n >= 4 * least else 1))
        out += _mixed(total[full] + (full.astype(np.uint64) << np.uint64(8)) + np.uint64(level)).view(np.int64).tolist()
    return out


def text_hash(text_col: str):
    return F.xxhash64(text_or_empty(text_col))


def sketches(docs: DataFrame, *, words: int = 5, lanes: int = 8, segments: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, th (a hash of the text), print (lanes * 8 bytes), keys, fp (the print's first 64 bits) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints, keys = [], []
            for t in (t for at in range(0, b.num_rows, 256) for t in b.column(2).slice(at, 256).to_pylist()):
                terms = np.unique(term_hashes(t, words))
                prints.append(wide_print(terms, lanes))
                keys.append(segment_keys(terms, segments))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array([int.from_bytes(p[:8], "little", signed=True) for p in prints], pa.int64())], ["doc_id", "th", "print", "keys", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(text_col).alias("th"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, th long, print binary, keys array<long>, fp long")


def connect_wide(ids: np.ndarray, prints: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of a breadth-first search over rows within the radius; prints: rows of 64-bit words."""
    out, left, rows = [], ids, prints
    while len(left) > 1:
        frontier = [(left[0], rows[0])]
        left, rows = left[1:], rows[1:]
        while frontier and len(left):
            i, f = frontier.pop()
            hit = np.bitwise_count(rows ^ f).sum(1) <= radius
            if hit.any():
                out.append((np.full(int(hit.sum()), i), left[hit]))
                frontier += zip(left[hit], rows[hit])
                left, rows = left[~hit], rows[~hit]
    return out


def block_groups(meets: DataFrame, group_rows: int) -> DataFrame:
    """Rows (key, n, ...) with n rows a key, once for each group they belong to, as `key`: the key itself, or two blocks of a large one."""
    blocks = F.when(F.col("n") > group_rows, F.ceil(F.col("n") * 2 / group_rows)).otherwise(1).cast("int")
    rows = meets.withColumn("_blocks", blocks).withColumn("_mine", F.pmod(F.xxhash64("node", F.lit(5)), F.col("_blocks")).cast("int"))
    mates = F.when(F.col("_blocks") > 1, F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda b: F.xxhash64("key", F.least(b, "_mine"), F.greatest(b, "_mine")))).otherwise(F.array("key"))
    return rows.withColumn("key", F.explode(mates)).drop("n", "_blocks", "_mine")


def near_copy_links(distinct: DataFrame, radius: int, group_rows: int = 20_000) -> DataFrame:
    """Edges (a, b) that connect candidates. distinct: node, print, keys."""
    keyed = distinct.select(F.explode("keys").alias("key"), "node")
    shared = written(keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi").select("key", "n"), "shared")
    meets = block_groups(keyed.join(shared, "key").join(distinct.select("node", "print"), "node").select("key", "n", "node", "print"), group_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def out(k: np.ndarray, i: np.ndarray, p: np.ndarray) -> Iterator[pa.RecordBatch]:
            found = []
            for rows in np.split(np.arange(len(k)), np.flatnonzero(np.diff(k)) + 1):
                if len(rows) > 1:
                    found += connect_wide(i[rows], p[rows], radius)
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            k, i = b.column(0).to_numpy(), b.column(1).to_numpy()
            p = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint64).reshape(len(k), -1)
            first = int(np.searchsorted(k, k[-1]))
            if first or (held and held[0][0][0] != k[0]):
                yield from out(*(np.concatenate(x) for x in zip(*held, (k[:first], i[:first], p[:first]))))
                held = []
            held.append((k[first:], i[first:], p[first:]))
        if held:
            yield from out(*(np.concatenate(x) for x in zip(*held)))

    count = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return meets.repartition(count, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def fingerprint_links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Edges (a, b) that connect nodes whose 64-bit fingerprints near_dup's search connects. distinct: node, fp."""
    firsts = written(distinct.groupBy("fp").agg(F.min("node").alias("first")), "fingerprints")
    a, b = (firsts.select(F.col("fp").alias(c), F.col("first").alias("n" + c)) for c in "ab")
    near = links(firsts.select("fp"), radius).join(a, "a").join(b, "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    return near.unionByName(distinct.join(firsts, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")))


def connect_exact(ids: np.ndarray, terms: list[np.ndarray], similarity: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of a breadth-first search over sets of terms, none empty, of at least the Jaccard similarity."""
    sizes = np.array([len(t) for t in terms])
    codes = np.unique(np.concatenate(terms), return_inverse=True)[1]
    own = np.split(codes, np.cumsum(sizes)[:-1])
    has = np.zeros(int(codes.max()) + 1, bool)
    out, left = [], np.arange(1, len(ids))
    frontier, rows, at = [0], left, np.cumsum(sizes)[:-1]
    codes = codes[sizes[0] :]
    at = at - sizes[0]
    while len(left):
        if not frontier:
            frontier, left = [left[0]], left[1:]
            continue
        if 2 * len(left) < len(rows):
            rows, codes = left, np.concatenate([own[i] for i in left])
            at = np.cumsum(sizes[rows]) - sizes[rows]
        f = frontier.pop()
        has[own[f]] = True
        both = np.add.reduceat(has[codes], at, dtype=np.int64)[np.searchsorted(rows, left)]
        has[own[f]] = False
        hit = both * (1 + similarity) >= similarity * (sizes[left] + sizes[f]) - 1e-9
        if hit.any():
            out.append((np.full(int(hit.sum()), ids[f]), ids[left[hit]]))
            frontier += left[hit].tolist()
            left = left[~hit]
    return out


def maybe_in(rows: DataFrame, side: DataFrame, on: list[str], most_bits: int = 1 << 28) -> DataFrame:
    """rows with `_maybe`: false only if the key is not in `side` (a written table).

    A bitmap of hashes, of 32 MB at most whatever the size, tells the rows that a join need not shuffle.
    """
    bits = 1 << max(20, min(most_bits.bit_length() - 1, (32 * side.count()).bit_length()))
    place = F.pmod(F.xxhash64(*on), F.lit(bits))
    bitmaps = side.select(place.alias("_h")).groupBy(F.bitmap_bucket_number("_h").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_bitmap"))
    found = rows.withColumns({"_bucket": F.bitmap_bucket_number(place), "_at": F.bitmap_bit_position(place)}).join(F.broadcast(bitmaps), "_bucket", "left")
    byte = F.conv(F.hex(F.substring("_bitmap", (F.floor(F.col("_at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return found.withColumn("_maybe", F.coalesce(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1, F.lit(False))).drop("_bucket", "_bitmap", "_at")


def exact_links(docs: DataFrame, candidates: DataFrame, similarity: float, *, words: int = 5, group_terms: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Edges (a, b) of nodes whose sets of terms have at least the Jaccard similarity. candidates: node, component, first_id and th (the node's document)."""
    texts = docs.select(F.col(id_col).cast("long").alias("first_id"), text_hash(text_col).alias("th"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = maybe_in(texts, candidates, ["first_id", "th"]).where("_maybe").join(candidates, ["first_id", "th"]).select("component", "node", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            terms = [np.unique(term_hashes(t, words)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(map(len, terms), pa.int64()), pa.array([t.tobytes() for t in terms], pa.binary())], ["key", "node", "size", "terms"])

    each = written(rows.mapInArrow(cut, "key long, node long, size long, terms binary").where("size > 0"), "terms")
    meets = block_groups(each.join(each.groupBy("key").agg(F.sum("size").alias("n")), "key").select("key", "n", "node", "terms"), group_terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets = None, [], []

        def out() -> Iterator[pa.RecordBatch]:
            if len(ids) > 1 and (found := connect_exact(np.array(ids), sets, similarity)):
                a, b = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for k, i, t in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if k != key:
                    yield from out()
                    key, ids, sets = k, [], []
                ids.append(i)
                sets.append(np.frombuffer(t, np.uint64))
        yield from out()

    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return meets.repartition(count, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def keep_one(docs: DataFrame, *, words: int = 5, similarity: float = 0.8, lanes: int = 8, segments: int = 24, group_rows: int = 20_000, group_terms: int = 1_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one of each group of near copies, that with the smallest id.

    The radius of candidates is where the expected share of differing bits for this similarity lies, and four standard
    deviations more.
    """
    bits = 64 * lanes
    share = acos(2 * similarity / (1 + similarity)) / pi
    radius = round(bits * share + 4 * (bits * share * (1 - share)) ** 0.5)
    found = written(sketches(docs.where(F.col(id_col).isNotNull()), words=words, lanes=lanes, segments=segments, id_col=id_col, text_col=text_col), "sketches")
    first = F.min(F.struct("doc_id", "th")).alias("first")
    distinct = written(found.groupBy("print").agg(first, F.count(F.lit(1)).alias("n"), F.min_by("keys", F.struct("doc_id", "th")).alias("keys"), F.min("fp").alias("fp")).select(F.monotonically_increasing_id().alias("node"), "print", "fp", "n", F.col("first.doc_id").alias("first_id"), F.col("first.th").alias("th"), "keys"), "distinct")
    met = near_copy_links(distinct, radius, group_rows).unionByName(fingerprint_links(distinct))
    candidates = written(connected_components(met, "a", "b").join(distinct.select("node", "first_id", "th"), "node"), "candidates")
    links = exact_links(docs, candidates, similarity, words=words, group_terms=group_terms, id_col=id_col, text_col=text_col)
    groups = written(connected_components(links, "a", "b").join(distinct.select("node", "first_id"), "node"), "groups")
    kept = groups.groupBy("component").agg(F.min(F.struct("first_id", "node"))["node"].alias("keeper"), F.count(F.lit(1)).alias("m"))
    dropped = join_spread(groups, written(kept, "kept"), ["component"], groups.count(), "m").where("node <> keeper").select("node", F.lit(True).alias("away"))
    # of a print all go but its first document, and that too if a copy of it stays
    firsts = written(distinct.join(dropped, "node", "left").select("print", "n", F.col("first_id").alias("keeper"), F.col("th").alias("keeper_th"), F.coalesce("away", F.lit(False)).alias("away")), "firsts")
    judged = join_spread(found.select("doc_id", "th", "print"), firsts, ["print"], found.count())
    gone = written(judged.where("away or doc_id <> keeper or th <> keeper_th").select(F.col("doc_id").alias("_gone_id"), F.col("th").alias("_gone_th")).distinct(), "gone")
    judged = maybe_in(docs.withColumns({"_gone_id": F.col(id_col).cast("long"), "_gone_th": text_hash(text_col)}), gone, ["_gone_id", "_gone_th"])
    left = judged.where(~F.col("_maybe")).unionByName(judged.where("_maybe").join(gone, ["_gone_id", "_gone_th"], "left_anti")).select(*docs.columns)
    if found.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return left
    whole = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.monotonically_increasing_id()))
    return left.withColumns({"_row": whole, "_th": text_hash(text_col)}).dropDuplicates(["_row", "_th"]).drop("_row", "_th")
