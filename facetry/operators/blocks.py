"""Searches block by block, for points that mostly differ: there are as many places as rows, and their pairs are neither shuffled
nor made at once.

Rows go to their block once, and those near its side to the next one too, packed: of each task the rows of one block travel as
one compressed piece, as repeated coordinates and likely keys take little room so. A block is searched in arrays
(functions.shapes.nearest_in). Results are those of the searches by place (places.py), which stay for points of which many share
a place. Rows without finite coordinates have no place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import product
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetry.functions.shapes import features_at_scales, nearest_in
from facetry.operators.joins import _cells, _packed, finite

XYZ = ("x", "y", "z")


def crowded(points: DataFrame, most: int = 1_000_000) -> bool:
    """Whether there are at most about so many places: then they are searched by place. Judged by a sixteenth of the places, of
    small tables by all; the result is the same either way."""
    hashes = points.where(finite(XYZ)).select(F.xxhash64(*[F.col(c) + 0.0 for c in XYZ]).alias("h"))
    for part in (16, 1):
        n = hashes.where(F.pmod("h", F.lit(part)) == 0).distinct().count()
        if n >= 1000:
            break
    return n * part <= most


def _block_size(rows: DataFrame, radius: float, most: int) -> float:
    """The widest of 64 to 2 radii with at most so many rows in a block: the wider, the fewer rows travel twice."""
    fine = rows.groupBy(*[c.alias(f"c{i}") for i, c in enumerate(_cells(XYZ, 2 * radius))]).count().checkpoint()
    for wide in (64, 32, 24, 16, 12, 8, 4):
        held = fine.groupBy(*[F.floor(F.col(f"c{i}") * 2 / wide) for i in range(3)]).agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] or 0
        if held <= most:
            return wide * radius
    return 2 * radius


def by_block(rows: DataFrame, radius: float, body: Callable[[pa.Table], pa.Table], schema: str, *, most: int = 300_000, tasks: int = 64) -> DataFrame:
    """body() of each block's rows (x, y, z, _own and what else there is) with those within the radius of it, whose _own is false.

    _own, if there, says which rows are asked at all.
    """
    size = _block_size(rows, radius, most)
    asked = F.col("_own") if "_own" in rows.columns else F.lit(True)
    cols = [c for c in rows.columns if c != "_own"]
    sent = rows.withColumn("_own", asked)
    for c in XYZ:
        at = F.floor(F.col(c) / size).cast("long")
        beside = [F.when(F.col(c) - at * size <= radius * (1 + 1e-6), at - 1), F.when((at + 1) * size - F.col(c) <= radius * (1 + 1e-6), at + 1)]
        sent = sent.withColumn("_b" + c, F.explode(F.array_compact(F.array(at, *beside))))
    here = reduce(lambda s, t: s & t, [F.col("_b" + c) == F.floor(F.col(c) / size) for c in XYZ])
    sent = sent.select(_packed([F.col("_b" + c) for c in XYZ]).alias("_b"), *cols, (F.col("_own") & here).alias("_own"))

    def packed(some: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(some).combine_chunks()
        b = t["_b"].to_numpy()
        order = np.argsort(b, kind="stable")
        t, b = t.drop_columns("_b").take(order), b[order]
        starts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
        for lo, hi in zip(starts, np.r_[starts[1:], len(b)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(t.slice(lo, hi - lo))
            yield pa.RecordBatch.from_pydict({"_b": pa.array(b[lo : lo + 1]), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, n = [], 0
        for batch in batches:
            some.append(batch)
            n += batch.num_rows
            if n >= 1 << 20:
                yield from packed(some)
                some, n = [], 0
        if n:
            yield from packed(some)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, list] = {}
        for batch in batches:
            for b, r in zip(batch["_b"].to_pylist(), batch["rows"]):
                pieces.setdefault(b, []).append(r.as_buffer())
        while pieces:
            _, parts = pieces.popitem()
            g = pa.concat_tables([pa.ipc.open_stream(r).read_all() for r in parts]).combine_chunks()
            if pc.any(g["_own"]).as_py():
                yield from body(g).to_batches(max_chunksize=20_000)

    tasks = max(tasks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return sent.mapInArrow(pack, "_b long, rows binary").repartition(tasks, "_b").mapInArrow(searched, schema)


def _at(g: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """xyz, _own, the rows in the order of their places, and which of these are the first of theirs."""
    xyz = np.stack([g[c].to_numpy() for c in XYZ], 1)
    order = np.lexsort(xyz.T)
    return xyz, g["_own"].to_numpy().astype(bool), order, np.r_[True, (xyz[order][1:] != xyz[order][:-1]).any(1)]


def _ranks(keys: pa.Array, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), np.int64)
    out[rows] = pc.rank(keys.take(pa.array(rows)), tiebreaker="dense").to_numpy()
    return out


def _spread(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... n[0] numbers, then those of the next."""
    return np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())


def _complete(full: np.ndarray, must: bool) -> None:
    if must and not full.all():
        raise RuntimeError("a block lacks neighbours that its cells promise")


def _key_lists(key: str, k: int, radius: float, must: bool | None) -> Callable[[pa.Table], pa.Table]:
    """Of each row asked its place, the keys of its k nearest rows in order (ties to the smaller key) and their d2."""

    def body(g: pa.Table) -> pa.Table:
        xyz, own, order, new = _at(g)
        keys = g[key].combine_chunks()
        keys = keys if isinstance(keys, pa.Array) else pa.concat_arrays(keys.chunks)
        copies = not new.all()
        rank = _ranks(keys, np.arange(len(keys))) if copies else None
        order = np.lexsort((rank, *xyz.T)) if copies else order
        start = np.flatnonzero(new)
        m = np.minimum(np.diff(np.r_[start, len(order)]), k)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        asked = np.flatnonzero(np.bincount(place[own], minlength=len(start)))
        q, b, d2, full = nearest_in(xyz[order[start]], m, asked, k, radius)
        _complete(full, must)
        row = order[_spread(start[b], m[b])]
        q, d2 = np.repeat(q, m[b]), np.repeat(d2, m[b])
        by = np.lexsort((d2, q))
        q, d2, row = q[by], d2[by], row[by]
        same = (q[1:] == q[:-1]) & (d2[1:] == d2[:-1])
        tied = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
        if len(tied):
            rank = rank if copies else _ranks(keys, np.unique(row[tied]))
            row[tied] = row[tied][np.lexsort((rank[row[tied]], d2[tied], q[tied]))]
        first = np.searchsorted(q, np.arange(len(asked) + 1))
        mine = np.flatnonzero(own)
        i = np.searchsorted(asked, place[mine])
        n = np.minimum(np.diff(first), k)[i]
        at = _spread(first[i], n)
        ends = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
        out = {key + "_a": keys.take(pa.array(mine)), "_k": pa.ListArray.from_arrays(ends, keys.take(pa.array(row[at]))), "_d": pa.ListArray.from_arrays(ends, pa.array(d2[at]))}
        return pa.table(out if must is not False else out | {c: xyz[mine, j] for j, c in enumerate(XYZ)} | {"_full": full[i]})

    return body


def _sound(points: DataFrame, *cols: str) -> DataFrame:
    return points.where(finite(XYZ)).select(*cols, *[(F.col(c) + 0.0).alias(c) for c in XYZ])


def _listed(lists: DataFrame, key: str) -> DataFrame:
    each = lists.select(key + "_a", F.posexplode(F.arrays_zip("_k", "_d")).alias("_n", "_p"))
    return each.select(key + "_a", F.col("_p._k").alias(key + "_b"), F.col("_p._d").alias("d2"), (F.col("_n") + 1).cast("int").alias("rank"))


def nearest_within(points: DataFrame, k: int, radius: float, key: str) -> DataFrame:
    """The k nearest rows within the radius, the row itself among them: key_a, key_b, d2, rank. Ties go to the smaller key."""
    kind = dict(points.dtypes)[key]
    return _listed(by_block(_sound(points, key), radius, _key_lists(key, k, radius, None), f"{key}_a {kind}, _k array<{kind}>, _d array<double>"), key)


def at_any_distance(rows: DataFrame, k: int, start: float, body: Callable[[int, float, bool], Callable[[pa.Table], pa.Table]], schema: str, *, bulk: str, most_cells: int = 10_000, most_rounds: int = 40) -> tuple[DataFrame, DataFrame | None]:
    """by_block() of body(k, radius, must) with a radius that is wide enough for each row: most of them (schema: bulk), and the
    rest, for which must is false and whose rows (schema) also carry x, y, z and _full.

    In a cell of side radius / sqrt(3) every two rows lie within the radius, so all rows of a cell that holds k are done in one
    pass. The radius grows until few cells hold less; the rows of those are searched apart, with what is near them, in rounds
    of growing radius, as far as they have to.
    """
    k = min(k, rows.count())
    radius = start
    for _ in range(most_rounds):
        side = radius / sqrt(3) * (1 - 1e-9)
        sparse = rows.groupBy(*[c.alias("_c" + n) for c, n in zip(_cells(XYZ, side), XYZ)]).count().where(F.col("count") < k).drop("count")
        if sparse.limit(most_cells + 1).count() <= most_cells:
            break
        radius *= 2
    names = ["_c" + n for n in XYZ]
    sparse = F.broadcast(sparse.withColumn("_few", F.lit(True)).checkpoint())
    celled = rows.withColumns({n: c for n, c in zip(names, _cells(XYZ, side))}).join(sparse, names, "left").drop(*names)
    most = by_block(celled.withColumn("_own", F.col("_few").isNull()).drop("_few"), radius, body(k, radius, True), bulk)
    parts: list[DataFrame] = []
    todo = celled.where("_few").select(*XYZ).distinct().checkpoint()
    around = F.array(*[F.struct(*[F.lit(d).cast("long").alias(n) for n, d in zip(names, step)]) for step in product((-1, 0, 1), repeat=3)])
    for _ in range(most_rounds):
        if todo.isEmpty():
            return most, reduce(DataFrame.unionByName, parts) if parts else None
        at = _cells(XYZ, radius)
        cells = todo.select(*[c.alias(n) for n, c in zip(names, at)]).distinct().withColumn("_g", F.explode(around)).select(*[(F.col(n) + F.col("_g." + n)).alias(n) for n in names]).distinct()
        near = rows.withColumns({n: c for n, c in zip(names, at)}).join(F.broadcast(cells), names, "left_semi").drop(*names)
        flagged = near.join(todo.withColumn("_own", F.lit(True)), list(XYZ), "left").withColumn("_own", F.coalesce("_own", F.lit(False))).checkpoint()
        got = by_block(flagged, radius, body(k, radius, False), schema, tasks=1).checkpoint()
        parts.append(got.where("_full"))
        todo = got.where("not _full").select(*XYZ).distinct().checkpoint()
        radius *= 2
    raise RuntimeError(f"neighbours not found in {most_rounds} rounds")


def nearest_rows(points: DataFrame, k: int, key: str, start: float) -> DataFrame:
    """The k nearest rows at any distance (itself included): key_a, key_b, d2, rank. Ties go to the smaller key."""
    kind = dict(points.dtypes)[key]
    lists = f"{key}_a {kind}, _k array<{kind}>, _d array<double>"
    most, rest = at_any_distance(_sound(points, key), k, start, lambda k, r, must: _key_lists(key, k, r, must), lists + ", x double, y double, z double, _full boolean", bulk=lists)
    return _listed(most if rest is None else most.unionByName(rest.select(*most.columns)), key)


def _some_places(g: pa.Table, k: int, radius: float, must: bool) -> Iterator[tuple]:
    """For a few of the places asked at a time: xyz, the rows asked, order, the places' first rows, m, the places, and what nearest_in() says."""
    xyz, own, order, new = _at(g)
    start = np.flatnonzero(new)
    m = np.diff(np.r_[start, len(order)])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    rows = np.flatnonzero(own)
    rows = rows[np.argsort(place[rows], kind="stable")]
    asked, first = np.unique(place[rows], return_index=True)
    first = np.r_[first, len(rows)]
    p = xyz[order[start]]
    step = max(1, 4_000_000 // max(k, 1))
    for lo in range(0, len(asked), step):
        some = asked[lo : lo + step]
        got = nearest_in(p, m, some, k, radius)
        _complete(got[3], must)
        yield xyz, rows[first[lo] : first[min(lo + step, len(asked))]], order, start, m, p, some, place, got


def nn_distances(points: DataFrame, start: float) -> DataFrame:
    """d: for each row that shares its place with no other one the distance to the nearest other row."""

    def body(k: int, radius: float, must: bool) -> Callable[[pa.Table], pa.Table]:
        def spaced(g: pa.Table) -> pa.Table:
            out = []
            for xyz, rows, _, _, m, _, asked, place, (q, b, d2, full) in _some_places(g, k, radius, must):
                d = np.full(len(asked), np.inf)
                np.minimum.at(d, q[b != asked[q]], d2[b != asked[q]])
                i = np.searchsorted(asked, place[rows])
                d = np.where((m[asked] > 1) | ~np.isfinite(d), 0.0, np.sqrt(d))[i]
                out.append(pa.table({"d": d} if must else {"d": d, **{c: xyz[rows, j] for j, c in enumerate(XYZ)}, "_full": full[i]}))
            return pa.concat_tables(out)

        return spaced

    most, rest = at_any_distance(_sound(points), 2, start, body, "d double, x double, y double, z double, _full boolean", bulk="d double")
    return (most if rest is None else most.unionByName(rest.select("d"))).where("d > 0")


def mean_distances(points: DataFrame, k: int, start: float) -> tuple[DataFrame, float, float]:
    """All columns with mean_distance, the mean distance of each row to its k nearest others, and mean and population deviation of these.

    What is kept on the way is packed like the rows.
    """
    cols = [c for c in points.columns if c not in XYZ]
    kinds = dict(points.dtypes)
    flat = ", ".join([*[f"`{c}` {kinds[c]}" for c in cols], "x double, y double, z double, mean_distance double"])

    def body(k: int, radius: float, must: bool) -> Callable[[pa.Table], pa.Table]:
        def told(g: pa.Table) -> pa.Table:
            out = []
            for xyz, rows, _, _, m, _, asked, place, (q, b, d2, full) in _some_places(g, k, radius, must):
                last = np.zeros(len(asked))
                np.maximum.at(last, q, d2)
                nearer = d2 < last[q]
                n = np.bincount(q[nearer], m[b[nearer]], len(asked))
                d = np.bincount(q[nearer], m[b[nearer]] * np.sqrt(d2[nearer]), len(asked)) + (k - n) * np.sqrt(last)
                i = np.searchsorted(asked, place[rows])
                d = (d / max(k - 1, 1))[i]
                t = g.select([*cols, *XYZ]).take(pa.array(rows)).append_column("mean_distance", pa.array(d))
                if must:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                        writer.write_table(t)
                    t = pa.table({"rows": pa.array([sink.getvalue().to_pybytes()], pa.binary()), "n": [len(d)], "mean": [float(d.mean())], "m2": [float(((d - d.mean()) ** 2).sum())]})
                else:
                    t = t.append_column("_full", pa.array(full[i]))
                out.append(t)
            return pa.concat_tables(out)

        return told

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch["rows"]:
                yield from pa.ipc.open_stream(r.as_buffer()).read_all().to_batches(max_chunksize=20_000)

    most, rest = at_any_distance(_sound(points, *cols), k + 1, start, body, flat + ", _full boolean", bulk="rows binary, n long, mean double, m2 double")
    most = most.checkpoint()
    sums = most.select("n", "mean", "m2")
    if rest is not None:
        rest = rest.drop("_full")
        sums = sums.unionByName(rest.select(F.lit(1).cast("long").alias("n"), F.col("mean_distance").alias("mean"), F.lit(0.0).alias("m2")))
    n, s = sums.agg(F.sum("n"), F.sum(F.col("n") * F.col("mean"))).first()
    if not n:
        return most.select("rows").mapInArrow(unpacked, flat), 0.0, 0.0
    mean = s / n
    spread = sqrt(sums.agg(F.sum(F.col("m2") + F.col("n") * (F.col("mean") - mean) * (F.col("mean") - mean))).first()[0] / n)
    told = most.select("rows").mapInArrow(unpacked, flat)
    return (told if rest is None else told.unionByName(rest)), mean, spread


def scale_features(points: DataFrame, radii: list[float], min_neighbors: int, cap: int, stable_angle_deg: float, min_valid_scales: int, key: str) -> DataFrame:
    """points.multiscale_features() of the nearest `cap` rows of each row, itself included, within the largest radius."""

    def body(g: pa.Table) -> pa.Table:
        keys, out = g[key].combine_chunks(), []
        keys = keys if isinstance(keys, pa.Array) else pa.concat_arrays(keys.chunks)
        for _, rows, order, start, m, p, asked, place, (q, b, d2, _) in _some_places(g, cap, radii[-1], False):
            w = m[b].astype(float)
            held = np.bincount(q, w, len(asked))
            if (held > cap).any():
                # the last distance has more rows than room: those with the smaller keys
                last = np.zeros(len(asked))
                np.maximum.at(last, q, d2)
                tied = np.flatnonzero((d2 == last[q]) & (held > cap)[q])
                room = cap - np.bincount(q, np.where(d2 < last[q], w, 0), len(asked))
                i = np.repeat(tied, m[b[tied]])
                row = order[_spread(start[b[tied]], m[b[tied]])]
                by = np.lexsort((_ranks(keys, np.unique(row))[row], q[i]))
                i, of = i[by], q[i[by]]
                nth = np.arange(len(of)) - np.searchsorted(of, of)
                w[tied] = 0
                np.add.at(w, i[nth < room[of]], 1)
            t = features_at_scales(p[b] - p[asked[q]], d2, q, w, len(asked), radii, min_neighbors, stable_angle_deg, min_valid_scales)
            i = np.searchsorted(asked, place[rows])
            cols = {key: keys.take(pa.array(rows))}
            for name, v in t.items():
                missing = np.isnan(v if v.ndim == 1 else v[:, 0])[i] if v.dtype == float else None
                if v.ndim == 1:
                    cols[name] = pa.array(v[i], mask=missing)
                else:
                    flat = pa.array(v[i][~missing].ravel())
                    ends = np.r_[0, np.cumsum(np.where(missing, 0, v.shape[1]))].astype(np.int32)
                    cols[name] = pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(missing))
            out.append(pa.table(cols))
        return pa.concat_tables(out)

    schema = "neighbor_count int, normal array<double>, eigenvalues array<double>, planarity double, surface_variation double, curvature double, normal_scale_m double, normal_stability_deg double, normal_stable boolean, normal_valid_scale_count int, multiscale_entropy double"
    return by_block(_sound(points, key), radii[-1], body, f"{key} {dict(points.dtypes)[key]}, {schema}")
