"""Nearest neighbours by collision counting over sorted single projections.

Largest inner product is least distance after one more component makes all vectors equally long. A shard is cut into bands of
similar norm, each with its own length, so that this component stays small; queries are scaled to it. Each band sorts its vectors
by each of ``projections`` random directions. A query opens a window around its own place in every sorted array and widens all of
them together (virtual rehashing) until enough vectors collide with it in ``threshold`` of the windows; these are verified by
their inner product. The windows then grow once more, to the width at which a vector as near as the k-th one found collides
often enough with probability ``target``. That width follows from the distance found, whatever the norms, the dimension or the
spread of the vectors are, so nothing is cut off by a share or a number of candidates. A band that can't hold a better inner
product than the k-th one found is passed over.

Vectors are dealt to shards by the nearest of a bounded number of centres. A query first goes to one shard of its own centre; the
k-th inner product found there rules out every shard whose centre and radius can't hold a larger one, and it then goes to the
others. Each vector moves once; queries stream past the shards they touch.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crosslink.llm.common import partitions, ranges, written

SEED = 20240531
WIDEN = 1.3
#: The longest vector of a band is at most this many times as long as its shortest.
BAND = 1.1


def usable(embedding: str = "embedding") -> Column:
    """Not null, not empty, all components finite, not zero."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def directions(dim: int, projections: int) -> np.ndarray:
    """dim x projections: random orthonormal blocks, scaled so that a difference of length d has projections of variance d^2."""
    r = np.random.default_rng(SEED)
    blocks = [np.linalg.qr(r.standard_normal((dim, dim)))[0] for _ in range(-(-projections // dim))]
    return np.concatenate(blocks, axis=1)[:, :projections] * math.sqrt(dim)


@functools.cache
def width_for(projections: int, need: int, target: float) -> float:
    """Half a window's width for a distance of 1: at it, ``need`` of the projections collide with probability ``target``."""

    def enough(p: float) -> float:
        return sum(math.comb(projections, i) * p**i * (1 - p) ** (projections - i) for i in range(need, projections + 1))

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if enough(mid) >= target else (mid, high)
    return NormalDist().inv_cdf((1 + min(high, 1 - 1e-12)) / 2)


class Band:
    """Points of similar norm: sorted projections, and each point's place in every sorted array."""

    def __init__(self, points: np.ndarray, projections: int, threshold: float, target: float):
        self.directions, self.need = directions(points.shape[1], projections), math.ceil(threshold * projections)
        p = points @ self.directions
        order = np.argsort(p, axis=0, kind="stable")
        self.ordered = np.take_along_axis(p, order, 0).T.copy()
        self.place = np.empty((projections, len(points)), np.uint16 if len(points) < 1 << 16 else np.uint32)
        np.put_along_axis(self.place, order.T, np.arange(len(points), dtype=self.place.dtype)[None, :], 1)
        self.unit_width = width_for(projections, self.need, target)

    def colliding(self, projected: np.ndarray, half: float) -> np.ndarray:
        """The points that lie in at least ``need`` windows of this half width around the query's own place."""
        low = np.array([np.searchsorted(row, x - half) for row, x in zip(self.ordered, projected)])
        high = np.array([np.searchsorted(row, x + half, side="right") for row, x in zip(self.ordered, projected)])
        inside = (self.place - low.astype(self.place.dtype)[:, None]) < (high - low).astype(self.place.dtype)[:, None]  # unsigned: places before low wrap round
        inside[high - low > np.iinfo(self.place.dtype).max] = True
        return np.flatnonzero(np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8 if len(inside) < 256 else np.uint32) >= self.need)


def norms(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1)
    return largest * np.sqrt(((x / largest[:, None]) ** 2).sum(axis=1))


def norms_or_zero(x: np.ndarray) -> np.ndarray:
    largest = np.abs(x).max(axis=1, initial=0)
    return largest * np.sqrt(((x / np.where(largest > 0, largest, 1)[:, None]) ** 2).sum(axis=1))


def bands(length: np.ndarray) -> list[np.ndarray]:
    """The places of lengths within a factor ``BAND`` of each other, from the longest down."""
    order, out = np.argsort(-length, kind="stable"), []
    while len(order):
        n = int(np.searchsorted(-length[order], -length[order[0]] / BAND, side="right"))
        out.append(order[:n])
        order = order[n:]
    return out


class Shard:
    """Vectors ``x`` with ``ids``, ready for queries."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, k: int, projections: int, threshold: float, target: float):
        self.x, self.ids, self.k, self.verified, self.usual = x, ids, k, 0, 1.0
        self.scale = float(np.abs(x).max())
        if not 1e-100 < self.scale < 1e100:  # so that no square overflows; the scores are of the vectors as they are
            self.y = x / self.scale
        else:
            self.y, self.scale = x, 1.0
        length = norms(self.y)
        self.longest, self.bands = float(length.max()), []
        for band in bands(length):
            unit = self.y[band] / length[band[0]]
            lifted = np.column_stack([unit, np.sqrt(np.maximum(1 - (unit**2).sum(axis=1), 0))])
            self.bands.append((band, length[band[0]], None if target >= 1 else Band(lifted, projections, threshold, target)))

    def search(self, q: np.ndarray, own: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the k nearest found, those only that can exceed ``least`` (-inf: any)."""
        x, y, ids, k = self.x, self.y, self.ids, self.k
        most = float(np.abs(q).max())
        unit = q / most
        long = math.sqrt(float(unit @ unit))
        unit = unit / long
        seen, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        floor = least / most / long / self.scale if math.isfinite(least) else -math.inf
        best = floor = floor - 1e-9 * abs(floor)

        def verify(found: np.ndarray) -> float:
            """Inner products with the query's direction; returns the k-th largest so far."""
            found = found[ids[found] != own]
            seen.append(found)
            scores.append(y[found] @ unit)
            both = np.concatenate(scores)
            return max(floor, float(np.partition(both, len(both) - k)[len(both) - k]) if len(both) >= k else -math.inf)

        lifted = np.append(unit, 0.0)
        projected = [None if points is None else lifted @ points.directions for _, _, points in self.bands]
        met = [np.zeros(0, np.int64) for _ in self.bands]

        def widen(i: int, distance: float) -> None:
            """Verifies what collides in band i at the width for this distance and did not before."""
            nonlocal best
            band, _, points = self.bands[i]
            if points is None:
                now = np.arange(len(band))
            else:
                now = points.colliding(projected[i], points.unit_width * distance)
            if len(now) > len(met[i]):
                new = np.ones(len(band), bool)
                new[met[i]] = False
                met[i], best = now, verify(band[now[new[now]]])

        distance = 0.8 * self.usual
        while best == -math.inf and any(len(m) < len(b[0]) for m, b in zip(met, self.bands)):  # until k are found
            for i in range(len(self.bands)):
                widen(i, distance)
            distance *= WIDEN
        for i, (_, longest, _) in enumerate(self.bands):
            if best <= longest:
                widen(i, math.sqrt(max(2 - 2 * best / longest, 0.0)) if best > -math.inf else math.inf)
        if best > -math.inf and floor == -math.inf:
            self.usual = math.sqrt(max(2 - 2 * best / self.longest, 0.0))
        found, near = np.concatenate(seen), np.concatenate(scores)
        self.verified += len(found)
        if self.scale == 1.0 and most < 1e100:  # no infinite products: only those that can be among the k
            found = found[near >= best - 1e-9 * (abs(best) + self.longest)] if best > -math.inf else found
        with np.errstate(over="ignore", invalid="ignore"):
            score = (x[found] * q).sum(axis=1)
        chosen = np.lexsort((ids[found], -score))[:k]
        return ids[found][chosen], score[chosen]


def pieces_of(batches: Iterator[pa.RecordBatch], dim: int, make) -> Iterator[pa.RecordBatch]:
    """Rows (shard, copy, kind, vec_id, embedding, least) sorted by the first three: a shard's vectors (kind 0) make its index, its queries (kind 1) stream past."""
    matrix = lambda column: column.flatten().to_numpy().reshape(len(column), dim)
    key, held, index = None, [], None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            if (new := tuple(keys[:2, a].tolist())) != key:
                key, held, index = new, [], None
            part = batch.slice(a, b - a)
            if not keys[2, a]:
                held.append((matrix(part.column(4)), part.column(3).to_numpy()))
                continue
            if index is None and held:
                index, held = make(*(np.concatenate(c) for c in zip(*held))), []
            if index is None:
                continue
            own, q, least = part.column(3).to_numpy(), matrix(part.column(4)), part.column(5).to_numpy()
            found = [index.search(q[i], own[i], least[i]) for i in range(len(own))]
            sizes = [len(v) for v, _ in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, sizes)), pa.array(np.concatenate([v for v, _ in found])), pa.array(np.concatenate([s for _, s in found]))], names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, projections: int = 64, threshold: float = 0.75, target: float = 0.9, shard: int = 16384, centres: int = 1024, together: int = 32768) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of ``queries`` the ``k`` rows of ``vectors`` of largest inner product found.

    Both have vec_id and embedding; rows with the query's own vec_id are no candidates. Ties go to the smaller vec_id. Vectors
    that are null, zero, hold null or non-finite components or lack an id take no part, nor do vectors of another length
    than the most frequent one. Repeated queries count once. Fewer candidates: all of them. Other columns are left out.
    The rank is per query; empty tables give no rows. Every vector that reaches the collision threshold is verified.
    ``target``: the probability with which each of the k nearest is found; 1 verifies every vector, which is exact. Inner
    products beyond the largest double are infinite, and such of both signs not a number, which comes last.
    """
    clean = lambda df: df.filter(usable() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    vectors, queries = clean(vectors), clean(queries)
    lengths = vectors.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    best = lengths.orderBy(F.desc("n"), "dim").first()
    dim, total = (best["dim"], best["n"]) if best else (1, 0)
    vectors, queries = vectors.filter(F.size("embedding") == dim), queries.filter(F.size("embedding") == dim).distinct()
    parts = partitions(vectors.sparkSession)
    order = [F.xxhash64("vec_id", "embedding"), "vec_id"]
    chosen = vectors.orderBy(*order).limit(max(1, min(centres, total // shard))).select("embedding").collect()
    middle = np.array([r["embedding"] for r in chosen], np.float64).reshape(-1, dim) if chosen else np.zeros((1, dim))

    def homes(batches):
        """Adds the nearest centre and its distance."""
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, dim)
            scale = max(float(np.abs(x).max(initial=0)), float(np.abs(middle).max()), 1e-300)
            a, c = x / scale, middle / scale
            near = np.argmin((c**2).sum(axis=1) - 2 * a @ c.T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(norms_or_zero(a - c[near]) * scale)], names=["vec_id", "embedding", "home", "distance"])

    schema = "vec_id long, embedding array<double>, home int, distance double"
    data = written(vectors.select("vec_id", "embedding").mapInArrow(homes, schema), "vectors")
    sizes = {r["home"]: r for r in data.groupBy("home").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}  # a row for each centre
    shards = np.array([-(-sizes[h]["n"] // shard) if h in sizes else 0 for h in range(len(middle))], np.int64)
    first = np.cumsum(shards) - shards
    radius = np.array([sizes[h]["radius"] if h in sizes else 0.0 for h in range(len(middle))])
    table = F.create_map(*[x for h in range(len(middle)) if shards[h] for x in (F.lit(h), F.lit(int(first[h] << 32 | shards[h])).cast("long"))]) if total else F.create_map(F.lit(0), F.lit(1).cast("long"))
    code = F.element_at(table, F.col("home"))
    spread = (F.shiftright(code, 32) + F.pmod(F.xxhash64("vec_id", "embedding"), code.bitwiseAND(F.lit((1 << 32) - 1)))).cast("int")
    data = data.select("vec_id", "embedding", spread.alias("shard"))
    asked = queries.select("vec_id", "embedding").mapInArrow(homes, schema).filter(F.element_at(table, F.col("home")).isNotNull() if total else F.lit(False))
    asked = asked.select("vec_id", "embedding", spread.alias("shard"))

    def search(asked: DataFrame, name: str) -> DataFrame:
        """asked: vec_id, embedding, shard, least."""
        asked = written(asked, "asked")
        copies = asked.groupBy("shard").agg(F.ceil(F.count("*") / together).cast("int").alias("copies"))
        points = data.join(copies, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("kind"), "vec_id", "embedding", F.lit(0.0).alias("least"))
        streamed = asked.join(copies, "shard").select("shard", F.pmod(F.xxhash64("vec_id", "embedding"), "copies").cast("int").alias("copy"), F.lit(1).alias("kind"), "vec_id", "embedding", "least")
        rows = points.unionByName(streamed).repartition(parts, "shard", "copy").sortWithinPartitions("shard", "copy", "kind")
        make = lambda x, ids: Shard(x, ids, k, projections, threshold, target)
        return written(rows.mapInArrow(lambda b: pieces_of(b, dim, make), "query_id long, vec_id long, score double"), name)

    near = search(asked.withColumn("least", F.lit(float("-inf"))), "near")
    bound = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))  # each query has k rows at most here
    rest = asked.join(bound.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select("vec_id", "embedding", "shard", F.when(~F.isnan("least"), F.col("least")).alias("least"))

    def touched(batches):
        """The shards that can hold a larger inner product: with |x - c| <= radius no x of a centre has more than q c + |q| radius."""
        some = np.flatnonzero(shards)
        for batch in batches:
            q, own = batch.column(1).flatten().to_numpy().reshape(-1, dim), batch.column(2).to_numpy()
            least = np.nan_to_num(pc.fill_null(batch.column(3), -math.inf).to_numpy(), nan=-math.inf, neginf=-math.inf, posinf=math.inf)
            with np.errstate(over="ignore", invalid="ignore"):
                long = norms_or_zero(q)
                most = q @ middle[some].T + long[:, None] * radius[some]
                slack = 1e-9 * long[:, None] * (radius[some] + norms_or_zero(middle[some]))
                row, home = np.nonzero(~(most + slack < least[:, None]))
            home = some[home]
            to = ranges(first[home], shards[home])
            row = np.repeat(row, shards[home])
            row, to = row[to != own[row]], to[to != own[row]]
            for a in range(0, len(row), 4096):
                part = batch.take(pa.array(row[a : a + 4096]))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(to[a : a + 4096].astype(np.int32)), pa.array(least[row[a : a + 4096]])], names=["vec_id", "embedding", "shard", "least"])

    far = search(rest.mapInArrow(touched, "vec_id long, embedding array<double>, shard int, least double"), "far")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.isnan("score"), F.desc("score"), "vec_id"))
    return near.unionByName(far).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
