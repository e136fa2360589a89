"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the neighbour graph is cut into balanced parts: halves
along principal directions first, then moves of vertices to the part that most
of their neighbours are in, as long as the sizes stay balanced. A small
classifier learns which parts a vector's neighbours are in. Every vector is
indexed under its most probable part; a query goes to its several most
probable parts, where exact cosines rank the candidates. How much probability
these must hold together is calibrated on held-out vectors of the sample
against brute force, for all of them and for the most isolated ones, whose
neighbours are hardest to place. A query goes to further parts until they hold
enough candidates. Every vector length has its own partitions.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import stored
from bazaar.llm.vectors import asked, best_first, in_blocks, matrix, numbered

SAMPLE = 8_192         # vectors that the partitions are learned on, at most
HELD_OUT = 1_024       # of these, used only to calibrate the number of probes
PARTS = 16             # a power of two, at least (fewer for a small sample)
PART_ROWS = 4_096      # vectors of a part, about, where more parts are needed for it
ROWS_A_PART = 8        # sampled vectors that a part is learned from, at least
LENGTHS = 4            # vector lengths, the most frequent, with partitions; others are one part
GRAPH_NEIGHBOURS = 10
SLACK = 1.05           # a part's size over the mean
HIDDEN = 128
TARGET = 0.95          # recall on the held-out vectors
TAIL_TARGET = 0.92     # and on the most isolated half, quarter and so on of them
TAIL = 16              # held-out vectors, the fewest of these
BLOCK, QUERY_BLOCK = 8_192, 2_048
SEED = 7


@dataclasses.dataclass
class Router:
    layers: list            # (weights, bias) of the classifier
    mass: float = np.inf    # of probability, that a query's parts hold together

    @property
    def parts(self) -> int:
        return len(self.layers[1][1])

    def probes(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each row of probabilities, the parts from the most probable on,
        and how many of them to search."""
        order = np.argsort(-p, axis=1, kind="stable")
        held = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1)
        return order, np.minimum(1 + (held < self.mass).sum(axis=1), self.parts)

    def probabilities(self, unit: np.ndarray) -> np.ndarray:
        (w1, b1), (w2, b2) = self.layers
        z = np.maximum(unit @ w1 + b1, 0) @ w2 + b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by a power of two first, which is exact, so
    that squares neither overflow nor vanish."""
    scaled = _scaled(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def cosine(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of one query with each row, in double precision; equal rows give equal
    values, wherever they stand."""
    q, v = _scaled(query[None, :])[0], _scaled(vectors)
    return (v * q).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((q * q).sum()))


def neighbours(rows: np.ndarray, among: np.ndarray, k: int, same: bool) -> np.ndarray:
    """Indexes of the nearest ``k`` of ``among`` for each row."""
    out = []
    for at in range(0, len(rows), 256):
        sims = rows[at:at + 256] @ among.T
        if same:
            sims[np.arange(len(sims)), np.arange(at, at + len(sims))] = -np.inf
        out.append(np.argpartition(-sims, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def balanced_parts(points: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 8) -> np.ndarray:
    """A part for each vertex of the neighbour graph."""
    n = len(points)
    part = np.zeros(n, np.int64)
    for _ in range(parts.bit_length() - 1):
        new = part.copy()
        for p in np.unique(part):
            own = np.flatnonzero(part == p)
            centred = points[own] - points[own].mean(axis=0)
            along = centred @ np.linalg.svd(centred, full_matrices=False)[2][0]
            order = own[np.argsort(along, kind="stable")]
            new[order[:len(own) // 2]], new[order[len(own) // 2:]] = 2 * p, 2 * p + 1
        part = new
    edges = np.concatenate([np.stack([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()]),
                            np.stack([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])], axis=1)
    most = int(np.ceil(n / parts * SLACK))
    size = np.bincount(part, minlength=parts)
    for _ in range(sweeps):
        near = np.zeros((n, parts))
        np.add.at(near, (edges[0], part[edges[1]]), 1)
        want = near.argmax(axis=1)
        gain = near[np.arange(n), want] - near[np.arange(n), part]
        moved = 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if size[want[v]] < most:
                size[part[v]] -= 1
                size[want[v]] += 1
                part[v] = want[v]
                moved += 1
        if not moved:
            break
    return part


def _classifier(points: np.ndarray, wanted: np.ndarray, epochs: int = 25, rate: float = 3e-3) -> list:
    """One hidden layer, cross entropy against the shares ``wanted``, Adam."""
    rng = np.random.default_rng(SEED)
    dims, parts = points.shape[1], wanted.shape[1]
    shapes = [(dims, HIDDEN), (HIDDEN,), (HIDDEN, parts), (parts,)]
    p = [rng.normal(0, 1 / np.sqrt(s[0]), s) * (len(s) > 1) for s in shapes]
    p[0] *= np.sqrt(dims)  # unit rows have small components
    m, v, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
    for _ in range(epochs):
        order = rng.permutation(len(points))
        for at in range(0, len(points), 256):
            x, y = points[order[at:at + 256]], wanted[order[at:at + 256]]
            h = np.maximum(x @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            e = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (e / e.sum(axis=1, keepdims=True) - y) / len(x)
            dh = (dz @ p[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((x.T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return [(p[0], p[1]), (p[2], p[3])]


def learn(sample: np.ndarray, k: int = 5, parts: int = PARTS, target: float = TARGET) -> Router:
    """The router from sampled vectors (rows, in any order)."""
    points = unit(sample)
    held = min(HELD_OUT, len(points) // 4)
    test, train = points[:held], points[held:]
    while parts > 1 and len(train) < ROWS_A_PART * parts:
        parts //= 2
    near = min(GRAPH_NEIGHBOURS, len(train) - 1)
    if parts < 2 or near < 1:
        return Router([(np.zeros((points.shape[1], 1)), np.zeros(1)), (np.zeros((1, 1)), np.zeros(1))])
    graph = neighbours(train, train, near, True)
    part = balanced_parts(train, graph, parts)
    wanted = np.zeros((len(train), parts))
    np.add.at(wanted, (np.repeat(np.arange(len(train)), near + 1),
                       part[np.column_stack([np.arange(len(train)), graph])].ravel()), 1 / (near + 1))
    router = Router(_classifier(train, wanted))
    return dataclasses.replace(router, mass=_mass(router, test, train, min(k, len(train)), target))


def _mass(router: Router, test: np.ndarray, train: np.ndarray, k: int, target: float) -> float:
    """The least mass (of 1/2, 3/4, 7/8 ...) that reaches the recall wanted of
    all ``test`` rows and of each group of isolated ones; infinite, all parts,
    if none does."""
    p = router.probabilities(test)
    order, _ = router.probes(p)
    # the place, among the query's parts by probability, of the part that each true neighbour is indexed under
    home, nearest_ = router.probabilities(train).argmax(axis=1), neighbours(test, train, k, False)
    places = np.take_along_axis(np.argsort(order, axis=1), home[nearest_], axis=1)
    isolated = np.argsort(np.einsum("nd,nkd->nk", test, train[nearest_]).min(axis=1), kind="stable")
    groups, n = [], len(test) // 2
    while n >= TAIL:
        groups, n = groups + [isolated[:n]], n // 2
    for mass in 1 - 0.5 ** np.arange(1, 40):
        recall = (places < dataclasses.replace(router, mass=mass).probes(p)[1][:, None]).mean(axis=1)
        if len(test) and recall.mean() >= target and all(recall[g].mean() >= TAIL_TARGET for g in groups):
            return float(mass)
    return np.inf


def fit(vectors: DataFrame, k: int = 5, sample: int = SAMPLE, parts: int = PARTS) -> dict[int, Router]:
    """Routers for the most frequent vector lengths, each from the ``sample``
    vectors of the length that are first in hash order. The number of parts
    grows with the vectors, as far as the sample can tell parts apart."""
    lengths = (vectors.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(LENGTHS).collect())
    routers = {}
    for n, count in lengths:
        own = vectors.where(F.size("vector") == n)
        rows = own.orderBy(F.xxhash64("id", "vector"), "id").limit(sample).select("vector").toArrow()
        grown = max(parts, 1 << max(0, int(np.ceil(np.log2(count / PART_ROWS)))))
        routers[n] = learn(matrix(rows.column("vector"), np.float64), k, grown)
    return routers


def nearest(vectors: DataFrame, queries: DataFrame, routers: dict[int, Router], k: int = 5, block: int = BLOCK,
            query_block: int = QUERY_BLOCK, id_col: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest cosines found for each
    query; never fewer while there are candidates of its length.

    Both frames: (id, vector), see ``usable``; vectors meet queries of their
    own length. Rows of a query's own id are no candidates of it, and a query
    id that occurs more than once is answered for its least vector; any other
    row is a candidate, repeated ones too. Ties go to the smaller id. A length
    without a router is one part, all of which is searched. Empty frames give
    an empty result. ``vectors`` should be read from files, see ``numbered``.
    """
    vectors = numbered(vectors).withColumn("dims", F.size("vector"))
    queries = asked(queries).withColumn("dims", F.size("vector"))

    def by_length(batch: pd.Series):
        """(rows, unit vectors, router) of each length with a router."""
        sizes = np.array([len(v) for v in batch], np.int64)
        for n in np.unique(sizes):
            if n in routers:
                rows = np.flatnonzero(sizes == n)
                yield rows, unit(np.stack(batch.iloc[rows].to_numpy()).astype(np.float64)), routers[n]

    @F.pandas_udf("int")
    def own_part(batch: pd.Series) -> pd.Series:
        out = np.zeros(len(batch), np.int32)
        for rows, units, router in by_length(batch):
            out[rows] = router.probabilities(units).argmax(axis=1)
        return pd.Series(out)

    indexed = vectors.withColumn("part", own_part("vector"))
    sizes = stored(indexed.groupBy("dims", "part").agg(F.count(F.lit(1)).alias("n")), "part-sizes", rows=1)
    # one number for each part of a length with a router
    held = {n: np.zeros(r.parts, np.int64) for n, r in routers.items()}
    for dims, part, n in sizes.where(F.col("dims").isin(list(routers))).collect() if routers else []:
        held[dims][part] = n

    @F.pandas_udf("array<int>")
    def parts_of(batch: pd.Series, need: pd.Series) -> pd.Series:
        out = [[0]] * len(batch)
        for rows, units, router in by_length(batch):
            order, n = router.probes(router.probabilities(units))
            covered = np.cumsum(held[units.shape[1]][order], axis=1) < need.to_numpy()[rows][:, None]
            n = np.minimum(np.maximum(n, 1 + covered.sum(axis=1)), router.parts)
            for i, row in enumerate(rows):
                out[row] = order[i, :n[i]].astype(np.int32)
        return pd.Series(out, dtype=object)

    # a query's own rows fill its parts too
    own = vectors.join(queries.select("id"), "id", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("own_"))
    need = (F.coalesce("own_", F.lit(0)) + k).cast("long")
    routed = (queries.join(own, "id", "left").withColumn("part", F.explode(parts_of("vector", need))).drop("own_"))
    routed = numbered(stored(routed.drop("row_"), "routed-queries"))
    met = (routed.groupBy("dims", "part").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("query_blocks"))
           .join(sizes, ["dims", "part"]).select("dims", "part", "query_blocks", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    met = stored(met, "part-blocks", rows=1)

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        rows, wanted, ids = matrix(a.column("vector"), np.float64), matrix(b.column("vector"), np.float64), a.column("id").to_numpy()
        units, out = unit(rows), []
        for at in range(0, len(wanted), 256):
            keys = b.column("id").to_numpy()[at:at + 256]
            sims = unit(wanted[at:at + 256]) @ units.T
            sims[keys[:, None] == ids[None, :]] = -np.inf
            n = min(k, sims.shape[1])
            kth = np.partition(sims, sims.shape[1] - n, axis=1)[:, sims.shape[1] - n]
            for i, key in enumerate(keys.tolist()):
                # all that could tie with the k-th but for rounding, then exactly
                near = np.flatnonzero((sims[i] >= kth[i] - 1e-9) & np.isfinite(sims[i]))
                scores = cosine(wanted[at + i], rows[near])
                best = np.lexsort((ids[near], -scores))[:k]
                out.append((np.full(len(best), key, np.int64), ids[near[best]], scores[best]))
        return pa.table(dict(zip(("query_id", "id", "score"), (np.concatenate(c) for c in zip(*out)))))

    key = ["dims", "part"]
    found = in_blocks(indexed.join(met, key), routed.join(met.toDF(*met.columns), key), key, F.col("blocks"), F.col("query_blocks"), compare, "double")
    return best_first(found, k, id_col)
