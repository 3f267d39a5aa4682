"""Nearest neighbours by inner product: an inverted-list index scanned by adaptive dimension.

Method (adaptive dimension scan): vectors get one more component that makes all their lengths equal, so that the largest inner product is
the smallest distance, and are rotated by one random orthogonal matrix. A k-means over a bounded sample gives the lists. A list is scanned in
column blocks of the rotated vectors: after each block the distance so far is tested against the distance a candidate must beat, and
candidates that fail are abandoned. For a random rotation the share of a squared distance that the first d of D components hold follows
Beta(d/2, (D-d)/2), so the test abandons a candidate that is near enough with probability ``MISS`` at most. What passes all blocks is
scored exactly, in double precision, on the original vectors.

How many lists a query probes is measured, not fixed: ``TUNING_QUERIES`` queries are compared with all rows, and the number of lists
that hold ``TARGET_RECALL`` of their true neighbours is taken for every query (more where these hold under k + 1 rows).

Distribution: lists are packed into tiles of about ``TILE_ROWS`` rows; a list beyond that (a hot one may hold a third of all rows) is dealt over
several. A query goes once to each tile that holds a list it probes; the queries of a tile are dealt over blocks of about ``QUERY_ROWS`` and
a task scans one tile for one block. The driver and the task closures hold the sample (``SAMPLE_ROWS`` at most), the centroids and one row
per list; all vectors are indexed.

Results: (query id, rank, id, score), nearest first, ties to the smaller id; all candidates if there are fewer than k. Rows whose
id is NULL, or whose vector is NULL, zero, of another length than the commonest, or holds NULL or non-finite components take no part.
Every row of a repeated id is a candidate; as a query the id counts once, with its smallest vector, and none of its rows is its neighbour.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow.llm.common import small_side, staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import this package

#: Rows of the sample that the lists are fitted on, at most, and rows of it per list.
SAMPLE_ROWS = 65_536
SAMPLE_PER_LIST = 16
TUNING_QUERIES = 128
TARGET_RECALL = 0.97
#: Probability that one test abandons a candidate that is near enough.
MISS = 0.001
#: Shares of the components after which candidates are tested.
STEPS = (1 / 2, 3 / 4, 7 / 8)
TILE_ROWS = 4096
QUERY_ROWS = 2048
#: Queries compared at once with the rows of a list (bounds the matrix of distances).
CHUNK = 256
ROUNDS = 10
SEED = 17


def beta_quantile(a: float, b: float, p: float, grid: int = 200_000) -> float:
    """The ``p`` quantile of Beta(a, b), by summing its density on a grid."""
    t = (np.arange(grid) + 0.5) / grid
    log = (a - 1) * np.log(t) + (b - 1) * np.log1p(-t)
    mass = np.cumsum(np.exp(log - log.max()))
    return float(t[min(int(np.searchsorted(mass, p * mass[-1])), grid - 1)])


def _vectors(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _near_lists(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every centre, but for the point's own length."""
    return (centres**2).sum(1) - 2 * (points @ centres.T)


def k_means(points: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` centres of ``points`` (starting at the first ones; a centre without points stays)."""
    centres = points[:k].copy()
    for _ in range(rounds):
        label = np.concatenate([_near_lists(points[i : i + 4096], centres).argmin(1) for i in range(0, len(points), 4096)])
        order = np.argsort(label, kind="stable")
        found, start = np.unique(label[order], return_index=True)
        centres[found] = np.add.reduceat(points[order], start, axis=0) / np.diff(np.append(start, len(order)))[:, None]
    return centres


@dataclass(frozen=True)
class Index:
    """What tasks need to place a vector or a query: scale, rotation, centres and the sample."""

    dim: int
    scale: float
    rotation: np.ndarray
    centres: np.ndarray
    sample: np.ndarray
    sample_ids: np.ndarray
    sample_lists: np.ndarray

    def rotate(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Scaled vectors with the component that evens their lengths (0 for queries), rotated."""
        x = vectors / self.scale
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, 1.0 - (x**2).sum(1)))
        return (np.column_stack([x, more]) @ self.rotation).astype(np.float32)

    def ratios(self) -> list[tuple[int, int, float]]:
        """(first component, end, share) of each column block; distances beyond share x bound are abandoned, 0 for no test."""
        full = self.dim + 1
        ends = sorted({int(full * s) for s in STEPS if 0 < int(full * s) < full - 1} | {full})
        quantile = [beta_quantile(e / 2, (full - e) / 2, 1 - MISS) if e < full else 0.0 for e in ends]
        return list(zip([0, *ends[:-1]], ends, quantile, strict=True))


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(key, vec) of the rows that take part, but for the length of the vector."""
    kind = rows.schema[vec_col].dataType.elementType
    vec = F.col(vec_col) if isinstance(kind, T.FloatType | T.DoubleType) else F.col(vec_col).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    picked = rows.select(F.col(id_col).alias("key"), vec.alias("vec")).where(F.col("key").isNotNull() & F.col("vec").isNotNull())
    return picked.where(~F.exists("vec", bad) & F.exists("vec", lambda x: x != 0))


def _norm(vec: Column) -> Column:
    """Length of a vector, safe from overflow of its square."""
    top = F.array_max(F.transform(vec, F.abs)).cast("double")
    return top * F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") / top, F.lit(2.0))))


def fit(rows: DataFrame, dim: int, count: int, longest: float) -> Index:
    """Lists by k-means on the ``SAMPLE_PER_LIST`` x lists rows with the smallest id hashes."""
    lists = max(1, min(int(np.ceil(np.sqrt(count))), SAMPLE_ROWS // SAMPLE_PER_LIST))
    picked = rows.orderBy(F.xxhash64("key"), "key", "vec").limit(lists * SAMPLE_PER_LIST).toArrow()
    sample = _vectors(picked.column("vec"), dim)
    rotation, _ = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim + 1, dim + 1)))
    ids = picked.column("key").to_numpy()
    rotated = Index(dim, longest, rotation, np.empty(0), sample, ids, np.empty(0)).rotate(sample)
    centres = k_means(rotated, min(lists, len(rotated)))
    return Index(dim, longest, rotation, centres, sample, ids, _near_lists(rotated, centres).argmin(1))


def _assign(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = 0  # deals the rows of a list over its tiles, whatever their ids
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                label = _near_lists(index.rotate(_vectors(part.column(1), index.dim)), index.centres).argmin(1)
                slots = np.arange(slot, slot + part.num_rows)
                slot += part.num_rows
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(label, pa.int32()), pa.array(slots, pa.int64())], ["key", "vec", "list", "slot"])

    return run


def _best_of(scores: np.ndarray, query: np.ndarray, key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ``k`` best entries of each query, and their rank from 0; ties to the smaller key."""
    order = np.lexsort((key, -scores, query))
    q = query[order]
    start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.empty(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[rank < k], rank[rank < k]


def _true_lists(index: Index, queries: np.ndarray, ids: np.ndarray, k: int):
    """Best k rows of each task for each tuning query, with the lists they are in."""
    names = ["query", "score", "key", "list"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0), np.empty(0, ids.dtype), np.empty(0, np.int32)]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                key = part.column(0).to_numpy(zero_copy_only=False)
                scores = queries @ _vectors(part.column(1), index.dim).T
                scores[ids[:, None] == key[None, :]] = -np.inf
                top = np.argpartition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k]
                q = np.repeat(np.arange(len(queries)), top.shape[1])
                t = top.ravel()
                more = [q, scores[q, t], key[t], part.column(2).to_numpy()[t]]
                best = [np.concatenate(x) for x in zip(best, more, strict=True)]
                picked, _ = _best_of(best[1], best[0], np.zeros(len(best[0])), k)
                best = [x[picked] for x in best]
        real = best[1] > -np.inf
        yield pa.RecordBatch.from_arrays([pa.array(x[real]) for x in best], names)

    return run


def probes(index: Index, rows: DataFrame, queries: DataFrame, k: int) -> int:
    """Lists a query must probe so that ``TARGET_RECALL`` of the true neighbours of the tuning queries lie in them."""
    picked = queries.orderBy(F.xxhash64("key"), "key").limit(TUNING_QUERIES).toArrow()
    vectors, ids = _vectors(picked.column("vec"), index.dim), picked.column("key").to_numpy()
    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("key", rows.schema["key"].dataType), T.StructField("list", T.IntegerType())])
    near = rows.select("key", "vec", "list").mapInArrow(_true_lists(index, vectors, ids, k), schema)
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    true = near.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query", "list").toArrow()
    if not true.num_rows:
        return len(index.centres)
    distance = _near_lists(index.rotate(vectors, query=True), index.centres)
    place = np.empty_like(distance, dtype=np.int64)
    np.put_along_axis(place, np.argsort(distance, axis=1, kind="stable"), np.arange(distance.shape[1])[None, :], axis=1)
    needed = np.sort(place[true.column("query").to_numpy(), true.column("list").to_numpy()])
    return int(needed[min(len(needed) - 1, int(np.ceil(TARGET_RECALL * len(needed))) - 1)]) + 1


def tiles_of(index: Index, counts: np.ndarray) -> np.ndarray:
    """(first tile, number of tiles) of each list: neighbouring lists share tiles, a large list has several of its own."""
    groups = max(1, min(len(counts), int(counts.sum()) // TILE_ROWS))
    order = np.argsort(_near_lists(index.centres, k_means(index.centres, groups)).argmin(1), kind="stable")
    out, tile, held = np.zeros((len(counts), 2), np.int64), 0, 0
    for k in order.tolist():
        own = -(-int(counts[k]) // TILE_ROWS)
        if held and held + counts[k] > TILE_ROWS:
            tile, held = tile + 1, 0
        out[k] = tile, max(1, own)
        if own > 1:
            tile += own
        else:
            held += int(counts[k])
    return out


def _send(index: Index, tiles: np.ndarray, counts: np.ndarray, n_probes: int, k: int):
    """A row for each tile that holds a list the query probes: those lists, and a score that 2 k rows of them reach at least.

    The score is that of the 2 k-th best sample row in these lists: k rows more than needed, so that a query keeps k rows even if
    some are abandoned.
    """
    names = ["tile", "query", "vec", "least", "lists"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                ids, vectors = part.column(0).to_numpy(zero_copy_only=False), _vectors(part.column(1), index.dim)
                near = np.argsort(_near_lists(index.rotate(vectors, query=True), index.centres), axis=1, kind="stable")
                take = np.maximum(n_probes, 1 + (np.cumsum(counts[near], axis=1) < k + 1).sum(1))
                place = np.empty_like(near)
                np.put_along_axis(place, near, np.arange(near.shape[1])[None, :], axis=1)
                seen = vectors @ index.sample.T
                seen[(ids[:, None] == index.sample_ids[None, :]) | (place[:, index.sample_lists] >= take[:, None])] = -np.inf
                least = -np.partition(-seen, 2 * k - 1, axis=1)[:, 2 * k - 1] if seen.shape[1] >= 2 * k else np.full(len(ids), -np.inf)
                least -= 1e-9 * index.scale * np.sqrt((vectors**2).sum(1))  # the product above rounds in its own way
                pos, tile, lists = [], [], []
                for row in range(len(ids)):
                    by_tile: dict[int, list[int]] = {}
                    for x in near[row, : take[row]].tolist():
                        for t in range(tiles[x, 0], tiles[x, 0] + tiles[x, 1]) if counts[x] else ():
                            by_tile.setdefault(t, []).append(x)
                    pos += [row] * len(by_tile)
                    tile += by_tile.keys()
                    lists += by_tile.values()
                where = pa.array(pos, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tile, pa.int64()), part.column(0).take(where), part.column(1).take(where), pa.array(least[pos], pa.float64()), pa.array(lists, pa.list_(pa.int32()))],
                    names,
                )

    return run


def _survivors(blocks: list[tuple[np.ndarray, np.ndarray, float]], bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) positions whose distance stays under the query's ``bound`` in every block's test.

    ``blocks``: the columns of the queries, the same columns of the rows, and the share of the bound they may use. While many pairs
    are left a block is one matrix product; once few are, only theirs is computed.
    """
    so_far, live, pairs = None, None, None
    for q, x, share in blocks:
        limit = bound * share if share else bound
        if pairs is None:
            part = (q**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * (q @ x.T)
            so_far = part if so_far is None else so_far + part
            ok = so_far <= limit[:, None]
            live = ok if live is None else live & ok
            if share and live.mean() < 0.1:
                pairs = np.nonzero(live)
                so_far = so_far[pairs]
        else:
            so_far = so_far + ((q[pairs[0]] - x[pairs[1]]) ** 2).sum(1)
            ok = so_far <= limit[pairs[0]]
            pairs, so_far = (pairs[0][ok], pairs[1][ok]), so_far[ok]
    return np.nonzero(live) if pairs is None else pairs


def _scan(index: Index, k: int, names: list[str]):
    cuts = index.ratios()

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([queries.schema.field("query").with_name(names[0]), rows.schema.field("key").with_name(names[1]), pa.field(names[2], pa.float64())])
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        rows = rows.sort_by([("list", "ascending"), ("key", "ascending")])
        keys = rows.column("key").to_numpy()
        rank = np.unique(keys, return_inverse=True)[1]
        vectors, wanted = _vectors(rows.column("vec"), index.dim), _vectors(queries.column("vec"), index.dim)
        x, q = index.rotate(vectors), index.rotate(wanted, query=True)
        own = queries.column("query").to_numpy()
        least = queries.column("least").to_numpy().copy()
        lists = queries.column("lists").combine_chunks()
        probing = np.repeat(np.arange(len(own)), np.diff(lists.offsets.to_numpy()))
        probed = lists.flatten().to_numpy()
        label = rows.column("list").to_numpy()
        name, start = np.unique(label, return_index=True)
        size = (q.astype(np.float64) ** 2).sum(1)
        unit = index.scale**2
        best_q, best_x, best_s = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for one, a, b in zip(name.tolist(), start.tolist(), [*start[1:].tolist(), len(label)], strict=True):
            asked = probing[probed == one]
            for at in range(0, len(asked), CHUNK):
                mine = asked[at : at + CHUNK]
                bound = size[mine] + 1 - 2 * (least[mine] / unit)
                bound = (np.maximum(bound, 0) * (1 + 1e-4) + 1e-5).astype(np.float32)  # single precision below
                qi, xi = _survivors([(q[mine, s:e], x[a:b, s:e], share) for s, e, share in cuts], bound)
                qi, xi = mine[qi], xi + a
                other = own[qi] != keys[xi]
                qi, xi = qi[other], xi[other]
                score = np.zeros(len(qi))
                for d in range(index.dim):
                    score += wanted[qi, d] * vectors[xi, d]
                good = score >= least[qi]
                best_q, best_x, best_s = (np.concatenate(p) for p in ((best_q, qi[good]), (best_x, xi[good]), (best_s, score[good])))
            picked, place = _best_of(best_s, best_q, rank[best_x], k)
            best_q, best_x, best_s = best_q[picked], best_x[picked], best_s[picked]
            full = place == k - 1
            least[best_q[full]] = np.maximum(least[best_q[full]], best_s[full])
        return pa.Table.from_arrays([queries.column("query").take(pa.array(best_q)), rows.column("key").take(pa.array(best_x)), pa.array(best_s, pa.float64())], schema=schema)

    return run


def search(
    rows: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", names: tuple[str, str, str, str] = ("query_id", "rank", "vec_id", "score")
) -> DataFrame:
    """(query id, rank, id, score): the ``k`` nearest other rows found for each id of the rows that fit ``is_query``."""
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType
    out = T.StructType([T.StructField(names[0], kind), T.StructField(names[1], T.IntegerType()), T.StructField(names[2], kind), T.StructField(names[3], T.DoubleType())])
    part = usable(rows, id_col, vec_col)
    sizes = part.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(_norm(F.col("vec"))).alias("longest"))
    most = sizes.orderBy(F.desc("n"), F.desc("dim")).head()
    if most is None:
        return spark.createDataFrame([], out)
    part = part.where(F.size("vec") == F.lit(most["dim"]))
    asked = usable(rows.where(is_query), id_col, vec_col).where(F.size("vec") == F.lit(most["dim"])).groupBy("key").agg(F.min("vec").alias("vec"))
    asked = staged(asked, "ann-queries")

    index = fit(part, most["dim"], most["n"], most["longest"])
    placed_schema = T.StructType([part.schema["key"], part.schema["vec"], T.StructField("list", T.IntegerType()), T.StructField("slot", T.LongType())])
    placed = staged(part.mapInArrow(_assign(index), placed_schema), "ann-index")
    counts = np.zeros(len(index.centres), np.int64)
    for r in placed.groupBy("list").count().collect():  # one row per list
        counts[r["list"]] = r["count"]
    tiles = tiles_of(index, counts)
    n_probes = probes(index, placed, asked, k)

    sent_schema = T.StructType([T.StructField("tile", T.LongType()), T.StructField("query", kind), part.schema["vec"], T.StructField("least", T.DoubleType()), T.StructField("lists", T.ArrayType(T.IntegerType()))])
    sent = staged(asked.mapInArrow(_send(index, tiles, counts, n_probes, k), sent_schema), "ann-sent")
    blocks = sent.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_ROWS)).cast("long").alias("blocks"))
    blocks = small_side(staged(blocks, "ann-blocks"))
    where = spark.createDataFrame([(i, int(t), int(n)) for i, (t, n) in enumerate(tiles)], "list int, first long, n long")
    tiled = placed.join(F.broadcast(where), "list").withColumn("tile", F.col("first") + F.pmod("slot", "n"))
    tiled = tiled.join(blocks, "tile").select("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "list", "key", "vec")
    dealt = sent.join(blocks, "tile").select("tile", F.pmod(F.xxhash64("query"), "blocks").alias("block"), "query", "vec", "least", "lists")
    found_schema = T.StructType([out.fields[0], out.fields[2], out.fields[3]])
    scan = _scan(index, k, found_schema.names)
    found = tiled.groupBy("tile", "block").cogroup(dealt.groupBy("tile", "block")).applyInArrow(lambda a, b: scan(a, b), found_schema)
    by_query = Window.partitionBy(names[0]).orderBy(F.desc(names[3]), names[2])
    return found.withColumn(names[1], F.row_number().over(by_query).cast("int")).where(F.col(names[1]) <= k).select(*out.names)
