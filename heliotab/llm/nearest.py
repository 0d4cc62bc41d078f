"""Approximate nearest neighbours by inner product: an adaptive scan of dimensions within probed lists.

Vectors get one more component that gives all the same norm, so the largest inner product is the least
distance; then they are rotated at random, so that any first d components of a difference estimate its
length. Lists are made around centroids. Within a probed list a query walks column blocks: after each
block a hypothesis test compares the scaled partial distance with the distance of the k-th best so far,
and candidates that would be farther with high probability are abandoned. What is left is scored by the
inner product of the original vectors in double precision.

How many lists to probe is calibrated: ``CALIBRATION`` queries are compared with all vectors, and the
number of lists is the least that holds the ``TARGET`` share of their true neighbours.

Centroids are fitted on at most ``SAMPLE_VALUES`` vector components, chosen by a hash of the id; all
vectors are indexed. Lists are split into tiles of ``TILE`` vectors and their queries into tiles of
``QUERY_TILE``, so a group is bounded whatever the size of a list. Equal vectors are one candidate with
their ``k + 1`` least ids, which is all that a query can return of them.

Defined results: rows with a null id, and vectors that are null, empty, zero, hold a null or non-finite
component or have another length than most, take no part; an id is a row's identity, so rows that share
the query's id are its own and rows equal in id and vector count once; ties go to the smaller id; with
fewer candidates than k all are returned; other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table

K = 20
EVERY = 20  # queries: ids divisible by it
TARGET = 0.97  # share of true neighbours that the probed lists must hold, on the calibration queries
CALIBRATION = 128  # queries compared with all vectors
MOST_LISTS = 4_096
SAMPLE_VALUES = 1 << 21
ROUNDS = 8
TILE = 20_000
QUERY_TILE = 2_000
COLUMNS = 16  # of a block
CANDIDATES = 1_024  # walked together
EPSILON = 2.1  # of the hypothesis test: larger abandons later
SEED = 5


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part, in double precision."""
    vec = F.col(vec_col).cast("array<double>")
    good = F.size(vec) > 0
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(id_col).alias("vec_id"), vec.alias("vec")).filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & good & finite & F.exists(vec, lambda x: x != 0)
    )
    most = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("vec") == (most.d if most else 0)).dropDuplicates()


def named(rows: DataFrame) -> DataFrame:
    """``rows`` with a 128-bit name of the vector."""
    return rows.withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.reverse("vec"), F.lit(1))})


class Space:
    """The rotation and the centroids."""

    def __init__(self, norm: float, rotation: np.ndarray, centroids: np.ndarray, sizes: np.ndarray | None = None):
        self.norm, self.rotation, self.centroids, self.sizes = norm, rotation, centroids, sizes

    def place(self, vectors: np.ndarray, is_query: bool) -> np.ndarray:
        """Vectors in the rotated space of equal norms (queries keep theirs)."""
        more = np.zeros(len(vectors)) if is_query else np.sqrt(np.maximum(0.0, self.norm - (vectors**2).sum(axis=1)))
        return np.column_stack((vectors, more)) @ self.rotation

    def distances(self, placed: np.ndarray) -> np.ndarray:
        """Squared distances to all centroids."""
        c = self.centroids
        return (placed**2).sum(axis=1)[:, None] - 2 * placed @ c.T + (c**2).sum(axis=1)


def fit(points: DataFrame, total: int, dim: int, norm: float) -> Space:
    """Centroids of about the square root of the number of vectors, by Lloyd's rounds on a sample."""
    rng = np.random.default_rng(SEED)
    rotation = np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0]
    most = max(256, SAMPLE_VALUES // dim)
    sample = points.filter(F.pmod(F.xxhash64("k1"), F.lit(max(1, total))) < most).select("vec").toArrow().column("vec")
    vectors = np.array(sample.combine_chunks().flatten().to_numpy()).reshape(-1, dim)
    space = Space(norm, rotation, np.zeros((0, dim + 1)))
    placed = space.place(vectors, False)
    if not len(placed):
        placed = np.zeros((1, dim + 1))
    lists = int(min(MOST_LISTS, len(placed), max(1, np.sqrt(total))))
    space.centroids = placed[rng.permutation(len(placed))[:lists]]
    for _ in range(ROUNDS):
        own = np.concatenate([space.distances(placed[i : i + 4096]).argmin(axis=1) for i in range(0, len(placed), 4096)])
        count = np.bincount(own, minlength=lists)
        sums = np.zeros_like(space.centroids)
        np.add.at(sums, own, placed)
        space.centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], space.centroids)
    return space


def stacked(column) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    return np.stack([np.asarray(x, np.float64) for x in column])


def adaptive_scan(x: np.ndarray, q: np.ndarray, k: int, columns: int = COLUMNS, epsilon: float = EPSILON) -> np.ndarray:
    """Candidates (rows of x) that stay near a query to the last column block.

    ``x`` is stored by columns. Of the candidates walked so far only those no farther than the k-th
    best are returned, ties included.
    """
    n, d = x.shape
    kept, kept_distance, bound = np.zeros(0, np.int64), np.zeros(0), np.inf
    for lo in range(0, n, CANDIDATES):
        alive = np.arange(lo, min(lo + CANDIDATES, n))
        partial = np.zeros(len(alive))
        if bound == np.inf and len(alive) > 4 * k:  # a first bound from whole distances of a few
            first = alive[: 2 * k]
            whole = ((x[first] - q) ** 2).sum(axis=1)
            bound = np.partition(whole, k - 1)[k - 1]
        for c in range(0, d, columns):
            part = x[alive, c : c + columns] - q[c : c + columns]
            partial = partial + np.einsum("ij,ij->i", part, part)
            done = min(c + columns, d)
            if bound < np.inf:
                slack = (1 + epsilon / np.sqrt(done)) ** 2 if done < d else 1 + 1e-9
                near = partial * (d / done) <= bound * slack
                alive, partial = alive[near], partial[near]
                if not len(alive):
                    break
        kept, kept_distance = np.append(kept, alive), np.append(kept_distance, partial)
        if len(kept) >= k:
            bound = np.partition(kept_distance, k - 1)[k - 1]
            near = kept_distance <= bound * (1 + 1e-9)
            kept, kept_distance = kept[near], kept_distance[near]
    return kept


def calibrate(index: DataFrame, queries: DataFrame, space: Space, k: int, target: float) -> int:
    """The least number of probed lists that holds the target share of the true neighbours of some queries."""
    spark = index.sparkSession
    total = max(1, queries.count())
    some = queries.filter(F.pmod(F.xxhash64("k2", F.lit(7)), F.lit(total)) < CALIBRATION).select("vec").collect()
    if not some:
        return 1
    asked = np.array([r.vec for r in some])
    sent = spark.sparkContext.broadcast(asked)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = sent.value
        score, lists = np.zeros((len(q), 0)), np.zeros((len(q), 0), np.int32)
        for batch in batches:
            if batch.num_rows:
                mine = np.broadcast_to(batch.column(0).to_numpy(), (len(q), batch.num_rows))
                score, lists = np.hstack((score, q @ stacked(batch.column(1).to_pylist()).T)), np.hstack((lists, mine))
                if score.shape[1] > k:
                    top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    score, lists = np.take_along_axis(score, top, 1), np.take_along_axis(lists, top, 1)
        n = score.shape[1]
        yield pa.record_batch(
            [pa.array(np.repeat(np.arange(len(q)), n)), pa.array(lists.ravel()), pa.array(score.ravel())], names=["q", "list", "score"]
        )

    found = index.select("list", "vec").mapInArrow(best, "q long, list int, score double")
    order = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "list"))
    rows = found.withColumn("_r", order).filter(F.col("_r") <= k).select("q", "list").collect()
    ranks = space.distances(space.place(asked, True)).argsort(axis=1, kind="stable").argsort(axis=1, kind="stable")
    needed = np.sort([ranks[r.q, r["list"]] + 1 for r in rows])
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])


def search(
    df: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vec_col: str = "embedding",
    target: float = TARGET, tile: int = TILE, query_tile: int = QUERY_TILE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id ``every`` divides."""
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    rows = settle(named(usable(df, id_col, vec_col)), "vectors")
    vector = ["k1", "k2"]
    rank = F.row_number().over(Window.partitionBy(*vector).orderBy("vec_id"))
    points = settle(
        rows.withColumn("_r", rank).filter(F.col("_r") <= k + 1)
        .groupBy(*vector).agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("vec").alias("vec")),
        "points",
    )
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    total, norm, dim = points.agg(F.count("*"), F.max(square), F.max(F.size("vec"))).first()
    space = fit(points, total, dim or 1, norm or 0.0)
    sent = spark.sparkContext.broadcast(vars(space))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Space(**sent.value)
        for batch in batches:
            if batch.num_rows:
                placed = own.place(stacked(batch.column(2).to_pylist()), False)
                yield pa.record_batch([pa.array(own.distances(placed).argmin(axis=1).astype(np.int32)), *batch.columns[1:]], names=["list", "ids", "vec"])

    index = settle(points.select("k1", "ids", "vec").mapInArrow(assign, f"list int, ids array<{kind}>, vec array<double>"), "index")
    # One row for each list, at most MOST_LISTS.
    sizes = index.groupBy("list").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids"))
    per = {r["list"]: (r.n, r.ids) for r in sizes.collect()}
    space.sizes = np.array([per.get(i, (0, 0))[1] for i in range(len(space.centroids))])
    probing = spark.sparkContext.broadcast(vars(space))

    asked = rows.filter(F.col("vec_id") % every == 0)
    queries = settle(asked.groupBy(*vector).agg(F.first("vec").alias("vec")), "queries")
    probes = calibrate(index, queries, space, k, target)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Space(**probing.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            order = own.distances(own.place(stacked(batch.column(2).to_pylist()), True)).argsort(axis=1, kind="stable")
            # At least ``probes`` lists, and as many as it takes to hold k + 1 ids.
            held = own.sizes[order].cumsum(axis=1)
            wanted = np.maximum(probes, (held < k + 1).sum(axis=1) + 1)
            for a in range(0, batch.num_rows, 256):
                take = np.arange(order.shape[1]) < wanted[a : a + 256, None]
                row, at = np.nonzero(take)
                part = batch.slice(a, 256).take(pa.array(row))
                yield pa.record_batch([pa.array(order[a + row, at].astype(np.int32)), *part.columns], names=["list", "k1", "k2", "vec"])

    probed = settle(queries.select("k1", "k2", "vec").mapInArrow(probe, "list int, k1 long, k2 long, vec array<double>"), "probed")
    wants = {r["list"]: r["count"] for r in probed.groupBy("list").count().collect()}
    plan = [(i, max(1, -(-n // tile)), max(1, -(-wants.get(i, 0) // query_tile))) for i, (n, _) in per.items()]
    tiles = F.broadcast(spark.createDataFrame(plan, "list int, tiles int, parts int"))
    held = index.join(tiles, "list").select(
        "list", F.pmod(F.xxhash64("vec"), "tiles").cast("int").alias("tile"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "ids", "vec",
    )
    wanted = probed.join(tiles, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"),
        F.pmod(F.xxhash64("k1"), "parts").cast("int").alias("part"), "k1", "k2", "vec",
    )

    def scan(mine: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = {"k1": [], "k2": [], "vec_id": [], "score": []}
        if len(mine) and len(asking):
            own = Space(**probing.value)
            x, q = stacked(mine["vec"]), stacked(asking["vec"])
            placed, moved = np.asfortranarray(own.place(x, False)), own.place(q, True)
            ids = mine["ids"].tolist()
            least = np.array([i[0] for i in ids])
            for row, (k1, k2) in enumerate(zip(asking["k1"].tolist(), asking["k2"].tolist())):
                near = adaptive_scan(placed, moved[row], k + 1)
                score = (x[near] * q[row]).sum(axis=1)
                best = np.lexsort((least[near], -score))[: k + 1]
                found = sorted((-float(score[b]), i) for b in best for i in ids[near[b]])[: k + 1]
                out["k1"] += [k1] * len(found)
                out["k2"] += [k2] * len(found)
                out["vec_id"] += [i for _, i in found]
                out["score"] += [-s for s, _ in found]
        return pd.DataFrame(out)

    group = ["list", "tile", "part"]
    found = held.groupBy(*group).cogroup(wanted.groupBy(*group)).applyInPandas(scan, f"k1 long, k2 long, vec_id {kind}, score double")
    order = Window.partitionBy(*vector).orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k + 1)
    answers = best.groupBy(*vector).agg(F.array_sort(F.collect_list(F.struct("_r", "vec_id", "score"))).alias("found"))
    mine = asked.select(F.col("vec_id").alias("query_id"), *vector).join(answers, vector)
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = mine.select("query_id", F.posexplode(others).alias("rank", "x"))
    return ranked.select("query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", "x.score")


@query("op9_nearest_neighbours")
def op9(spark, sf_dir):
    """The nearest vectors of every twentieth one."""
    return search(table(spark, sf_dir, "embeddings"))
