"""Exact top-k search by inner product: cells of a ball tree, a tree per shard, branch and bound."""

import heapq
import io

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from urbanstats.llm.common import stored

# Distinct vectors per shard and queries per block, about; both fit in a task many times.
SHARD_VECTORS = 8192
BLOCK_QUERIES = 2048
LEAF = 64
# Cells at most, vectors that they are fitted on, and so many of these per cell at least;
# cells that a query goes to after the first one, before the rest.
CELLS = 1024
SAMPLE_VECTORS = 20_000
SAMPLE_PER_CELL = 16
NEAR_CELLS = 4

_NONE = np.int64(-(1 << 63))
_FAR = np.int64((1 << 63) - 1)


def integer_vectors(vectors, scale=256, also=()):
    """Rows (vec_id, v) and the columns of ``also``: each component as floor(scale * x) of x as a double.

    Rows with a NULL id, a NULL vector, or a component that is NULL or not finite take no
    part. Equal rows count once. Vectors of different lengths compare as if the shorter
    one ended in zeros. Inner products must fit in 64 bits.
    """
    parts = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(usable)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform(parts, lambda x: F.floor(x * scale)).alias("v"),
            *also,
        )
        .distinct()
    )


class BallTree:
    """Balls around halves of halves of the points, down to leaves of LEAF points.

    Node i covers points[start[i]:stop[i]]; its children are listed after it. Each point
    carries the smallest ids of the rows that hold it.
    """

    def __init__(self, points, ids, nodes):
        self.points, self.ids = points, ids
        self.start, self.stop, self.left, self.right, self.radius, self.centre = nodes

    @classmethod
    def build(cls, points, ids):
        """``ids`` has a row per point, filled up with _FAR."""
        real = points.astype(np.float64)
        order = np.arange(len(points))
        start, stop, left, right, radius, centre = [], [], [], [], [], []
        todo = [(0, len(points), None)]
        while todo:
            a, b, link = todo.pop()
            node = len(start)
            if link is not None:
                link[0][link[1]] = node
            at = order[a:b]
            c = real[at].mean(0)
            far = np.sqrt(((real[at] - c) ** 2).sum(1))
            for column, value in zip((start, stop, left, right, radius, centre), (a, b, -1, -1, far.max(), c)):
                column.append(value)
            if b - a > LEAF:
                # Along the line between two far points, cut at the median.
                p = real[at[far.argmax()]]
                q = real[at[((real[at] - p) ** 2).sum(1).argmax()]]
                side = real[at] @ (q - p)
                half = (b - a) // 2
                order[a:b] = at[np.argpartition(side, half)]
                todo += [(a, a + half, (left, node)), (a + half, b, (right, node))]
        columns = (start, stop, left, right, radius, centre)
        return cls(points[order], ids[order], [np.array(c) for c in columns])

    def to_bytes(self):
        out = io.BytesIO()
        names = ("start", "stop", "left", "right", "radius", "centre", "points", "ids")
        np.savez(out, **{n: getattr(self, n) for n in names})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw):
        f = np.load(io.BytesIO(raw))
        return cls(f["points"], f["ids"], [f[n] for n in ("start", "stop", "left", "right", "radius", "centre")])

    def search(self, query_ids, queries, kth, k):
        """The best of this shard for each query, as (scores, ids) of k columns.

        ``kth`` is a score that each query's k-th result is known to reach. It rises as
        better points are found, and all nodes that cannot reach it are skipped. A node
        that can just reach it is searched, as a smaller id wins a tie.
        """
        n = len(queries)
        scores, ids = np.full((n, k), _NONE), np.full((n, k), _FAR)
        kth = kth.copy()
        if not len(self.points) or not n:
            return scores, ids
        width = max(queries.shape[1], self.points.shape[1])
        q, points = _wide(queries, width), _wide(self.points, width)
        centre = _wide(self.centre, width)
        qf = q.astype(np.float64)
        length = np.sqrt((qf**2).sum(1))
        top = np.abs(q).max(initial=0) * float(np.abs(points).max(initial=0)) * max(1, width)
        fits = top < 2.0**52
        # Bounds are rounded; this much more makes them safe.
        slack = 1.0 + 1e-9 * top

        def bound(node, who):
            return qf[who] @ centre[node] + length[who] * self.radius[node] + slack

        everyone = np.arange(n)
        first = bound(0, everyone)
        queue = [(-first.max(), 0, everyone, first)]
        while queue:
            _, node, who, reach = heapq.heappop(queue)
            open_ = reach >= kth[who]
            who = who[open_]
            if not len(who):
                continue
            if self.left[node] >= 0:
                for child in (int(self.left[node]), int(self.right[node])):
                    reach = bound(child, who)
                    may = reach >= kth[who]
                    if may.any():
                        heapq.heappush(queue, (-reach[may].max(), child, who[may], reach[may]))
                continue
            a, b = self.start[node], self.stop[node]
            if fits:
                found = (qf[who] @ points[a:b].astype(np.float64).T).astype(np.int64)
            else:
                found = q[who] @ points[a:b].T
            hit = found.max(1) >= kth[who]
            who, found = who[hit], found[hit]
            if not len(who):
                continue
            point, column = np.nonzero(self.ids[a:b] != _FAR)
            names = self.ids[a:b][point, column]
            entry = np.where(names == query_ids[who][:, None], _NONE, found[:, point])
            name = np.where(entry == _NONE, _FAR, names)
            entry, name = np.concatenate((scores[who], entry), 1), np.concatenate((ids[who], name), 1)
            best = np.lexsort((name, -(entry + 1)), axis=1)[:, :k]
            scores[who] = np.take_along_axis(entry, best, 1)
            ids[who] = np.take_along_axis(name, best, 1)
            kth[who] = np.maximum(kth[who], scores[who, -1])
        return scores, ids


def _wide(rows, width):
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def _matrix(rows, width=None):
    """Lists of any lengths as a matrix, zeros at the end of short ones."""
    width = max([1, *map(len, rows)]) if width is None else width
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


class Cells:
    """The upper levels of a ball tree over a sample: every vector lands in one cell.

    Each level halves the largest part of the sample at the median along the line between
    two far points. A cell's ball stands around the mean of its sample.
    """

    def __init__(self, sample, cells):
        self.width = max(1, sample.shape[1] if sample.ndim == 2 else 1)
        real = np.asarray(sample, np.float64).reshape(-1, self.width)
        # An inner node has a direction, a threshold and two children; a leaf its cell.
        self.nodes, self.centres = [None], []
        parts = [(0, np.arange(len(real)))]
        done = []
        while parts and len(parts) + len(done) < cells:
            parts.sort(key=lambda x: len(x[1]))
            node, at = parts.pop()
            split = self._split(real[at]) if len(at) > 1 else None
            if split is None:
                done.append((node, at))
                continue
            direction, threshold, upper = split
            self.nodes[node] = (direction, threshold, len(self.nodes), len(self.nodes) + 1)
            parts += [(len(self.nodes), at[~upper]), (len(self.nodes) + 1, at[upper])]
            self.nodes += [None, None]
        for node, at in parts + done:
            self.nodes[node] = len(self.centres)
            self.centres.append(real[at].mean(0) if len(at) else np.zeros(self.width))
        self.centres = np.array(self.centres)

    @staticmethod
    def _split(real):
        far = real[((real - real.mean(0)) ** 2).sum(1).argmax()]
        direction = real[((real - far) ** 2).sum(1).argmax()] - far
        side = real @ direction
        threshold = float(np.median(side))
        upper = side > threshold
        return (direction, threshold, upper) if upper.any() else None

    def of(self, points):
        """The cell of each point, and its distance from the cell's centre."""
        real = _fitted(points, self.width).astype(np.float64)
        cell = np.zeros(len(real), np.int64)
        todo = [(0, np.arange(len(real)))]
        while todo:
            node, at = todo.pop()
            if isinstance(self.nodes[node], tuple):
                direction, threshold, low, high = self.nodes[node]
                upper = real[at] @ direction > threshold
                todo += [(low, at[~upper]), (high, at[upper])]
            else:
                cell[at] = self.nodes[node]
        # What a point has beyond the sample's width counts in full.
        rest = (points[:, self.width :].astype(np.float64) ** 2).sum(1)
        return cell, np.sqrt(((real - self.centres[cell]) ** 2).sum(1) + rest)

    def bounds(self, queries, radius, most):
        """Highest inner product that each query can have with a point of each cell."""
        real = queries.astype(np.float64)
        top = np.abs(real).max(initial=0) * most * max(self.width, queries.shape[1])
        with_centre = _fitted(queries, self.width).astype(np.float64) @ self.centres.T
        # Rounded: this much more makes it safe.
        return with_centre + np.sqrt((real**2).sum(1))[:, None] * radius + 1.0 + 1e-9 * top


def _fitted(rows, width):
    """Rows cut or filled with zeros to ``width``."""
    return _wide(rows[:, :width], max(width, min(rows.shape[1], width)))


def _celled(points, k, cells):
    """Rows (v, ids, cell, far): distinct vectors with their smallest ids, cell and distance."""
    best = Window.partitionBy("v").orderBy("vec_id")
    # The k + 1 smallest ids of a vector are all that can be among the results: one may
    # be the query's own. Spark applies such a limit before the shuffle too.
    kept = points.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    distinct = kept.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))

    def place(batches):
        for batch in batches:
            cell, far = cells.of(_matrix(batch["v"].tolist()))
            yield batch.assign(cell=cell, far=far)

    return distinct.mapInPandas(place, "v array<long>, ids array<long>, cell long, far double")


def _trees(celled, k):
    """Rows (cell, shard, tree): each shard of a cell's distinct vectors as a ball tree."""

    def build(rows):
        ids = np.full((len(rows), k + 1), _FAR)
        for i, some in enumerate(rows["ids"]):
            ids[i, : len(some)] = some
        tree = BallTree.build(_matrix(rows["v"].tolist()), ids)
        return pd.DataFrame(
            {"cell": [rows["cell"].iloc[0]], "shard": [rows["shard"].iloc[0]], "tree": [tree.to_bytes()]}
        )

    return celled.groupBy("cell", "shard").applyInPandas(build, "cell long, shard long, tree binary")


def _numbers(n):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))


_PAIRS = "query_id long, v array<long>, kth long, cell long"


def admitted(queries, cells, radius, most, first, last):
    """Rows (query_id, v, kth, cell): the cells that may hold a result of a query.

    Cells are taken in order of their bound, from the ``first`` place to before the
    ``last`` one, and only while the bound reaches the query's k-th score so far.
    """

    def pick(batches):
        for batch in batches:
            bounds = cells.bounds(_matrix(batch["v"].tolist()), radius, most)
            order = np.argsort(-bounds, axis=1, kind="stable")[:, first:last]
            reach = np.take_along_axis(bounds, order, 1)
            row, place = np.nonzero(reach >= batch["kth"].to_numpy(np.float64)[:, None])
            out = batch.iloc[row][["query_id", "v", "kth"]]
            yield out.assign(cell=order[row, place])

    return queries.select("query_id", "v", "kth").mapInPandas(pick, _PAIRS)


def _search(pairs, trees, shards, k, block_queries):
    """The best of each admitted cell, for blocks of queries and one tree at a time."""
    # One row per cell, of which there are CELLS at most.
    asked = pairs.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_queries).alias("blocks"))
    plan = shards.join(F.broadcast(asked), "cell").select("cell", "shards", "blocks").collect()
    spark = pairs.sparkSession
    ours, theirs = (F.broadcast(spark.createDataFrame(plan, "cell long, shards long, blocks long")) for _ in "lr")

    def search(rows, tree):
        schema = ["query_id", "vec_id", "score"]
        if not len(rows) or not len(tree):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in schema})
        ball, names = BallTree.from_bytes(tree["tree"].iloc[0]), rows["query_id"].to_numpy(np.int64)
        floor = rows["kth"].to_numpy(np.int64)
        scores, ids = ball.search(names, _matrix(rows["v"].tolist()), floor, k)
        real = ids != _FAR
        return pd.DataFrame(
            {"query_id": np.repeat(names, k)[real.ravel()], "vec_id": ids[real], "score": scores[real]}
        )

    key = ["cell", "shard", "block"]
    block = F.pmod(F.xxhash64("query_id"), F.col("blocks"))
    left = pairs.join(ours, "cell").withColumn("shard", _numbers("shards")).withColumn("block", block)
    right = trees.join(theirs, "cell").withColumn("block", _numbers("blocks"))
    cogroup = left.groupBy(*key).cogroup(right.groupBy(*key))
    return cogroup.applyInPandas(search, "query_id long, vec_id long, score long")


def top_k(
    vectors,
    is_query,
    k=5,
    scale=256,
    shard_vectors=SHARD_VECTORS,
    block_queries=BLOCK_QUERIES,
    sample_vectors=SAMPLE_VECTORS,
):
    """The ``k`` rows of highest inner product with each query: query_id, rank, vec_id, score.

    ``vectors`` has the columns vec_id and embedding; ``is_query`` is a condition on
    vec_id. Components are made integers first, see ``integer_vectors``. A row with the
    query's own id is no candidate; ties go to the smaller vec_id; fewer candidates than
    ``k`` all come out. Where a query id has several vectors, the one that sorts first
    asks. No vectors or no queries give an empty result.

    Vectors are dealt to cells by the upper levels of a ball tree that is fitted on a
    sample (the ``sample_vectors`` with the smallest hashes); every vector lands in a cell,
    whose radius is that of all its vectors. A cell with over ``shard_vectors`` of them has
    several shards, each a ball tree of its own. A query goes to the cell of the highest
    bound, then to the next few, then to the rest, each time only where the bound reaches
    the k-th score found so far; that goes along and prunes within the trees. A task holds
    one tree and one block of queries.
    """
    spark = vectors.sparkSession
    points = stored(integer_vectors(vectors, scale), "topk_points")
    asked = points.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    n_points = points.count()
    chosen = points.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(sample_vectors).collect()
    sample = _matrix([r["v"] for r in chosen])
    count = max(1, min(CELLS, -(-n_points // shard_vectors), len(chosen) // SAMPLE_PER_CELL))
    cells = Cells(sample, count)
    celled = stored(_celled(points, k, cells), "topk_cells")
    stats = celled.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("far").alias("far"), F.max(F.array_max("v")), F.min(F.array_min("v"))
    ).collect()
    radius = np.full(len(cells.centres), -np.inf)
    for r in stats:
        radius[r["cell"]] = r["far"] * (1 + 1e-9)
    most = float(max((max(r[3] or 0, -(r[4] or 0)) for r in stats), default=0))
    shards = spark.createDataFrame([(r["cell"], -(-r["n"] // shard_vectors)) for r in stats], "cell long, shards long")
    own = F.pmod(F.xxhash64("v"), F.col("shards"))
    trees = stored(_trees(celled.join(F.broadcast(shards), "cell").withColumn("shard", own), k), "topk_trees")
    nothing = F.lit(int(_NONE)).cast("long")
    queries = asked.select(F.col("vec_id").alias("query_id"), "v", nothing.alias("kth"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = None
    for name, first, last in (("home", 0, 1), ("near", 1, 1 + NEAR_CELLS), ("rest", 1 + NEAR_CELLS, None)):
        if first >= len(cells.centres):
            break
        pairs = stored(admitted(queries, cells, radius, most, first, last), f"topk_{name}_pairs")
        new = _search(pairs, trees, shards, k, block_queries)
        rows = new if found is None else found.select("query_id", "vec_id", "score").unionByName(new)
        ranked = rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        found = stored(ranked, f"topk_{name}")
        known = found.filter(F.col("rank") == k).select("query_id", F.col("score").alias("reached"))
        queries = asked.withColumnRenamed("vec_id", "query_id").join(known, "query_id", "left").select(
            "query_id", "v", F.coalesce("reached", nothing).alias("kth")
        )
    return found.select("query_id", "rank", "vec_id", "score")
