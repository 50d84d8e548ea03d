"""Exact top-k by inner product: a KD-tree for each shard, best-first under box bounds, shards by a coarse KD-tree."""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salvor.llm.common import bounded, staged, table

TOP = 20
SHARD_ROWS = 16_384
BLOCK_QUERIES = 1024
LEAF_ROWS = 256
# Cells of the coarse tree: what every task has is a box for each. The sample that it is grown on.
MOST_CELLS = 4096
SAMPLE_ROWS = 20_000
EXACT = 2.0**53


class Tree:
    """Median splits along the widest side; every node, inner ones too, is a range of rows with its tight box."""

    def __init__(self, points: np.ndarray, leaf_rows: int):
        order = np.arange(len(points))
        self.start, self.stop, self.children = [0], [len(points)], [(0, 0)]
        at = 0
        while at < len(self.start):
            start, stop = self.start[at], self.stop[at]
            part = points[order[start:stop]]
            spread = part.max(axis=0) - part.min(axis=0) if part.size else np.zeros(1)
            if stop - start > leaf_rows and spread.max() > 0:
                middle = (stop - start) // 2
                order[start:stop] = order[start:stop][np.argpartition(part[:, spread.argmax()], middle)]
                self.children[at] = (len(self.start), len(self.start) + 1)
                for low, high in ((start, start + middle), (start + middle, stop)):
                    self.start.append(low)
                    self.stop.append(high)
                    self.children.append((0, 0))
            at += 1
        self.order = order
        self.points = points[order]
        ends = list(zip(self.start, self.stop))
        self.low = np.array([self.points[a:b].min(axis=0) for a, b in ends]).reshape(len(ends), points.shape[1])
        self.high = np.array([self.points[a:b].max(axis=0) for a, b in ends]).reshape(len(ends), points.shape[1])

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product that a node's box allows, for each query and node."""
        return box_bounds(queries, self.low, self.high)


def box_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products with points in each box. Bounds of very large numbers carry rounding, so they
    are widened by more than that; a visit too many costs time only."""
    bound = np.maximum(queries, 0.0) @ high.T + np.minimum(queries, 0.0) @ low.T
    return bound + np.abs(bound) * 1e-9


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exact: in doubles where no sum can pass 2^53, else in integers."""
    most = (np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0)) * max(1, a.shape[1])
    if most < EXACT:
        return a @ b.T
    return a.astype(np.int64) @ b.astype(np.int64).T


def best(queries: np.ndarray, query_rows: np.ndarray, floors: np.ndarray, tree: Tree, rows: np.ndarray, ids: np.ndarray, k: int):
    """For each query its k best points of the tree but its own row, with a score not below its floor, as (query's place, id, score).

    Best-first: the open node with the highest bound is opened next, and the walk ends when that bound is below the k-th score
    so far (or the floor, a k-th score found elsewhere), as all others are lower still. An equal bound is opened, as a tie
    may have a smaller id. ``rows`` and ``ids`` are in the tree's order.
    """
    found, bounds = [], tree.bounds(queries)
    for who, query in enumerate(queries):
        level, heap, open_nodes = float(floors[who]), [], [(-bounds[who, 0], 0)]
        while open_nodes and -open_nodes[0][0] >= level:
            _, node = heapq.heappop(open_nodes)
            left, right = tree.children[node]
            if left:
                for child in (left, right):
                    if bounds[who, child] >= level:
                        heapq.heappush(open_nodes, (-bounds[who, child], child))
                continue
            start, stop = tree.start[node], tree.stop[node]
            scores = products(query[None], tree.points[start:stop])[0]
            for j in np.flatnonzero(scores >= level):
                if rows[start + j] == query_rows[who]:
                    continue
                item = (int(scores[j]), -int(ids[start + j]))
                if len(heap) < k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)
                if len(heap) == k:
                    level = max(level, float(heap[0][0]))
        found += [(who, -v, s) for s, v in heap]
    return found


class Cells:
    """A coarse KD-tree over a bounded sample: which cell a vector of that length falls into."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.axis, self.cut, self.next = [0], [0.0], [(-1, -1)]
        parts, self.count = [(0, sample, cells)], 0
        while parts:
            node, part, wanted = parts.pop()
            spread = part.max(axis=0) - part.min(axis=0) if part.size else np.zeros(1)
            if wanted < 2 or len(part) < 2 or not spread.max() > 0:
                self.next[node] = (-1, self.count)
                self.count += 1
                continue
            axis = int(spread.argmax())
            values = np.sort(part[:, axis])
            cut = values[(len(values) - 1) // 2]
            if cut == values[-1]:  # so many equal ones that the median is the highest
                cut = values[np.searchsorted(values, cut) - 1]
            self.axis[node], self.cut[node], self.next[node] = axis, float(cut), (len(self.axis), len(self.axis) + 1)
            for side in (part[part[:, axis] <= cut], part[part[:, axis] > cut]):
                parts.append((len(self.axis), side, wanted // 2))
                self.axis.append(0)
                self.cut.append(0.0)
                self.next.append((-1, -1))
        self.axis, self.cut, self.next = np.array(self.axis), np.array(self.cut), np.array(self.next)

    def of(self, v: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(v), int), np.arange(len(v))
        while (inner := self.next[at, 0] >= 0).any():
            right = v[rows, self.axis[at]] > self.cut[at]
            at = np.where(inner, np.where(right, self.next[at, 1], self.next[at, 0]), at)
        return self.next[at, 1]


FOUND = "query_row long, query_id long, vec_id long, score long"


def search(vectors: DataFrame, wanted: Column, *, id_column: str = "vec_id", column: str = "embedding", scale: float = 64.0, k: int = TOP,
           shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, leaf_rows: int = LEAF_ROWS, most_cells: int = MOST_CELLS, each_row: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: for each vector that ``wanted`` selects, its k best others by the
    inner product of floor(scale * x), ties to the smaller id.

    1. A coarse KD-tree over a bounded sample deals the vectors to cells, ``most_cells`` at most; a cell of more than
       ``shard_rows`` vectors is several shards, by hash. Every shard grows its KD-tree once, and keeps it with its tight box.
    2. Each query first meets the cell whose box allows the highest score. Its k-th score there is its floor.
    3. It then meets only the other cells whose box allows its floor, and walks their trees best-first.

    A task holds a shard's tree and a block of queries; the boxes of all cells, whose number is bounded, are what every task has.
    Where boxes prune little, as with many even dimensions, a query meets many cells; results are exact all the same.

    Vectors that are null, or hold null or non-finite components, take no part; nor do missing ids. An id
    that repeats counts once, with its smallest vector, or with ``each_row`` each of its rows is a candidate, for the other rows of
    that id too, and a query of its own where it is wanted; ties of score and id then need no further order, as their rows come
    out alike. Only vectors of equal length are compared. With
    fewer than k others, all are returned; an empty table gives no rows.
    """
    whole = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(column).alias("v"), wanted.alias("wanted"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    whole = whole.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    whole = whole.withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double")))
    if not each_row:
        whole = whole.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("wanted").alias("wanted"))
    # The number of a row holds as it is written once.
    whole = staged(whole.withColumn("size", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    cells = {}
    for length, some, n in sample_by_length(whole):
        cells[length] = Cells(some, min(most_cells, 1 << max(0, (-(-n // shard_rows) - 1).bit_length())))

    @F.pandas_udf("int")
    def cell_of(v: pd.Series, size: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int32)
        for length in size.unique():
            at = np.flatnonzero(size.to_numpy() == length)
            if length in cells and length:
                out[at] = cells[length].of(np.stack(v.to_numpy()[at]))
        return pd.Series(out)

    placed = whole.withColumn("cell", cell_of("v", "size"))
    sizes = placed.groupBy("size", "cell").agg(F.ceil(F.count("*") / F.lit(shard_rows)).cast("int").alias("parts"))
    placed = placed.join(bounded(sizes, "cell-sizes"), ["size", "cell"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))

    def plant(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(np.array(rows["v"].tolist(), float).reshape(len(rows), key[0]), leaf_rows)
        kept = {"tree": tree.__dict__, "rows": rows["row"].to_numpy()[tree.order], "ids": rows["vec_id"].to_numpy()[tree.order]}
        return pd.DataFrame([(*key, pickle.dumps(kept), tree.low[0].tolist(), tree.high[0].tolist())], columns=["size", "cell", "part", "tree", "low", "high"])

    planted = placed.select("size", "cell", "part", "row", "vec_id", "v").groupBy("size", "cell", "part")
    trees = staged(planted.applyInPandas(plant, "size int, cell int, part int, tree binary, low array<double>, high array<double>"), "trees")
    # A row for each shard; those of a cell are joined to one box, of a bounded number of cells.
    ends = [F.min("low").alias("low"), F.max("high").alias("high")]
    sides = trees.select("size", "cell", F.posexplode(F.arrays_zip("low", "high")).alias("axis", "end")).select("size", "cell", "axis", "end.*")
    hulls = sides.groupBy("size", "cell", "axis").agg(*ends).groupBy("size", "cell").agg(F.array_sort(F.collect_list(F.struct("axis", "low", "high"))).alias("b"))
    boxes: dict[int, tuple[list, list, list]] = {}
    for r in hulls.select("size", "cell", F.col("b.low").alias("low"), F.col("b.high").alias("high")).collect():
        for into, value in zip(boxes.setdefault(r["size"], ([], [], [])), (r["cell"], r["low"], r["high"])):
            into.append(value)
    boxes = {length: tuple(map(np.array, parts)) for length, parts in boxes.items()}

    def near_cells(floors: bool):
        """The cell of the highest bound; with ``floors`` all others whose bound reaches the floor."""

        def of(v: pd.Series, size: pd.Series, floor: pd.Series) -> pd.Series:
            out = [[] for _ in range(len(v))]
            for length in size.unique():
                at = np.flatnonzero(size.to_numpy() == length)
                if length not in boxes:  # vectors without components: one cell
                    for i in at:
                        out[i] = [] if floors else [0]
                    continue
                names, low, high = boxes[length]
                for start in range(0, len(at), 256):
                    some = at[start : start + 256]
                    bound = box_bounds(np.stack(v.to_numpy()[some]), low, high)
                    first = bound.argmax(axis=1)
                    for line, top, i in zip(bound, first, some):
                        out[i] = [int(names[j]) for j in np.flatnonzero(line >= floor[i]) if j != top] if floors else [int(names[top])]
            return pd.Series(out)

        return F.pandas_udf(of, "array<int>")

    shards = bounded(trees.select("size", "cell", "part"), "shards")
    queries = whole.filter("wanted").select("row", "vec_id", "v", "size")

    def meet(asking: DataFrame, floors: bool) -> DataFrame:
        """The queries at every shard of the cells they are sent to, in blocks; a tree is read, not grown, for each block."""
        sent = asking.withColumn("cell", F.explode(near_cells(floors)("v", "size", "floor"))).join(shards, ["size", "cell"])
        sent = staged(sent, "queries-sent")
        blocks = sent.groupBy("size", "cell", "part").agg(F.ceil(F.count("*") / F.lit(block_queries)).cast("int").alias("blocks"))
        at = ["size", "cell", "part"]
        left = sent.join(blocks, at).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
        # New names for the columns: both sides come from one table.
        own = blocks.select(*[F.col(c).alias(c) for c in blocks.columns])
        right = trees.select(*at, "tree").join(own, at).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return left.groupBy(*at, "block").cogroup(right.groupBy(*at, "block")).applyInPandas(walk, FOUND)

    def walk(asking: pd.DataFrame, having: pd.DataFrame) -> pd.DataFrame:
        found = []
        for kept in having["tree"] if len(asking) else []:
            kept = pickle.loads(kept)
            tree = Tree.__new__(Tree)
            tree.__dict__.update(kept["tree"])
            a = np.array(asking["v"].tolist(), float).reshape(len(asking), tree.points.shape[1])
            rows_, ids = asking["row"].tolist(), asking["vec_id"].tolist()
            for i, v, s in best(a, asking["row"].to_numpy(), asking["floor"].to_numpy(float), tree, kept["rows"], kept["ids"], k):
                found.append((rows_[i], ids[i], v, s))
        return pd.DataFrame(found, columns=["query_row", "query_id", "vec_id", "score"]).astype("int64")

    first = staged(meet(queries.withColumn("floor", F.lit(float("-inf"))), False), "nearest-home")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    floors = ranked.filter(F.col("rank") == k).select("query_row", F.col("score").cast("double").alias("floor"))
    lifted = queries.join(floors, queries["row"] == floors["query_row"], "left").drop("query_row").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    every = ranked.drop("rank").unionByName(meet(lifted, True))
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def sample_by_length(whole: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[int, np.ndarray, int]]:
    """(length, sampled vectors, their whole number) of the most frequent lengths; about ``rows`` vectors in all, by hash."""
    sizes = whole.filter("size > 0").groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(64).collect()
    total = sum(r["n"] for r in sizes)
    if not total:
        return []
    share = min(1.0, rows / total)
    drawn = whole.filter(F.col("size").isin([r["size"] for r in sizes]) & (F.pmod(F.xxhash64("row", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))))
    some: dict[int, list] = {}
    for r in drawn.select("size", "v").orderBy(F.xxhash64("row")).limit(2 * rows).collect():
        some.setdefault(r["size"], []).append(r["v"])
    return [(r["size"], np.array(some[r["size"]], float), r["n"]) for r in sizes if r["size"] in some]


def query(spark, folder: str) -> DataFrame:
    return search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, each_row=True)


SQL = """
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.r, q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.r <> c.r and len(q.v) = len(c.v)
  where q.vec_id % 20 = 0
)
select query_id, row_number() over (partition by r order by score desc, vec_id)::int as rank, vec_id, score
from s
qualify rank <= 20
"""
