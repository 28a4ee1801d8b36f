"""Exact top-k by inner product with a KD-tree for each shard.

The vectors are cut into shards of bounded size, near vectors together: a
KD-tree over a bounded sample gives cells, and a cell with many vectors is
dealt to several shards.  Each shard builds its KD-tree with median splits and
tight bounding boxes.  The queries come in blocks, sorted so that a block
holds near queries, and walk a tree best first: the node whose box allows the
highest inner product with one of the block's queries is next, only the
queries whose k-th score the box can still reach go on into it, and the walk
ends when no node is left that any query could gain from.

Queries and their k-th scores travel, shards don't: each shard is written once,
as a file of the shared folder, and a task reads the file of the shard that its
queries were sent to.  The queries first search the shard that they themselves
lie in, and take the k-th score that they reach there with them.  Every block is
then held against the bounding boxes of all shards (a small row each), and only
queries whose k-th score a box can still reach are sent to its shard: first to
the NEAREST shards of the block, which raises the k-th scores, then to those
that are still within reach.  A task builds a shard's tree once for all queries
that come.  Answers are merged by score and id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.files import arrow_file_system
from .support import Scratch

#: Vectors of a shard, about, and of a leaf at most.  Where boxes rule out few shards, as in many
#: dimensions, a query is sent once for so many vectors.
SHARD_ROWS = 32_768
LEAF_ROWS = 64
#: Bytes of a shard's vectors as 64-bit numbers: long vectors make shards of fewer rows.
SHARD_BYTES = 64_000_000
#: Queries that walk a tree together.
BLOCK_QUERIES = 128
#: Shards that a block of queries goes to before its k-th scores are taken anew.
NEAREST = 4
#: Blocks that walk a shard's tree in one task; a shard that more blocks reach is read by several tasks.
BLOCKS_PER_TASK = 16
#: Bytes of boxes that are broadcast at once.
BOX_BYTES = 64_000_000
#: Vectors that the cells are fitted on at most; it changes which shard a vector is in, never a result.
SAMPLE_ROWS = 8_192
#: Stands for no k-th score yet.
NO_BOUND = -(1 << 63)
#: Largest absolute component whose products float64 sums hold exactly at MAX_DIMENSION.
EXACT = 1 << 20
MAX_DIMENSION = 4096


# --- one tree ---------------------------------------------------------------


@dataclass
class Tree:
    """Nodes of a KD-tree: boxes, children (-1 for a leaf) and the rows of each node."""

    vectors: np.ndarray
    ids: np.ndarray
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray) -> Tree:
        order = np.argsort(ids, kind="stable")
        low, high, left, right, begin, end = [], [], [], [], [], []

        def node(a: int, b: int) -> int:
            own = vectors[order[a:b]]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            for column, value in ((left, -1), (right, -1), (begin, a), (end, b)):
                column.append(value)
            return len(low) - 1

        todo = [node(0, len(ids))]
        while todo:
            at = todo.pop()
            a, b = begin[at], end[at]
            spread = high[at] - low[at]
            if b - a <= LEAF_ROWS or not spread.max():
                continue
            middle = (a + b) // 2  # the median of the widest dimension, so equal values may stand on both sides
            order[a:b] = order[a:b][np.argpartition(vectors[order[a:b], int(spread.argmax())], middle - a)]
            left[at], right[at] = node(a, middle), node(middle, b)
            todo += [left[at], right[at]]
        return cls(vectors[order], ids[order], *(np.array(x) for x in (low, high, left, right, begin, end)))


class Best:
    """The k best (score, id) of each query of a block; smaller ids win ties."""

    def __init__(self, n: int, k: int, bound: np.ndarray):
        self.k = k
        self.scores = np.full((n, k), -np.inf, dtype=bound.dtype)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.bound = bound  # k-th scores from elsewhere

    def least(self) -> np.ndarray:
        return np.maximum(self.scores[:, -1], self.bound)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        """Scores (rows x ids) against what is held; a query's own id doesn't count."""
        good = (scores >= self.least()[rows, None]) & (ids[None, :] != own[rows, None])
        for at in np.flatnonzero(good.any(axis=1)).tolist():
            row, new = rows[at], good[at]
            all_scores = np.concatenate((self.scores[row], scores[at, new]))
            all_ids = np.concatenate((self.ids[row], ids[new]))
            order = np.lexsort((all_ids, -all_scores))[: self.k]
            self.scores[row], self.ids[row] = all_scores[order], all_ids[order]


def search(tree: Tree, queries: np.ndarray, own: np.ndarray, best: Best) -> None:
    """Walk the tree best first with all queries of a block."""
    positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)

    def bounds(node: int, rows: np.ndarray) -> np.ndarray:
        return positive[rows] @ tree.high[node] + negative[rows] @ tree.low[node]

    def push(node: int, rows: np.ndarray) -> None:
        if len(rows):
            reach = bounds(node, rows)
            on = reach >= best.least()[rows]
            if on.any():
                heapq.heappush(heap, (-float((reach[on] - np.maximum(best.least()[rows[on]], -1e300)).max()), node, rows[on], reach[on]))

    heap: list = []
    push(0, np.arange(len(queries)))
    while heap:
        _, node, rows, reach = heapq.heappop(heap)
        rows = rows[reach >= best.least()[rows]]
        if not len(rows):
            continue
        if tree.left[node] < 0:
            a, b = tree.begin[node], tree.end[node]
            best.offer(rows, queries[rows] @ tree.vectors[a:b].T, tree.ids[a:b], own)
        else:
            push(int(tree.left[node]), rows)
            push(int(tree.right[node]), rows)


# --- shards -----------------------------------------------------------------


def scaled(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of every component as long; null for vectors that are null, empty or not finite."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite & (F.size(vector) > 0), F.transform(numbers, lambda x: F.floor(x * factor).cast("long")))


@dataclass(frozen=True)
class Cells:
    """A KD-tree over the sample.  Children of a node are nodes, or cells c written as -1 - c."""

    dimension: np.ndarray
    value: np.ndarray
    children: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, size: int) -> Cells:
        """Median splits until a cell has at most `size` rows of the sample or equal rows only."""
        nodes: list[list] = []
        cells = 0
        todo: list[tuple[np.ndarray, int, int]] = [(sample, -1, 0)]
        while todo:
            own, parent, side = todo.pop()
            spread = own.max(axis=0) - own.min(axis=0) if len(own) > size else np.zeros(1)
            if spread.max() > 0:
                dimension = int(spread.argmax())
                column = own[:, dimension]
                value = max(float(np.median(column)), float(column[column > column.min()].min()))
                at = len(nodes)
                nodes.append([dimension, value, [0, 0]])
                todo += [(own[column < value], at, 0), (own[column >= value], at, 1)]
            else:
                at, cells = -1 - cells, cells + 1
            if parent >= 0:
                nodes[parent][2][side] = at
        return cls(np.array([n[0] for n in nodes], dtype=np.int64), np.array([n[1] for n in nodes]), np.array([n[2] for n in nodes]).reshape(-1, 2))

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Cell of each vector."""
        at = np.zeros(len(vectors), dtype=np.int64) if len(self.value) else np.full(len(vectors), -1)
        while len(inner := np.flatnonzero(at >= 0)):
            node = at[inner]
            right = vectors[inner, self.dimension[node]] >= self.value[node]
            at[inner] = self.children[node, right.astype(np.int64)]
        return -1 - at


def _assign(cells: Cells, width: int):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.asarray(batch.column("v").value_lengths())
            cell = np.zeros(len(batch), dtype=np.int64)
            usual = np.flatnonzero(widths == width)  # other widths have one cell each
            if len(usual):
                cell[usual] = cells.of(np.asarray(batch.column("v").take(pa.array(usual)).flatten()).reshape(-1, width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return assign


def _matrix(values: pa.Array, rows: int) -> np.ndarray:
    """Integers as floats that hold their products exactly."""
    matrix = np.asarray(values).reshape(rows, -1)
    small = matrix.shape[1] <= MAX_DIMENSION and np.abs(matrix).max(initial=0) <= EXACT
    return matrix.astype(np.float64 if small else np.longdouble)


def _shard_tree(folder: str, name: str) -> Tree:
    """The tree of a shard, from its file."""
    from pyarrow import fs as arrow_fs
    from pyarrow import parquet

    store, path = arrow_file_system(f"{folder}/{name}")
    ids, vectors = [], []
    for f in store.get_file_info(arrow_fs.FileSelector(path)):
        if f.base_name.endswith(".parquet"):
            with store.open_input_file(f.path) as file:
                table = parquet.read_table(file, columns=["ids", "v"])
            for row in range(len(table)):
                ids.append(np.asarray(table.column("ids")[row].values))
                vectors.append(_matrix(table.column("v")[row].values, len(ids[-1])))
    return Tree.build(np.concatenate(vectors), np.concatenate(ids))


def _searcher(k: int, folder: str):
    """Map function over blocks of queries, sorted by the shard that they are sent to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tree = None, None
        for batch in batches:
            for row in range(len(batch)):
                name = batch.column("at")[row].as_py()
                if name != at:
                    at, tree = name, _shard_tree(folder, f"at={name}")
                ids = np.asarray(batch.column("ids")[row].values)
                vectors = _matrix(batch.column("v")[row].values, len(ids))
                bound = np.asarray(batch.column("bound")[row].values).astype(np.longdouble)
                bound[bound == NO_BOUND] = -np.inf
                kind = np.result_type(vectors, tree.vectors)
                best = Best(len(ids), k, bound.astype(kind))
                search(tree, vectors.astype(kind), ids, best)
                found = best.ids != np.iinfo(np.int64).max
                query = np.repeat(ids, k)[found.reshape(-1)]
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(best.ids[found]), pa.array(best.scores[found].astype(np.int64))], names=["query_id", "vec_id", "score"])

    return run


def _boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lowest and highest components of each shard."""
    for batch in batches:
        sides: list[list] = [[], []]
        for row in range(len(batch)):
            vectors = np.asarray(batch.column("v")[row].values).reshape(len(batch.column("ids")[row].values), -1)
            sides[0].append(vectors.min(axis=0))
            sides[1].append(vectors.max(axis=0))
        low, high = (pa.array(x, pa.list_(pa.int64())) for x in sides)
        yield pa.RecordBatch.from_arrays([batch.column("width"), batch.column("shard"), low, high], names=["width", "shard", "low", "high"])


_ASKED = "width int, shard long, home long, block int, ids array<long>, v array<long>, bound array<long>"


def _reacher(shared, nearest: bool):
    """Map function: the queries of each block that a shard's box lets hope for more, for the block's nearest shards or for all others."""

    def bounds(values: pa.Array, kind: np.dtype) -> np.ndarray:
        out = np.asarray(values).astype(kind)
        out[out == NO_BOUND] = -np.inf
        return out[:, None]

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes = shared.value
        for batch in batches:
            for row in range(len(batch)):
                width, home, block = (batch.column(c)[row].as_py() for c in ("width", "home", "block"))
                if width not in boxes:
                    continue
                numbers, low, high = boxes[width]
                ids, flat = batch.column("ids")[row].values, np.asarray(batch.column("v")[row].values)
                queries = _matrix(flat, len(ids))
                highest = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
                before, now = (bounds(batch.column(c)[row].values, highest.dtype) for c in ("before", "bound"))
                may = np.flatnonzero((highest >= before).any(axis=0) & (numbers != home))
                hope = (highest[:, may] - np.maximum(before, -1e300)).max(axis=0)
                order = np.argsort(-hope, kind="stable")
                may = np.sort(may[order[:NEAREST]]) if nearest else np.sort(may[order[NEAREST:]])
                on = highest[:, may] >= now
                may, on = may[on.any(axis=0)], on[:, on.any(axis=0)]
                shard, query = np.nonzero(on.T)
                offsets = pa.array(np.concatenate(([0], np.cumsum(on.sum(axis=0)))).astype(np.int32))
                sent = [np.asarray(ids)[query], flat.reshape(len(ids), -1)[query].reshape(-1), np.asarray(batch.column("bound")[row].values)[query]]
                lists = [pa.ListArray.from_arrays(pa.array(np.asarray(offsets) * step, pa.int32()), pa.array(x)) for x, step in zip(sent, (1, width, 1), strict=True)]
                same = [pa.array(np.full(len(may), x), kind) for x, kind in ((width, pa.int32()), (home, pa.int64()), (block, pa.int32()))]
                yield pa.RecordBatch.from_arrays([same[0], pa.array(numbers[may], pa.int64()), *same[1:], *lists], names=["width", "shard", "home", "block", "ids", "v", "bound"])

    return reach


def _box_ranges(boxes: DataFrame) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """{width: (shards, lowest, highest)} of all shards, at most BOX_BYTES (or one box) at a time."""
    held: dict[int, list] = {}
    size = 0

    def packed() -> dict:
        return {w: (np.array([r.shard for r in rows]), *(_matrix(np.array([x for r in rows for x in r[side]]), len(rows)) for side in ("low", "high"))) for w, rows in held.items()}

    for r in boxes.orderBy("width", "shard").toLocalIterator():
        if held and size + 16 * r.width > BOX_BYTES:
            yield packed()
            held, size = {}, 0
        held.setdefault(r.width, []).append(r)
        size += 16 * r.width
    if held:
        yield packed()


def _pack(rows: DataFrame, by: list[str], *more: Column) -> DataFrame:
    """Vectors as one row for each group: ids and v, one after the other, in the order of `spot`."""
    packed = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("spot", "vec_id", "v", *more))).alias("rows"))
    return packed.select(*by, F.transform("rows", lambda x: x["vec_id"]).alias("ids"), F.flatten(F.transform("rows", lambda x: x["v"])).alias("v"), "rows")


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best vectors of each query row, itself left out.

    Scores are inner products of `scaled` vectors, ties go to the smaller id.
    Vectors of different lengths are not compared.  Null vectors and ids,
    empty vectors and those with null or non-finite components take no part;
    of rows that repeat an id, equal ones count once, and others are
    candidates of their own and join their scores as queries.  Other columns
    are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled(F.col(vector_col)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = scratch.keep(rows.where("vec_id IS NOT NULL AND v IS NOT NULL").dropDuplicates(["vec_id", "v"]), "vectors")
    share = min(1.0, SAMPLE_ROWS / max(rows.count(), 1))
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("v").limit(2 * SAMPLE_ROWS).collect()
    widths = [len(r.v) for r in sample]
    width = max(set(widths), key=widths.count) if widths else 1
    known = np.array([r.v for r in sample if len(r.v) == width], dtype=np.float64).reshape(-1, width)
    shard_rows = lambda w: max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * max(w, 1))))
    cells = Cells.fit(known, max(8, int(shard_rows(width) * share)))

    placed = rows.mapInArrow(_assign(cells, width), "vec_id long, v array<long>, is_query boolean, cell long").withColumn("width", F.size("v"))
    placed = scratch.keep(placed, "placed")
    # Shards are numbered within a width.  There are at most SAMPLE_ROWS / 4 cells of the usual width, and one of each other.
    sizes = placed.groupBy("width", "cell").agg(F.count("*").alias("n")).orderBy("width", "cell").collect()
    numbered, shards_of = [], {}
    for r in sizes:
        shards = -(-r.n // shard_rows(r.width))
        numbered.append((r.width, r.cell, shards_of.get(r.width, 0), shards))
        shards_of[r.width] = shards_of.get(r.width, 0) + shards
    numbers = F.broadcast(spark.createDataFrame(numbered, "width int, cell long, first long, shards long"))
    placed = placed.join(numbers, ["width", "cell"])
    placed = placed.select("width", "vec_id", "v", "is_query", (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("shards"))).alias("shard"))
    name_of = F.concat_ws("_", "width", "shard").alias("at")
    candidates = scratch.keep(_pack(placed.withColumn("spot", F.lit(0)), ["width", "shard"]).drop("rows").select("*", name_of), "shards", by="at")

    boxes = scratch.keep(candidates.mapInArrow(_boxes, "width int, shard long, low array<long>, high array<long>"), "boxes")

    # Queries in blocks of near ones: those of a shard, dealt by a hash.
    queries = placed.where("is_query").withColumnRenamed("shard", "home")
    counts = queries.groupBy("width", "home").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("blocks"))
    queries = queries.join(counts, ["width", "home"]).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("blocks")).cast("int"))
    queries = scratch.keep(queries.select("home", "width", "block", "vec_id", "v"), "queries")

    def searched(asked: DataFrame, name: str) -> DataFrame:
        """Answers (query_id, vec_id, score) to blocks (width, shard, home, block, ids, v, bound)."""
        parts = asked.groupBy("width", "shard").agg(F.ceil(F.count("*") / BLOCKS_PER_TASK).cast("int").alias("parts"))
        dealt = asked.join(parts, ["width", "shard"]).withColumn("part", F.pmod(F.xxhash64("home", "block"), F.col("parts")).cast("int"))
        rows = dealt.select(name_of, "part", "ids", "v", "bound").repartition("at", "part").sortWithinPartitions("at", "part")
        return scratch.keep(rows.mapInArrow(_searcher(k, candidates._scratch_path), "query_id long, vec_id long, score long"), name)

    def blocks_of(rows: DataFrame) -> DataFrame:
        blocks = _pack(rows.withColumn("spot", F.col("vec_id")), ["home", "width", "block"], F.col("bound"), F.col("before"))
        of = lambda name: F.transform("rows", lambda x: x[name]).alias(name)
        return scratch.keep(blocks.select("home", "width", "block", "ids", "v", of("bound"), of("before")), "blocks")

    def reached(blocks: DataFrame, nearest: bool) -> DataFrame:
        found: DataFrame | None = None
        for boxes_now in _box_ranges(boxes):
            shared = spark.sparkContext.broadcast(boxes_now)
            asked = blocks.mapInArrow(_reacher(shared, nearest), _ASKED)
            found = scratch.keep(asked, "asked") if found is None else scratch.add(asked, found)
            shared.destroy()
        return spark.createDataFrame([], _ASKED) if found is None else found

    def kth(answers: DataFrame, name: str) -> DataFrame:
        """The k-th score of each query that has so many answers."""
        best = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        return scratch.keep(best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias(name)), name)

    none = F.lit(NO_BOUND)
    at_home = blocks_of(queries.select("*", none.alias("before"), none.alias("bound"))).withColumn("shard", F.col("home"))
    home = searched(at_home.select("width", "shard", "home", "block", "ids", "v", "bound"), "home")
    queries = queries.join(kth(home, "before"), "vec_id", "left").withColumn("before", F.coalesce("before", none))
    near = home.union(searched(reached(blocks_of(queries.withColumn("bound", F.col("before"))), True), "near"))
    queries = queries.join(kth(near, "bound"), "vec_id", "left").withColumn("bound", F.coalesce("bound", none))
    found = near.union(searched(reached(blocks_of(queries), False), "far"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
