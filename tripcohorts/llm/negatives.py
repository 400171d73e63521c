"""Hard-negative mining by inner product, with a multiway hyperplane tree (GNAT).

Vectors get one more component that gives all of them the same length M, anchors a zero there; then
the inner product with an anchor falls exactly as the distance from it grows, and a window of scores
is an annulus. The tree is fitted on a bounded sample: a node holds split points, far from each other,
and each vector belongs to the nearest one. All rows are put into the tree, and for every split point
the least and greatest distance to the rows below each sibling is kept, by grouped aggregates. A
subtree whose ranges cannot meet the annulus of a window is left out, by the triangle inequality;
leaves that remain are scored exactly, on integers.

A search has two rounds. The first looks into a few near leaves. Its k-th best score narrows
the window, and the second looks into all other leaves that the narrowed window may meet. So the
result is that of a search in all rows. Rows of a leaf are dealt into parts of bounded size, and
so are anchors; no task holds more than one part of both.

Edge cases: rows with a null id, label or vector, or with a null, non-finite or huge component (32,768
or more, whose scores need not fit a long a hundred times) take no part. Vectors shorter than the longest count as
ending in zeros. Repeated rows are rows of their own: a copy of an anchor may be its positive, and copies
come one after the other. An anchor without positives, and a window that holds nothing, give no rows.
An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripcohorts.llm.common import arrow_schema, written

#: Rows that the split points are chosen from, children of a node, sampled rows that are not split further.
TREE_SAMPLE, FAN_OUT, LEAF_SAMPLE = 20_000, 16, 100

#: Rows of a leaf, and anchors, that meet in one task.
ROWS_TOGETHER, ANCHORS_TOGETHER = 16_384, 4_096

#: Near leaves of the first round; anchors that are scored or routed at a time.
FIRST_LEAVES, AT_A_TIME = 12, 128

#: Components of this size and more, after scaling, take no part; bounds of a window without bounds.
HUGE, FAR = 1 << 23, 1 << 61


@dataclass
class Node:
    """Split points, and by (split point, child) the distances of the rows below the child."""

    points: np.ndarray
    extra: np.ndarray
    child: list[int] = field(default_factory=list)  # of a node, or -1 - leaf
    nearest: np.ndarray | None = None
    farthest: np.ndarray | None = None


class Tree:
    """Split points fitted on a sample of integer vectors whose squared length is `square` at most."""

    def __init__(self, sample: np.ndarray, square: int):
        self.square = float(square)
        self.slack = 1e-6 * (1 + self.square**0.5)
        self.nodes: list[Node] = []
        self.leaves = 0
        self._grow(np.unique(sample, axis=0).astype(np.float64) if len(sample) else np.zeros((1, 1)))

    def extra(self, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square - np.einsum("ij,ij->i", vectors, vectors), 0))

    def _distances(self, vectors: np.ndarray, extra: np.ndarray, node: Node) -> np.ndarray:
        inner = vectors @ node.points.T + np.outer(extra, node.extra)
        return np.sqrt(np.maximum(2 * self.square - 2 * inner, 0))

    def _grow(self, rows: np.ndarray) -> int:
        """A node over these rows and all below it; its number."""
        extra = self.extra(rows)
        chosen = [0]
        far = self._distances(rows, extra, Node(rows[:1], extra[:1]))[:, 0]
        while len(chosen) < min(FAN_OUT, len(rows)):
            chosen.append(int(far.argmax()))
            far = np.minimum(far, self._distances(rows, extra, Node(rows[chosen[-1:]], extra[chosen[-1:]]))[:, 0])
        node = Node(rows[chosen], extra[chosen])
        self.nodes.append(node)
        number = len(self.nodes) - 1
        below = self._distances(rows, extra, node).argmin(1)
        for child in range(len(chosen)):
            group = rows[below == child]
            if len(group) > LEAF_SAMPLE and len(group) < len(rows):
                node.child.append(self._grow(group))
            else:
                node.child.append(-1 - self.leaves)
                self.leaves += 1
        return number

    def place(self, vectors: np.ndarray, visit: Callable[[int, int, np.ndarray], None] | None = None) -> np.ndarray:
        """The leaf of each vector; `visit` gets node, child and distances of the rows that go there."""
        extra, leaf = self.extra(vectors), np.zeros(len(vectors), np.int32)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            number, rows = todo.pop()
            node = self.nodes[number]
            distances = self._distances(vectors[rows], extra[rows], node)
            below = distances.argmin(1)
            for child in np.unique(below):
                here = below == child
                if visit:
                    visit(number, int(child), distances[here])
                if node.child[child] < 0:
                    leaf[rows[here]] = -1 - node.child[child]
                else:
                    todo.append((node.child[child], rows[here]))
        return leaf

    def set_ranges(self, ranges: list[tuple[int, int, int, float, float]]) -> None:
        """Rows of (node, split point, child, nearest, farthest); a child without one holds nothing."""
        for node in self.nodes:
            shape = (len(node.points),) * 2
            node.nearest, node.farthest = np.full(shape, np.inf), np.full(shape, -np.inf)
        for number, point, child, nearest, farthest in ranges:
            self.nodes[number].nearest[point, child] = nearest
            self.nodes[number].farthest[point, child] = farthest

    def reach(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By (anchor, leaf): whether any window of scores may meet it, and the distance of its split point.

        Windows are (anchor, window) arrays of their least and greatest score.
        """
        total = np.einsum("ij,ij->i", anchors, anchors) + self.square
        inner = np.sqrt(np.maximum(total[:, None] - 2.0 * high, 0)) - self.slack
        outer = np.sqrt(np.maximum(total[:, None] - 2.0 * low, 0)) + self.slack
        meets = np.zeros((len(anchors), self.leaves), bool)
        away = np.full((len(anchors), self.leaves), np.inf)
        todo = [(0, low <= high)]
        while todo:
            number, open_ = todo.pop()
            node = self.nodes[number]
            # anchors have a zero in the further component
            distances = np.sqrt(np.maximum(total[:, None] - 2 * (anchors @ node.points.T), 0))
            for child, below in enumerate(node.child):
                nearest, farthest = node.nearest[:, child], node.farthest[:, child]
                least = np.maximum(distances - farthest, nearest - distances).max(1)
                most = (distances + farthest).min(1)
                still = open_ & (least[:, None] <= outer) & (most[:, None] >= inner)
                if below >= 0:
                    if still.any():
                        todo.append((below, still))
                else:
                    meets[:, -1 - below] = still.any(1)
                    away[:, -1 - below] = distances[:, child]
        return meets, away


def prepared(embeddings: DataFrame, moved: int = 7, labels: int = 10) -> DataFrame:
    """key, vec_id, label, ints of the rows that take part; each row has a key of its own."""
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    plain = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < HUGE / 256))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & plain)
    label = F.when(F.col("vec_id") % moved == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.select(
        F.monotonically_increasing_id().alias("key"),
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("int").alias("label"),
        scaled.cast("array<int>").alias("ints"),
    )


def _matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    """A list column with lists of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind)


def fit(rows: DataFrame, square: int) -> Tree:
    """A tree on a bounded sample, with ranges over all rows."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "key").limit(TREE_SAMPLE).select("ints").collect()
    tree = Tree(np.array([row[0] for row in sample], np.int64).reshape(len(sample), -1), square)
    schema = "node int, point int, child int, nearest double, farthest double"
    types = arrow_schema(rows.sparkSession, schema)

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, most = {}, {}

        def visit(node: int, child: int, distances: np.ndarray) -> None:
            at = node, child
            least[at] = np.minimum(least.get(at, np.inf), distances.min(0))
            most[at] = np.maximum(most.get(at, -np.inf), distances.max(0))

        for batch in batches:
            if batch.num_rows:
                tree.place(_matrix(batch.column("ints")), visit)
        found = [
            (node, point, child, near, far)
            for node, child in least
            for point, (near, far) in enumerate(zip(least[node, child], most[node, child]))
        ]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), types)], schema=types)

    grouped = rows.select("ints").mapInArrow(ranges, schema).groupBy("node", "point", "child")
    # FAN_OUT squared rows for each node of the tree, whose size the sample bounds
    tree.set_ranges([tuple(r) for r in grouped.agg(F.min("nearest"), F.max("farthest")).collect()])
    return tree


def placed(rows: DataFrame, tree: Tree) -> tuple[DataFrame, dict[int, int]]:
    """The rows with leaf and part, written; and the number of parts of each leaf."""
    schema = "leaf int, key long, vec_id long, label int, ints array<int>"
    types = arrow_schema(rows.sparkSession, schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = pa.array(tree.place(_matrix(batch.column("ints"))))
                columns = [leaf, *(batch.column(f.name) for f in list(types)[1:])]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, types)], schema=types)

    index = written(rows.mapInArrow(work, schema), "leaves")
    sizes = {row[0]: row[1] for row in index.groupBy("leaf").count().collect()}  # a row for each leaf
    parts = {leaf: -(-size // ROWS_TOGETHER) for leaf, size in sizes.items()}
    large = [f"when {leaf} then {n}" for leaf, n in parts.items() if n > 1]
    count = F.expr(f"case leaf {' '.join(large)} else 1 end") if large else F.lit(1)
    return index.withColumn("part", F.pmod(F.xxhash64("key"), count).cast("int")), parts


def _routes(queries: DataFrame, tree: Tree, parts: dict[int, int], rest: bool) -> DataFrame:
    """A row for each anchor and part of a leaf that it has to look into, in this round."""
    schema = "leaf int, part int, key long, label int, ints array<int>, low array<long>, high array<long>"
    types = arrow_schema(queries.sparkSession, schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, AT_A_TIME):
                some = batch.slice(start, AT_A_TIME)
                anchors = _matrix(some.column("ints"))
                high = _matrix(some.column("high"), np.int64)
                meets, away = tree.reach(anchors, _matrix(some.column("first_low"), np.int64), high)
                away[~meets] = np.inf
                first = np.zeros_like(meets)
                order = np.argsort(away, axis=1, kind="stable")[:, :FIRST_LEAVES]
                np.put_along_axis(first, order, True, axis=1)
                wanted = first & meets
                if rest:
                    wanted = tree.reach(anchors, _matrix(some.column("low"), np.int64), high)[0] & ~wanted
                row, leaf = np.nonzero(wanted)
                times = np.array([parts.get(int(each), 0) for each in leaf], np.int64)
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, leaf = np.repeat(row, times), np.repeat(leaf, times)
                columns = [pa.array(leaf.astype(np.int32)), pa.array(part.astype(np.int32))]
                columns += [some.column(f.name).take(pa.array(row)) for f in list(types)[2:]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, types)], schema=types)

    return queries.mapInArrow(work, schema)


def _scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    largest = float(np.abs(anchors).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * anchors.shape[1]
    if largest < 1 << 53:
        return (anchors.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return anchors @ vectors.T


def best_of(
    anchors: dict[str, np.ndarray], rows: dict[str, np.ndarray], same_label: bool, count: int
) -> tuple[np.ndarray, ...]:
    """The first `count` rows of each anchor and window: key, window, score, vec_id."""
    found = []
    for start in range(0, len(anchors["key"]), AT_A_TIME):
        key, label, ints, low, high = (anchors[n][start : start + AT_A_TIME] for n in ("key", "label", "ints", "low", "high"))
        score = _scores(ints, rows["ints"])
        open_ = (score >= low.min(1)[:, None]) & (score <= high.max(1)[:, None])
        open_ &= (label[:, None] == rows["label"]) == same_label
        open_ &= key[:, None] != rows["key"]
        anchor, row = np.nonzero(open_)
        score = score[anchor, row]
        for window in range(low.shape[1]):
            here = (score >= low[anchor, window]) & (score <= high[anchor, window])
            a, s, ids = anchor[here], score[here], rows["vec_id"][row[here]]
            order = np.lexsort((ids, -s, a))
            a, s, ids = a[order], s[order], ids[order]
            first = np.searchsorted(a, np.arange(len(key)))
            kept = np.arange(len(a)) - first[a] < count
            found.append((key[a[kept]], np.full(kept.sum(), window, np.int32), s[kept], ids[kept]))
    return tuple(np.concatenate(column) for column in zip(*found))


_FOUND = "key long, window int, score long, vec_id long"


def _scan(index: DataFrame, routes: DataFrame, anchors: int, same_label: bool, count: int) -> DataFrame:
    """The first rows of each anchor and window out of the leaves it was sent to."""
    groups = -(-anchors // ANCHORS_TOGETHER) or 1
    types = arrow_schema(index.sparkSession, _FOUND)

    def work(rows: pa.Table, sent: pa.Table) -> pa.Table:
        if not rows.num_rows or not sent.num_rows:
            return types.empty_table()
        one = {n: rows.column(n).to_numpy() for n in ("key", "vec_id", "label")} | {"ints": _matrix(rows.column("ints"), np.int64)}
        other = {n: sent.column(n).to_numpy() for n in ("key", "label")}
        other |= {n: _matrix(sent.column(n), np.int64) for n in ("ints", "low", "high")}
        return pa.Table.from_arrays([pa.array(c) for c in best_of(other, one, same_label, count)], schema=types)

    copies = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = routes.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
    keys = ["leaf", "part", "group"]
    return copies.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(work, _FOUND)


def _first(found: DataFrame, count: int) -> DataFrame:
    """The first `count` of each anchor and window with their place, from 1."""
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= count)


def search(queries: DataFrame, index: DataFrame, tree: Tree, parts: dict[int, int], same_label: bool, count: int) -> DataFrame:
    """key, window, score, vec_id, place of the first `count` rows in each window of `queries`.

    `queries` are rows with arrays `low` and `high`, a window of scores at each place.
    """
    anchors = queries.count()
    queries = queries.withColumn("first_low", F.col("low"))
    near = _scan(index, _routes(queries, tree, parts, rest=False), anchors, same_label, count)
    near = written(_first(near, count), "near-leaves")
    full = near.filter(F.col("place") == count).groupBy("key")
    bounds = full.agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("bounds"))
    bound = F.expr("transform(low, (x, i) -> greatest(x, coalesce(bounds[i], x)))")
    narrowed = queries.join(bounds, "key", "left").withColumn("low", bound).drop("bounds")
    rest = _scan(index, _routes(narrowed, tree, parts, rest=True), anchors, same_label, count)
    return _first(near.drop("place").unionByName(rest), count)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90)) -> DataFrame:
    """For anchors (ids divisible by `every`) and their first positives, the first rows of another label in the window.

    The window is given in percent of the positive's score.
    """
    spark = embeddings.sparkSession
    rows = prepared(embeddings)
    square = F.aggregate("ints", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))
    rows = written(rows.withColumn("square", square), "vectors")
    size, width = rows.agg(F.max("square"), F.max(F.size("ints"))).first()
    if size is None:
        return spark.createDataFrame([], RESULT)
    filled = F.slice(F.concat("ints", F.array_repeat(F.lit(0), width)), 1, max(width, 1))
    if not width:  # all vectors are empty: one zero each
        filled = F.array(F.lit(0))
    rows = rows.withColumn("ints", filled).drop("square")
    tree = fit(rows, size)
    index, parts = placed(rows, tree)
    anchors = rows.filter(F.col("vec_id") % every == 0)

    def bounds(low: int, high: int) -> dict:
        return {name: F.array(F.lit(value).cast("long")) for name, value in (("low", low), ("high", high))}

    first = written(search(anchors.withColumns(bounds(-FAR, FAR)), index, tree, parts, True, positives), "positives")
    found = F.array_sort(F.collect_list(F.struct("place", F.col("vec_id").alias("id"), "score")))
    windows = first.groupBy("key").agg(found.alias("found"))
    for name, percent, shift in (("low", window[0], 99), ("high", window[1], 0)):  # rounded up, rounded down
        each = f"transform(found, f -> cast(({percent} * f.score + {shift} - pmod({percent} * f.score + {shift}, 100)) div 100 as bigint))"
        # every anchor has as many windows; those beyond its positives are empty
        beyond = f"array_repeat(cast({FAR if name == 'low' else -FAR} as bigint), {positives})"
        windows = windows.withColumn(name, F.expr(f"slice(concat({each}, {beyond}), 1, {positives})"))
    queries = written(anchors.join(windows.select("key", "low", "high"), "key"), "windows")
    hard = search(queries, index, tree, parts, False, negatives).alias("hard")
    named = first.select(
        F.col("key"), (F.col("place") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    ids = anchors.select("key", F.col("vec_id").alias("anchor_id"))
    return hard.join(named, ["key", "window"]).join(ids, "key").select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
