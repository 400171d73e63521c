"""Near-duplicate documents: MinHash with tensored banding, links confirmed on full shingle sets.

Two small collections of `COLLECTION` band hashes each are computed for every set; the keys of the
`COLLECTION` ** 2 tables are all pairs of a hash of the one and a hash of the other. Sets that share
a table key are candidates; their signatures weed out those that are far apart, and connected
candidates meet in one group, where every link is confirmed on the full sets.

A group too large for one task is split into parts. Its pivots, the documents with most
candidates, go to all parts. What the links found so connect with each other is settled; the largest
such component stays where it is, and every document outside of it is compared with all parts. So no
task holds a whole large group, and of two linked documents that are still apart one meets the other.

Edge cases: texts are compared by their set, so exact copies share one class and are compared once.
A null or empty text, or one without words, has an empty set, no links and is kept. A text with fewer words
than a shingle is one shingle. Repeated ids count as one document whose rows all return. A null id cannot
stand for a group: such a row is kept unless its set is that of a document with an id. Further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripcohorts.llm.common import map_texts, text_of, written
from tripcohorts.llm.words import LOWER, PART_BYTES, Words, mixed, split_words, text_bytes, window_hashes

#: MinHashes in a band, and bands in each of the two collections. A pair with similarity 0.85 is
#: missed with probability 2 * (1 - 0.85 ** 3) ** 12 = 2e-5, one with 0.8 with 4e-4.
BAND, COLLECTION = 3, 12
HASHES = 2 * BAND * COLLECTION

#: Signatures that agree in fewer places are not looked at again: far below any wanted similarity
#: (at 0.8, five standard deviations of the estimate).
LEAST_AGREEMENT = 0.55

#: Buckets of at most this many sets give all their pairs. In a larger one each set is paired with the
#: first in one of some orders: the bucket stays connected, and connected sets are compared whole.
SMALL_BUCKET, ORDERS = 4, 16

#: Pairs whose connections one task finds by itself.
TASK_PAIRS = 500_000

#: Bytes of shingles in one part of a group, and documents that are pivots of a larger group.
GROUP_BYTES, PIVOTS = 32 << 20, 32


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every shingle, in order of texts; a shorter text is one shingle."""
    at, hashes = window_hashes(words, size)
    text = words.text[at]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if not len(short):
        return text, hashes
    first = words.first[short]
    total = words.hashes[first].copy()
    for place in range(1, size - 1):
        more = words.counts[short] > place
        total[more] = mixed(total[more] * np.uint64(5) + words.hashes[first[more] + place])
    text, hashes = np.concatenate([text, short]), np.concatenate([hashes, mixed(total, 3)])
    order = np.argsort(text, kind="stable")
    return text[order], hashes[order]


def distinct_shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after the other, and their bounds."""
    data, bounds = text_bytes(column)
    text, hashes = shingle_hashes(split_words(LOWER[data], bounds), size)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    text, hashes = text[new], hashes[new]
    return hashes, np.searchsorted(text, np.arange(len(bounds)))


def sketches(documents: DataFrame, size: int) -> DataFrame:
    """row, doc_id, n_shingles, digest of the set, signature (32-bit MinHashes as bytes)."""

    def work(part: pa.RecordBatch) -> dict:
        hashes, bounds = distinct_shingles(part.column("text"), size)
        counts = np.diff(bounds)
        full = np.flatnonzero(counts)
        at = bounds[:-1][full]
        digest = np.zeros((2, len(counts)), np.uint64)
        signature = np.zeros((len(counts), HASHES), np.uint32)
        if len(full):
            for seed in (0, 1):
                digest[seed, full] = np.add.reduceat(mixed(hashes, 90 + seed), at)
            for place in range(HASHES):
                factor = np.uint64((place * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64) | 1)
                spread = (hashes ^ (hashes >> np.uint64(29))) * factor
                spread ^= spread >> np.uint64(32)
                low = np.minimum.reduceat((spread * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32), at)
                signature[full, place] = low.astype(np.uint32)
        return {
            "row": part.column("row"),
            "doc_id": part.column("doc_id"),
            "n_shingles": counts,
            "digest": [d.tobytes() for d in digest.T],
            "signature": [s.tobytes() for s in signature],
        }

    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_of().alias("text"))
    schema = "row long, doc_id long, n_shingles long, digest binary, signature binary"
    return map_texts(rows, work, schema, limit=PART_BYTES)


def table_rows(classes: DataFrame) -> DataFrame:
    """key, id for each class and table: pairs of a band hash of each collection."""

    def work(part: pa.RecordBatch) -> dict:
        signature = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint32)
        bands = signature.reshape(-1, 2, COLLECTION, BAND).astype(np.uint64)
        hashes = np.zeros(bands.shape[:3], np.uint64)
        for place in range(BAND):
            hashes = mixed(hashes * np.uint64(3) + bands[..., place])
        left, right = hashes[:, 0, :, None], hashes[:, 1, None, :]
        table = np.arange(COLLECTION**2, dtype=np.uint64).reshape(1, COLLECTION, COLLECTION)
        keys = mixed(left * np.uint64(3) + mixed(right + table)).reshape(-1)
        return {"key": keys.view(np.int64), "id": np.repeat(part.column("id").to_numpy(), COLLECTION**2)}

    return map_texts(classes.select("id", "signature"), work, "key long, id long", "signature", limit=64 * 4 * HASHES)


def bucket_pairs(rows: DataFrame) -> DataFrame:
    """a, b: pairs of sets that share a table key, one pair once in a task.

    Buckets are read in order, so none is held whole.
    """

    def run(batches):
        last_key = head = None
        for batch in batches:
            key, ids = batch.column("key").to_numpy(), batch.column("id").to_numpy()
            if not len(key):
                continue
            firsts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            sizes = np.diff(np.append(firsts, len(key)))
            size, place = np.repeat(sizes, sizes), np.arange(len(key)) - np.repeat(firsts, sizes)
            left, right = [], []
            for back in range(SMALL_BUCKET - 1):
                # by the first member, or by each before in a small bucket
                here = np.flatnonzero((place > back) & ((size <= SMALL_BUCKET) | (back == 0)))
                left.append(ids[here - place[here] + back])
                right.append(ids[here])
            goes_on = key[0] == last_key
            if goes_on:
                left.append(np.full(sizes[0], head))
                right.append(ids[: sizes[0]])
            if not (goes_on and len(firsts) == 1):
                head = ids[firsts[-1]]
            last_key = key[-1]
            pairs = np.stack([np.concatenate(left), np.concatenate(right)])
            pairs = np.unique(np.sort(pairs[:, pairs[0] != pairs[1]], axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    # the first of a bucket differs with the order, so two close members of large buckets meet in some
    order = F.xxhash64("id", F.pmod("key", F.lit(ORDERS)))
    ordered = rows.repartition("key").sortWithinPartitions("key", order)
    return ordered.mapInArrow(run, "a long, b long").distinct()


def close_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree often enough."""

    def work(part: pa.RecordBatch) -> dict:
        a, b = (
            np.frombuffer(b"".join(part.column(side).to_pylist()), np.uint32).reshape(-1, HASHES)
            for side in ("signature_a", "signature_b")
        )
        near = np.flatnonzero((a == b).mean(axis=1) >= LEAST_AGREEMENT)
        return {"a": part.column("a").take(pa.array(near)), "b": part.column("b").take(pa.array(near))}

    known = classes.select("id", "signature")
    both = pairs.join(known.toDF("a", "signature_a"), "a").join(known.toDF("b", "signature_b"), "b")
    return map_texts(both, work, "a long, b long", "signature_a", limit=4096 * 4 * HASHES)


def forests(pairs: DataFrame) -> DataFrame:
    """u, v: each id with the smallest one that the pairs of its task reach.

    A task takes a bounded number of pairs and returns at most one row for each of their ids, so
    a dense group comes down to its members before its pairs meet in a join.
    """

    def run(batches):
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (above := root.setdefault(x, x)) != x:
                root[x] = root[above]
                x = above
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        rows = [(x, find(x)) for x in list(root)]
        rows = [(x, r) for x, r in rows if x != r]
        columns = [pa.array([row[place] for row in rows], pa.int64()) for place in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    tasks = max(1, -(-pairs.count() // TASK_PAIRS))
    return pairs.coalesce(tasks).mapInArrow(run, "u long, v long")


def components(pairs: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of every id in the written pairs (a, b).

    Large and small stars in turn: each id's neighbours are linked with the smallest of them. The
    number of rounds grows with the logarithm of the longest path, and every round is grouped
    with partial aggregation, so a hub is no burden for one task.
    """
    edges = written(forests(pairs).distinct(), "edges")
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").filter("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        edges = written(small.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == known:
            break
        known = now
    members = edges.groupBy("u").agg(F.min("v").alias("v"))
    roots = members.select("v").distinct().select("v", "v")
    return members.unionByName(roots.toDF("u", "v")).toDF("id", "component")


class Links:
    """Links among the sets of one block, found through an index of their shingles."""

    def __init__(self, ids: np.ndarray, sets: list[np.ndarray], percent: int):
        self.ids, self.percent = ids, percent
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], owner[order]

    def of(self, one: np.ndarray) -> np.ndarray:
        """Places of the block's sets that are linked with a set."""
        low, high = np.searchsorted(self.values, one), np.searchsorted(self.values, one, side="right")
        sizes = high - low
        total = int(sizes.sum())
        if not total:
            return np.zeros(0, np.int64)
        at = np.repeat(low - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(total)
        common = np.bincount(self.owner[at], minlength=len(self.sizes))
        union = self.sizes + len(one) - common
        return np.flatnonzero((100 * common >= self.percent * union) & (common > 0))


def _sets(table: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(shingles, np.uint64) for shingles in table["shingles"]]


class Block:
    """The links of one block, searched for from set to set among those that nothing has reached yet.

    Two linked sets share one of the rarest shingles of each: so many that the others alone could not make
    the link. Only sets that share such a one are compared whole. A set that links have reached
    leaves the index, so many near copies are found once and not from each other again.
    """

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        _, names, counts = np.unique(values, return_inverse=True, return_counts=True)
        # shingles are numbered by how many sets hold them
        rank = np.empty(len(counts), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((rank[names], owner))
        self.shingles = rank[names][order]
        #: at least ceil(percent of the size) are common with a linked set
        self.rare = self.sizes - -(-percent * self.sizes // 100) + 1
        self.marked = np.zeros(len(counts), bool)
        self.open = np.ones(len(sets), bool)
        self._index()

    def _flat(self, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first shingles of some sets after each other, and where each set's begin."""
        begins = np.cumsum(counts) - counts
        at = np.repeat(self.starts[places] - begins, counts) + np.arange(int(counts.sum()))
        return self.shingles[at], begins

    def _index(self) -> None:
        places = np.flatnonzero(self.open & (self.sizes > 0))
        held, _ = self._flat(places, self.rare[places])
        order = np.argsort(held, kind="stable")
        self.keys, self.owners = held[order], np.repeat(places, self.rare[places])[order]
        self.indexed = len(places)

    def take(self, places: np.ndarray) -> None:
        """Leaves sets out from now on."""
        self.open[places] = False
        if 2 * int(self.open.sum()) < self.indexed:
            self._index()

    def linked(self, place: int) -> np.ndarray:
        """The open sets that are linked with a set."""
        own = self.shingles[self.starts[place] : self.ends[place]]
        rare = own[: self.rare[place]]
        low, high = np.searchsorted(self.keys, rare), np.searchsorted(self.keys, rare, side="right")
        sizes = high - low
        total = int(sizes.sum())
        if not total:
            return np.zeros(0, np.int64)
        at = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        maybe = np.unique(self.owners[at])
        maybe = maybe[self.open[maybe]]
        sizes = self.sizes[maybe]
        fits = 100 * np.minimum(sizes, len(own)) >= self.percent * np.maximum(sizes, len(own))
        maybe = maybe[fits]
        if not len(maybe):
            return maybe
        self.marked[own] = True
        held, begins = self._flat(maybe, self.sizes[maybe])
        common = np.add.reduceat(self.marked[held].astype(np.int64), begins)
        self.marked[own] = False
        return maybe[100 * common >= self.percent * (self.sizes[maybe] + len(own) - common)]


def _block_links(table: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A link between each set and the smallest place that links of this block reach."""
    ids = table["id"].to_numpy()
    block = Block(_sets(table), percent)
    root = np.arange(len(ids))
    for first in range(len(ids)):
        if not block.open[first]:
            continue
        block.take(np.array([first]))
        todo = [first]
        while todo:
            found = block.linked(todo.pop())
            root[found] = first
            block.take(found)
            todo += found.tolist()
    return pd.DataFrame({"a": ids, "b": ids[root]})


def confirmed_links(sets: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect exactly what all links connect.

    `sets`: id, component, degree, shingles. `parts`: component, parts of the groups that are too
    large for one task.
    """
    schema = "a long, b long"
    key = ["component", "part"]

    def block(table: pd.DataFrame) -> pd.DataFrame:
        return _block_links(table, percent)

    if parts.isEmpty():
        return sets.withColumn("part", F.lit(0)).groupBy(key).applyInPandas(block, schema)

    placed = sets.join(parts, "component", "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("id"), "parts"), F.lit(0))
    )
    placed = written(placed, "sets")
    split = placed.filter("parts is not null")

    # pivots meet every part of their group
    first = Window.partitionBy(key).orderBy(F.desc("degree"), "id")
    best = split.select("id", "degree", *key).withColumn("place", F.row_number().over(first))
    first = Window.partitionBy("component").orderBy(F.desc("degree"), "id")
    best = best.filter(F.col("place") <= PIVOTS).withColumn("place", F.row_number().over(first))
    best = best.filter(F.col("place") <= PIVOTS).select("id")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("to")
    pivots = split.join(best, "id", "left_semi")
    others = pivots.select("*", every).filter("`to` != part").drop("part").withColumnRenamed("to", "part")
    inner = written(placed.unionByName(others).groupBy(key).applyInPandas(block, schema), "links")

    # all but the largest component of a group meets every part: pivots can lie in several
    reached = written(components(inner).withColumnRenamed("component", "reached"), "reached")
    sizes = split.join(reached, "id").groupBy("component", "reached").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("component").agg(F.max_by("reached", F.struct("size", "reached")).alias("reached"))
    near = reached.join(largest, "reached", "left_semi").select("id")
    far = split.join(near, "id", "left_anti").withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), "parts"))
    far = written(far.select("id", "component", "chunk", "shingles", every).withColumnRenamed("to", "part"), "far")
    meetings = far.select([F.col(name).alias(name) for name in (*key, "chunk")]).distinct()
    here = split.select("id", *key, "shingles").join(meetings, key)

    def across(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        others = Links(right["id"].to_numpy(), _sets(right), percent)
        found = [others.ids[others.of(one)] for one in _sets(left)]
        a = np.repeat(left["id"].to_numpy(), [len(b) for b in found])
        return pd.DataFrame({"a": a, "b": np.concatenate(found) if found else a})

    key = [*key, "chunk"]
    outer = far.groupBy(key).cogroup(here.groupBy(key)).applyInPandas(across, schema)
    return inner.unionByName(outer)


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Linked: 100 * common >= percent * all shingles of both. component_id is the smallest doc_id
    that links reach; kept marks the document with that id.
    """
    known = written(sketches(documents, size), "sketches")
    classes = known.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("id"),
        F.min_by("signature", "doc_id").alias("signature"),
        F.first("n_shingles").alias("n_shingles"),
    )
    classes = written(classes.filter("id is not null"), "classes")
    pairs = written(close_pairs(bucket_pairs(table_rows(classes)), classes), "pairs")
    degree = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    groups = written(components(pairs).join(degree, "id"), "groups")
    count = F.ceil(8 * F.sum("n_shingles") / GROUP_BYTES).cast("int")
    parts = groups.join(classes, "id").groupBy("component").agg(count.alias("parts")).filter("parts > 1")
    parts = written(parts, "parts")
    rows = documents.select(F.col("doc_id").alias("id"), text_of().alias("text"))
    rows = rows.join(groups.hint("shuffle_hash"), "id")

    def work(part: pa.RecordBatch) -> dict:
        hashes, bounds = distinct_shingles(part.column("text"), size)
        return {name: part.column(name) for name in ("id", "component", "degree")} | {
            "shingles": [hashes[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
        }

    sets = map_texts(rows, work, "id long, component long, degree long, shingles binary", limit=PART_BYTES)
    linked = components(written(confirmed_links(sets, parts, percent), "links"))
    reached = classes.join(linked, "id", "left").select(
        "digest", F.least("id", F.coalesce("component", "id")).alias("component_id")
    )
    return (
        known.join(reached, "digest", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )
