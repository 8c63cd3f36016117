"""Hard negatives by exact window searches in a multiway hyperplane tree.

Method, a GNAT-style tree. Inner products become distances: a row gets one more
coordinate that brings all rows to the longest row's length, a query gets 0
there, so a smaller distance is a larger score. A node holds several split
points; a row belongs to the nearest one. For each pair of split point ``i``
and sibling subtree ``j`` the node stores the range of the distances from ``i`` to
all rows below ``j``. A query window (scores from ``lo`` to ``hi``) is an annulus
around the query; a sibling goes as soon as one of its ranges cannot meet it.
Leaves that are left are compared exactly.

A search takes two rounds: the leaf where the query itself falls gives a first
answer, whose last score narrows the window for the others.

Scale. The tree is grown on a bounded sample (``SAMPLE`` rows), but every row is
indexed and every range covers all rows, so no answer is missed. Leaves are cut
into blocks of about ``LEAF_ROWS`` rows by a hash. Queries go in packs of ``PACK``,
sorted by leaf; a pack meets the blocks of a leaf by a join on the leaf, which
adaptive execution splits, and what a task returns is a top list for each
query, never its pairs. Rows of equal vector and label are one entry with their
smallest ids, as many as can be asked for, and equal queries are one query, so
a vector that a third of all rows hold costs as much as any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooktext.llm.arrays import groups, mix
from brooktext.llm.vectors import inner_products, matrix
from brooktext.sources.workspace import discard, materialize

# Rows that the tree is grown on, split points of a node, rows of a leaf block, queries of a pack.
SAMPLE = 8192
FANOUT = 8
LEAF_ROWS = 2048
PACK = 512
# Distances are rounded; windows are wider by this share of the longest row.
SLACK = 1e-6
LOWEST, HIGHEST = -(1 << 62), 1 << 62
# Entries that a task holds before it hands its top lists on.
MOST_HELD = 200_000

POSITIVES = 5
NEGATIVES = 3
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)
FOUND = "qid long, probe long, score long, id long"
PACKED = "leaf int, qids binary, labels binary, x binary, owner binary, probes binary, lows binary, highs binary"


def lifted(x: np.ndarray, square: float) -> np.ndarray:
    """Rows with the coordinate that makes the square of their length ``square``."""
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(square - np.einsum("ij,ij->i", x, x), 0.0))
    return np.hstack([x, rest[:, None]])


def flat(x: np.ndarray) -> np.ndarray:
    """Queries in the space of the lifted rows."""
    return np.hstack([x.astype(np.float64), np.zeros((len(x), 1))])


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", left, left)[:, None] + np.einsum("ij,ij->i", right, right)[None]
    return np.sqrt(np.maximum(squares - 2.0 * (left @ right.T), 0.0))


@dataclass
class Node:
    """Split points; ``children`` are node numbers, or ``-1 - leaf``. Ranges: from split point i to subtree j."""

    splits: np.ndarray
    children: list[int]
    least: np.ndarray = field(default=None)
    most: np.ndarray = field(default=None)


@dataclass
class Tree:
    square: float
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 0

    def _spread(self, points: np.ndarray) -> np.ndarray:
        """Split points, each as far as can be from those before."""
        chosen = [0]
        nearest = distances(points, points[:1])[:, 0]
        while len(chosen) < min(FANOUT, len(points)) and nearest.max() > 0:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, distances(points, points[chosen[-1:]])[:, 0])
        return points[chosen]

    def grow(self, points: np.ndarray, leaf_points: int) -> int:
        """Add a subtree for these sample points; returns its number as a child."""
        splits = self._spread(points) if len(points) > leaf_points else points[:1]
        if len(splits) < 2:
            self.leaves += 1
            return -self.leaves
        number = len(self.nodes)
        self.nodes.append(Node(splits, []))
        nearest = distances(points, splits).argmin(axis=1)
        self.nodes[number].children = [self.grow(points[nearest == j], leaf_points) for j in range(len(splits))]
        return number

    def walk(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Each node that points reach: its number, their indices, their distances to its split points, their child."""
        open_nodes = [(0, np.arange(len(points)))] if self.nodes and len(points) else []
        while open_nodes:
            number, index = open_nodes.pop()
            node = self.nodes[number]
            far = distances(points[index], node.splits)
            child = far.argmin(axis=1)
            yield number, index, far, child
            for j, below in enumerate(node.children):
                if below >= 0 and (child == j).any():
                    open_nodes.append((below, index[child == j]))

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(points), dtype=np.int32)
        for number, index, _, child in self.walk(points):
            below = np.array(self.nodes[number].children)[child]
            leaf[index[below < 0]] = -1 - below[below < 0]
        return leaf

    def reached(self, points: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf that an annulus may meet, with the indices of the annuli."""
        slack = SLACK * np.sqrt(self.square) + 1e-9
        open_nodes = [(0 if self.nodes else -1, np.arange(len(points)))] if len(points) else []
        while open_nodes:
            number, index = open_nodes.pop()
            if number < 0:
                yield -1 - number, index
                continue
            node = self.nodes[number]
            far = distances(points[index], node.splits)
            for j, below in enumerate(node.children):
                nearest = np.maximum(far - node.most[:, j], node.least[:, j] - far).max(axis=1)
                farthest = (far + node.most[:, j]).min(axis=1)
                meets = (nearest <= outer[index] + slack) & (farthest >= inner[index] - slack)
                if meets.any():
                    open_nodes.append((below, index[meets]))

    def radius(self, points: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Distance of a row of that score."""
        squares = np.einsum("ij,ij->i", points, points) + self.square - 2.0 * scores
        return np.where(scores <= LOWEST, np.inf, np.sqrt(np.maximum(squares, 0.0)))


# --- the index ----------------------------------------------------------------


def _smallest_ids(rows: DataFrame, most: int) -> DataFrame:
    """``x, label, ids``: rows of equal vector and label as one entry with its ``most`` smallest ids, in order."""
    place = F.dense_rank().over(Window.partitionBy("x", "label").orderBy("vec_id"))
    first = rows.withColumn("place", place).where(F.col("place") <= most)
    return first.groupBy("x", "label").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


def grow_tree(entries: DataFrame) -> tuple[Tree, list[int]]:
    """A tree for all entries, with ranges over all of them, and the number of entries in each leaf."""
    norm = F.aggregate("x", F.lit(0.0), lambda total, c: total + c.cast("double") * c)
    size = entries.agg(F.count("*").alias("n"), F.max(norm).alias("square")).first()
    sample = entries.select("x").orderBy(F.xxhash64("x"), "label").limit(SAMPLE).toArrow()
    tree = Tree(float(size.square or 0.0))
    points = lifted(matrix(sample.column("x")), tree.square) if size.n else np.zeros((1, 1))
    tree.grow(points, max(1, -(-len(points) * LEAF_ROWS // max(size.n, 1))))
    grown = tree  # as the tasks get it, without ranges

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: dict[tuple[int, int, int], tuple[float, float]] = {}
        counts = np.zeros(grown.leaves, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = lifted(matrix(batch.column("x")), grown.square)
            counts += np.bincount(grown.leaf_of(x), minlength=grown.leaves)
            for number, _, far, child in grown.walk(x):
                for j in np.unique(child):
                    low, high = far[child == j].min(axis=0), far[child == j].max(axis=0)
                    for i in range(len(low)):
                        a, b = ranges.get((number, i, j), (np.inf, -np.inf))
                        ranges[number, i, j] = min(a, low[i]), max(b, high[i])
        cells = [(n, i, j, a, b, 0) for (n, i, j), (a, b) in ranges.items()]
        cells += [(-1, leaf, 0, 0.0, 0.0, n) for leaf, n in enumerate(counts.tolist()) if n]
        if cells:
            types = [pa.int32()] * 3 + [pa.float64()] * 2 + [pa.int64()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*cells, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "i", "j", "low", "high", "n"])

    told = entries.select("x").mapInArrow(local, "node int, i int, j int, low double, high double, n long")
    told = told.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    sizes = [0] * tree.leaves
    for node in tree.nodes:
        m = len(node.splits)
        node.least, node.most = np.full((m, m), np.inf), np.full((m, m), -np.inf)
    for row in told.collect():
        if row.node < 0:
            sizes[row.i] = row.n
        else:
            node = tree.nodes[row.node]
            node.least[row.i, row.j], node.most[row.i, row.j] = row.low, row.high
    return tree, sizes


def _bytes(column: np.ndarray) -> bytes:
    return np.ascontiguousarray(column, dtype=np.int64).tobytes()


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def leaf_blocks(entries: DataFrame, tree: Tree, sizes: list[int]) -> DataFrame:
    """Packed entries: ``leaf, x, labels, ids, counts``, about ``LEAF_ROWS`` of a leaf in each row."""
    parts = np.maximum(1, -(-np.array(sizes, dtype=np.int64) // LEAF_ROWS))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            leaf = tree.leaf_of(lifted(x, tree.square))
            weights = mix(np.arange(1, x.shape[1] + 1, dtype=np.uint64))
            chance = mix((x.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64))
            part = (chance % parts[leaf].astype(np.uint64)).astype(np.int32)
            columns = [pa.array(leaf), pa.array(part), *[batch.column(name) for name in ("x", "label", "ids")]]
            yield pa.RecordBatch.from_arrays(columns, ["leaf", "part", "x", "label", "ids"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            borders = groups(leaf)
            for a, b in zip(borders, np.append(borders[1:], len(leaf)), strict=True):
                for first in range(int(a), int(b), LEAF_ROWS):
                    own = batch.slice(first, min(LEAF_ROWS, int(b) - first))
                    ids = own.column("ids")
                    row = [
                        [int(leaf[a])],
                        [_bytes(matrix(own.column("x")))],
                        [_bytes(own.column("label").to_numpy())],
                        [_bytes(ids.flatten().to_numpy())],
                        [_bytes(ids.value_lengths().to_numpy())],
                    ]
                    kinds = [pa.int32(), *[pa.binary()] * 4]
                    columns = [pa.array(values, kind) for values, kind in zip(row, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["leaf", "x", "labels", "ids", "counts"])

    placed = entries.mapInArrow(assign, "leaf int, part int, x array<long>, label long, ids array<long>")
    dealt = placed.repartition("leaf", "part").sortWithinPartitions("leaf", "part")
    blocks = dealt.mapInArrow(packed, "leaf int, x binary, labels binary, ids binary, counts binary")
    return materialize(blocks, "leaf_blocks")


# --- searches -----------------------------------------------------------------


def _packs(probes: DataFrame, tree: Tree, home: bool) -> DataFrame:
    """Probes in packs, one for each leaf that they go to: their own leaf, or all others that their window may meet."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = pa.array(tree.leaf_of(flat(matrix(batch.column("x")))))
                yield pa.RecordBatch.from_arrays([own, *batch.columns], ["home", *batch.schema.names])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, PACK):
                part = batch.slice(first, PACK)
                own, x = part.column("home").to_numpy(), matrix(part.column("x"))
                if home:
                    reached = [(leaf, np.flatnonzero(own == leaf)) for leaf in np.unique(own)]
                else:
                    points = flat(x)
                    inner = tree.radius(points, part.column("hi").to_numpy())
                    outer = tree.radius(points, part.column("lo").to_numpy())
                    reached = [(leaf, at[own[at] != leaf]) for leaf, at in tree.reached(points, inner, outer)]
                numbers = {name: part.column(name).to_numpy() for name in ("qid", "label", "probe", "lo", "hi")}
                for leaf, at in reached:
                    if not len(at):
                        continue
                    _, query, owner = np.unique(numbers["qid"][at], return_index=True, return_inverse=True)
                    query = at[query]
                    values = (numbers["qid"][query], numbers["label"][query], x[query], owner)
                    values += tuple(numbers[name][at] for name in ("probe", "lo", "hi"))
                    columns = [pa.array([int(leaf)], pa.int32()), *[pa.array([_bytes(v)]) for v in values]]
                    yield pa.RecordBatch.from_arrays(columns, [part.split(" ")[0] for part in PACKED.split(", ")])

    schema = "home int, qid long, probe long, label long, lo long, hi long, x array<long>"
    ordered = probes.select("qid", "probe", "label", "lo", "hi", "x").mapInArrow(place, schema)
    return ordered.repartitionByRange("home", "qid", "probe").sortWithinPartitions("home", "qid").mapInArrow(visit, PACKED)


def _best(qid: np.ndarray, probe: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The first ``k`` of each probe by falling score, then id."""
    order = np.lexsort((ids, -score, probe, qid))
    qid, probe, score, ids = qid[order], probe[order], score[order], ids[order]
    if not len(qid):
        return qid, probe, score, ids
    new = np.concatenate(([True], (qid[1:] != qid[:-1]) | (probe[1:] != probe[:-1])))
    first = np.maximum.accumulate(np.where(new, np.arange(len(qid)), 0))
    keep = np.arange(len(qid)) - first < k
    return qid[keep], probe[keep], score[keep], ids[keep]


def _scan(pack: dict, block: dict, same: bool, k: int) -> tuple[np.ndarray, ...]:
    """The top lists of a pack's probes over one block, exactly."""
    qids, labels = _numbers(pack["qids"]), _numbers(pack["labels"])
    owner, probe = _numbers(pack["owner"]), _numbers(pack["probes"])
    of, counts, ids = _numbers(block["of"]), _numbers(block["counts"]), _numbers(block["ids"])
    scores = inner_products(_numbers(pack["x"]).reshape(len(qids), -1), _numbers(block["bx"]).reshape(len(of), -1))
    fits = (labels[:, None] == of[None]) == same
    scores = scores[owner]
    low, high = _numbers(pack["lows"])[:, None], _numbers(pack["highs"])[:, None]
    scores = np.where(fits[owner] & (scores >= low) & (scores <= high), scores, LOWEST)
    if k < scores.shape[1]:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
    else:
        least = LOWEST
    p, b = np.nonzero((scores >= least) & (scores > LOWEST))
    start = np.cumsum(counts) - counts
    each = counts[b]
    at = np.repeat(start[b], each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    p, b = np.repeat(p, each), np.repeat(b, each)
    return _best(qids[owner[p]], probe[p], scores[p, b], ids[at], k)


def _visits(packs: DataFrame, blocks: DataFrame, same: bool, k: int) -> DataFrame:
    names = [part.split(" ")[0] for part in PACKED.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def merged() -> tuple[np.ndarray, ...]:
            return _best(*[np.concatenate(parts) for parts in zip(*held, strict=True)], k)

        def out(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v) for v in found], ["qid", "probe", "score", "id"])

        for batch in batches:
            for row in batch.to_pylist():
                held.append(_scan(row, row, same, k))
                if sum(len(part[0]) for part in held) > MOST_HELD:
                    yield out(merged())
                    held = []
        if held:
            yield out(merged())

    theirs = blocks.select(F.col("leaf").alias("of_leaf"), F.col("x").alias("bx"), F.col("labels").alias("of"), "ids", "counts")
    # Spark takes the packs for as large as the probes they are made of, though each probe is in a pack of every leaf
    # that it visits. Without the hint it broadcasts them, through the driver.
    met = packs.hint("merge").join(theirs, F.col("leaf") == F.col("of_leaf")).select(*names[1:], "bx", "of", "ids", "counts")
    return met.mapInArrow(scan, FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid", "probe").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def search(blocks: DataFrame, tree: Tree, probes: DataFrame, same: bool, k: int) -> DataFrame:
    """``qid, probe, score, id, place``: the first ``k`` rows in each probe's window; a staged table.

    ``probes``: ``qid, probe, label, lo, hi, x``. Rows of the same label as the
    query if ``same``, else of other ones; higher scores first, then smaller ids.
    """
    first = materialize(_top(_visits(_packs(probes, tree, True), blocks, same, k), k), "home_leaf")
    last = first.where(F.col("place") == k).select(F.col("qid").alias("of_qid"), F.col("probe").alias("of_probe"), "score")
    narrowed = probes.join(last, (F.col("qid") == F.col("of_qid")) & (F.col("probe") == F.col("of_probe")), "left")
    narrowed = narrowed.withColumn("lo", F.greatest("lo", F.coalesce("score", "lo"))).select(*probes.columns)
    rest = _visits(_packs(narrowed, tree, False), blocks, same, k)
    both = first.select("qid", "probe", "score", "id").union(rest)
    found = materialize(_top(both, k), "search")
    discard(first)
    return found


def window_of(score: Column, low: int, high: int) -> tuple[Column, Column]:
    """The least and the largest integer ``s`` with ``low * score <= 100 * s <= high * score``."""

    def floor_div(value: Column) -> Column:
        return F.call_function("div", value - F.pmod(value, F.lit(100)), F.lit(100))

    return -floor_div(-score * low), floor_div(score * high)


def mine_negatives(
    rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 50, high: int = 95
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows``: ``vec_id, label, x`` (integer vectors of one length, see
    ``vectors``). Anchors are the rows where ``anchors`` holds. An anchor's
    positives are the first ``positives`` other rows of its label by inner product
    (ties: smaller id); the negatives of a positive are the first
    ``negatives`` rows of other labels whose score lies between ``low`` and
    ``high`` per cent of the positive's. Fewer rows give fewer answers, none give
    none. Rows with a null id, label or vector take no part; repeated rows of
    one id count once, and no row of the anchor's own id is its positive; other
    columns are not read; no rows give no rows.
    """
    usable = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    usable = usable.withColumn("is_anchor", F.coalesce(anchors, F.lit(False)))
    usable = materialize(usable.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "x", "is_anchor"), "vectors")
    entries = materialize(_smallest_ids(usable, max(positives + 1, negatives)), "entries")
    tree, sizes = grow_tree(entries)
    blocks = leaf_blocks(entries, tree, sizes)
    asked = usable.where("is_anchor").select(F.col("vec_id").alias("anchor_id"), "x", "label").distinct()
    queries = materialize(asked.groupBy("x", "label").agg(F.min("anchor_id").alias("first_id")), "queries")
    # One id may be an anchor with several vectors; a query is told by its vector and label.
    queries = queries.select(F.xxhash64("first_id", "x", "label").alias("qid"), "x", "label")
    everything = queries.select(
        "qid", F.lit(0).cast("long").alias("probe"), "label", F.lit(LOWEST).alias("lo"), F.lit(HIGHEST).alias("hi"), "x"
    )
    near = search(blocks, tree, everything, True, positives + 1)

    # A window for each score among the positives.
    scores = near.select(F.col("qid").alias("of_qid"), F.col("score").alias("positive")).distinct()
    least, most = window_of(F.col("positive"), low, high)
    windows = scores.withColumns({"lo": least, "hi": most}).where("lo <= hi")
    probes = windows.join(queries, F.col("qid") == F.col("of_qid")).select(
        "qid", F.col("positive").alias("probe"), "label", "lo", "hi", "x"
    )
    probes = materialize(probes, "probes")
    far = search(blocks, tree, probes, False, negatives)

    own = queries.select("qid", F.col("x").alias("query_x"), F.col("label").alias("query_label"))
    of_query = (F.col("x") == F.col("query_x")) & (F.col("label") == F.col("query_label"))
    named = asked.join(own, of_query).select("anchor_id", "qid")
    others = near.select(F.col("qid").alias("near_qid"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = named.join(others, F.col("qid") == F.col("near_qid")).where("anchor_id != positive_id")
    order = Window.partitionBy("anchor_id", "qid").orderBy(F.desc("positive_score"), "positive_id")
    pairs = pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    hard = far.select(
        F.col("qid").alias("far_qid"), F.col("probe"), F.col("place").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    out = pairs.join(hard, (F.col("qid") == F.col("far_qid")) & (F.col("positive_score") == F.col("probe")))
    return out.select(*[part.split(" ")[0] for part in RESULT.split(", ")])
