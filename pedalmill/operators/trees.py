"""Regression trees over counted, binned rows: single ones, forests and boosting, by the rules of Spark's ML.

Rows with equal bins and label are one cell with a count, so a level of all trees costs a pass over the cells and not
over the rows; one column holds all values of a category, so the features that tell them apart cost no column each.
Nothing is left out: cut points come from all values, sums from all cells, and a bootstrap draws for each cell the sum
of the draws of its rows, Poisson with the count as mean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pedalmill.session import cut

#: Most bins of an ordered column, as Spark's default.
BINS = 32
#: Cells packed into one row, and bytes of sums that a task holds at once.
PACK, HELD = 1 << 17, 1 << 26
CELLS = "id bigint, n bigint, codes binary, label binary, rows binary"


def cut_points(values: DataFrame, bins: int = BINS) -> dict[int, np.ndarray]:
    """Per column the values between its bins, by Spark's rule over all rows instead of a sample of them.

    ``values`` is (c int, v double, n bigint): column, value and rows. Up to ``bins`` distinct values are told apart.
    Of more, going up, there is a cut before the value whose running count is further from the next multiple of rows / ``bins``
    than the one before it. Counts run over range buckets; of the values between the same two multiples no more than the first
    ``bins`` can have a cut, so that few reach the driver.
    """
    counts = values.groupBy("c", "v").agg(F.sum("n").alias("n"))
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(counts.repartitionByRange(parts, "c", "v").withColumn("b", F.spark_partition_id()))
    sizes = placed.groupBy("c", "b").agg(F.sum("n").alias("size"), F.max("v").alias("last"))  # one row per column and bucket
    ahead = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("c", "b", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("ahead"), F.sum("size").over(Window.partitionBy("c")).alias("all"), F.max("last").over(ahead).alias("lower"))
    up = Window.partitionBy("c", "b").orderBy("v")
    running = placed.withColumns({"end": F.sum("n").over(up.rowsBetween(Window.unboundedPreceding, 0)), "below": F.lag("v").over(up)}).join(F.broadcast(offsets), ["c", "b"])
    # multiples of all / bins that lie below the middle of the running counts before and after the value
    passed = F.ceil((2 * (F.col("end") + F.col("ahead")) - F.col("n")) * bins / (2 * F.col("all"))) - 1
    near = running.select("c", "b", "v", F.coalesce("below", "lower").alias("below"), passed.alias("passed"))
    few = near.withColumn("k", F.row_number().over(Window.partitionBy("c", "b", "passed").orderBy("v"))).where(F.col("k") <= bins + 1)
    out: dict[int, list] = {}
    for r in sorted(few.collect(), key=lambda r: (r.c, r.v)):
        out.setdefault(r.c, []).append(r)
    return {c: _walk(rows, bins) for c, rows in out.items()}


def _walk(rows: list, bins: int) -> np.ndarray:
    between = [(r.below + r.v) / 2 for r in rows[1:]]
    if len(rows) > bins:
        done, kept = 0, []
        for r, middle in zip(rows[1:], between, strict=True):
            if r.passed > done:
                kept.append(middle)
                done += 1
        between = kept
    return np.array(between, dtype=float)


@dataclass(frozen=True)
class Shape:
    """Bins of each column of codes; the first ``ordered`` columns are split by order, the others into one bin and the rest."""

    bins: tuple[int, ...]
    ordered: int

    @property
    def features(self) -> int:
        return self.ordered + sum(self.bins[self.ordered :])

    @property
    def width(self) -> int:
        return sum(self.bins)


def pack(batches: Iterable[pa.RecordBatch], shape: Shape, codes: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
    """Cells of all batches of a task: ``codes`` makes rows of codes (columns x rows) and labels of a batch."""
    from pyspark import TaskContext

    part, made = TaskContext.get().partitionId(), 0
    held: list[tuple] = []

    def flush(most: int) -> Iterator[pa.RecordBatch]:
        nonlocal held, made
        if not held:
            return
        cells = merged(shape, *(np.concatenate(x, axis=-1) for x in zip(*held, strict=True)))
        n = len(cells[1])
        if n < most:
            held = [cells]
            return
        held = []
        for i in range(0, n, PACK):
            c, y, w = cells[0][:, i : i + PACK], cells[1][i : i + PACK], cells[2][i : i + PACK]
            one = [[(part << 32) + made], [len(y)], [np.ascontiguousarray(c).tobytes()], [y.tobytes()], [w.tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(one[0], pa.int64()), pa.array(one[1], pa.int64()), *(pa.array(x, pa.binary()) for x in one[2:])], names=["id", "n", "codes", "label", "rows"])
            made += 1

    for batch in batches:
        for c, y in codes(batch):
            held.append(merged(shape, c, y, np.ones(len(y), np.int64)))
            if sum(len(x[1]) for x in held) >= 4 * PACK:
                yield from flush(2 * PACK)
    yield from flush(1)


def gathered(cells: DataFrame) -> DataFrame:
    """Packed cells in as few tasks as keep all cores busy and hold about PACK cells each; a level is a pass with a fixed cost per task."""
    cores = cells.sparkSession.sparkContext.defaultParallelism
    n = cells.agg(F.sum("n")).first()[0] or 0
    return cells.coalesce(cores * max(1, -(-n // (PACK * cores))))


def merged(shape: Shape, codes: np.ndarray, label: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells with equal codes and label as one."""
    if not len(label):
        return codes, label, rows
    keys, room = [label], 1 << 62  # codes as digits of as few numbers as hold them
    for c, size in zip(codes, shape.bins, strict=True):
        if room * size >= 1 << 62:
            keys.append(c.astype(np.int64))
            room = size
        else:
            keys[-1] = keys[-1] * size + c
            room *= size
    order = np.lexsort(keys)
    first = np.zeros(len(order), bool)
    first[0] = True
    for k in keys:
        k = k[order]
        first[1:] |= k[1:] != k[:-1]
    return codes[:, order[first]], label[order[first]], np.add.reduceat(rows[order], np.flatnonzero(first))


def unpacked(batches: Iterable[pa.RecordBatch], columns: int) -> Iterator[tuple]:
    """(id, codes, labels, rows) of each packed row."""
    for batch in batches:
        for i, n, c, y, w in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            yield i, np.frombuffer(c, np.int32).reshape(columns, n), np.frombuffer(y, float), np.frombuffer(w, np.int64)


@dataclass
class Tree:
    """Nodes in the order of a heap from 1 on: the column and bin of the split, -1 at a leaf, and the mean."""

    depth: int
    column: np.ndarray = field(init=False)
    bin: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = 2 << self.depth
        self.column, self.bin, self.value = np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n)

    def node(self, codes: np.ndarray, shape: Shape, level: int) -> np.ndarray:
        """The node of the level under which each cell falls; below a leaf the first one."""
        column = np.maximum(self.column, 0)
        plain = column < shape.ordered
        # right are the bins from low on: all of an ordered column, one of another, none at a leaf
        low = np.where(plain, self.bin + 1, self.bin).astype(np.int32)
        many = np.where(self.column < 0, 0, np.where(plain, 1 << 30, 1)).astype(np.uint32)
        right = lambda b, at: (b - low[at]).view(np.uint32) < many[at]

        def under(node: int, levels: int) -> np.ndarray | int:
            if not levels:
                return np.int32(node)
            if self.column[node] < 0:
                return np.int32(node << levels)
            return np.where(right(codes[column[node]], node), under(2 * node + 1, levels - 1), under(2 * node, levels - 1))

        few = min(level, 3)  # so far whole columns are compared with each node, then each cell with its node
        n = codes.shape[1]
        at = np.broadcast_to(under(1, few), n)
        flat, start = codes.ravel(), column.astype(np.int64) * n
        cells = np.arange(n)
        for _ in range(few, level):
            at = 2 * at + right(flat.take(start[at] + cells), at)
        return at

    def predict(self, codes: np.ndarray, shape: Shape) -> np.ndarray:
        value = self.value.copy()
        for level in range(self.depth):
            leaf = (1 << level) + np.flatnonzero(self.column[1 << level : 2 << level] < 0)
            value[2 * leaf] = value[leaf]
        return value[self.node(codes, shape, self.depth)]


@dataclass
class Ensemble:
    """A sum of trees by weight."""

    trees: list[Tree]
    weights: list[float]

    def predict(self, codes: np.ndarray, shape: Shape) -> np.ndarray:
        out = np.zeros(codes.shape[1])
        for t, w in zip(self.trees, self.weights, strict=True):
            out += w * t.predict(codes, shape)
        return out


@dataclass
class Job:
    """A tree to grow: rows of a leaf at least, features looked at by a node (all where None), the seed of the
    bootstrap (none where None), and for boosting what the trees before it give."""

    tree: Tree
    leaf: int
    seed: int
    drawn: bool = False
    features: int | None = None
    before: Ensemble | None = None


def sums(cells: Iterator[tuple], shape: Shape, jobs: dict[int, Job], level: int) -> dict[int, np.ndarray]:
    """Per tree (count and sum of labels) x node of the level x bin of every column."""
    first, nodes = 1 << level, 1 << level
    edges = np.cumsum([0, *shape.bins])
    out = {k: np.zeros((2, nodes, shape.width)) for k in jobs}
    for i, codes, label, rows in cells:
        for k, job in jobs.items():
            w = drawn(rows, job.seed, i) if job.drawn else rows
            target = label if job.before is None else 2 * (label - job.before.predict(codes, shape))
            at, w = (job.tree.node(codes, shape, level) - first).astype(np.int64), w.astype(float)
            wy = w * target
            for c, size in enumerate(shape.bins):
                place = at * size + codes[c]
                for s, x in enumerate((w, wy)):
                    out[k][s, :, edges[c] : edges[c + 1]] += np.bincount(place, x, nodes * size).reshape(nodes, size)
    for k, job in jobs.items():
        if level:  # nothing is split below a leaf
            out[k][:, np.repeat(job.tree.column[first // 2 : first] < 0, 2)] = 0
    return out


def drawn(rows: np.ndarray, seed: int, pack_: int) -> np.ndarray:
    """How often a bootstrap draws the rows of each cell: the same whenever it is asked."""
    rng = np.random.default_rng([seed, pack_])
    out, several = rng.poisson(1.0, len(rows)), rows > 1
    out[several] = rng.poisson(rows[several])
    return out


def best_splits(total: np.ndarray, shape: Shape, job: Job, level: int) -> list[tuple]:
    """(node, mean, column, bin, mean left, mean right) of every node with rows; column -1 where no split gains."""
    edges = np.cumsum([0, *shape.bins])
    n, s = (x[:, : shape.bins[0]].sum(axis=1, keepdims=True) for x in total)
    left_n, left_s, place, feature = [], [], [], []
    for c, size in enumerate(shape.bins):
        part = total[:, :, edges[c] : edges[c + 1]]
        if c < shape.ordered:
            run = part.cumsum(axis=2)[:, :, :-1]
            place += [(c, b) for b in range(size - 1)]
            feature += [c] * (size - 1)
        else:
            run = np.stack([n, s]) - part
            place += [(c, b) for b in range(size)]
            feature += list(range(shape.ordered + edges[c] - edges[shape.ordered], shape.ordered + edges[c + 1] - edges[shape.ordered]))
        left_n.append(run[0])
        left_s.append(run[1])
    ln, ls = np.concatenate(left_n, axis=1), np.concatenate(left_s, axis=1)
    rn, rs = n - ln, s - ls
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (ls * ls / ln + rs * rs / rn - s * s / n) / n
    gain[~((ln >= job.leaf) & (rn >= job.leaf) & (gain > 0))] = 0
    if job.features is not None and job.features < shape.features:
        looked = np.random.default_rng([job.seed, level, 1]).random((len(n), shape.features)).argsort(axis=1).argsort(axis=1) < job.features
        gain[~looked[:, feature]] = 0
    out = []
    for k in np.flatnonzero(n[:, 0] > 0):
        j = int(gain[k].argmax()) if gain.shape[1] else 0
        mean = float(s[k, 0] / n[k, 0])
        if gain.shape[1] and gain[k, j] > 0:
            out.append(((1 << level) + int(k), mean, *place[j], float(ls[k, j] / ln[k, j]), float(rs[k, j] / rn[k, j])))
        else:
            out.append(((1 << level) + int(k), mean, -1, 0, mean, mean))
    return out


def grow(cells: DataFrame, shape: Shape, jobs: list[Job]) -> None:
    """Grow all trees level by level. The sums of a tree are added up and judged in one task of its own; as many trees
    share a pass as their sums fit into HELD bytes."""
    for level in range(max(j.tree.depth for j in jobs)):
        open_ = {k: j for k, j in enumerate(jobs) if j.tree.depth > level and (level == 0 or (j.tree.column[1 << level >> 1 : 1 << level] >= 0).any())}
        step = max(1, HELD // ((16 * shape.width) << level))
        for start in range(0, len(open_), step):
            _level(cells, shape, dict(list(open_.items())[start : start + step]), level)


def _level(cells: DataFrame, shape: Shape, jobs: dict[int, Job], level: int) -> None:
    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sums(unpacked(batches, len(shape.bins)), shape, jobs, level)
        for k, x in found.items():
            if x[0].any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["tree", "sums"])

    def judge(key: tuple, parts: pa.Table) -> pa.Table:
        k, total = key[0].as_py(), 0.0
        for x in sorted(parts.column("sums").to_pylist()):  # in one order whatever comes first, for equal sums
            total = total + np.frombuffer(x).reshape(2, 1 << level, shape.width)
        rows = best_splits(total, shape, jobs[k], level)
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*[(k, *r) for r in rows], strict=True), kinds, strict=True)], names=["tree", "node", "mean", "c", "b", "l", "r"])

    split = "tree int, node int, mean double, c int, b int, l double, r double"
    for r in cells.mapInArrow(partial, "tree int, sums binary").groupBy("tree").applyInArrow(judge, split).collect():
        t = jobs[r.tree].tree
        t.column[r.node], t.bin[r.node], t.value[r.node] = r.c, r.b, r.mean
        if r.c >= 0:
            t.value[2 * r.node], t.value[2 * r.node + 1] = r.l, r.r


def forest(trees: int, depth: int, leaf: int, seed: int, features: int | None) -> list[Job]:
    return [Job(Tree(depth), leaf, seed + 1000 * (k + 1), True, features) for k in range(trees)]


def mean_of(jobs: list[Job]) -> Ensemble:
    return Ensemble([j.tree for j in jobs], [1 / len(jobs)] * len(jobs))


def boosted(cells: DataFrame, shape: Shape, rounds: int, depth: int, leaf: int, pace: float, seed: int) -> Ensemble:
    """Gradient boosting on squared errors: the first tree counts in full, each later one is fitted to twice what is left, and
    counts by ``pace``."""
    out = Ensemble([], [])
    for k in range(rounds):
        job = Job(Tree(depth), leaf, seed, before=Ensemble([*out.trees], [*out.weights]) if k else None)
        grow(cells, shape, [job])
        out.trees.append(job.tree)
        out.weights.append(pace if k else 1.0)
    return out
