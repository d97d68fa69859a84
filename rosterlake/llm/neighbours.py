"""Near-duplicate vectors by NN-descent over a neighbour graph of balls and cells of vectors.

A ball's vectors are all linked with each other; a cell holds vectors of a dense place that is too
wide for balls. Links between vectors are only counted, and joined up into components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import components, stored

THRESHOLD = 0.95
#: Nodes compared at once, and best neighbours that a node keeps beside all that may be linked.
GROUP_ROWS = 384
NEIGHBOURS = 12
#: Random-hyperplane tables that seed the graph, rounds of descent in which it may still change much,
#: rounds after which a missed recall is an error, and rounds of merging balls.
TABLES = 8
ROUNDS = 6
MOST_ROUNDS = 24
MERGES = 3
#: Linked nodes in a bucket that make a cell, the most vectors of a ball that goes into one, and the
#: rounds of making cells.
SATURATED = 2 * NEIGHBOURS
CELL_BALL = 64
CELL_ROUNDS = 6
#: Vectors of a ball or cell, and vectors asked about them, that are compared at once.
TILE_ROWS = 1024
#: Nodes of each stratum that the audit compares with all others, how far below the cosine of a link
#: the nearest neighbour of the second stratum's nodes may lie, and the recall asked for.
AUDIT_NODES = 4096
AUDIT_NEAR = 0.05
RECALL = 0.995
#: Cosines held at a time by a task of the audit.
_CELLS = 1 << 22
#: Codes are vectors rounded to 8 bits a component; their cosines are off by less than this.
CODE_ERROR = 0.02
_MARGIN = 1e-7


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, dim, vec): rows with unit vectors as 64-bit floats; `vec` is null if there is none."""
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, dims = [], []
            for values in batch["v"].to_pylist():
                unit = unit_of(values)
                units.append(None if unit is None else unit.tobytes())
                dims.append(None if unit is None else len(unit))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["id"], pa.array(dims, pa.int32()), pa.array(units, pa.binary())],
                names=["row", "id", "dim", "vec"],
            )

    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    return rows.mapInArrow(run, f"row long, id {kind}, dim int, vec binary")


def unit_of(values: list | None) -> np.ndarray | None:
    """The vector at length 1; null for null, zero, and vectors with null or non-finite components."""
    if not values or None in values:
        return None
    vector = np.array(values, np.float64)
    largest = np.abs(vector).max()
    if not np.isfinite(vector).all() or largest == 0:
        return None
    vector /= largest  # so that no square overflows or vanishes
    return vector / math.sqrt(float(vector @ vector))


def coded(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True) / 127
    return np.concatenate([scale.astype("<f4").view(np.int8), np.round(vectors / scale).astype(np.int8)], axis=1)


def decoded(codes: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1)
    vectors = raw[:, 4:].astype(np.float32) * np.ascontiguousarray(raw[:, :4]).view("<f4")
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The rows of each key, which arrive sorted by it."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if rest is None else pa.concat_batches([rest, batch])
        keys = rows[key].to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield rows.slice(a, b - a)
        rest = rows.slice(cuts[-1])
    if rest is not None:
        yield rest


def _bucketed(nodes: DataFrame, count: int, seed: int, tables: int, codes: bool) -> DataFrame:
    """The nodes once per table, dealt into groups of at most about `GROUP_ROWS` that lie close.

    A table's buckets are the sides of random hyperplanes on which vectors lie. Buckets are counted,
    and one that holds too many is cut by a hash of its nodes, so that no task gets a hot one.
    """
    bits = max(0, math.ceil(math.log2(max(1, count / GROUP_ROWS)))) + 1
    data = "code" if codes else "vec"
    more = [] if codes else ["loose"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple, np.ndarray] = {}
        for batch in batches:
            dims, vecs = batch["dim"].to_numpy(), batch["vec"].to_pylist()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                matrix = np.frombuffer(b"".join(vecs[i] for i in at), np.float64).reshape(len(at), -1)
                rows = batch.take(pa.array(at))
                if codes:
                    payload = pa.array([c.tobytes() for c in coded(matrix)], pa.binary())
                else:
                    payload = rows["vec"]
                for table in range(tables):
                    if (table, dim) not in planes:
                        planes[table, dim] = np.random.default_rng([seed, table, dim]).normal(size=(dim, bits))
                    sides = (matrix @ planes[table, dim] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [*(rows[c] for c in ("node", "dim", "radius", "n", *more)), payload, pa.array(np.full(len(at), table, np.int32)), pa.array(sides)],
                        names=["node", "dim", "radius", "n", *more, data, "hash_table", "side"],
                    )

    flag = "".join(f"{c} boolean, " for c in more)
    schema = f"node long, dim int, radius double, n long, {flag}{data} binary, hash_table int, side long"
    dealt = stored(nodes.select("node", "dim", "vec", "radius", "n", *more).mapInArrow(run, schema), "vector-buckets")
    keys = ["hash_table", "dim", "side"]
    sizes = dealt.groupBy(*keys).agg(F.ceil(F.count("*") / GROUP_ROWS).alias("parts"))
    salt = F.pmod(F.xxhash64("node", "hash_table"), F.col("parts"))
    grouped = dealt.join(sizes, keys).withColumn("grp", F.xxhash64(*keys, salt)).drop("side", "parts", "hash_table")
    return grouped.repartition("grp").sortWithinPartitions("grp")


def _merged(nodes: DataFrame, count: int, seed: int, limit: float, near_by: float, cells: bool = False) -> DataFrame:
    """(node, dim, into, vec, radius, n, loose): each node with what it joins; vec of `into` in its own row.

    A ball or cell lies around a mean direction of nodes within `near_by` radians of one of them,
    within `limit` radians with all it has taken in. A cell begins with `SATURATED` nodes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "grp"):
            names = group["node"].to_numpy()
            order = np.argsort(names, kind="stable")
            names, radii, n = names[order], group["radius"].to_numpy()[order], group["n"].to_numpy()[order]
            loose = group["loose"].to_numpy(zero_copy_only=False)[order].copy()
            matrix = np.frombuffer(b"".join(group["vec"].to_pylist()), np.float64).reshape(len(names), -1)[order]
            cosines = matrix @ matrix.T
            into, vecs, wide = np.full(len(names), -1), [None] * len(names), radii.copy()
            near = cosines >= math.cos(near_by)
            for leader in np.argsort(-(near @ n), kind="stable"):
                if into[leader] >= 0:
                    continue
                free = np.flatnonzero(near[leader] & (into < 0))
                if leader not in free or (cells and len(free) < SATURATED and not loose[leader]):
                    free = np.array([leader])
                centre = matrix[leader]
                if len(free) > 1:
                    mean = (matrix[free] * n[free, None]).sum(axis=0)
                    mean /= np.linalg.norm(mean)
                    if reach(mean[None], matrix[[leader]])[0] + radii[leader] <= limit:
                        centre = mean
                    else:
                        free = free[reach(centre[None], matrix[free]) + radii[free] <= limit]
                angles = reach(centre[None], matrix[free]) + radii[free]
                taken = free[(angles <= limit) | (free == leader)]
                if len(taken) == 1:
                    centre, taken = matrix[leader], np.array([leader])
                    widest = radii[leader]
                else:
                    widest = float(angles[(angles <= limit) | (free == leader)].max())
                into[taken], vecs[leader], wide[leader] = leader, centre.tobytes(), widest
                loose[leader] |= cells and len(taken) > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), group["dim"], pa.array(names[into]), pa.array(vecs, pa.binary()), pa.array(wide), pa.array(n), pa.array(loose)],
                names=["node", "dim", "into", "vec", "radius", "n", "loose"],
            )

    schema = "node long, dim int, into long, vec binary, radius double, n long, loose boolean"
    return _bucketed(nodes, count, seed, 1, codes=False).mapInArrow(run, schema)


def reach(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Angles between rows, exact also for small ones."""
    return 2 * np.arcsin(np.minimum(np.linalg.norm(a - b, axis=1) / 2, 1.0))


def balls(units: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """((node, dim, vec, radius, n, loose), (row, node)): balls whose vectors are all linked, and members.

    Two vectors within half the threshold's angle of a common centre are linked, so a dense group
    of any size becomes a few nodes and its pairs are never listed.
    """
    limit = math.acos(threshold) / 2 - _MARGIN
    nodes = units.where(F.col("vec").isNotNull()).select(
        F.col("row").alias("node"), "dim", "vec", F.lit(0.0).alias("radius"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("loose")
    )
    members = nodes.select(F.col("node").alias("row"), "node")
    for turn in range(MERGES):
        merged = stored(_merged(nodes, nodes.count(), turn, limit, 2 * limit), "vector-merges")
        nodes, members = _moved(merged, members)
    return nodes, members


def _moved(merged: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes that a merge leaves, and the members of these."""
    sums = merged.groupBy("into").agg(F.sum("n").alias("n"))
    heads = merged.where(F.col("vec").isNotNull()).drop("n", "into")
    nodes = stored(heads.join(sums, F.col("node") == F.col("into")).drop("into"), "vector-balls")
    moved = merged.select(F.col("node").alias("old"), "into")
    members = stored(members.join(moved, F.col("node") == F.col("old")).select("row", F.col("into").alias("node")), "vector-members")
    return nodes, members


def cells(nodes: DataFrame, members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The nodes and members with small balls in dense places put into cells (`loose`).

    Where many nodes are linked, and yet too far apart for one ball, lists of neighbours would be
    as long as there are nodes. A cell takes in what lies within the threshold's angle of its
    centre; its vectors are compared later, tile by tile, and their links counted. Balls of more
    than `CELL_BALL` vectors stay, as their pairs need no comparison. Ends with the round that
    takes away less than one node in fifty.
    """
    angle, size = math.acos(threshold), nodes.count()
    small = F.col("loose") | (F.col("n") <= CELL_BALL)
    for turn in range(CELL_ROUNDS):
        some = nodes.where(small)
        merged = _merged(some, some.count(), 50 + turn, angle, angle, cells=True)
        rest = nodes.where(~small).withColumn("into", F.col("node"))
        merged = stored(merged.unionByName(rest), "vector-cells")
        left = merged.where(F.col("vec").isNotNull()).count()
        if left < size:
            nodes, members = _moved(merged, members)
        if left > 0.98 * size:
            break
        size = left
    return nodes, members


def needed(angle: float, a, b, slack: float):
    """The cosine from which two balls may hold linked vectors, less the error of codes."""
    return np.cos(np.minimum(angle + a + b, math.pi)) - slack


def _best(edges: DataFrame, angle: float) -> DataFrame:
    """Per node its best neighbours, and every one that may be linked, so that full lists grow."""
    each = edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine"), F.max("ra").alias("ra"), F.max("rb").alias("rb"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cosine"), "b"))
    least = F.cos(F.least(F.lit(angle) + F.col("ra") + F.col("rb"), F.lit(math.pi))) - CODE_ERROR
    ranked = each.withColumn("rank", rank)
    return ranked.where((F.col("rank") <= NEIGHBOURS) | (F.col("cosine") >= least)).drop("rank")


_EDGES = "a long, b long, cosine double, ra double, rb double"


def _pairs_within(angle: float, key: str):
    """Compares the nodes of each group with each other and hands on each node's best pairs there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, key):
            if group.num_rows < 2:
                continue
            dims = group["dim"].to_numpy()
            for dim in np.unique(dims):
                rows = group.take(pa.array(np.flatnonzero(dims == dim)))
                names, radii = rows["node"].to_numpy(), rows["radius"].to_numpy()
                vectors = decoded(rows["code"].to_pylist())
                cosines = vectors @ vectors.T
                np.fill_diagonal(cosines, -2)
                keep = cosines >= needed(angle, radii[:, None], radii[None, :], CODE_ERROR)
                if len(names) > NEIGHBOURS + 1:
                    kth = -np.partition(-cosines, NEIGHBOURS - 1, axis=1)[:, NEIGHBOURS - 1]
                    keep |= cosines >= kth[:, None]
                else:
                    keep[:] = True
                np.fill_diagonal(keep, False)
                a, b = np.nonzero(keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[a]), pa.array(names[b]), pa.array(cosines[a, b].astype(np.float64)), pa.array(radii[a]), pa.array(radii[b])],
                    names=["a", "b", "cosine", "ra", "rb"],
                )

    return run


def neighbour_graph(nodes: DataFrame, angle: float, rounds: int | None = None, recall: float = RECALL) -> tuple[DataFrame, float]:
    """(edges (a, b, cosine, ra, rb) in both directions, audited recall of those that may be linked).

    Seeded by hyperplane tables, the graph is refined by NN-descent: at each node its neighbours, and
    those whose neighbour it is, are compared with each other, until hardly anything changes. More
    than `GROUP_ROWS` of them are dealt into groups, otherwise each round, so that no hub is one
    task's work. The audit compares some nodes with all; as long as the recall falls short, another
    set of tables is added and descent goes on. Missing it for `rounds` rounds is an error.
    """
    rounds = MOST_ROUNDS if rounds is None else rounds
    count = nodes.count()
    if count < 2:
        return nodes.sparkSession.createDataFrame([], _EDGES), 1.0
    codes = _codes(nodes)
    true, edges, found = None, None, 0.0
    for turn in range(rounds):
        if turn == 0 or found < recall:
            seeded = _bucketed(nodes, count, 100 + turn, TABLES, codes=True)
            seeded = seeded.mapInArrow(_pairs_within(angle, "grp"), _EDGES)
            edges = stored(_best(seeded if edges is None else edges.unionByName(seeded), angle), "vector-graph")
        if true is None:
            true = stored(linkable(nodes, angle, edges), "vector-audited")
        around = edges.select(F.col("a").alias("z"), F.col("b").alias("node")).unionByName(
            edges.select(F.col("b").alias("z"), F.col("a").alias("node"))
        )
        around = around.distinct()
        hubs = around.groupBy("z").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("parts")).where("parts > 1")
        salt = F.pmod(F.xxhash64("node", F.lit(turn)), F.coalesce("parts", F.lit(1)))
        dealt = around.join(hubs, "z", "left").select("node", F.xxhash64("z", salt).alias("grp"))
        joined = dealt.join(codes, "node").repartition("grp").sortWithinPartitions("grp")
        better = joined.mapInArrow(_pairs_within(angle, "grp"), _EDGES)
        before, edges = edges, stored(_best(edges.unionByName(better), angle), "vector-graph")
        changed = edges.join(before, ["a", "b"], "left_anti").count()
        found = audited(true, edges)
        if found >= recall and (turn + 1 >= ROUNDS or changed <= 0.05 * count * NEIGHBOURS):
            return edges, found
    raise RuntimeError(f"near vectors: recall {found:.4f} after {rounds} rounds, {recall} asked for")


def _codes(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [coded(np.frombuffer(v, np.float64)[None])[0].tobytes() for v in batch["vec"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["dim"], batch["radius"], pa.array(codes, pa.binary())], names=["node", "dim", "radius", "code"]
            )

    schema = "node long, dim int, radius double, code binary"
    return stored(nodes.select("node", "dim", "radius", "vec").mapInArrow(run, schema), "vector-codes")


def audited(true: DataFrame, edges: DataFrame) -> float:
    """The share of the pairs (a, b) in `true` that the graph has."""
    total = true.count()
    return true.join(edges, ["a", "b"], "left_semi").count() / total if total else 1.0


def linkable(nodes: DataFrame, angle: float, edges: DataFrame | None = None) -> DataFrame:
    """(a, b): all pairs that may be linked of a sample of nodes with all others, in one pass.

    One stratum is any `AUDIT_NODES` nodes, the other as many of those that have a neighbour in the
    graph that is linked or nearly so, where missed links are likely. Both are chosen by hash. If
    the first misses nothing, then with 95 % confidence fewer than 3 / `AUDIT_NODES` of all nodes
    have a missed link; a table of no more nodes is audited in full.
    """
    order = F.xxhash64("node", F.lit(7))
    chosen = nodes.select("node").orderBy(order, "node").limit(AUDIT_NODES)
    if edges is not None:
        least = F.cos(F.least(F.lit(angle) + F.col("ra") + F.col("rb"), F.lit(math.pi))) - AUDIT_NEAR
        near = edges.where(F.col("cosine") >= least).select(F.col("a").alias("node")).distinct()
        chosen = chosen.unionByName(near.orderBy(order, "node").limit(AUDIT_NODES)).distinct()
    return _linked_with(nodes, nodes.join(chosen, "node", "left_semi"), angle)


def _linked_with(nodes: DataFrame, block: DataFrame, angle: float) -> DataFrame:
    """(a, b): the pairs of the block's nodes with all others that may be linked."""
    chosen = block.select("node", "dim", "radius", "vec").collect()
    asked: dict[int, list] = {}
    for r in chosen:
        asked.setdefault(r.dim, []).append((r.node, r.radius, bytes(r.vec)))
    shared = nodes.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = {}
        for dim, own in shared.value.items():
            queries = np.frombuffer(b"".join(q[2] for q in own), np.float64).reshape(len(own), -1)
            ready[dim] = queries, np.array([q[0] for q in own]), np.array([q[1] for q in own])
        for batch in batches:
            dims, vecs = batch["dim"].to_numpy(), batch["vec"].to_pylist()
            for dim in np.unique(dims).tolist():
                if dim not in ready:
                    continue
                queries, ids, wide = ready[dim]
                every = np.flatnonzero(dims == dim)
                rows = max(1, _CELLS // len(ids))
                for start in range(0, len(every), rows):
                    at = every[start : start + rows]
                    names, radii = batch["node"].to_numpy()[at], batch["radius"].to_numpy()[at]
                    matrix = np.frombuffer(b"".join(vecs[i] for i in at), np.float64).reshape(len(at), -1)
                    cosines = queries @ matrix.T
                    i, j = np.nonzero(cosines >= needed(angle, wide.max(), radii.max(), 0.0))
                    close = (cosines[i, j] >= needed(angle, wide[i], radii[j], 0.0)) & (ids[i] != names[j])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i[close]]), pa.array(names[j[close]])], names=["a", "b"])

    return nodes.select("node", "dim", "radius", "vec").mapInArrow(run, "a long, b long")


def _judged(pairs: DataFrame, angle: float, threshold: float) -> DataFrame:
    """(x, key, q, n, open): how a vector x is linked with all of ball q, unless open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            radii, loose = batch["rq"].to_numpy(), batch["loose"].to_numpy(zero_copy_only=False)
            cosines, angles = np.zeros(len(radii)), np.zeros(len(radii))
            for k, (v, c) in enumerate(zip(batch["vx"].to_pylist(), batch["cq"].to_pylist(), strict=True)):
                a, b = np.frombuffer(v, np.float64), np.frombuffer(c, np.float64)
                cosines[k], angles[k] = a @ b, reach(a[None], b[None])[0]
            single = (radii == 0) & ~loose
            linked = np.where(single, cosines >= threshold, ~loose & (angles + radii <= angle - _MARGIN))
            unclear = ~single & ~linked & (angles - radii <= angle + _MARGIN)
            keep = pa.array(np.flatnonzero(linked | unclear))
            rows = batch.select(["x", "key", "q", "nq"]).take(keep)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(unclear).take(keep)], names=["x", "key", "q", "n", "open"])

    return pairs.mapInArrow(run, "x long, key long, q long, n long, open boolean")


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels that linked rows and columns of a boolean matrix share; -1 for those without a link."""
    rows, columns = np.full(linked.shape[0], -1), np.full(linked.shape[1], -1)
    for first in np.flatnonzero(linked.any(axis=1)):
        if rows[first] >= 0:
            continue
        new = np.array([first])
        while len(new):
            rows[new] = first
            met = np.flatnonzero(linked[new].any(axis=0) & (columns < 0))
            columns[met] = first
            new = np.flatnonzero(linked[:, met].any(axis=1) & (rows < 0))
    return rows, columns


def _tiled(unclear: DataFrame, within: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(x, n, a, b): vectors that are linked in a tile, with how many, and a link of their keys.

    The vectors asked about a ball or cell, and its members, are cut into tiles of `TILE_ROWS`; each
    pair of tiles is one group of rows, which hands on a row per vector, and never one per pair.
    """
    asked = unclear.groupBy("q").agg(F.ceil(F.count("*") / TILE_ROWS).alias("blocks"))
    sizes = asked.join(nodes.select(F.col("node").alias("q"), F.ceil(F.col("n") / TILE_ROWS).alias("tiles")), "q")

    def dealt(rows: DataFrame, own: str, count: str, other: str, others: str, member: bool) -> DataFrame:
        place = F.pmod(F.xxhash64("x"), F.col(count)).alias(own)
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1)).alias(other)
        return rows.join(sizes, "q").select("q", "x", "key", "vx", place, every).withColumn("member", F.lit(member))

    left = dealt(unclear.select("q", "x", "key").join(within.select("x", "vx"), "x"), "block", "blocks", "tile", "tiles", False)
    right = dealt(within.withColumnRenamed("node", "q"), "tile", "tiles", "block", "blocks", True)
    both = left.unionByName(right).withColumn("grp", F.xxhash64("q", "block", "tile"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "grp"):
            places = np.stack([group[c].to_numpy() for c in ("q", "block", "tile")], axis=1)
            for place in np.unique(places, axis=0):
                rows = group.take(pa.array(np.flatnonzero((places == place).all(axis=1))))
                member = rows["member"].to_numpy(zero_copy_only=False)
                if member.all() or not member.any():
                    continue
                ids, keys, vecs = rows["x"].to_numpy(), rows["key"].to_numpy(), rows["vx"].to_pylist()
                x, y = np.flatnonzero(~member), np.flatnonzero(member)
                matrix = np.frombuffer(b"".join(vecs), np.float64).reshape(len(vecs), -1)
                linked = (matrix[x] @ matrix[y].T >= threshold) & (ids[x][:, None] != ids[y][None, :])
                roots, others = _forest(linked)
                at = np.concatenate([x[roots >= 0], y[others >= 0]])
                root = np.concatenate([roots[roots >= 0], others[others >= 0]])
                n = np.concatenate([linked.sum(axis=1)[roots >= 0], np.zeros((others >= 0).sum(), np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(n), pa.array(keys[at]), pa.array(keys[x][root])], names=["x", "n", "a", "b"]
                )

    grouped = both.repartition("grp").sortWithinPartitions("grp")
    return grouped.mapInArrow(run, "x long, n long, a long, b long")


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> tuple[DataFrame, float]:
    """((id, n_links, component_id, kept) per row, audited recall).

    Vectors are linked if their cosine, in 64-bit floats, reaches the threshold, which every link
    counted is checked against; n_links counts the others linked directly, component_id is the
    smallest id reachable, and a row is kept if that is its own. Null, empty and zero vectors, those
    with null or non-finite components, and those of another length than all others link with
    nothing. Repeated rows are vectors of their own; an empty table gives no rows.
    """
    angle = math.acos(threshold)
    units = stored(unit_vectors(vectors, id_col, vector_col), "vectors")
    nodes, members = cells(*balls(units, threshold), threshold)
    graph, recall = neighbour_graph(nodes, angle)
    key = F.when(F.col("loose"), F.col("row")).otherwise(F.col("node")).alias("key")  # what components join up
    members = members.join(nodes.select("node", "n", "loose"), "node").select("row", "node", key, "n", "loose")
    within = stored(
        members.join(units.select("row", "vec"), "row").select(F.col("row").alias("x"), "node", "key", F.col("vec").alias("vx")),
        "vector-within",
    )
    least = F.cos(F.least(F.lit(angle) + F.col("ra") + F.col("rb"), F.lit(math.pi))) - CODE_ERROR
    close = graph.where(F.col("cosine") >= least).select(F.col("a").alias("p"), F.col("b").alias("q"))
    own = nodes.where("loose").select(F.col("node").alias("p"), F.col("node").alias("q"))
    close = close.unionByName(close.select(F.col("q").alias("p"), F.col("p").alias("q"))).unionByName(own).distinct()
    far = nodes.select(F.col("node").alias("q"), F.col("vec").alias("cq"), F.col("radius").alias("rq"), F.col("n").alias("nq"), "loose")
    pairs = close.join(far, "q").join(within.withColumnRenamed("node", "p"), "p")
    judged = stored(_judged(pairs.select("x", "key", "q", "vx", "cq", "rq", "nq", "loose"), angle, threshold), "vector-judged")
    compared = stored(_tiled(judged.where("open"), within, nodes, threshold), "vector-compared")
    clear = judged.where(~F.col("open")).select("x", "n", F.col("key").alias("a"), F.col("q").alias("b"))
    links = clear.unionByName(compared)
    counts = links.groupBy("x").agg(F.sum("n").alias("outside"))
    joined = components(links.select("a", "b").distinct())
    joined = joined.withColumnRenamed("node", "linked")
    inside = F.when(F.col("loose"), F.lit(0)).otherwise(F.col("n") - 1).alias("inside")
    placed = members.join(joined, F.col("key") == F.col("linked"), "left").select(
        "row", inside, F.coalesce("component", "key").alias("root")
    )
    placed = placed.join(counts, F.col("row") == F.col("x"), "left").drop("x")
    every = units.select("row", "id").join(placed, "row", "left").select(
        "id", "row", "root", (F.coalesce("inside", F.lit(0)) + F.coalesce("outside", F.lit(0))).cast("long").alias("n_links")
    )
    every = stored(every, "vector-links")
    smallest = every.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("least"))
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least"))
    result = every.join(smallest, "root", "left").withColumn("component_id", component)
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return result.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept")), recall
