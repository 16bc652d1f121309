"""Near-duplicate embeddings by sorted projection passes.

Equal vectors are one node with a weight. Each pass orders all nodes by a key of 64 random hyperplane
bits, compares every node with its next ``WINDOW`` neighbours in that order, and keeps a forest of the
pairs whose cosine in double precision reaches the threshold. Passes differ in their hyperplanes;
their pairs are united into components. Range partitions are compared as streams, and the ends of
neighbouring ranges meet in a second small step, so that no window is cut.

A pair at the threshold agrees in a bit with probability ``p = 1 - angle/pi``. It surely stays within
the window of a node when it agrees in one bit more than that node shares with the node a window away.
Every pass measures that for every node, so each node knows how likely all passes so far are to miss
a link of it. A first round has the passes that evenly spread nodes need (``n^0.22`` of them). Nodes
whose links may still be missed more often than ``MISS``, as in a crowd that shares a direction, go
through further passes among themselves, until none is left or comparing them all block by block is
cheaper; then those outside the largest component meet all of them, which misses nothing.

Links within a component are then counted exactly without listing them. Small components are compared
in one block. In a large one, the nodes within half the threshold angle of its mean direction are all
linked with one another by the triangle inequality, and only the remaining ones are compared with the
members, block by block.

Defined results: a vector that is null, empty, zero or has null or non-finite parts is alone, as are
vectors of different lengths to one another; repeated rows and ids are rows of their own; an empty
table gives an empty result; other columns, labels among them, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import Sets, attach, components, join_on, key_bounds, staged_rows, whole_keys
from punctua.sources.storage import staged

COSINE = 0.9
WINDOW = 64
MISS = 1e-3
BLOCK = 1024
ROUND = 64  # passes between two looks at what is still crowded
UNITS = 10**9  # a chance of one, in the whole numbers that travel


def agreement(cosine: float) -> float:
    """Probability that a pair of this cosine lies on the same side of a random hyperplane."""
    return 1 - math.acos(cosine) / math.pi


def passes(nodes: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold is missed with probability ``miss`` at most, where
    nodes spread evenly."""
    together = agreement(cosine) ** max(0.0, math.log2(max(1, nodes) / window) + 1)
    return max(1, math.ceil(math.log(miss) / math.log(max(1 - together, 1e-12))))


def _vectors(batches) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        digests, packed = [], []
        for cell in batch.column("vector").to_pylist():
            good = bool(cell) and None not in cell
            values = np.array(cell if good else [0.0], np.float64)
            with np.errstate(over="ignore"):
                good = good and np.isfinite(values).all() and 0 < (values @ values) < math.inf
            values = values + 0.0  # no negative zero
            digests.append(xxhash.xxh3_128_digest(values.tobytes()) if good else None)
            packed.append(values.tobytes() if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())],
            names=["vec_id", "digest", "vector"])


def matrix(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), np.float64).reshape(len(cells), -1)


def _projected(first: int, count: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        planes: dict[tuple[int, int], np.ndarray] = {}
        bits = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
        for batch in batches:
            cells = batch.column("vector").to_pylist()
            sizes = np.array([len(cell) // 8 for cell in cells])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                values = matrix([cells[i] for i in rows])
                picked = batch.take(pa.array(rows))
                for number in range(first, first + count):
                    if (size, number) not in planes:
                        planes[size, number] = np.random.default_rng([int(size), number]).standard_normal((size, 64))
                    sides = values @ planes[size, number] > 0
                    keys = (sides * bits).sum(axis=1, dtype=np.uint64) ^ np.uint64(1 << 63)
                    name = np.full(len(rows), int(size) * 100_000 + number, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name), pa.array(keys.view(np.int64)), picked.column("uid"), picked.column("vector")],
                        names=["pass", "key", "uid", "vector"])

    return run


def forest(values: np.ndarray, window: int, cosine: float, near) -> list[tuple[int, int]]:
    """A forest of the rows linked within the window; ``near(i, j)`` tells which pairs may be compared."""
    norms = np.sqrt(np.einsum("ij,ij->i", values, values))
    root, links = np.arange(len(values)), []
    for step in range(1, min(window, len(values) - 1) + 1):
        i = np.flatnonzero(near(np.arange(len(values) - step), np.arange(step, len(values))))
        i = i[root[i] != root[i + step]]
        if not len(i):
            continue
        dots = np.einsum("ij,ij->i", values[i], values[i + step])
        i = i[dots / (norms[i] * norms[i + step]) >= cosine]
        for a in i.tolist():
            x, y = a, a + step
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((a, a + step))
        while not np.array_equal(root, root[root]):
            root = root[root]
    return links


def chances(keys: np.ndarray, window: int, agree: float, begins: bool, ends: bool) -> np.ndarray:
    """For every row of a sorted pass, how likely a row at the threshold is within its window. A row
    that first differs in bit m lies before it or after it by that bit, and surely nearer than the row
    a window away on that side if that one differs earlier. Beyond the ends is nothing or unknown."""
    far = (keys[window:] ^ keys[:-window]).view(np.uint64) if len(keys) > window else np.empty(0, np.uint64)
    shared = 64 - np.frexp(far.astype(float))[1]
    edge = np.ones(min(window, len(keys)), np.int64)
    before, after = np.append(edge * (-1 if begins else 64), shared), np.append(shared, edge * (-1 if ends else 64))
    bits, found = keys.view(np.uint64) ^ np.uint64(1 << 63), np.zeros(len(keys))
    for m in range(64):
        ones = bits >> np.uint64(63 - m) & np.uint64(1) > 0
        found += (np.where(ones, before, after) < m) * (agree**m * (1 - agree))
    return found


def _windows(window: int, cosine: float):
    """Links of a sorted range (``side`` 0), the names of its first and last rows (1 and 2), and the
    logarithm of every row's chance not to meet a row at the threshold (3)."""
    agree = agreement(cosine)

    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        here = TaskContext.get().partitionId()
        held, seen = None, 0

        def reached(uids, chance):
            whole = np.rint(-np.log1p(-np.minimum(chance, 1 - 1e-6)) * UNITS).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(uids), 3)), pa.array(uids), pa.array(whole), *[pa.array(np.zeros(len(uids), np.int64))] * 2],
                names=["side", "a", "b", "range", "pass"])

        def out(rows):
            columns = list(zip(*rows)) or [()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                              names=["side", "a", "b", "range", "pass"])

        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            rows = fresh if held is None else pa.concat_tables([held, fresh])
            old = 0 if held is None else held.num_rows
            uids, names, keys = (rows.column(n).to_numpy() for n in ("uid", "pass", "key"))
            whole = here == 0 or seen > old  # what precedes the first row here is known not to matter
            found = []
            if seen < window:
                found += [(1, int(u), seen + i, here - 1, int(p)) for i, (u, p) in enumerate(
                    zip(uids[old:old + window - seen], names[old:old + window - seen]))]
            seen += batch.num_rows
            bounds = key_bounds(names)
            for a, b in zip(bounds, bounds[1:]):
                values = matrix(rows.column("vector").slice(a, b - a).to_pylist())
                fresh_from = max(0, old - a)
                for i, j in forest(values, window, cosine, lambda i, j: j >= fresh_from):
                    found.append((0, int(uids[a + i]), int(uids[a + j]), here, int(names[a])))
                # Rows whose window was open before; the last pass goes on, its last rows wait.
                ended = b < rows.num_rows
                c, d = max(a, old - window), b if ended else b - window
                if c < d:
                    yield reached(uids[c:d], chances(keys[a:b], window, agree, a > 0 or whole, ended)[c - a:d - a])
            held = rows.slice(max(0, rows.num_rows - 2 * window))
            yield out(found)
        if held is not None:
            names, uids, keys = (held.column(n).to_numpy() for n in ("pass", "uid", "key"))
            a = int(key_bounds(names)[-2])
            c = max(a, len(uids) - window)
            yield reached(uids[c:], chances(keys[a:], window, agree, a > 0 or here == 0 or seen > len(uids), False)[c - a:])
            held = held.slice(max(0, held.num_rows - window))
            names, uids = held.column("pass").to_numpy(), held.column("uid").to_numpy()
            yield out([(2, int(u), i - len(uids), here, int(p)) for i, (u, p) in enumerate(zip(uids, names))])

    return run


def _ends(window: int, cosine: float):
    """Links between the last rows of a range and the first rows of the next."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        for rows in whole_keys(batches, "range"):
            bounds = key_bounds(rows.column("range").to_numpy())
            found = []
            for a, b in zip(bounds, bounds[1:]):
                part = rows.slice(a, b - a)
                order = np.lexsort((part.column("b").to_numpy(), part.column("pass").to_numpy()))
                part = part.take(pa.array(order))
                place, uids = part.column("b").to_numpy(), part.column("a").to_numpy()
                inner = key_bounds(part.column("pass").to_numpy())
                for c, d in zip(inner, inner[1:]):
                    at = place[c:d]
                    values = matrix(part.column("vector").slice(c, d - c).to_pylist())
                    for i, j in forest(values, window, cosine,
                                       lambda i, j: (at[i] < 0) & (at[j] >= 0) & (at[j] - at[i] <= window)):
                        found.append((int(uids[c + i]), int(uids[c + j])))
            columns = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return run


def _met(cosine: float):
    """Per block, a forest of the links of its probes (``role`` 1) with its members (2)."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        for rows in whole_keys(batches, "key"):
            bounds = key_bounds(rows.column("key").to_numpy())
            found = []
            for a, b in zip(bounds, bounds[1:]):
                part = rows.slice(a, b - a)
                values = matrix(part.column("vector").to_pylist())
                values = values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]
                role, uid = part.column("role").to_numpy(), part.column("uid").to_numpy()
                probes, members = np.flatnonzero(role == 1), np.flatnonzero(role == 2)
                sets, (_, number) = Sets(b - a), np.unique(uid, return_inverse=True)
                for i, j in zip(*np.nonzero(values[probes] @ values[members].T >= cosine)):
                    x, y = int(number[probes[i]]), int(number[members[j]])
                    if sets.find(x) != sets.find(y):
                        sets.join(x, y)
                        found.append((int(uid[probes[i]]), int(uid[members[j]])))
            columns = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return run


def _strays(crowd: DataFrame, parts: DataFrame) -> DataFrame:
    """The crowd with vector lengths, and whether a node is outside the largest component of its length."""
    named = join_on(crowd, parts.withColumnRenamed("node", "uid"), ["uid"], "left").select(
        "uid", "vector", F.length("vector").alias("width"), F.coalesce("component", "uid").alias("component"))
    main = named.groupBy("width", "component").agg(F.count("*").alias("size")).groupBy("width").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"),
        F.sum("size").alias("n"), (F.sum("size") - F.max("size")).alias("strays"))
    return join_on(named, main, ["width"]).withColumn("stray", F.col("component") != F.col("main"))


def _meetings(named: DataFrame, cosine: float) -> DataFrame:
    """Links of all strays of a crowd with all of its nodes, block by block."""
    half = BLOCK // 2
    dealt = named.where("strays > 0").withColumns({"chunks": F.ceil(F.col("strays") / half), "blocks": F.ceil(F.col("n") / half)}) \
        .withColumns({"chunk": F.pmod(F.xxhash64("uid"), F.col("chunks")), "block": F.pmod(F.xxhash64("uid", F.lit(1)), F.col("blocks"))})
    zero = F.lit(0).cast("long")
    probes = dealt.where("stray").withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1))).withColumn("role", F.lit(1))
    others = dealt.withColumn("chunk", F.explode(F.sequence(zero, F.col("chunks") - 1))).withColumn("role", F.lit(2))
    return probes.unionByName(others).select(F.xxhash64("width", "chunk", "block").alias("key"), "uid", "vector", "role") \
        .repartition("key").sortWithinPartitions("key").mapInArrow(_met(cosine), "a long, b long")


def all_links(nodes: DataFrame, cosine: float, window: int, miss: float) -> DataFrame:
    """Links ``a, b`` that connect every component of ``uid, vector``."""
    need = -math.log(miss)
    crowd, edges, reach, first, more = nodes, None, None, 0, passes(nodes.count(), cosine, window, miss)
    while True:
        ordered = crowd.mapInArrow(_projected(first, more), "pass long, key long, uid long, vector binary") \
            .repartitionByRange("pass", "key", "uid").sortWithinPartitions("pass", "key", "uid")
        found = staged(ordered.mapInArrow(_windows(window, cosine), "side long, a long, b long, range long, pass long"), "links")
        ends = join_on(found.where("side IN (1, 2)"), nodes.select(F.col("uid").alias("a"), "vector"), ["a"])
        across = ends.repartition("range").sortWithinPartitions("range").mapInArrow(_ends(window, cosine), "a long, b long")
        fresh = found.where("side = 0").select("a", "b").union(across)
        edges = fresh if edges is None else edges.union(fresh)
        gained = found.where("side = 3").groupBy(F.col("a").alias("uid")).agg((F.sum("b") / UNITS).alias("gain"))
        before = F.lit(0.0) if reach is None else F.col("reach")
        reach = staged((gained if reach is None else join_on(gained, reach, ["uid"])).select(
            "uid", (before + F.col("gain")).alias("reach"), "gain").where(F.col("reach") < need).select(
            "uid", "reach", "gain"), "reach")
        size, lacking, gain = reach.agg(F.count("*"), F.avg(need - F.col("reach")), F.avg("gain")).first()
        if size < 2:
            return edges
        rate, first = gain / more, first + more
        more = math.ceil(min(1e9, 1.2 * lacking / max(rate, 1e-9)))
        crowd = staged(join_on(reach.select("uid"), nodes, ["uid"]), "crowd")
        reach = reach.select("uid", "reach")
        half = BLOCK // 2
        if more >= min(ROUND, math.ceil(size / half)):
            edges = staged(edges, "edges")
            named = staged(_strays(crowd, staged(components(edges), "components")), "strays")
            if more >= math.ceil(named.where("stray").count() / half):
                return edges.union(_meetings(named, cosine))
        more = min(more, ROUND)


def _counted(cosine: float):
    """Per block, the links of its probes (``role`` 1 or 3) with its members (2 or 3)."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        for rows in whole_keys(batches, "key"):
            bounds = key_bounds(rows.column("key").to_numpy())
            uids, links = [], []
            for a, b in zip(bounds, bounds[1:]):
                part = rows.slice(a, b - a)
                values = matrix(part.column("vector").to_pylist())
                norms = np.sqrt(np.einsum("ij,ij->i", values, values))
                role, weight = part.column("role").to_numpy(), part.column("weight").to_numpy()
                uid, core = part.column("uid").to_numpy(), part.column("core").to_numpy(zero_copy_only=False)
                probes, members = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
                hit = (values[probes] @ values[members].T) / np.outer(norms[probes], norms[members]) >= cosine
                hit &= uid[probes][:, None] != uid[members][None, :]
                uids += [uid[probes], uid[members]]
                links += [hit @ weight[members], np.where(core[members], weight[probes] @ hit, 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(uids), pa.int64()), pa.array(np.concatenate(links), pa.int64())], names=["uid", "links"])

    return run


def _totals(batches) -> Iterator:
    """Sums of unit vectors per component, one row for each batch."""
    import pyarrow as pa

    for batch in batches:
        names = batch.column("component").to_numpy()
        cells = batch.column("vector").to_pylist()
        found = {}
        for name, cell in zip(names.tolist(), cells):
            values = np.frombuffer(cell, np.float64)
            values = values / np.sqrt(values @ values)
            found[name] = found[name] + values if name in found else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.int64()), pa.array([v.tolist() for v in found.values()], pa.list_(pa.float64()))],
            names=["component", "total"])


def _cores(cosine: float):
    """Whether a vector lies within half the threshold angle of its component's mean direction."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        half = math.cos(math.acos(cosine) / 2 - 1e-9)
        for batch in batches:
            core = []
            for cell, center in zip(batch.column("vector").to_pylist(), batch.column("center").to_pylist()):
                values, center = np.frombuffer(cell, np.float64), np.array(center)
                scale = math.sqrt(values @ values) * math.sqrt(center @ center)
                core.append(bool(scale > 0 and values @ center >= half * scale))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("component", "uid", "weight", "vector", "size")), pa.array(core)],
                names=["component", "uid", "weight", "vector", "size", "core"])

    return run


def link_counts(members: DataFrame, cosine: float) -> DataFrame:
    """``uid, links`` of ``component, uid, weight, vector``: links with the other nodes of the component."""
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    sized = staged(join_on(members, sizes, ["component"]), "members")
    small = sized.where(F.col("size") <= BLOCK).select(
        F.col("component").alias("key"), "uid", "weight", "vector", F.lit(False).alias("core"), F.lit(3).alias("role"))
    large = sized.where(F.col("size") > BLOCK)
    totals = large.select("component", "vector").mapInArrow(_totals, "component long, total array<double>")
    centers = (
        totals.select("component", F.posexplode("total").alias("at", "x")).groupBy("component", "at").agg(F.sum("x").alias("x"))
        .groupBy("component").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("c"))
        .select("component", F.transform("c", lambda e: e["x"]).alias("center"))
    )
    parted = staged(join_on(large, centers, ["component"]).mapInArrow(
        _cores(cosine), "component long, uid long, weight long, vector binary, size long, core boolean"), "cores")
    shares = parted.groupBy("component").agg(
        F.sum(F.when(F.col("core"), F.col("weight")).otherwise(0)).alias("mass"),
        F.sum(F.when(F.col("core"), 0).otherwise(1)).alias("rest"))
    half = BLOCK // 2
    dealt = join_on(parted, shares, ["component"]).withColumns({
        "chunks": F.ceil(F.col("rest") / half), "blocks": F.ceil(F.col("size") / half)})
    inside = dealt.where("core").select("uid", (F.col("mass") - F.col("weight")).alias("links"))
    open_ = dealt.where("rest > 0").withColumns({
        "chunk": F.pmod(F.xxhash64("uid"), F.col("chunks")), "block": F.pmod(F.xxhash64("uid", F.lit(1)), F.col("blocks"))})
    zero = F.lit(0).cast("long")
    probes = open_.where("NOT core").withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1))).withColumn("role", F.lit(1))
    others = open_.withColumn("chunk", F.explode(F.sequence(zero, F.col("chunks") - 1))).withColumn("role", F.lit(2))
    blocks = probes.unionByName(others).select(
        F.xxhash64("component", "chunk", "block").alias("key"), "uid", "weight", "vector", "core", "role")
    counted = small.union(blocks).repartition("key").sortWithinPartitions("key").mapInArrow(
        _counted(cosine), "uid long, links long")
    return counted.union(inside).groupBy("uid").agg(F.sum("links").alias("links"))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> DataFrame:
    """``vec_id, n_links, component_id`` of every row of ``vec_id, embedding``."""
    rows = staged_rows(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        .mapInArrow(_vectors, "vec_id long, digest binary, vector binary"), "vectors")
    nodes = staged(
        rows.where("digest IS NOT NULL").groupBy("digest").agg(
            F.min("uid").alias("uid"), F.count("*").alias("weight"), F.min("vec_id").alias("least"),
            F.first("vector").alias("vector")), "nodes")
    parts = staged(components(all_links(nodes.select("uid", "vector"), cosine, window, miss)), "components")
    named = staged(join_on(parts.withColumnRenamed("node", "uid"), nodes, ["uid"]), "named")
    links = link_counts(named.select("component", "uid", "weight", "vector"), cosine)
    least = named.groupBy("component").agg(F.min("least").alias("first"))
    facts = join_on(join_on(named.select("uid", "component"), least, ["component"]), links, ["uid"], "left")
    by_digest = join_on(nodes.select("digest", "uid", "weight", "least"), facts, ["uid"], "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("first", "least").alias("component_id"))
    alone = F.col("digest").isNull()
    return attach(rows.drop("vector"), by_digest, ["digest"]).select(
        "vec_id", F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
