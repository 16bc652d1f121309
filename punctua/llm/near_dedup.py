"""MinHash near-deduplication by chosen-path trees.

A document's set is its distinct shingles of five words; documents with equal sets are one node of
the search. Every set has a signature of independent minwise tokens. A tree branches all documents
by one token of the signature; a branch that is still too large branches again by tokens chosen by
a hash of its path, on average 1/similarity of them, which keeps a similar pair together in one
branch on average. Small branches are compared exhaustively, first by signature, then on the full
sets; independent trees repeat this until the miss probability of a pair at the threshold is below
``MISS``, where branches are small at once. Each further level keeps such a pair together with a
probability of 0.87, so that pairs of documents that share most of their trees with thousands of
others without being near copies are missed more often: 2e-4 by calculation when all trees go
through all ``LEVELS``. Equal branches of different trees are compared once.

A large branch (a large group of near copies agrees in almost every token) is dealt into blocks that
share random pivots of the branch: block members that are alike become linked. A group of near copies
is in all trees; therefore every document is dealt into blocks of two branches only, its largest and,
as that may be one of a common line, its smallest large one. Branches in which one component then holds
the most, with ``MEETING`` others at most, are settled: they do not branch again, so that a group goes
through one level and not through all. The others branch again, once a level settles none without being
dealt, and what is still large after ``LEVELS`` is dealt too and settled whatever it holds. Members of a settled
branch outside its largest component are compared with all members, up to ``MEETING`` of either side in
a block. Branches of one largest component, those that its trees repeat, do so together. Small branches
come last and compare neither members of a known component nor those that have met already. So no task
holds more than a block, and nothing is left out. Signatures come to a document once per level, not to
each of its branches.

Verified links are reduced to stars within each block; components come from star contraction. What
later links add is contracted on the components found before.

Defined results: a null, empty or blank text has no shingles and is linked with nothing; fewer than
five words are one shingle; texts of any length are read whole; identical rows share a component; ``component_id`` ignores null ids; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import (
    WordHashes, attach, components, join_on, key_bounds, mixed, staged_rows, utf8, whole_keys, windows,
)
from punctua.sources.storage import staged

WORDS = 5
PERCENT = 85
TOKENS = 64
MISS = 1e-9
BRANCH = 512
LEVELS = 4
PIVOTS = 16
# Strays and others that meet in a block: 256 bytes each, so a block has 1 MB.
MEETING = 2048
_FACTORS = np.random.default_rng(64).integers(0, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: list[bytes], hashes: WordHashes, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    return np.unique(windows(hashes.of(words), width))


def signature(found: np.ndarray) -> np.ndarray:
    """The minwise token of the set under each of ``TOKENS`` orders, cut to 32 bits."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        np.minimum(least, (_FACTORS[:, None] * found[None, at:at + 2048]).min(axis=1), out=least)
    return (mixed(least) >> np.uint64(32)).astype(np.uint32)


def trees(percent: int = PERCENT, miss: float = MISS) -> int:
    """Trees that leave a pair at the threshold apart with probability ``miss`` at most."""
    return min(TOKENS, math.ceil(math.log(miss) / math.log(max(miss, 1 - percent / 100))))


def least_matches(percent: int) -> int:
    """Equal signature tokens that a pair at the threshold has but for six standard deviations."""
    p = percent / 100
    return max(1, math.floor(TOKENS * p - 6 * math.sqrt(TOKENS * p * (1 - p))))


def _unite(labels: np.ndarray, i: int, near: np.ndarray) -> None:
    """Give all that carry a label of ``near`` the label of ``i``."""
    if len(near):
        labels[np.isin(labels, labels[near])] = labels[i]


def linked(full: list[np.ndarray], known: np.ndarray, percent: int) -> np.ndarray:
    """Labels, equal where ``known`` components and pairs alike on their full sets connect members."""
    labels = np.unique(known, return_inverse=True)[1]
    sizes = np.array([len(cells) for cells in full])
    starts = np.concatenate(([0], np.cumsum(sizes)))
    distinct, codes = np.unique(np.concatenate(full), return_inverse=True)
    held = np.zeros(len(distinct), bool)
    for i in range(len(full) - 1):
        others = i + 1 + np.flatnonzero(labels[i + 1:] != labels[i])
        if not len(others):
            continue
        held[codes[starts[i]:starts[i + 1]]] = True
        common = np.add.reduceat(held[codes[starts[i + 1]:]], starts[i + 1:-1] - starts[i + 1], dtype=np.int64)[others - i - 1]
        held[codes[starts[i]:starts[i + 1]]] = False
        _unite(labels, i, others[100 * common >= percent * (sizes[i] + sizes[others] - common)])
    return labels


def _signatures(count: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            sizes, digests, heads, marks = [], [], [], []
            for text in utf8(batch.column("text")):
                found = shingles(text.lower().split(), hashes)
                sizes.append(len(found))
                if not len(found):
                    digests.append(None), heads.append(None), marks.append(None)
                    continue
                mark = signature(found)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                heads.append(mark[:count].astype(np.int64))
                marks.append(mark.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("raw"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(heads, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                names=["doc_id", "raw", "n_shingles", "digest", "heads", "mark"])

    return run


def _candidates(percent: int):
    """Of every branch, the groups of members that signatures connect across known components and sets
    of members that have met (the same ``met``, an optional column); one row per member."""
    floor = least_matches(percent)

    def run(batches) -> Iterator:
        import pyarrow as pa

        for rows in whole_keys(batches, "key"):
            uids, known = rows.column("uid").to_numpy(), rows.column("component").to_numpy()
            met = rows.column("met").to_numpy() if "met" in rows.column_names else uids
            marks = np.frombuffer(b"".join(rows.column("mark").to_pylist()), np.uint32).reshape(-1, TOKENS)
            bounds = key_bounds(rows.column("key").to_numpy())
            groups, members, named = [], [], []
            for a, b in zip(bounds, bounds[1:]):
                labels = np.arange(a, b)
                for i in range(a, b - 1):
                    others = i + 1 + np.flatnonzero(
                        (known[i + 1:b] != known[i]) & (met[i + 1:b] != met[i]) & (labels[i + 1 - a:] != labels[i - a]))
                    _unite(labels, i - a, others[(marks[others] == marks[i]).sum(axis=1) >= floor] - a)
                by_label: dict[int, dict[int, int]] = {}
                for i, label in enumerate(labels.tolist(), a):
                    by_label.setdefault(label, {})[int(uids[i])] = int(known[i])
                for component_of in by_label.values():
                    found = sorted(component_of)
                    if len(found) > 1:
                        name = xxhash.xxh3_64_intdigest(np.array(found, np.int64).tobytes()) - 2**63
                        groups += [name] * len(found)
                        members += found
                        named += [component_of[uid] for uid in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(groups, pa.int64()), pa.array(members, pa.int64()), pa.array(named, pa.int64())],
                names=["key", "uid", "component"])

    return run


def _sets(batches) -> Iterator:
    import pyarrow as pa

    hashes = WordHashes()
    for batch in batches:
        found = [shingles(text.lower().split(), hashes).tobytes() for text in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(found, pa.binary())], names=["uid", "shingles"])


def _verified(percent: int):
    """Links from the first to the others of every set that known components and links which hold on the
    full sets make of a candidate group."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        for rows in whole_keys(batches, "key"):
            uids, known = rows.column("uid").to_numpy(), rows.column("component").to_numpy()
            full = [np.frombuffer(cell, np.uint64) for cell in rows.column("shingles").to_pylist()]
            bounds = key_bounds(rows.column("key").to_numpy())
            links = []
            for a, b in zip(bounds, bounds[1:]):
                first: dict[int, int] = {}
                for i, label in enumerate(linked(full[a:b], known[a:b], percent).tolist(), a):
                    if (root := first.setdefault(label, i)) != i:
                        links.append((int(uids[root]), int(uids[i])))
            left, right = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def _by_key(df: DataFrame, function, schema: str) -> DataFrame:
    return df.repartition("key").sortWithinPartitions("key", "uid").mapInArrow(function, schema)


def _sized(members: DataFrame) -> DataFrame:
    """Branches of two members or more, with a fingerprint of who they are."""
    return members.groupBy("key").agg(
        F.count("*").alias("n"), F.expr("bit_xor(xxhash64(uid))").alias("x"),
        F.expr("bit_xor(xxhash64(uid, 1))").alias("y"),
    ).where("n > 1")


def _branches(
    nodes: DataFrame, percent: int, settle: Callable[[DataFrame], DataFrame | None] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Small branches ``key, uid`` and, where there are any, those that stay large ``key, uid, n``.
    ``settle`` gets the large branches of a level and returns those that are to branch again."""
    members = nodes.select("uid", F.posexplode("heads").alias("tree", "token")).select(
        "uid", F.xxhash64("tree", "token").alias("key"))
    marks = nodes.select("uid", "mark")
    every, small = None, None
    for level in range(LEVELS + 1):
        sized = staged(_sized(members), "branches")
        once = sized.where(F.col("n") <= BRANCH).groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key")
        every = members if every is None else every.unionByName(members)
        small = once if small is None else small.union(once)
        large = sized.where(F.col("n") > BRANCH).select("key", "n")
        ended = large.isEmpty()
        large = None if ended else staged(join_on(members, large, ["key"]), "large")
        if large is not None and settle is not None and level < LEVELS:
            large = settle(large)
        if large is None or level == LEVELS:
            return join_on(every, small, ["key"]).select("key", "uid"), large
        hot = staged(join_on(large.groupBy("uid").agg(F.collect_list("key").alias("keys")), marks, ["uid"]), "hot")
        marks = hot.select("uid", "mark")
        again = F.pmod(F.xxhash64("key", F.lit("again")), F.lit(1000)) < F.lit(int(1e5 / percent) - 1000)
        first = F.pmod(F.xxhash64("key", F.lit(0)), F.lit(TOKENS))
        # Never the first again: a member that is twice in a branch would leave its fingerprint.
        second = F.pmod(first + 1 + F.pmod(F.xxhash64("key", F.lit(1)), F.lit(TOKENS - 1)), F.lit(TOKENS))
        chosen = hot.select("uid", "mark", F.explode("keys").alias("key")).select("uid", "mark", "key", F.explode(
            F.when(again, F.array(first, second)).otherwise(F.array(first))).alias("token"))
        members = staged(
            chosen.select("uid", F.xxhash64(
                "key", "token", F.substr("mark", (F.col("token") * 4 + 1).cast("int"), F.lit(4))).alias("key")),
            "members",
        )
    raise AssertionError("unreachable")


def _dealt(large: DataFrame) -> DataFrame:
    """Every document in a block of its largest and of its smallest large branch; random pivots of a
    branch, wherever they are dealt, are in all of its blocks."""
    place = F.struct("n", "key")
    first = staged(large.groupBy("uid").agg(F.array_distinct(F.array(F.max(place), F.min(place))).alias("ends"))
                   .select("uid", F.explode("ends.key").alias("key")), "first")
    blocks = first.groupBy("key").agg(F.ceil(F.count("*") / BRANCH).alias("blocks"))
    own = join_on(first, blocks, ["key"]).withColumn("block", F.pmod(F.xxhash64("uid", F.lit("block")), "blocks"))
    pivots = large.where(F.pmod(F.xxhash64("uid", "key"), "n") < PIVOTS).select("uid", "key")
    pivots = join_on(pivots, blocks, ["key"]) \
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return own.union(pivots.select(own.columns)).select("uid", F.xxhash64("key", "block").alias("key")).distinct()


def _known(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` with the component of their ``uid``, its own where it has none."""
    return join_on(rows, parts.select(F.col("node").alias("uid"), "component"), ["uid"], "left") \
        .withColumn("component", F.coalesce("component", "uid"))


def _mains(named: DataFrame) -> DataFrame:
    """The largest component of every branch, as ``key, main``, with its ``size`` and the number of ``strays``."""
    counts = named.groupBy("key", "component").agg(F.count("*").alias("size"))
    return counts.groupBy("key").agg(
        F.max_by("component", F.struct("size", "component")).alias("main"), F.max("size").alias("size"),
        (F.sum("size") - F.max("size")).alias("strays"))


def _settled(large: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Of the large branches those that the known components settle, by their strays ``main, uid``, and
    the others, if any: ``large`` itself where none is settled. A component meets ``MEETING`` strays of a
    level at most, so that a member costs no more."""
    named = staged(_known(large, parts), "named")
    mains = staged(_mains(named).where((F.col("strays") <= F.col("size")) & (F.col("strays") <= MEETING)), "mains")
    if mains.isEmpty():
        return mains.select("main", F.col("key").alias("uid")), large
    strays = join_on(named.select("key", "uid", "component"), mains.select("key", "main"), ["key"]) \
        .where("component <> main").select("main", "uid")
    strays = staged(strays.distinct(), "strays")
    crowded = strays.groupBy("main").count().where(F.col("count") > MEETING).select("main")
    settled = join_on(mains.select("key", "main"), crowded, ["main"], "left_anti")
    others = staged(join_on(large, settled.select("key"), ["key"], "left_anti"), "others")
    return join_on(strays, crowded, ["main"], "left_anti"), None if others.isEmpty() else others


def _gathered(strays: DataFrame, parts: DataFrame) -> DataFrame:
    """Strays ``main, uid`` with all members of the component that ``main`` now is in, the ``key``, as
    ``key, uid, component``."""
    own = join_on(strays, parts.select(F.col("node").alias("main"), F.col("component").alias("key")), ["main"])
    own = staged(_known(own.select("key", "uid").distinct(), parts).where("component <> key"), "strays")
    inside = join_on(parts.select(F.col("component").alias("key"), F.col("node").alias("uid")), own.select("key").distinct(), ["key"])
    return own.select("key", "uid", "component").union(inside.select("key", "uid", F.col("key").alias("component")))


def _merged(large: DataFrame, parts: DataFrame) -> DataFrame:
    """Large branches with members outside the largest component, as ``key, uid, component``. Those of one
    largest component, the ``key``, are one here: near copies are in all the trees, and meet once."""
    named = staged(_known(large, parts), "named")
    main = _mains(named).where("strays > 0").select("key", "main")
    return join_on(named, main, ["key"]).select(F.col("main").alias("key"), "uid", "component")


def _strays(merged: DataFrame) -> DataFrame:
    """Blocks in which all members outside the component ``key`` meet all members."""
    counts = merged.groupBy("key").agg(F.count("*").alias("n"), F.count_if(F.col("component") != F.col("key")).alias("strays"))
    open_ = join_on(merged, counts, ["key"]).withColumns({
        "chunks": F.ceil(F.col("strays") / MEETING), "blocks": F.ceil(F.col("n") / MEETING),
    }).withColumns({
        "chunk": F.pmod(F.xxhash64("uid", F.lit("chunk")), F.col("chunks")),
        "block": F.pmod(F.xxhash64("uid", F.lit("part")), F.col("blocks")),
    })
    zero = F.lit(0).cast("long")
    strays = open_.where("component <> key").withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    others = open_.withColumn("chunk", F.explode(F.sequence(zero, F.col("chunks") - 1)))
    return strays.union(others.select(strays.columns)).select(
        "uid", F.xxhash64("key", "chunk", "block").alias("key")).distinct()


def _contracted(parts: DataFrame, more: DataFrame) -> DataFrame:
    """The components ``parts`` (``node, component``) with more links ``a, b`` between them."""
    for end in ("a", "b"):
        more = join_on(more, parts.select(F.col("node").alias(end), "component"), [end], "left") \
            .withColumn(end, F.coalesce("component", end)).drop("component")
    across = staged(more.where("a <> b").distinct(), "across")
    if across.isEmpty():
        return parts
    merged = staged(components(across).select(F.col("node").alias("component"), F.col("component").alias("into")), "merged")
    every = parts.union(merged.select(F.col("component").alias("node"), "component")).distinct()
    return join_on(every, merged, ["component"], "left").select("node", F.coalesce("into", "component").alias("component"))


def near_groups(docs: DataFrame, percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """Every row's component: ``doc_id, uid, raw, n_shingles, component_id, keep_uid``.

    ``raw`` is a hash of the text. One row of a component has ``uid = keep_uid``: that of its least id.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"),
                        F.col("text").cast("string").alias("text"))
    rows = staged_rows(
        texts.mapInArrow(_signatures(trees(percent, miss)), "doc_id long, raw long, n_shingles long, digest binary, "
                         "heads array<long>, mark binary"), "signatures")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid"))
    nodes = staged(
        rows.where("digest IS NOT NULL").groupBy("digest")
        .agg(F.min("uid").alias("uid"), best.alias("best"), F.first("heads").alias("heads"), F.first("mark").alias("mark")),
        "nodes",
    )

    def links(members: DataFrame, parts: DataFrame | None = None, merged: DataFrame | None = None) -> DataFrame:
        marks = nodes.select("uid", "mark")
        marks = marks.withColumn("component", F.col("uid")) if parts is None else _known(marks, parts)
        if merged is not None:
            # Below all uids, which stand for those that met nobody; of several places one is enough.
            places = merged.groupBy("uid").agg((-1 - F.min("key")).alias("met"))
            marks = join_on(marks, places, ["uid"], "left").withColumn("met", F.coalesce("met", "uid"))
        found = _by_key(join_on(members, marks, ["uid"]), _candidates(percent), "key long, uid long, component long")
        found = staged(found.distinct(), "candidates")
        wanted = join_on(rows.select("uid", "doc_id", "raw"), found.select("uid").distinct(), ["uid"])
        full = join_on(texts, wanted, ["doc_id", "raw"]).select("uid", "text")
        full = full.mapInArrow(_sets, "uid long, shingles binary").dropDuplicates(["uid"])
        return staged(_by_key(join_on(found, full, ["uid"]), _verified(percent), "a long, b long"), "verified")

    parts, strays, settling = None, [], True

    def linked_more(members: DataFrame, met: DataFrame | None = None) -> DataFrame:
        more = links(members, parts, met)
        return staged(components(more) if parts is None else _contracted(parts, more), "components")

    def settle(large: DataFrame) -> DataFrame | None:
        nonlocal parts, settling
        if not settling:
            return large
        parts = linked_more(_dealt(large))
        found, others = _settled(large, parts)
        strays.append(found)
        settling = others is not large
        return others

    members, large = _branches(nodes, percent, settle)
    if large is not None:
        parts = linked_more(_dealt(large))
    meetings = [_gathered(found, parts) for found in strays] + ([] if large is None else [_merged(large, parts)])
    merged = staged(reduce(DataFrame.union, meetings).distinct(), "merged") if meetings else None
    if merged is not None and merged.isEmpty():
        merged = None
    if merged is not None:
        parts = linked_more(_strays(merged))
    parts = linked_more(members, merged)
    named = _known(nodes.select("digest", "uid", "best"), parts)
    kept = named.groupBy("component").agg(F.min("best").alias("best"))
    by_digest = join_on(named.select("digest", "component"), kept, ["component"]).select(
        "digest", F.col("best.doc_id").alias("component_id"), F.col("best.uid").alias("keep_uid"))
    alone = F.col("digest").isNull()
    return attach(rows.drop("heads", "mark"), by_digest, ["digest"]).select(
        "doc_id", "uid", "raw", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("uid")).otherwise(F.col("keep_uid")).alias("keep_uid"),
    )
