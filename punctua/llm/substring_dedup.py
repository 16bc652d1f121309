"""Removal of long repeated passages through a sparse De Bruijn graph of token k-mers.

Of the k-mers of a text those are kept as edges that are the least, in hash order, of some window of
``WINDOW`` words; equal windows keep equal k-mers, so no repeated window is missed, while one k-mer in
fourteen remains. An edge's context is the text up to the edges before and after it.

* *Repeated edges.* One aggregation per k-mer counts its occurrences and tells whether all of them have
  the same context. If so, the path through it does not branch.
* *Compaction.* Repeated edges and their flags are joined back to their source coordinates, where
  neighbours that do not branch merge into one path. All occurrences of a non-branching path are
  equal over its whole length, so every window inside it is repeated without looking at it.
* *Verification.* Windows with a repeated edge that leave such a path (a branch, the end of a text)
  are hashed whole at their source coordinates; those that occur again are repeated.

Texts with the same words are one text with a multiplicity, so a large group of copies is reduced
before anything else. Hot passages are k-mers and windows with many occurrences: they are counted with
partial aggregation, and what is known about them comes back to their occurrences part by part.

Defined results: null, empty and blank texts have no words; a text with fewer words than a window
keeps all; repeated rows are copies like any other; ``kept_sha256`` of no words is that of the empty
string; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import WordHashes, attach, join_on, mixed, staged_rows, utf8, windows
from punctua.sources.storage import Scratch, staged

WINDOW = 35
EDGE = 8
PLACE = np.uint64((1 << 28) - 1)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    step, least = 1, values
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    rest = width - step
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def edges_of(hashes: np.ndarray, window: int, edge: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all k-mers, positions of the kept ones, and for every window the position of its own."""
    marks = windows(hashes, edge)
    placed = (marks & ~PLACE) | np.arange(len(marks), dtype=np.uint64)
    own = (sliding_least(placed, window - edge + 1) & PLACE).astype(np.int64)
    kept = own[np.concatenate(([True], own[1:] != own[:-1]))]
    return marks, kept, own


def contexts(hashes: np.ndarray, kept: np.ndarray, edge: int, name: int) -> np.ndarray:
    """A hash of the text from the edge before to the edge after, unique to the text at its ends."""
    count = len(hashes)
    base = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(count, base, np.uint64))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes) * powers)))
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        backward = np.cumprod(np.full(count, inverse, np.uint64))
        found = np.arange(1, len(kept) + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(name)
        if len(kept) > 2:
            a, b = kept[:-2], kept[2:] + edge
            middle = kept[1:-1]
            text = (sums[b] - sums[a]) * backward[a]
            found[1:-1] = text + mixed(((middle - a) * 4096 + (b - middle)).astype(np.uint64))
    return mixed(found)


def runs(starts: np.ndarray, length: int) -> list[int]:
    """Words that windows cover, as ``[from, to, from, to, ...]`` in ascending order."""
    if not len(starts):
        return []
    starts = np.unique(starts)
    cut = np.flatnonzero(np.diff(starts) > length)
    first, last = np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(starts) - 1]))
    return np.stack([starts[first], starts[last] + length], axis=1).ravel().tolist()


def _first_pass(window: int, edge: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            sizes, whole, digests, places, marks, sides = [], [], [], [], [], []
            raws = batch.column("raw").to_pylist()
            for raw, text in zip(raws, utf8(batch.column("text"))):
                words = text.split()
                sizes.append(len(words))
                whole.append(hashlib.sha256(b" ".join(words)).hexdigest())
                if len(words) < window:
                    digests.append(None), places.append(None), marks.append(None), sides.append(None)
                    continue
                found = hashes.of(words)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                every, kept, _ = edges_of(found, window, edge)
                places.append(kept.astype(np.int32))
                marks.append(every[kept].view(np.int64))
                sides.append(contexts(found, kept, edge, raw % (1 << 64)).view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("raw"), pa.array(sizes, pa.int64()), pa.array(whole),
                 pa.array(digests, pa.binary()), pa.array(places, pa.list_(pa.int32())), pa.array(marks, longs),
                 pa.array(sides, longs)],
                names=["doc_id", "raw", "n_words", "whole", "digest", "place", "mark", "side"])

    return run


def certain(kept: np.ndarray, own: np.ndarray, repeated: np.ndarray, branches: np.ndarray, window: int, edge: int):
    """For every window: whether its own edge is repeated, and whether a path that does not branch
    covers it. ``repeated`` and ``branches`` belong to the kept edges."""
    starts = np.arange(len(own))
    owner = np.searchsorted(kept, own)
    left = np.searchsorted(kept, starts, "right") - 1
    right = np.searchsorted(kept, starts + window - edge)
    inside = (left >= 0) & (right < len(kept))
    sums = np.concatenate(([0], np.cumsum(branches)))
    i, j = np.maximum(left, 0), np.minimum(right, len(kept) - 1)
    between = sums[np.maximum(j, i + 1)] - sums[i + 1]
    return repeated[owner], repeated[owner] & inside & (between == 0) & ~branches[owner], owner


def _second_pass(window: int, edge: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        hashes = WordHashes()
        for batch in batches:
            spans, starts, marks, checks = [], [], [], []
            hits = batch.column("hits").to_pylist()
            for text, hit in zip(utf8(batch.column("text")), hits):
                found = hashes.of(text.split())
                every, kept, own = edges_of(found, window, edge)
                at = np.searchsorted(kept, [h["place"] for h in hit])
                repeated, branches = np.zeros(len(kept), bool), np.ones(len(kept), bool)
                repeated[at] = True
                branches[at] = [h["branches"] for h in hit]
                possible, sure, _ = certain(kept, own, repeated, branches, window, edge)
                spans.append(runs(np.flatnonzero(sure), window))
                open_ = np.flatnonzero(possible & ~sure)
                starts.append(open_.astype(np.int32))
                marks.append(every[own[open_]].view(np.int64))
                checks.append(windows(found, window)[open_].view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("weight"), pa.array(spans, pa.list_(pa.int32())),
                 pa.array(starts, pa.list_(pa.int32())), pa.array(marks, longs), pa.array(checks, longs)],
                names=["uid", "weight", "spans", "start", "mark", "check"])

    return run


def _third_pass(window: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            counts, texts = [], []
            for text, spans, starts in zip(utf8(batch.column("text")), batch.column("spans").to_pylist(),
                                           batch.column("starts").to_pylist()):
                words = text.split()
                keep = np.ones(len(words), bool)
                more = runs(np.array(starts or [], np.int64), window)
                for found in (spans or [], more):
                    for a, b in zip(found[::2], found[1::2]):
                        keep[a:b] = False
                counts.append(int(len(words) - keep.sum()))
                texts.append(hashlib.sha256(b" ".join([words[i] for i in np.flatnonzero(keep)])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), pa.array(counts, pa.int64()), pa.array(texts)], names=["uid", "n_removed", "kept"])

    return run


def repeated_passages(docs: DataFrame, window: int = WINDOW, edge: int = EDGE) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"),
                        F.col("text").cast("string").alias("text"))
    rows = staged_rows(
        texts.mapInArrow(_first_pass(window, edge), "doc_id long, raw long, n_words long, whole string, digest binary, "
                         "place array<int>, mark array<long>, side array<long>"), "edges")
    groups = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("uid").alias("uid"), F.count("*").alias("copies"))
    groups = staged(groups, "texts")
    weight = F.least(F.col("copies"), F.lit(2)).cast("int").alias("weight")
    sources = join_on(rows, groups.select("uid", weight), ["uid"])

    with Scratch(docs.sparkSession) as scratch:
        occurrences = sources.select(
            "uid", "weight", "part", F.explode(F.arrays_zip("place", "mark", "side")).alias("e"),
        ).select("uid", "weight", "part", "e.*")
        nodes = occurrences.groupBy("mark").agg(
            F.sum("weight").alias("n"), F.min("side").alias("least"), F.max("side").alias("most")
        ).where("n > 1").select("mark", (F.col("least") != F.col("most")).alias("branches"))
        nodes = scratch.staged(nodes, "repeated")
        hits = attach(occurrences.drop("side"), nodes, ["mark"], "inner").groupBy("uid").agg(
            F.max("weight").alias("weight"), F.collect_list(F.struct("place", "branches")).alias("hits"))
        hits = join_on(scratch.staged(hits, "hits"), rows.select("uid", "doc_id", "raw"), ["uid"])
        checked = scratch.staged(
            join_on(texts, hits, ["doc_id", "raw"]).select("uid", "weight", "hits", "text").mapInArrow(
                _second_pass(window, edge),
                "uid long, weight int, spans array<int>, start array<int>, mark array<long>, check array<long>")
            .withColumn("part", F.spark_partition_id()), "paths")

        open_ = checked.select("uid", "weight", "part", F.explode(F.arrays_zip("start", "mark", "check")).alias("w")).select(
            "uid", "weight", "part", "w.*")
        again = open_.groupBy("mark", "check").agg(F.sum("weight").alias("n")).where("n > 1").select("mark", "check")
        starts = attach(open_, again, ["mark", "check"], "inner").groupBy("uid").agg(F.collect_set("start").alias("starts"))
        single = groups.where("copies = 1").select("uid")
        # A text without copies is one row here, as equal rows are copies.
        verdict = join_on(
            join_on(checked.select("uid", "spans"), single, ["uid"]), starts, ["uid"], "left",
        ).where("size(spans) > 0 OR starts IS NOT NULL")
        verdict = staged(verdict, "verdict")
    verdict = join_on(verdict, rows.select("uid", "doc_id", "raw"), ["uid"])
    cut = join_on(texts, verdict, ["doc_id", "raw"]).select("uid", "spans", "starts", "text").mapInArrow(
        _third_pass(window), "uid long, n_removed long, kept string")
    basis = rows.select("doc_id", "uid", "part", "n_words", "whole", "digest")
    copied = groups.where("copies > 1").select("digest", F.lit(True).alias("copied"))
    joined = attach(join_on(basis, cut, ["uid"], "left"), copied, ["digest"])
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        "doc_id", "n_words",
        F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copied"), nothing).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"),
    )
