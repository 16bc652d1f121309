"""Exact deduplication through a cuckoo-filter index of live digests.

Texts are reduced to the SHA-256 of their text without white space. Digests are dealt to index
buckets of bounded size; each bucket holds a cuckoo filter and, under the filter's own buckets,
the stored digests. A digest that the filter has never seen is new for certain and is inserted; a
hit is verified against the stored digests, so a false hit of the filter never merges two texts.
A filter that overflows is rebuilt at twice the size from the stored digests.

Defined results: a null text counts as empty; empty texts equal one another; of equal texts the row
with the most code points stays, then the smallest ``doc_id`` (a null id last), then any one row of
identical ones; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import BLANK, join_on, staged_rows
from punctua.sources.storage import staged

SLOTS = 4
MAX_KICKS = 200
BUCKET_DIGESTS = 100_000


class CuckooFilter:
    """Approximate membership of 64-bit hashes with deletion; ``insert`` is False on overflow."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, math.ceil(math.log2(max(2, capacity / (SLOTS * 0.9)))))
        self.buckets: list[list[int]] = [[] for _ in range(self.size)]

    def place(self, value: int) -> tuple[int, int, int]:
        """Fingerprint and both buckets of a hash."""
        mark = (value >> 40) & 0xFFFF or 1
        first = value & (self.size - 1)
        return mark, first, self.other(first, mark)

    def other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.size - 1)

    def __contains__(self, value: int) -> bool:
        mark, first, second = self.place(value)
        return mark in self.buckets[first] or mark in self.buckets[second]

    def insert(self, value: int) -> bool:
        mark, first, second = self.place(value)
        for bucket in (first, second):
            if len(self.buckets[bucket]) < SLOTS:
                self.buckets[bucket].append(mark)
                return True
        bucket = first
        for kick in range(MAX_KICKS):
            slots = self.buckets[bucket]
            turn = kick % SLOTS
            slots[turn], mark = mark, slots[turn]
            bucket = self.other(bucket, mark)
            if len(self.buckets[bucket]) < SLOTS:
                self.buckets[bucket].append(mark)
                return True
        return False

    def delete(self, value: int) -> bool:
        mark, first, second = self.place(value)
        for bucket in (first, second):
            if mark in self.buckets[bucket]:
                self.buckets[bucket].remove(mark)
                return True
        return False


class LiveDigests:
    """Live digests of one index bucket: a cuckoo filter in front of stored keys.

    ``content`` holds the stored digests under the low bits of their hash; each has a value.
    """

    def __init__(self, capacity: int = 64):
        self.filter = CuckooFilter(capacity)
        self.content: dict[int, dict[str, object]] = {}
        self.count = 0

    @staticmethod
    def hash(digest: str) -> int:
        return int(digest[-16:], 16)

    def find(self, digest: str) -> dict | None:
        """The stored bucket that holds the digest; the filter answers most misses alone."""
        value = self.hash(digest)
        if value not in self.filter:
            return None
        stored = self.content.get(value & 0xFFFFF)
        return stored if stored is not None and digest in stored else None

    def insert(self, digest: str, entry: object) -> None:
        value = self.hash(digest)
        self.content.setdefault(value & 0xFFFFF, {})[digest] = entry
        self.count += 1
        if not self.filter.insert(value):
            self.resize()

    def delete(self, digest: str) -> bool:
        stored = self.find(digest)
        if stored is None:
            return False
        del stored[digest]
        self.filter.delete(self.hash(digest))
        self.count -= 1
        return True

    def resize(self) -> None:
        """Rebuild the filter from the stored keys, each time with twice the room, until all fit."""
        capacity = self.count
        while True:
            capacity *= 2
            self.filter = CuckooFilter(capacity)
            if all(self.filter.insert(self.hash(digest)) for digest, _ in self.items()):
                return

    def items(self) -> Iterator[tuple[str, object]]:
        for stored in self.content.values():
            yield from stored.items()


def text_digest(text: Column) -> Column:
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, ""), 256)


def index_bucket(digest: Column, rows: int) -> Column:
    """Index bucket of a digest; the number of buckets follows the number of rows."""
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % max(1, -(-rows // BUCKET_DIGESTS))).cast("int")


def _merge(partials):
    """One index bucket: insert or find each partial group, then give every one the group's result."""
    import pandas as pd

    index = LiveDigests()
    for row in partials[["digest", "rows", "length", "no_id", "id", "uid"]].itertuples(index=False):
        best = (row.length, row.no_id, row.id, row.uid)
        stored = index.find(row.digest)
        if stored is None:
            index.insert(row.digest, (row.rows, best))
        else:
            rows, other = stored[row.digest]
            stored[row.digest] = (rows + row.rows, min(best, other))
    merged = dict(index.items())
    found = [merged[digest] for digest in partials["digest"]]
    return pd.DataFrame({
        "digest": partials["digest"], "part": partials["part"],
        "group_size": [rows for rows, _ in found],
        "keep": [best[2] for _, best in found], "keep_null": [bool(best[1]) for _, best in found],
        "keep_uid": [best[3] for _, best in found],
    })


def exact_groups(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row of ``df`` with its group: ``doc_id, uid, raw, keep_id, keep_uid, group_size, digest``.

    ``raw`` is a hash of the original text. The row that stays has ``uid = keep_uid``.
    """
    text = F.col(text_column)
    rows = staged_rows(
        df.select(
            F.col(id_column).cast("long").alias("doc_id"), text_digest(text).alias("digest"),
            F.coalesce(F.char_length(text), F.lit(0)).alias("length"), F.xxhash64(text).alias("raw"),
        ),
        "digests",
    )
    best = F.min(F.struct((-F.col("length")).alias("length"), F.col("doc_id").isNull().alias("no_id"),
                          F.coalesce("doc_id", F.lit(0)).alias("id"), "uid"))
    partial = rows.groupBy("digest", "part").agg(F.count("*").alias("rows"), best.alias("best"))
    merged = (
        partial.select("digest", "part", "rows", "best.*", index_bucket(F.col("digest"), rows.count()).alias("bucket"))
        .groupBy("bucket").applyInPandas(
            _merge, "digest string, part int, group_size long, keep long, keep_null boolean, keep_uid long")
    )
    joined = join_on(rows, merged, ["digest", "part"])
    return joined.select(
        "doc_id", "uid", "raw", F.when(~F.col("keep_null"), F.col("keep")).alias("keep_id"),
        "keep_uid", "group_size", "digest",
    )


def apply_changes(live: DataFrame, changes: DataFrame) -> DataFrame:
    """A stored index after a batch of changes.

    ``live`` has ``digest, rows`` (distinct digests and how many live texts have each); ``changes``
    has ``digest, change``: +1 for a text that arrives, -1 for one that is withdrawn. Changes of a
    digest are added up before the shuffle. Returns the new ``digest, rows``; a digest whose last
    text is withdrawn is deleted, a withdrawal of an unknown digest has no effect.
    """
    net = changes.groupBy("digest").agg(F.sum("change").alias("change"))
    total = staged(
        live.select("digest", F.col("rows").cast("long").alias("change"), F.lit(True).alias("live"))
        .union(net.select("digest", F.col("change").cast("long"), F.lit(False))),
        "changes",
    )

    def bucket(group):
        import pandas as pd

        index = LiveDigests()
        for row in group.sort_values("live", ascending=False).itertuples(index=False):
            stored = index.find(row.digest)
            if stored is not None:
                stored[row.digest] += row.change
                if stored[row.digest] <= 0:
                    index.delete(row.digest)
            elif row.change > 0:
                index.insert(row.digest, row.change)
        return pd.DataFrame(list(index.items()), columns=["digest", "rows"])

    return (
        total.withColumn("bucket", index_bucket(F.col("digest"), total.count()))
        .groupBy("bucket").applyInPandas(lambda g: bucket(g[["digest", "change", "live"]]), "digest string, rows long")
    )
