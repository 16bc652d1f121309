"""Best-fit decreasing packing of tokenised documents into sequences.

A document is its token ids and an end id. Only a longer one is cut, into full pieces, of which the
first may be shorter. Best-fit decreasing looks at lengths alone, and there are at most ``CAPACITY``
of them: Spark counts the pieces of every length, the plan is made once per length instead of once
per piece (a segment tree over remaining capacities finds the tightest open sequence; a run of equal
pieces fills equal sequences in one step), and Spark gives every piece its place by its rank among
the pieces of its length. Ranks are counted per written part and offset by the parts before, so a
length that a third of all pieces share is not gathered anywhere.

The plan has at most ``CAPACITY`` lengths, each of which opens and splits a few runs, and a run
holds at most 63 different lengths: below 600,000 rows of five numbers for any corpus (24 MB), in
practice a few thousand. That bound is what allows it to be sent to every task.

Defined results: null and empty texts are one piece, the end id alone; names of added tokens in a text
become the ids of those tokens; very long texts are encoded whole; equal pieces are interchangeable, and
repeated rows are documents of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.common import join_on, staged_rows
from punctua.sources.storage import staged

CAPACITY = 2048
END_ID = 0
# Fixed pattern: how byte-level files divide a text into units that are merged on their own.
UNITS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself,
    the other bytes for the code points from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, place long"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_pairs(path: str):
    """The byte-pair engine for a tokenizer file, or None where the file asks for more than byte pairs.

    The engine merges by rank of the merged piece, the file by the order of its merges; both are the
    same where pieces are numbered in the order of their merges, as is checked here.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    added = {token["content"] for token in spec["added_tokens"]}
    plain = (
        model["type"] == "BPE" and not model.get("dropout") and not model.get("byte_fallback") and not model.get("ignore_merges")
        and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix") and spec["normalizer"] is None
        and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    )
    if not plain:
        return None
    signs = {sign: byte for byte, sign in byte_signs().items()}
    vocabulary = {piece: number for piece, number in model["vocab"].items() if piece not in added}
    merged = [model["vocab"].get("".join(pair.split(" ") if isinstance(pair, str) else pair)) for pair in model["merges"]]
    if None in merged or merged != sorted(merged) or not all(sign in signs for piece in vocabulary for sign in piece):
        return None
    ranks = {bytes(signs[sign] for sign in piece): number for piece, number in vocabulary.items()}
    return tiktoken.Encoding("file", pat_str=UNITS, mergeable_ranks=ranks, special_tokens={})


class TextIds:
    """Token ids of texts as little-endian bytes, as the tokenizers library gives them for a file.

    A byte-pair engine finds the same ids in half the time (tests compare all code points); the library
    itself encodes texts that hold the name of an added token, and all texts where the file asks
    for more than byte pairs.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.names = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.engine = byte_pairs(path)

    def of(self, text: str) -> bytes:
        if self.engine is None or any(name in text for name in self.names):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.engine.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


@functools.lru_cache(maxsize=1)
def text_ids(path: str) -> TextIds:
    """One per Python worker, which serves many tasks."""
    return TextIds(path)


def pieces_of(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int]]:
    """``(start, length, crc)`` of the pieces of a document's ids, four bytes each."""
    count = len(ids) // 4
    cuts = [0, *range(count % capacity or capacity, count + 1, capacity)] if count > capacity else [0, count]
    return [(a, b - a, zlib.crc32(ids[4 * a:4 * b])) for a, b in zip(cuts, cuts[1:])]


class TightestFit:
    """Segment tree over remaining capacities 0..capacity; a leaf holds runs of equal sequences."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.used = [0] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, count: int) -> None:
        if not room:
            return  # a full sequence is closed
        self.runs[room].append((first, count))
        node = room + self.leaves
        while node:
            self.used[node] += 1
            node >>= 1

    def pop(self, length: int) -> tuple[int, int, int] | None:
        """``(room, first, count)`` of a run with the least room that is at least ``length``."""
        node = length + self.leaves
        if not self.used[node]:
            while node > 1 and (node & 1 or not self.used[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.used[2 * node] else 2 * node + 1
        room = node - self.leaves
        first, count = self.runs[room].pop()
        while node:
            self.used[node] -= 1
            node >>= 1
        return room, first, count


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: pieces}``.

    Returns runs ``(length, rank, sequence, each, offset)``: pieces of that length from ``rank`` on
    fill sequences from ``sequence`` on, ``each`` of them one after another from ``offset``.
    """
    tree, opened, runs = TightestFit(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            found = tree.pop(length)
            if found is None:
                # As many sequences as the rest of this length opens, all at once.
                room, first, count = capacity, opened, -(-left // (capacity // length))
                opened += count
            else:
                room, first, count = found
            each = room // length
            whole = min(count, left // each)
            if whole:
                runs.append((length, rank, first, each, capacity - room))
                tree.add(room - each * length, first, whole)
                rank, left = rank + whole * each, left - whole * each
            first, count = first + whole, count - whole
            if count and left:
                runs.append((length, rank, first, each, capacity - room))
                tree.add(room - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            if count:
                tree.add(room, first, count)
    return runs


def _tokenised(path: str, capacity: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        ids = text_ids(path)
        end = np.array([END_ID], "<u4").tobytes()
        counted: dict[int, int] = {}
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for piece, (start, length, crc) in enumerate(pieces_of(ids.of(text or "") + end, capacity)):
                    place = counted[length] = counted.get(length, -1) + 1
                    rows.append((doc_id, piece, start, length, crc, place))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "place"])

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = staged_rows(texts.mapInArrow(_tokenised(path or tokenizer_path(), capacity), PIECES), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("count"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(
        by_part.select("length", "part", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")),
        "bases",
    )
    counts = {row[0]: row[1] for row in bases.groupBy("length").agg(F.sum("count")).collect()}
    runs = spark.sparkContext.broadcast(
        np.array(sorted(plan(counts, capacity)), dtype=np.int64).reshape(-1, 5))

    def place(batches) -> Iterator:
        import pyarrow as pa

        table = runs.value
        lengths, first = np.unique(table[:, 0], return_index=True)
        last = np.append(first[1:], len(table))
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = np.empty(len(length), np.int64)
            for value in np.unique(length):
                at = np.searchsorted(lengths, value)
                here = length == value
                row[here] = first[at] + np.searchsorted(table[first[at]:last[at], 1], rank[here], "right") - 1
            run = table[row]
            nth = rank - run[:, 1]
            columns = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            columns += [pa.array(run[:, 2] + nth // run[:, 3]), pa.array(run[:, 4] + nth % run[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    # The bases grow with lengths and parts, so they are not for every task: a merge join.
    ranked = join_on(pieces, bases.drop("count").hint("merge"), ["length", "part"]).withColumn("rank", F.col("base") + F.col("place"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
