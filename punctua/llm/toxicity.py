"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Terms are words (letters only, lower case) and the first letters of longer ones, which catch other
endings of the same stem. The vocabulary is that of the labelled examples, all of it. A document's
vector weighs each term by ``1 + ln(count)``, an inverse document frequency counted over all documents,
and one plus the term's log-likelihood ratio between the two classes of examples: unlike plain TF-IDF,
in which a few marks drown in hundreds of rare words, this lets texts of like attitude come near
(figures in the README). The examples are an inverted index in blocks: each term knows its largest
weight in every block. The lists of common terms are kept dense, as one matrix, and their share of the
cosines comes from one product for a batch of queries; with it and the largest weights of the other terms, a query
reads the blocks of highest upper bound, then every other block whose bound reaches the nearest examples found, so
these are exact. Their votes, weighted by similarity and
drawn toward the rate of toxic examples, are calibrated by a logistic curve that is fitted on the
examples themselves, each with its own text left out. The odds are then multiplied by ``HARM``, so that
0.5 is where keeping a toxic text would cost as much as dropping ``HARM`` clean ones.

Bound, the only sampled thing here: about ``EXAMPLES`` labelled rows (fewer where there are fewer).
All documents are read twice, once for the frequencies, once for the scores; nothing is shuffled but
one partial count per task and term.

Defined results: null and empty texts have no terms and get the rate of toxic examples without terms, or of
all, as do texts without a known term; texts of any length are read whole; equal texts have equal scores;
of equally near examples those first in the index vote; a document with repeated labels counts as toxic
if any says so, null labels are ignored; without labelled rows of both classes every score is the rate of
toxic ones (0 without any); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import utf8
from punctua.sources.storage import Scratch

EXAMPLES = 3_000
NEIGHBOURS = 15
BLOCK = 64
STEM = 5
FIRST_BLOCKS = 4
COMMON = 10  # a term in more than one of so many examples is common
QUERIES = 64  # of a product; always as many, so that equal texts meet the same arithmetic
SHRINK = 0.5
HARM = 3.0
FOLDS = 5
SLICE = 400  # texts whose words a task holds at a time


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def terms_of(words) -> tuple:
    """Two Arrow arrays: the letters of each word and their beginning, null where they are no term."""
    import pyarrow as pa
    import pyarrow.compute as pc

    letters = pc.utf8_lower(words)
    mixed = pc.invert(pc.utf8_is_alpha(letters))
    letters = pc.replace_with_mask(letters, mixed, pc.replace_substring_regex(letters.filter(mixed), r"[^\p{L}]+", ""))
    size = pc.utf8_length(letters)
    mark, empty, none = (pa.scalar(value, letters.type) for value in ("-", "", None))
    begin = pc.binary_join_element_wise(pc.utf8_slice_codeunits(letters, 0, STEM), mark, empty)
    return pc.if_else(pc.greater_equal(size, 2), letters, none), pc.if_else(pc.greater_equal(size, STEM), begin, none)


def words_of(column) -> tuple[np.ndarray, np.ndarray, object]:
    """The distinct words of some texts, and for every word its text and which distinct word it is."""
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = column.cast(pa.large_string(), safe=False)
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:  # bytes that are not UTF-8 are left out
        texts = pa.array([text.decode("utf-8", "ignore") for text in utf8(column)], pa.large_string())
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy())
    return owner, coded.indices.to_numpy(), coded.dictionary


def counted(column, vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and count of the terms of a vocabulary (an Arrow array) in some texts, by text and term."""
    import pyarrow as pa
    import pyarrow.compute as pc

    owner, word, distinct = words_of(column)
    size, terms = max(1, len(vocabulary)), pa.concat_arrays(terms_of(distinct))
    number = pc.fill_null(pc.index_in(terms, value_set=vocabulary), -1).to_numpy().astype(np.int64).reshape(2, -1)[:, word]
    found, count = np.unique((owner * size + number)[number >= 0], return_counts=True)
    return found // size, found % size, count


def slices(batches) -> Iterator:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def labelled_sample(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of about ``EXAMPLES`` labelled documents outside the held-out fold."""
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = EXAMPLES / max(EXAMPLES, known.count())
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))


def class_ratios(rows: list[tuple[int, int, np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Log-likelihood ratio between the classes of examples, of each term of the vocabulary."""
    toxic = sum(row[1] for row in rows)
    if not 0 < toxic < len(rows):
        return np.zeros(size)
    n = np.bincount(np.concatenate([r[2] for r in rows]), minlength=size).astype(float)
    a = np.bincount(np.concatenate([r[2] for r in rows if r[1]]), minlength=size).astype(float)
    rate = toxic / len(rows)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    rest = len(rows) - n
    return np.maximum(0.0, 2 * (part(a, n * rate) + part(n - a, n * (1 - rate))
                                + part(toxic - a, rest * rate) + part(rest - (toxic - a), rest * (1 - rate))))


def ragged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all the ranges ``starts[i]:ends[i]`` in turn, and the length of each range."""
    lengths = ends - starts
    reached = np.cumsum(lengths)
    positions = np.repeat(starts - reached + lengths, lengths)
    positions += np.arange(len(positions))
    return positions, lengths


@dataclass
class Examples:
    """Inverted index of unit example vectors: the postings of each term, cut into runs of one block,
    and the largest weight of each run; those of common terms as rows of a matrix."""

    labels: np.ndarray
    texts: np.ndarray
    ids: np.ndarray  # example and weight of each posting, by term and example
    weights: np.ndarray
    runs: np.ndarray  # where the postings of each run begin, and their end
    blocks: np.ndarray  # block and largest weight of each run
    maxima: np.ndarray
    terms: np.ndarray  # where the runs of each term begin, and their end
    idf: np.ndarray
    common: np.ndarray  # row of each term in ``dense``, -1 for the others
    dense: np.ndarray  # weights of the common terms in all examples

    @classmethod
    def build(cls, rows: list[tuple[int, int, list[int], list[int]]], idf: np.ndarray) -> Examples:
        """``rows``: text hash, label, terms, counts. Examples of one label with the same heaviest
        term become neighbours in a block, which keeps the upper bounds near."""
        found = []
        for text, label, terms, counts in rows:
            if len(terms):
                weight = unit(terms, counts, idf)
                found.append((label, int(np.asarray(terms)[np.argmax(weight)]), text, np.asarray(terms, np.int64), weight))
        found.sort(key=lambda r: r[:3])
        sizes = [len(r[3]) for r in found]
        term = np.concatenate([np.zeros(0, np.int64), *(r[3] for r in found)])
        weight = np.concatenate([np.zeros(0), *(r[4] for r in found)])
        owner = np.repeat(np.arange(len(found)), sizes)
        order = np.lexsort((owner, term))
        term, owner, weight = term[order], owner[order], weight[order]
        often = np.flatnonzero(np.bincount(term, minlength=len(idf)) * COMMON > len(found))
        common = np.full(len(idf), -1)
        common[often] = np.arange(len(often))
        dense, inside = np.zeros((len(often), len(found))), common[term] >= 0
        dense[common[term[inside]], owner[inside]] = weight[inside]
        term, owner, weight = term[~inside], owner[~inside], weight[~inside]
        block = owner // BLOCK
        first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])))[:len(term)])
        return cls(
            np.array([r[0] for r in found], float), np.array([r[2] for r in found], np.int64), owner, weight,
            np.append(first, len(term)), block[first], np.maximum.reduceat(weight, first) if len(first) else weight,
            np.searchsorted(term[first], np.arange(len(idf) + 1)), idf, common, dense)

    def common_parts(self, queries: list[tuple]) -> np.ndarray:
        """For up to ``QUERIES`` pairs of terms and counts, the share of common terms in all cosines."""
        table = np.zeros((QUERIES, len(self.dense)))
        for line, (terms, counts) in zip(table, queries):
            row = self.common[np.asarray(terms, int)]
            line[row[row >= 0]] = unit(terms, counts, self.idf)[row >= 0]
        return (table @ self.dense)[:len(queries)]

    def nearest(
        self, terms, counts, count: int = NEIGHBOURS, without: int | None = None, part: np.ndarray | None = None,
    ) -> list[tuple[float, int]]:
        """The exact ``count`` best ``(cosine, example)``, ties by example; ``without`` leaves out a text,
        ``part`` is the query's line of ``common_parts``."""
        if not len(self.labels):
            return []
        terms = np.asarray(terms, int)
        scores = (self.common_parts([(terms, counts)])[0] if part is None else part).copy()
        other = self.common[terms] < 0
        query, terms = unit(terms, counts, self.idf)[other], terms[other]
        at, lengths = ragged(self.terms[terms], self.terms[terms + 1])
        blocks, weights = self.blocks[at], np.repeat(query, lengths)
        starts = np.arange(0, len(scores), BLOCK)
        bounds = np.maximum.reduceat(scores, starts) + np.bincount(blocks, weights * self.maxima[at], minlength=len(starts))

        def read(chosen: np.ndarray) -> None:
            mine = np.flatnonzero(chosen[blocks])
            run = at[mine]
            postings, lengths = ragged(self.runs[run], self.runs[run + 1])
            values = np.repeat(weights[mine], lengths)
            values *= self.weights[postings]
            found = np.bincount(self.ids[postings], values, minlength=len(scores))
            np.add(scores, found, out=scores)
            if without is not None:
                scores[self.texts == without] = 0.0

        first = np.zeros(len(bounds), bool)
        first[np.argsort(-bounds, kind="stable")[:FIRST_BLOCKS]] = True
        read(first)
        # What unread blocks have so far is never above their cosines, so the least can only be too low.
        least = np.partition(scores, -count)[-count] if len(scores) >= count else 0.0
        rest = ~first & (bounds >= least - 1e-9) & (bounds > 0)
        if rest.any():
            read(rest)
        scores = np.round(scores, 12)
        least = np.partition(scores, -count)[-count] if len(scores) >= count else 0.0
        near = np.flatnonzero((scores >= least) & (scores > 0))
        near = near[np.argsort(-scores[near], kind="stable")][:count]
        return [(float(scores[i]), int(i)) for i in near]

    def vote(self, found: list[tuple[float, int]], prior: float) -> float:
        """Share of toxic neighbours by similarity, drawn toward ``prior`` when all are far."""
        total = sum(score for score, _ in found)
        toxic = sum(score * self.labels[i] for score, i in found)
        return (toxic + SHRINK * prior) / (total + SHRINK)


def unit(terms, counts, idf: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(np.asarray(counts, float))) * idf[np.asarray(terms, int)]
    return weights / (np.linalg.norm(weights) or 1.0)


def logistic_fit(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve that turns votes into probabilities (smoothed targets)."""
    positive, negative = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    features = np.stack([votes - 0.5, np.ones_like(votes)], axis=1)
    fit = np.array([4.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ fit, -30, 30)))
        gradient = features.T @ (p - target) + 1e-3 * fit
        hessian = (features * (p * (1 - p))[:, None]).T @ features + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        fit -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(fit[0]), float(fit[1])


@dataclass
class Scorer:
    examples: Examples
    empty: float
    slope: float
    shift: float

    def scores(self, queries: list[tuple]) -> Iterator[tuple[float, list[tuple[float, int]]]]:
        """Calibrated score and the nearest examples as its evidence, for each pair of terms and counts."""
        for at in range(0, len(queries), QUERIES):
            batch = queries[at:at + QUERIES]
            for (terms, counts), part in zip(batch, self.examples.common_parts(batch)):
                found = self.examples.nearest(terms, counts, part=part) if len(terms) else []
                vote = self.examples.vote(found, self.empty)
                fitted = 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * (vote - 0.5) + self.shift))))
                yield (fitted, found) if found else (self.empty, [])


def fit(rows: list[tuple[int, int, list[int], list[int]]], idf: np.ndarray) -> Scorer:
    labels = np.array([r[1] for r in rows], float)
    bare = np.array([r[1] for r in rows if not len(r[2])], float)
    empty = float(bare.mean()) if len(bare) else (float(labels.mean()) if len(labels) else 0.0)
    examples = Examples.build(rows, idf)
    votes, truth = [], []
    for at in range(0, len(rows), QUERIES):
        batch = rows[at:at + QUERIES]
        for (text, label, terms, counts), part in zip(batch, examples.common_parts([r[2:] for r in batch])):
            found = examples.nearest(terms, counts, without=text, part=part) if len(terms) else []
            votes.append(examples.vote(found, empty) if found else empty)
            truth.append(label)
    slope, shift = 4.0, 0.0
    if 0 < sum(truth) < len(truth):
        slope, shift = logistic_fit(np.array(votes), np.array(truth, float))
        shift += math.log(HARM)
    return Scorer(examples, empty, slope, shift)


def vocabulary_of(examples: DataFrame):
    """All terms of the examples in order, an Arrow array; their number is bounded by that of the examples."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def found(batches) -> Iterator:
        for batch in slices(batches):
            for terms in terms_of(words_of(batch.column("text"))[2]):
                yield pa.RecordBatch.from_arrays([terms.drop_null().unique().cast(pa.string())], names=["term"])

    terms = examples.select("text").mapInArrow(found, "term string").distinct().toArrow().column("term").cast(pa.large_string())
    return pa.concat_arrays([pa.array([], pa.large_string()), *terms.take(pc.sort_indices(terms)).chunks])


def example_rows(examples: DataFrame, vocabulary) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Example texts as ``(text hash, label, terms, counts)``."""
    def run(batches) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches):
            owner, term, count = counted(batch.column("text"), vocabulary.value)
            cuts = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("raw"), batch.column("toxic"), pa.ListArray.from_arrays(cuts, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(cuts, pa.array(count, pa.int32()))], names=["raw", "toxic", "terms", "counts"])

    found = examples.select("raw", "toxic", "text").mapInArrow(
        run, "raw long, toxic int, terms array<int>, counts array<int>").toArrow().sort_by("raw")
    return [(raw, toxic, terms.values.to_numpy().astype(np.int64), counts.values.to_numpy()) for raw, toxic, terms, counts in zip(
        found["raw"].to_pylist(), found["toxic"].to_pylist(), found["terms"], found["counts"])]


def document_frequencies(texts: DataFrame, vocabulary) -> tuple[np.ndarray, int]:
    """In how many of all documents each term of the vocabulary occurs, and the number of documents."""
    def count(batches) -> Iterator:
        import pyarrow as pa

        size, rows = len(vocabulary.value), 0
        seen = np.zeros(size, np.int64)
        for batch in slices(batches):
            rows += batch.num_rows
            seen += np.bincount(counted(batch.column("text"), vocabulary.value)[1], minlength=size)[:size]
        kept = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(kept, size), pa.int32()), pa.array(np.append(seen[kept], rows), pa.int64())], names=["term", "n"])

    counts = texts.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(len(vocabulary.value) + 1)
    frequency[counts["term"].to_numpy()] = counts["n"].to_numpy()
    return frequency[:-1], int(frequency[-1])


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, raw, held_out, score, predicted, evidence`` of every row.

    ``evidence`` lists the text hashes and cosines of the nearest examples.
    """
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"),
                        F.col("text").cast("string").alias("text"))
    # About EXAMPLES rows of twelve bytes: small whatever the number of labels.
    chosen = F.broadcast(labelled_sample(labels))
    with Scratch(docs.sparkSession) as scratch:
        examples = scratch.staged(
            texts.join(chosen, "doc_id").groupBy("raw").agg(F.max("toxic").alias("toxic"), F.first("text").alias("text")), "examples")
        vocabulary = context.broadcast(vocabulary_of(examples))
        rows = example_rows(examples, vocabulary)
    frequency, total = document_frequencies(texts, vocabulary)
    weights = (np.log((1 + total) / (1 + frequency)) + 1) * (1 + class_ratios(rows, len(frequency)))
    model = context.broadcast(fit(rows, weights))

    def score(batches) -> Iterator:
        import pyarrow as pa

        scorer, seen = model.value, {}
        kind = pa.list_(pa.struct([("raw", pa.int64()), ("cosine", pa.float64())]))
        for batch in slices(batches):
            if len(seen) > 20_000:
                seen.clear()
            raws = batch.column("raw").to_pylist()
            owner, term, count = counted(batch.column("text"), vocabulary.value)
            cuts = np.searchsorted(owner, np.arange(len(raws) + 1))
            new = {raw: slice(a, b) for raw, a, b in zip(raws, cuts[:-1], cuts[1:]) if raw not in seen}
            results = scorer.scores([(term[place], count[place]) for place in new.values()])
            for raw, (value, near) in zip(new, results):
                seen[raw] = value, [{"raw": int(scorer.examples.texts[i]), "cosine": s} for s, i in near]
            found = [seen[raw] for raw in raws]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("raw"), pa.array([s for s, _ in found], pa.float64()),
                 pa.array([e for _, e in found], kind)], names=["doc_id", "raw", "score", "evidence"])

    return texts.mapInArrow(
        score, "doc_id long, raw long, score double, evidence array<struct<raw: long, cosine: double>>"
    ).select("doc_id", "raw", held_out(F.col("doc_id")).alias("held_out"), "score",
             (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
