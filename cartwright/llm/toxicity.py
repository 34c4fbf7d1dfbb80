"""Toxicity scores from the nearest labelled examples.

1. Examples: at most ``SAMPLE_ROWS`` labelled rows outside the held-out fold,
   drawn by a hash of their doc_id. Terms are words and beginnings of words (four to
   eight letters), the latter also when they come repeatedly. All terms of the
   examples make the vocabulary; none is left out. A term weighs the more the better
   it tells the labels apart: its likelihood ratio, shrunken to between 0 and 1
   (``HALF_RATIO`` gives a half), which multiplies its idf.
2. One pass turns every document into its term counts; document frequencies for
   the TF-IDF weights are counted over all documents.
3. Queries are compared with all examples, some at a time: the part of the cosine that
   is of frequent terms is a product of two dense matrices, the rest comes from an
   inverted index. Both are in single precision, whose loss is bounded: the examples
   that may be among the k nearest are compared again, exactly. The neighbours are exact.
4. Neighbours vote with their cosine as weight; the vote is smoothed towards the
   share of toxic examples among those without any term.

The vocabulary and the index are bounded by the terms of ``SAMPLE_ROWS`` examples and
are what each task receives; all other tables stay distributed. Texts are turned
into vocabulary terms by blocks: every different word of a block is looked up
once, and terms are counted for all its documents together. Documents with the same
terms are answered once a worker.

Defined cases: null and empty texts have no terms and get the share named in 4;
null labels are no examples; of equally near examples the one with the smaller
doc_id votes; repeated rows are scored alike; texts are read whole; without any
example every score is 0. Only doc_id and the text are read; labels are read
from doc_id and toxic, and never enter the score of a document but by the
examples.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.bpe import blocks
from cartwright.llm.common import own_cache, staged

#: labelled rows that the examples are drawn from; the bound of the fitted part
SAMPLE_ROWS = 4_000
#: answers that a worker keeps for documents with the same terms and counts
KEPT_ANSWERS = 20_000
#: the likelihood ratio at which a term has half the weight that its idf allows
HALF_RATIO = 30.0
#: a term is frequent from this part of the examples on (1 in 16), and so many may be
FREQUENT, MOST_FREQUENT = 16, 2_000
#: queries whose cosines are computed together, and rows that a worker holds as queries
QUERIES, SLICE_ROWS = 128, 512
#: the smallest weight in single precision, so that no product of two becomes 0
LEAST = 1e-18
NEIGHBOURS = 15
#: weight of the vote of no neighbour at all
SMOOTHING = 1.0
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
#: letters of the beginnings of words that are terms
PREFIXES = (4, 6)

#: bytes of texts that are worked on together
BLOCK_BYTES = 4 << 20

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT,
                      F.lit(False))


def terms_of(words: list[str]) -> Counter[str]:
    """Terms of a text: words, beginnings of words, and beginnings that come repeatedly.

    The cosine does not see how often the only term of a text comes, so a
    beginning that comes at least two and four times makes terms of its own.
    """
    out: Counter[str] = Counter(words)
    starts: Counter[str] = Counter()
    for word, n in out.items():
        for size in PREFIXES:
            if len(word) <= size:
                break
            starts[word[:size]] += n
    for start, n in starts.items():
        out[f"{start}-"] = n
        for least in (2, 4):
            if n >= least:
                out[f"{start}-{least}"] = 1
    return out


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, toxic, clean): documents with each term, by label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(block.column("text").to_pylist(),
                                   block.column("toxic").to_pylist()):
                counts[int(label)].update(terms_of(_WORD.findall((text or "").lower())).keys())
            terms = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()),
                 pa.array([counts[0][t] for t in terms], pa.int64())],
                names=["term", "toxic", "clean"])

    parts = sample.select("text", "toxic").mapInArrow(run, "term string, toxic long, clean long")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def vocabulary(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """All terms of the examples, most telling first, and how telling they are (0 to 1)."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    toxic_all, clean_all = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic_all + clean_all:
        return [], np.zeros(0)
    share = toxic_all / (toxic_all + clean_all)
    n = F.col("toxic") + F.col("clean")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(F.try_divide(seen, expected))).otherwise(0.0)

    without_toxic, without_clean = toxic_all - F.col("toxic"), clean_all - F.col("clean")
    rest = without_toxic + without_clean
    ratio = 2 * (part(F.col("toxic"), n * share) + part(F.col("clean"), n * (1 - share))
                 + part(without_toxic, rest * share) + part(without_clean, rest * (1 - share)))
    # one is what a term has by chance; rounding may bring a ratio below 0
    raised = F.greatest(ratio, F.lit(0.0)) + 1
    found = (_term_counts(sample).select("term", (raised / (raised + HALF_RATIO)).alias("telling"))
             .orderBy(F.desc("telling"), "term").toArrow())
    return found.column("term").to_pylist(), found.column("telling").to_numpy()


class Vocabulary:
    """Numbers of words and of beginnings of words, looked up for blocks of texts."""

    def __init__(self, terms: list[str]):
        self.words: dict[str, int] = {}
        self.starts: dict[str, int] = {}  # to a row of marks
        marks: list[list[int]] = []       # numbers of the term for any, two, four times
        for i, term in enumerate(terms):
            start, dash, least = term.rpartition("-")
            if not dash:
                self.words[term] = i
                continue
            at = self.starts.setdefault(start, len(marks))
            if at == len(marks):
                marks.append([-1, -1, -1])
            marks[at][("", "2", "4").index(least)] = i
        self.marks = np.array(marks, np.int64).reshape(-1, 3)
        self.size = max(len(terms), 1)

    def vectors(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """(terms, counts) of each text, by ascending number."""
        found = [_WORD.findall(t.lower()) for t in texts]
        coded = pa.array(chain.from_iterable(found), pa.string()).dictionary_encode()
        words, n_words = coded.dictionary.to_pylist(), len(coded.dictionary)
        owner = np.repeat(np.arange(len(texts)), [*map(len, found)])
        del found
        pair, n = np.unique(owner * max(n_words, 1) + coded.indices.to_numpy(), return_counts=True)
        owner, word = pair // max(n_words, 1), pair % max(n_words, 1)
        number = np.fromiter((self.words.get(w, -1) for w in words), np.int64, n_words)[word]
        parts = [(owner, number, n)]
        if len(self.marks):
            at = np.full((n_words, len(PREFIXES)), -1, np.int64)
            get = self.starts.get
            for i, w in enumerate(words):
                for k, size in enumerate(PREFIXES):
                    if len(w) <= size:
                        break
                    at[i, k] = get(w[:size], -1)
            own = at[word]
            some = own >= 0
            key = (owner[:, None] * len(self.marks) + own)[some]
            start, back = np.unique(key, return_inverse=True)
            times = np.bincount(back, np.broadcast_to(n[:, None], own.shape)[some],
                                len(start)).astype(np.int64)
            owner, marks = start // len(self.marks), self.marks[start % len(self.marks)]
            ones = np.ones(len(start), np.int64)
            parts += [(owner, marks[:, 0], times),
                      (owner, np.where(times >= 2, marks[:, 1], -1), ones),
                      (owner, np.where(times >= 4, marks[:, 2], -1), ones)]
        owner, number, n = (np.concatenate(x) for x in zip(*parts))
        known = number >= 0
        owner, number, n = owner[known], number[known], n[known]
        order = np.argsort(owner * self.size + number, kind="stable")
        ends = pa.array(np.searchsorted(owner[order], np.arange(len(texts) + 1)).astype(np.int32))
        return tuple(pa.ListArray.from_arrays(ends, pa.array(x[order].astype(np.int32)))
                     for x in (number, n))


def term_vectors(df: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, terms, counts): the vocabulary terms of every whole text."""
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(None)
        own = shared.value
        for block in blocks(batches, "text", BLOCK_BYTES):
            numbers, counts = own.vectors([x or "" for x in block.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), numbers, counts],
                                             names=["doc_id", "terms", "counts"])

    return df.select("doc_id", "text").mapInArrow(
        run, "doc_id long, terms array<int>, counts array<int>")


def gaps(vectors: DataFrame) -> DataFrame:
    """The term numbers of each row as distances to the number before: small where stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column("terms")
            values, at = terms.values.to_numpy(), terms.offsets.to_numpy()
            steps = np.diff(values, prepend=0).astype(np.int32)
            starts = at[:-1][np.diff(at) > 0]
            steps[starts] = values[starts]
            yield batch.set_column(batch.schema.get_field_index("terms"), "terms",
                                   pa.ListArray.from_arrays(terms.offsets, pa.array(steps)))

    return vectors.mapInArrow(run, vectors.schema)


def numbers(terms: pa.ListArray) -> pa.ListArray:
    """The term numbers of rows that are stored as distances."""
    at = terms.offsets.to_numpy() - terms.offsets[0].as_py()
    total = np.cumsum(terms.flatten().to_numpy(), dtype=np.int64)
    before = np.append(0, total)[at[:-1]]
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)),
                                    pa.array((total - np.repeat(before, np.diff(at))).astype(np.int32)))


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The numbers from each first up to before each last."""
    n = last - first
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


class CosineIndex:
    """Exact nearest examples by cosine.

    Frequent terms are columns of a dense matrix, so their part of all cosines of some
    queries is one matrix product; the postings of the others are added up. These sums
    are rounded; what they leave in reach of the k-th best example is computed exactly.
    """

    def __init__(self, n_terms: int, idf: list[float] | np.ndarray,
                 examples: list[tuple[int, int, list[int] | np.ndarray, list[int] | np.ndarray]]):
        """examples: (doc_id, label, terms, counts); idf may hold any positive weights."""
        self.idf = np.asarray(idf, float)
        empty = [y for _, y, t, _ in examples if not len(t)]
        share = sum(x[1] for x in examples) / len(examples) if examples else 0.0
        self.no_terms = (sum(empty) + share) / (len(empty) + 1)
        rows = [(d, y, np.asarray(t, np.int32), np.asarray(c, np.int32))
                for d, y, t, c in examples if len(t)]
        rows.sort(key=lambda x: (x[0], x[1], x[2].tobytes(), x[3].tobytes()))
        self.ids = np.array([x[0] for x in rows], np.int64)
        self.labels = [x[1] for x in rows]
        self.norms = np.array([math.sqrt(float(r @ r)) for r in (
            self.raw(t, c) for _, _, t, c in rows)])
        # the terms of each example ...
        self.at = np.cumsum([0, *(len(x[2]) for x in rows)])
        self.terms = np.concatenate([x[2] for x in rows]) if rows else np.zeros(0, np.int32)
        self.count = np.concatenate([x[3] for x in rows]) if rows else np.zeros(0, np.int32)
        self.frequency = 1 + np.log(np.maximum(np.arange(self.count.max(initial=0) + 1), 1))
        # ... and the examples of each term that is not frequent
        n = np.bincount(self.terms, minlength=n_terms)
        often = np.argsort(-n, kind="stable")[:MOST_FREQUENT]
        often = np.sort(often[n[often] * FREQUENT >= max(len(rows), 1)])
        self.column = np.full(n_terms, -1, np.int32)
        self.column[often] = np.arange(len(often))
        order = np.argsort(self.terms, kind="stable")
        order = order[self.column[self.terms[order]] < 0]
        owner = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(self.at))
        self.row = owner[order]
        self.weight = self._weights(owner, self.terms, self.count)[order]
        n[often] = 0
        self.post_at = np.concatenate(([0], np.cumsum(n)))
        self.n_frequent = len(often)
        # what single precision may lose: of a sum, by its length
        self.loss = 2 * (self.n_frequent + 16) * 2.0 ** -24
        self._dense: np.ndarray | None = None

    def raw(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (1 + np.log(counts)) * self.idf[terms]

    def _weights(self, row: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The parts of the unit vectors of examples, in single precision, none 0."""
        exact = self.frequency[counts] * self.idf[terms] / self.norms[row]
        return np.maximum(exact, LEAST).astype(np.float32)

    def dense(self) -> np.ndarray:
        """The weight of each frequent term in each example; made where it is used."""
        if self._dense is None:
            dense = np.zeros((self.n_frequent, len(self.ids)), np.float32)
            for row, (a, b) in enumerate(zip(self.at.tolist(), self.at[1:].tolist())):
                terms = self.terms[a:b]
                some = self.column[terms] >= 0
                dense[self.column[terms][some], row] = self._weights(
                    np.full(int(some.sum()), row), terms[some], self.count[a:b][some])
            self._dense = dense
        return self._dense

    def nearest(self, terms: list[int] | np.ndarray, counts: list[int] | np.ndarray,
                k: int = NEIGHBOURS) -> list[tuple[float, int, int]]:
        """(cosine, doc_id, label) of the k nearest examples that share a term."""
        return self.all_nearest([(terms, counts)], k)[0]

    def all_nearest(self, vectors: list[tuple], k: int = NEIGHBOURS
                    ) -> list[list[tuple[float, int, int]]]:
        """``nearest`` of each (terms, counts)."""
        out: list[list[tuple[float, int, int]]] = []
        factor = np.zeros(len(self.idf))
        for at in range(0, len(vectors), QUERIES):
            part = [(np.asarray(t), np.asarray(c)) for t, c in vectors[at:at + QUERIES]]
            near = self._rounded(part) if len(self.ids) else None
            out += [self._exact(t, c, near[i], factor, k) if len(t) and near is not None else []
                    for i, (t, c) in enumerate(part)]
        return out

    def _unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        query = self.raw(terms, counts)
        return query / math.sqrt(float(query @ query))

    def _rounded(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The cosines of each query with each example, above 0 where they share a term."""
        queries = np.zeros((len(vectors), self.n_frequent), np.float32)
        rest = np.zeros((len(vectors), len(self.ids)), np.float32)
        for i, (terms, counts) in enumerate(vectors):
            if not len(terms):
                continue
            query = np.maximum(self._unit(terms, counts), LEAST)
            column = self.column[terms]
            often = column >= 0
            queries[i, column[often]] = query[often]
            first, last = self.post_at[terms], self.post_at[terms + 1]  # none of frequent ones
            post = _ranges(first, last)
            rest[i] = np.bincount(self.row[post], np.repeat(query, last - first)
                                  * self.weight[post], len(self.ids))
        return queries @ self.dense() + rest

    def _exact(self, terms: np.ndarray, counts: np.ndarray, near: np.ndarray,
               factor: np.ndarray, k: int) -> list[tuple[float, int, int]]:
        """The k nearest; ``near``: the rounded cosines, ``factor``: room, all 0."""
        least = 0.0
        if len(near) > k:
            least = float(np.partition(near, -k)[-k]) * (1 - 2 * self.loss) - 1e-11
        met = np.flatnonzero((near > 0) & (near >= least))
        factor[terms] = self._unit(terms, counts) * self.idf[terms]
        first, last = self.at[met], self.at[met + 1]
        post = _ranges(first, last)
        cosine = np.bincount(np.repeat(np.arange(len(met)), last - first),
                             factor[self.terms[post]] * self.frequency[self.count[post]], len(met))
        factor[terms] = 0.0
        found = np.round(cosine / self.norms[met], 12)
        top = np.lexsort((self.ids[met], -found))[:k]
        return [(c, d, self.labels[at]) for c, d, at in zip(
            found[top].tolist(), self.ids[met[top]].tolist(), met[top].tolist())]

    def vote(self, neighbours: list[tuple[float, int, int]]) -> float:
        total = sum(c for c, _, _ in neighbours)
        return min(1.0, (sum(c * y for c, _, y in neighbours) + SMOOTHING * self.no_terms)
                   / (total + SMOOTHING))


#: the earlier name
BlockMaxIndex = CosineIndex


def examples_of(df: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) of the labelled rows that may be learned from."""
    allowed = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()
                             & ~held_out(F.col("doc_id"))).select("doc_id", "toxic").distinct())
    drawn = allowed.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(SAMPLE_ROWS)
    return df.select("doc_id", "text").join(drawn, "doc_id")


def fit(df: DataFrame, labels: DataFrame) -> tuple[DataFrame, CosineIndex]:
    """The term vectors of all documents and the index of the examples."""
    sample = staged(examples_of(df, labels), "examples")
    terms, telling = vocabulary(sample)
    vectors = staged(gaps(term_vectors(df, terms)), "vectors", compression="zstd")
    size = len(terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            seen += np.bincount(numbers(batch.column("terms")).values, minlength=size)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(seen[some], rows))],
            names=["term", "n"])

    # the number of all documents goes under -1
    seen = (vectors.select("terms").mapInArrow(counted, "term long, n long").groupBy("term")
            .agg(F.sum("n").alias("n")).toArrow())
    by_term = np.zeros(size + 1)
    by_term[seen.column("term").to_numpy()] = seen.column("n").to_numpy()
    idf = np.log((by_term[-1] + 1) / (by_term[:-1] + 1)) + 1
    drawn = term_vectors(sample.select("doc_id", "text"), terms).join(
        sample.select("doc_id", "toxic").distinct(), "doc_id").distinct().toArrow()
    rows = [(d, int(y), t.values.to_numpy(), c.values.to_numpy()) for d, y, t, c in zip(
        drawn.column("doc_id").to_pylist(), drawn.column("toxic").to_pylist(),
        drawn.column("terms"), drawn.column("counts"))]
    return vectors, CosineIndex(size, idf * telling, rows)


def _evidence(near: list[list[tuple[float, int, int]]]) -> pa.ListArray:
    cosines, ids, labels = zip(*chain.from_iterable(near)) if any(near) else ((), (), ())
    return pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *map(len, near)]).astype(np.int32)), pa.StructArray.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(cosines, pa.float64()),
             pa.array(labels, pa.int32())], ["doc_id", "cosine", "toxic"]))


def scored(vectors: DataFrame, index: CosineIndex) -> DataFrame:
    """(doc_id, score, evidence): the vote and the examples that cast it."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_cache(None)
        own, kept = shared.value, {}
        parts = (batch.slice(start, SLICE_ROWS) for batch in batches
                 for start in range(0, batch.num_rows, SLICE_ROWS))
        for part in parts:
            terms = numbers(part.column("terms"))
            at, counts = terms.offsets.to_numpy().tolist(), part.column("counts").flatten().to_numpy()
            terms = terms.values.to_numpy()
            cut = [(terms[a:b], counts[a:b]) for a, b in zip(at, at[1:])]
            keys = [hashlib.blake2b(t.tobytes() + c.tobytes(), digest_size=16).digest()
                    for t, c in cut]
            # equal documents are answered once
            new = {key: x for key, x in zip(keys, cut) if key not in kept}
            answers = dict(zip(new, own.all_nearest([*new.values()])))
            near = [answers[key] if key in answers else kept[key] for key in keys]
            if len(kept) + len(answers) > KEPT_ANSWERS:
                kept = {}
            kept.update(answers)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([own.vote(x) for x in near], pa.float64()),
                 _evidence(near)], names=["doc_id", "score", "evidence"])

    return vectors.mapInArrow(run, "doc_id long, score double, "
                                   "evidence array<struct<doc_id: long, cosine: double, toxic: int>>")


def score_documents(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Fold, score and prediction for every document."""
    return scored(*fit(df, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("evidence").cast("long").alias("n_evidence"))
