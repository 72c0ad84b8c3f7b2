"""Toxicity from the nearest labelled examples by exact cosine of class-weighted TF-IDF over a block-max inverted index.

Labelled documents give the examples, at most `per_class` of either class, chosen by a hash of their id. Terms are words and
their beginnings, and every term of every example is in the index, known by 64-bit keys. Document frequencies are counted
over the whole corpus. A term's weight is (1 + log of its count) * idf * (1 + |evidence|): evidence is the log of how much its
odds of being in a toxic example differ from those of any example, drawn towards 0 as with `EVIDENCE` more examples that say
nothing, so that it grows gradually with what is known of a term and no term is left out. Terms of a text that no example
holds count in its length, with the idf of a term of one document. Example vectors fill an inverted index cut
into blocks of examples. Queries come in batches: their short posting lists are added up example by example; the long ones,
of terms that many examples hold, are kept by block with each term's largest weight there. The blocks' bounds (short part
plus query times those maxima) order the search, and a block's long lists count only for queries whose bound reaches the
k-th score so far, so the k nearest are exact. Their votes, weighted by cosine and by how thinly their class was sampled,
and smoothed towards the share of that class among all labels, give the score; the nearest ids are the evidence.

The index is bounded by the texts of 2 * `per_class` examples and goes to every task; the corpus streams past it.

Edge cases: a text without words, also a null or empty one, has no neighbours and gets the prior share. Ties in
cosine go to the smaller doc_id. A doc_id labelled twice counts with its largest label; null labels and ids are left out.
Without labels of both classes every
score is the share of the one class (0 without labels). Repeated rows are scored
each. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerprice.llm.chunks import LOWER, Chunks, mix, words_and_signs
from hammerprice.llm.columns import id_and_bytes, map_slices, slices, written

PER_CLASS = 4000
EVIDENCE = 10.0
NEIGHBOURS = 25
BLOCK = 512
#: A term that one in so many examples holds has an open list.
COMMON = 20
#: Examples are put into blocks by so many of the terms that most of them hold.
LIKENESS = 1024
PREFIXES = range(4, 10)
SMOOTHING = 0.5

SCORED = "doc_id long, score double, evidence array<long>"


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def features(word: bytes) -> list[bytes]:
    """The word itself and its beginnings, which words of one stem share; a trailing `*` marks a beginning."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if n < len(word))]


def feature_counts(
    texts: list[bytes], counted: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]:
    """Document, feature and number of occurrences, by document and feature, and the keys of the distinct features.

    Without `counted` there are no numbers and no order.
    """
    chunks = Chunks(texts, words_and_signs, LOWER)
    words, distinct = pd.factorize(chunks.keys())
    at = np.empty(len(distinct), np.int64)
    at[words[::-1]] = np.arange(len(words) - 1, -1, -1)
    docs, n = np.repeat(np.arange(len(texts)), np.diff(chunks.first)), max(1, len(distinct))
    pairs = docs * n + words
    pairs, counts = np.unique(pairs, return_counts=True) if counted else (pd.unique(pairs), None)
    docs, words = pairs // n, pairs % n
    length, beginning = (chunks.ends - chunks.starts)[at], copy.copy(chunks)
    keys, feature, of = [distinct], [words], [np.arange(len(words))]
    for size in PREFIXES:
        longer = np.flatnonzero(length > size)
        beginning.starts, beginning.ends = chunks.starts[at[longer]], chunks.starts[at[longer]] + size
        codes, found = pd.factorize(mix(beginning.keys() ^ np.uint64(size)))
        number = np.full(len(distinct), -1)
        number[longer] = codes + sum(map(len, keys))
        keys.append(found)
        of.append(np.flatnonzero(number[words] >= 0))
        feature.append(number[words[of[-1]]])
    every, of, keys = np.concatenate(feature), np.concatenate(of), np.concatenate(keys)
    size = max(1, len(keys))
    pairs = docs[of] * size + every
    if not counted:
        pairs = pd.unique(pairs)
        return pairs // size, pairs % size, None, keys
    pairs, each = np.unique(pairs, return_inverse=True)
    return pairs // size, pairs % size, np.bincount(each, weights=counts[of], minlength=len(pairs)).astype(np.int64), keys


def _places(keys: pd.Index, own: np.ndarray) -> np.ndarray:
    """Places of `own` in `keys`, their number for what is absent; the index keeps its hash table."""
    place = keys.get_indexer(own)
    place[place < 0] = len(keys)
    return place


def _found(texts: list[bytes], keys: pd.Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, place in `keys` (their number if absent) and number of occurrences of every feature."""
    docs, codes, counts, own = feature_counts(texts)
    return docs, _places(keys, own)[codes], counts


def document_frequencies(texts: DataFrame, places: Callable[[list[bytes]], np.ndarray], size: int) -> np.ndarray:
    """Number of documents of the whole corpus that hold each of `size` terms; `places` gives those of some texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for part in slices(batches):
            total += np.bincount(places(part.column("text").to_pylist()), minlength=size + 1)
        held = np.flatnonzero(total[:size])
        yield pa.RecordBatch.from_pydict({"term": pa.array(held, pa.int64()), "n": pa.array(total[held])})

    rows = texts.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(size)
    frequency[rows["term"].to_numpy()] = rows["n"].to_numpy()  # one row per term
    return frequency


def _weighted(counts: np.ndarray, idf: np.ndarray | float) -> np.ndarray:
    return (1 + np.log(counts, dtype=np.float64)) * idf


def _scale(docs: np.ndarray, weights: np.ndarray, n_docs: int) -> np.ndarray:
    """What scales the vector of each document to length 1."""
    norm = np.sqrt(np.bincount(docs, weights=weights * weights, minlength=n_docs))
    return 1 / np.where(norm > 0, norm, 1)


def _ranges(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from `starts` up to `stops`, one range after the other, and the ranges' sizes."""
    sizes = stops - starts
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    at += np.arange(len(at))
    return at, sizes


class BlockMaxIndex:
    """Posting lists over the examples, which are cut into blocks of `block`.

    Long lists, of terms that at least one in `COMMON` examples holds, are kept open: by block, the weights
    of the terms that it holds for every example of it, in single precision, and their largest there; beside them the counts.
    The others are lists of examples, one for each count that a term has in them. A batch of queries adds up its short lists
    first; what the long ones can add to a block at most bounds it, and they are multiplied for those queries only whose
    bound reaches the k-th score that the blocks before gave; the block of its largest bound is a query's first. These
    products, too, are of single precision; whatever is within their error of the k-th is added up again from the counts in
    double precision.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, class_weight: np.ndarray, idf: np.ndarray, block: int):
        self.ids, self.labels, self.class_weight, self.idf, self.block = ids, labels, class_weight, idf, block
        self.n_blocks = -(-len(ids) // block)

    def fill(self, examples: np.ndarray, terms: np.ndarray, counts: np.ndarray, scale: np.ndarray) -> BlockMaxIndex:
        """`counts` of terms in examples; `scale` makes each example's vector one of length 1."""
        self.scale = scale
        sizes = np.bincount(terms, minlength=len(self.idf))
        common = np.flatnonzero((sizes > 1) & (sizes * COMMON >= len(self.ids)))
        self.row = np.full(len(self.idf), -1, np.int32)
        self.row[common] = np.arange(len(common))
        is_common, most = self.row[terms] >= 0, int(counts.max(initial=0))
        self._fill_short(examples[~is_common], terms[~is_common], counts[~is_common], 1 + most)
        examples, terms, counts = examples[is_common], terms[is_common], counts[is_common]
        at, row, weights = examples, self.row[terms], _weighted(counts, self.idf[terms])
        dense = np.zeros((self.n_blocks, len(common), self.block), np.float32)
        dense[at // self.block, row, at % self.block] = weights * scale[at]
        self.maxima = dense.max(axis=2, initial=0).T.copy()
        self.held = [np.flatnonzero(largest) for largest in self.maxima.T]
        self.open = [lists[held] for lists, held in zip(dense, self.held, strict=True)]
        del dense
        self.counts = np.zeros((len(self.ids), len(common)), np.min_scalar_type(most))
        self.counts[at, row] = counts
        self.by_count = np.append(0, _weighted(np.arange(1, 1 + most), 1.0))
        self.slack = (len(common) + 4) * 2.0**-23  # twice the error of a sum of so many products, none above 1
        return self

    def _fill_short(self, examples: np.ndarray, terms: np.ndarray, counts: np.ndarray, each: int) -> None:
        """`each` is more than any count."""
        examples = examples.astype(np.min_scalar_type(max(0, len(self.ids) - 1)))
        lists = terms.astype(np.int64)
        lists *= each
        lists += counts
        order = np.argsort(lists)
        self.examples, lists = examples[order], lists[order]
        del order
        first = np.flatnonzero(np.diff(lists, prepend=-1))
        self.bounds, terms = np.append(first, len(lists)), lists[first] // each
        self.weights = _weighted(lists[first] % each, self.idf[terms])
        self.of_term = np.searchsorted(terms, np.arange(len(self.idf) + 1))

    def _short(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the short lists of the terms give each example."""
        lists, sizes = _ranges(self.of_term[terms], self.of_term[terms + 1])
        weights = np.repeat(weights, sizes) * self.weights[lists]
        at, sizes = _ranges(self.bounds[lists], self.bounds[lists + 1])
        each = np.repeat(weights, sizes)
        return np.bincount(self.examples.take(at, mode="clip"), weights=each, minlength=len(self.ids)) * self.scale

    def nearest_of(
        self, queries: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """The k examples of largest cosine above 0 of each of `n` queries, nearest first, ties to the smaller id.

        `queries`, ascending, tells whose terms and weights these are.
        """
        row = self.row[terms]
        common = row >= 0
        asked = np.zeros((n, len(self.maxima)), np.float32)
        asked[queries[common], row[common]] = weights[common]
        short = np.zeros((n, len(self.ids)))
        edges = np.searchsorted(queries[~common], np.arange(n + 1)).tolist()
        short_terms, short_weights = terms[~common], weights[~common]
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            short[i] = self._short(short_terms[a:b], short_weights[a:b])
        scores = np.zeros((n, self.n_blocks * self.block), np.float32)
        scores[:, : len(self.ids)] = short
        by_block = scores.reshape(n, self.n_blocks, self.block)
        bound = by_block.max(axis=2, initial=0) + asked @ self.maxima
        best = np.zeros((n, k), np.float32)  # the largest scores so far, the k-th of them first
        order, likely = np.argsort(-bound.sum(axis=0), kind="stable").tolist(), np.argsort(-bound, axis=1)
        for j, is_first in [(j, is_first) for is_first in (True, False) for j in order]:
            asking = (likely[:, 0] == j) == is_first
            needs = asking & (bound[:, j] > 0) & (bound[:, j] >= best[:, 0] - self.slack)
            by_block[asking & ~needs, j] = 0
            some = np.flatnonzero(needs)
            if len(some):
                whole = slice(None) if len(some) == n else some
                by_block[whole, j] += asked[whole].take(self.held[j], axis=1) @ self.open[j]
                merged = np.concatenate([best[whole], by_block[whole, j]], axis=1)
                best[whole] = np.partition(merged, self.block, axis=1)[:, self.block :]
        edges = np.searchsorted(queries[common], np.arange(n + 1)).tolist()
        row, weights, found = row[common], (weights * self.idf[terms])[common], []
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            own = scores[i, : len(self.ids)]
            hit = np.flatnonzero(own >= max(best[i, 0] - self.slack, np.finfo(np.float32).tiny))
            held = self.counts[hit[:, None], row[a:b]]
            cosine = short[i, hit] + self.by_count[held] @ weights[a:b] * self.scale[hit]
            order = np.lexsort((self.ids[hit], -np.round(cosine, 12)))[:k]
            found.append((hit[order], cosine[order]))
        return found

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        return self.nearest_of(np.zeros(len(terms), np.int64), terms, weights, 1, k)[0]

    def vote(self, hit: np.ndarray, cosine: np.ndarray, prior: float, smoothing: float) -> float:
        mass = cosine * self.class_weight[self.labels[hit]]
        return float((mass[self.labels[hit] == 1].sum() + smoothing * prior) / (mass.sum() + smoothing))


class Examples:
    """Terms and counts of the examples, one after the other: what goes to the tasks, which make the index of it."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, first: np.ndarray, terms: np.ndarray, counts: np.ndarray):
        self.ids, self.labels, self.first, self.terms = ids, labels, first, terms
        self.counts = counts.astype(np.min_scalar_type(int(counts.max(initial=0))))

    def keyed(self) -> pd.Index:
        """Keys of the distinct terms; from now on terms are numbers in them.

        What most examples hold comes first, so that the lists that are read most lie side by side.
        """
        keys, sizes = np.unique(self.terms.view(np.uint64), return_counts=True)
        order = np.argsort(-sizes, kind="stable")
        number = np.empty(len(keys), np.int32)
        number[order] = np.arange(len(keys), dtype=np.int32)
        self.terms = number[np.searchsorted(keys, self.terms.view(np.uint64))]
        return pd.Index(keys[order])

    def weighted(self, idf: np.ndarray, class_weight: np.ndarray, block: int) -> Examples:
        """Terms weigh idf times `class_factors`."""
        share = float(self.labels.mean()) if len(self.ids) else 0.0
        factors = class_factors(self.terms, np.repeat(self.labels, np.diff(self.first)), share, len(idf))
        self.idf, self.class_weight, self.block = idf * factors, class_weight, block
        return self

    def index(self) -> BlockMaxIndex:
        """The index, made once in a process."""
        if "made" not in self.__dict__:
            idf, examples = self.idf, np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.first))
            scale = _scale(examples, _weighted(self.counts, idf[self.terms]), len(self.ids))
            order = self._by_likeness(examples, scale)
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            np.take(place, examples, out=examples, mode="clip")
            made = BlockMaxIndex(self.ids[order], self.labels[order], self.class_weight, idf, self.block)
            self.made = made.fill(examples, self.terms, self.counts, scale[order])
            self.terms = self.counts = None  # the task's copy: the index holds what it needs of them
        return self.made

    def _by_likeness(self, examples: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """An order of the examples that puts like ones into one block, so that a block's bound tells them from others.

        They are halved along the direction in which their vectors of the `LIKENESS` most held terms differ most, until
        a half fits a block.
        """
        some = self.terms < LIKENESS
        vectors = np.zeros((len(self.ids), min(LIKENESS, len(self.idf))), np.float32)
        at, terms = examples[some], self.terms[some]
        vectors[at, terms] = _weighted(self.counts[some], self.idf[terms]) * scale[at]
        order, open_parts = np.argsort(self.ids), [(0, len(self.ids))]
        while open_parts:
            a, b = open_parts.pop()
            if b - a <= self.block:
                continue
            part = vectors[order[a:b]]
            part -= part.mean(axis=0)
            direction = part[np.argmax(np.einsum("ij,ij->i", part, part))]
            for _ in range(6):
                direction = (part @ direction) @ part
                direction /= max(np.linalg.norm(direction), np.finfo(np.float32).tiny)
            order[a:b] = order[a:b][np.argsort(part @ direction, kind="stable")]
            middle = a + -(-(b - a) // (2 * self.block)) * self.block
            open_parts += [(a, middle), (middle, b)]
        return order

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "made"}


def example_counts(sample: DataFrame, counted: Callable) -> Examples:
    """The examples with words; `counted` gives documents, terms and counts of texts."""

    def vectors(part: pa.RecordBatch) -> pa.RecordBatch:
        docs, found, counts = counted(part.column("text").to_pylist())
        bounds = pa.array(np.searchsorted(docs, np.arange(part.num_rows + 1)), pa.int32())
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "label": part.column("label"),
                "terms": pa.ListArray.from_arrays(bounds, pa.array(found, pa.int64())),
                "counts": pa.ListArray.from_arrays(bounds, pa.array(counts, pa.int32())),
            }
        )

    schema = "doc_id long, label int, terms array<long>, counts array<int>"
    rows = map_slices(sample.select("doc_id", "label", "text"), vectors, schema).where(F.size("terms") > 0)
    table = rows.dropDuplicates(["doc_id"]).toArrow()  # at most `per_class` rows of either class
    lists = table["terms"].combine_chunks()
    flat, first = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
    counts = table["counts"].combine_chunks().flatten().to_numpy()
    return Examples(table["doc_id"].to_numpy(), table["label"].to_numpy().astype(np.int64), first.astype(np.int64), flat, counts)


def class_factors(terms: np.ndarray, labels: np.ndarray, share: float, size: int) -> np.ndarray:
    """1 + |evidence| of every term, from the labels of the examples that hold it and the share of toxic examples."""
    if not 0 < share < 1:
        return np.ones(size)
    toxic, other = (np.bincount(terms[labels == label], minlength=size) for label in (1, 0))
    odds = (toxic + EVIDENCE * share) / (other + EVIDENCE * (1 - share))
    return 1 + np.abs(np.log(odds * (1 - share) / share))


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    per_class: int = PER_CLASS,
    k: int = NEIGHBOURS,
    block: int = BLOCK,
    smoothing: float = SMOOTHING,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `score` (0 to 1) and `evidence` (doc_ids of the nearest examples) of every row.

    `labels` has `doc_id` and `label` (0 or 1), of the rows that may be learned from.
    """
    spark = df.sparkSession
    texts = id_and_bytes(df, id_col, text_col)
    marked = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id")
    marked = written(marked.agg(F.max("label").cast("int").alias("label")), "toxicity-labels")
    totals = {row["label"]: row["count"] for row in marked.groupBy("label").count().collect()}
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    chosen = None
    for label in (0, 1):
        some = marked.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.unionByName(some)
    # At most 2 * per_class ids.
    sample = written(texts.join(F.broadcast(chosen), "doc_id"), "toxicity-examples")
    n_docs = texts.count()

    def own(some: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        docs, codes, counts, keys = feature_counts(some)
        return docs, keys[codes].view(np.int64), counts

    rows = example_counts(sample, own)
    keys = rows.keyed()
    held, size = spark.sparkContext.broadcast(keys), len(keys)

    def places(some: list[bytes]) -> np.ndarray:
        _, codes, _, own = feature_counts(some, counted=False)
        return _places(held.value, own)[codes]

    frequency = np.append(document_frequencies(texts, places, size), 1.0)  # the last: terms of no example
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1
    class_weight = np.array([totals.get(c, 0) / max(1, min(per_class, totals.get(c, 0))) for c in (0, 1)])
    held_rows = spark.sparkContext.broadcast(rows.weighted(idf, class_weight, block))

    def score(part: pa.RecordBatch) -> pa.RecordBatch:
        searched, n = held_rows.value.index(), part.num_rows
        docs, found, counts = _found(part.column("text").to_pylist(), held.value)
        weights = _weighted(counts, searched.idf[found])
        weights *= _scale(docs, weights, n)[docs]
        known = found < size  # the others count in the length only
        docs, found, weights = docs[known], found[known], weights[known]
        near = searched.nearest_of(docs, found, weights, n, k)
        scores = [searched.vote(hit, cosine, prior, smoothing) if len(hit) else prior for hit, cosine in near]
        evidence = [searched.ids[hit[:3]].tolist() for hit, _ in near]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "score": pa.array(scores, pa.float64()),
                "evidence": pa.array(evidence, pa.list_(pa.int64())),
            }
        )

    return map_slices(texts, score, SCORED)
