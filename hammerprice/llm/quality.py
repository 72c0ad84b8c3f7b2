"""Text quality from a weak-label model and a hashed linear scorer.

Several heuristic labellers look at each document and vote good, bad, or abstain. Their votes overlap and disagree;
expectation-maximisation over the counts of all vote patterns of the corpus estimates how each labeller votes on good and on
bad documents, and with that the posterior of a document's class. The posteriors of a bounded sample of documents train a
linear scorer on hashed features (words, word shapes and a few bucketed ratios), which generalises beyond the rules and
scores every document.

The driver sees counts of vote patterns (at most 3**labellers) and the weights (2**bits). Training runs on `shards` groups
of the sample, at most `sample_rows` documents in all, whose weights are averaged.

Edge cases: a null or empty text has no features: all labellers abstain and it gets the score of the bias alone. Documents
that repeat a doc_id are sampled once and scored each; rows without an id are scored but not sampled. Ties in the sample's
order go to the smaller id. An empty table gives no rows and no weights.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerprice.llm.chunks import LOWER, MASKS, Chunks, mix, white_space_words
from hammerprice.llm.columns import id_and_bytes, map_slices, written

SAMPLE_ROWS = 20_000
SHARDS = 8
BITS = 16
EPOCHS = 60
STEP = 0.5
PENALTY = 1e-5
ITERATIONS = 100
#: Documents with a smaller probability of being good are rejected.
LEAST_SCORE = 0.5

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_PLAIN = bytes(c for c in range(128) if chr(c).isalnum() or chr(c).isspace() or chr(c) in ".,;:'\"-()")
_HIGH = bytes(range(128, 256))
#: Shape of a byte: upper case, letter, digit, or the sign itself.
_SHAPE = bytes(
    65 if 65 <= c < 91 else 97 if 97 <= c < 123 or c >= 128 else 48 if 48 <= c < 58 else c for c in range(256)
)


def _table(wanted: Callable[[int], bool]) -> np.ndarray:
    return np.array([wanted(c) for c in range(256)])


_LETTER = _table(lambda c: c >= 128 or chr(c).isalpha())
_STOP = _table(lambda c: chr(c) in ".!?")
_MARK = _table(lambda c: chr(c) in "!#$%&*+/<=>@\\^_`{|}~")


@dataclass
class Document:
    """What labellers and features need of one text."""

    words: int
    upper: float  # share of upper case among ASCII letters
    signs: float  # share of uncommon signs among bytes
    letterless: float  # shares of words without a letter, that end a sentence, that end in a mark
    stops: float
    marked: float
    echoes: float  # share of words that repeat the one before
    top: float  # share of the commonest word
    distinct: float
    length: float  # mean, in bytes
    repeated: float  # share of lines that occur before
    hashes: tuple[np.ndarray, np.ndarray] | None  # of the words in lower case and of their shapes


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum per text of a value per word."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[first])


def _shapes(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's shape: its first eight runs of like bytes."""
    shape = np.frombuffer(raw.translate(_SHAPE), np.uint8)
    turns = np.ones(len(shape), bool)
    turns[1:] = shape[1:] != shape[:-1]
    turns[starts] = True
    before = np.concatenate([[0], np.cumsum(turns)])
    runs = np.concatenate([shape[turns], np.zeros(8, np.uint8)])
    at = before[starts]
    words = np.ndarray((len(runs) - 7,), "<u8", runs, strides=(1,))
    return mix((words[at] & MASKS[np.minimum(before[ends] - at, 8)]) ^ np.uint64(0xA5A5A5A5A5A5A5A5))


#: Each returns 1 for good, -1 for bad, 0 to abstain. Most know one kind of junk and have no opinion on anything else.
LABELLERS = {
    "upper_case": lambda d: -1 if d.upper > 0.5 else 0,
    "signs": lambda d: -1 if d.signs > 0.1 else 0,
    "letterless_words": lambda d: -1 if d.words >= 20 and d.letterless > 0.25 else 0,
    "marked_words": lambda d: -1 if d.marked > 0.25 else 0,
    "one_word": lambda d: -1 if d.words >= 10 and d.top > 0.4 else 0,
    "few_distinct": lambda d: -1 if d.distinct < 0.15 and 30 <= d.words < 2000 else 0,
    "echoes": lambda d: -1 if d.words >= 10 and d.echoes > 0.15 else 0,
    "sentences": lambda d: 0 if d.words < 60 else -1 if d.stops < 0.002 else 1 if 0.02 < d.stops < 0.4 else 0,
    "repeated_lines": lambda d: -1 if d.repeated > 0.6 else 0,
    "word_length": lambda d: -1 if d.length > 25 or 0 < d.length < 1.5 else 0,
}


def documents(texts: list[bytes], hashed: bool = False) -> list[Document]:
    """Words are runs without white space, told apart in lower case; `hashed` adds what `features` needs."""
    chunks = Chunks(texts, white_space_words, LOWER)
    keys, first, starts, ends = chunks.keys(), chunks.first, chunks.starts, chunks.ends
    codes, _ = pd.factorize(keys)
    raw = b"".join(texts)
    data = np.frombuffer(raw, np.uint8)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    words = np.diff(first)
    each = np.maximum(words, 1)
    last = data[ends - 1] if len(ends) else data[:0]
    echo = np.zeros(len(codes), bool)
    echo[1:] = codes[1:] == codes[:-1]
    echo[first[:-1][words > 0]] = False
    shares = [
        (_sums(x, first) / each).tolist()
        for x in (letters[ends] == letters[starts], _STOP[last], _MARK[last], echo, ends - starts)
    ]
    shapes = _shapes(raw, starts, ends) if hashed and len(starts) else keys
    out = []
    for i, (text, a, b) in enumerate(zip(texts, first.tolist(), first[1:].tolist(), strict=False)):
        _, counts = np.unique(codes[a:b], return_counts=True)
        upper, lower = len(text) - len(text.translate(None, _UPPER)), len(text) - len(text.translate(None, _LOWER))
        lines = [line for line in text.split(b"\n") if line.strip()]
        letterless, stops, marked, echoes, length = (share[i] for share in shares)
        out.append(
            Document(
                words=b - a,
                upper=upper / max(1, upper + lower),
                signs=len(text.translate(None, _PLAIN + _HIGH)) / max(1, len(text.translate(None, b" \t\n\r\v\f"))),
                letterless=letterless,
                stops=stops,
                marked=marked,
                echoes=echoes,
                top=float(counts.max()) / (b - a) if b > a else 0.0,
                distinct=len(counts) / max(1, b - a),
                length=length,
                repeated=1 - len(set(lines)) / max(1, len(lines)),
                hashes=(keys[a:b], shapes[a:b]) if hashed else None,
            )
        )
    return out


def votes(document: Document) -> tuple[int, ...]:
    return tuple(rule(document) for rule in LABELLERS.values()) if document.words else (0,) * len(LABELLERS)


def features(document: Document, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values (of length about 1 together) of a document's hashed features."""
    if not document.words:
        return np.zeros(0, np.int64), np.zeros(0)
    ratios = (
        document.upper, document.signs, document.letterless, document.top, document.distinct, document.echoes,
        document.repeated,
    )
    bands = [xxhash.xxh3_64_intdigest(b"\1%d %d" % (i, min(9, int(ratio * 10)))) for i, ratio in enumerate(ratios)]
    words, shapes = document.hashes
    hashes = np.concatenate([words, shapes, np.array(bands, np.uint64)])
    shares = np.full(len(hashes), 1 / document.words)
    shares[: len(words)] *= 0.2
    shares[len(hashes) - len(bands) :] = 0.1
    slots, place = np.unique((hashes & np.uint64((1 << bits) - 1)).astype(np.int32), return_inverse=True)
    return slots.astype(np.int64), np.sqrt(np.bincount(place, weights=shares))


class WeakLabels:
    """Votes of conditionally independent labellers, given a document's class: 0 bad, 1 good."""

    def __init__(self, patterns: dict[tuple[int, ...], int], iterations: int = ITERATIONS):
        self.good = 0.7
        n = len(LABELLERS)
        #: Probability of a vote (bad, abstain, good) by class and labeller.
        self.rates = np.array([np.tile([0.5, 0.3, 0.2], (n, 1)), np.tile([0.1, 0.3, 0.6], (n, 1))])
        if not patterns:
            return
        cast = np.array(list(patterns), np.int64) + 1
        counts = np.array(list(patterns.values()), np.float64)
        for _ in range(iterations):
            posterior = self._posterior(cast)
            weight = np.array([(1 - posterior) * counts, posterior * counts])
            self.good = float((weight[1].sum() + 1) / (counts.sum() + 2))
            for vote in range(3):
                self.rates[:, :, vote] = weight @ (cast == vote) + 0.5
            self.rates /= self.rates.sum(axis=2, keepdims=True)

    def _posterior(self, cast: np.ndarray) -> np.ndarray:
        log = np.log(self.rates)[:, np.arange(cast.shape[1]), cast].sum(axis=2)
        odds = np.log(self.good / (1 - self.good)) + log[1] - log[0]
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    def posterior(self, pattern: tuple[int, ...]) -> float:
        """Probability that a document with these votes is good."""
        return float(self._posterior(np.array([pattern]) + 1)[0])

    def accuracies(self) -> dict[str, float]:
        """Share of right votes among those a labeller casts."""
        right = (1 - self.good) * self.rates[0, :, 0] + self.good * self.rates[1, :, 2]
        wrong = (1 - self.good) * self.rates[0, :, 2] + self.good * self.rates[1, :, 0]
        return dict(zip(LABELLERS, (right / (right + wrong)).tolist(), strict=True))


def vote_patterns(texts: DataFrame) -> dict[tuple[int, ...], int]:
    """Counts of the vote patterns over all documents."""

    def count(part: pa.RecordBatch) -> pa.RecordBatch:
        seen = Counter(votes(document) for document in documents(part.column("text").to_pylist()))
        patterns = pa.array([[*pattern] for pattern in seen], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([patterns, pa.array(list(seen.values()), pa.int64())], ["pattern", "n"])

    counted = map_slices(texts.select("text"), count, "pattern array<int>, n long")
    rows = counted.groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    return {tuple(row["pattern"]): row["n"] for row in sorted(rows)}


def train(rows: pd.DataFrame, bits: int) -> np.ndarray:
    """Weights and bias (last) of a logistic scorer by gradient steps of falling length on all rows."""
    rows = rows.sort_values("doc_id")
    sizes = rows["slots"].str.len().to_numpy()
    row = np.repeat(np.arange(len(rows)), sizes)
    slot, value = np.concatenate(rows["slots"].to_list()).astype(np.int64), np.concatenate(rows["vals"].to_list())
    wanted, weights, bias = rows["good"].to_numpy(), np.zeros(1 << bits), 0.0
    squares, bias_square = np.full(1 << bits, 1e-8), 1e-8
    for _ in range(EPOCHS):
        scores = np.bincount(row, weights=weights[slot] * value, minlength=len(rows)) + bias
        error = 1 / (1 + np.exp(-np.clip(scores, -50, 50))) - wanted
        slope = np.bincount(slot, weights=error[row] * value, minlength=1 << bits) / len(rows) + PENALTY * weights
        squares += slope * slope
        weights -= STEP * slope / np.sqrt(squares)
        bias_square += error.mean() ** 2
        bias -= STEP * error.mean() / np.sqrt(bias_square)
    return np.append(weights, bias)


def fit(texts: DataFrame, weak: WeakLabels, sample_rows: int, shards: int, bits: int) -> np.ndarray:
    """Scorer weights, averaged over the shards of a sample of at most `sample_rows` documents."""
    ids = texts.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).select("doc_id")
    sample = texts.join(F.broadcast(written(ids, "quality-ids")), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))

    def described(part: pa.RecordBatch) -> pa.RecordBatch:
        found = documents(part.column("text").to_pylist(), hashed=True)
        slots, vals = zip(*(features(document, bits) for document in found), strict=True)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "good": pa.array([weak.posterior(votes(document)) for document in found], pa.float64()),
                "slots": pa.array(slots, pa.list_(pa.int64())),
                "vals": pa.array(vals, pa.list_(pa.float64())),
            }
        )

    def trained(rows: pd.DataFrame) -> pd.DataFrame:
        weights = train(rows, bits)
        slots = np.append(np.flatnonzero(weights[:-1]), len(weights) - 1)
        return pd.DataFrame({"slot": slots, "weight": weights[slots]})

    described_rows = map_slices(sample, described, "doc_id long, good double, slots array<long>, vals array<double>")
    shard = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(shards)).alias("shard")
    parts = written(described_rows, "quality-features").groupBy(shard).applyInPandas(trained, "slot long, weight double")
    parts = written(parts, "quality-weights")
    trained_shards = max(1, parts.where(F.col("slot") == 1 << bits).count())
    weights = np.zeros((1 << bits) + 1)
    for row in parts.groupBy("slot").agg(F.sum("weight").alias("weight")).collect():  # one row per slot
        weights[row["slot"]] = row["weight"] / trained_shards
    return weights


class Scorer:
    """The fitted weak-label model and the scorer's weights."""

    def __init__(self, texts: DataFrame, sample_rows: int = SAMPLE_ROWS, shards: int = SHARDS, bits: int = BITS):
        """`texts` has `doc_id` and `text` (bytes)."""
        self.bits = bits
        self.weak = WeakLabels(vote_patterns(texts))
        self.weights = texts.sparkSession.sparkContext.broadcast(fit(texts, self.weak, sample_rows, shards, bits))

    def score(self, document: Document) -> float:
        slots, vals = features(document, self.bits)
        weights = self.weights.value
        return float(1 / (1 + np.exp(-np.clip(weights[slots] @ vals + weights[-1], -50, 50))))


def quality(
    df: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    shards: int = SHARDS,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id`, `score` (probability of being good), `kept`, and the labellers' `votes` and `posterior`, of every row."""
    texts = id_and_bytes(df, id_col, text_col)
    scorer = Scorer(texts, sample_rows, shards, bits)

    def score(part: pa.RecordBatch) -> pa.RecordBatch:
        found = documents(part.column("text").to_pylist(), hashed=True)
        cast = [votes(document) for document in found]
        known = {pattern: scorer.weak.posterior(pattern) for pattern in set(cast)}
        scores = [scorer.score(document) for document in found]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "score": pa.array(scores, pa.float64()),
                "kept": pa.array([x >= LEAST_SCORE for x in scores], pa.bool_()),
                "votes": pa.array([[*pattern] for pattern in cast], pa.list_(pa.int32())),
                "posterior": pa.array([known[pattern] for pattern in cast], pa.float64()),
            }
        )

    return map_slices(texts, score, "doc_id long, score double, kept boolean, votes array<int>, posterior double")


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that are not rejected, with all their columns, judged in place."""
    scorer = Scorer(id_and_bytes(df, id_col, text_col))
    at = df.columns.index(text_col)

    def keep(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(text or "").encode() for text in part.column(at).to_pylist()]
        good = [scorer.score(document) >= LEAST_SCORE for document in documents(texts, hashed=True)]
        return part.filter(pa.array(good, pa.bool_()))

    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # Spark resolves the names, and takes a dot for a field
    return map_slices(plain, keep, plain.schema).toDF(*df.columns)
