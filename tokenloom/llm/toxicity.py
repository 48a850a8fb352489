"""Toxicity by multiple-instance learning: labels are for documents, scores for sentences.

A sentence's logit is the sum of the weights of its words; it counts for what its -log(1 - p) exceeds that of the
background, and a document is toxic if any of its sentences is (noisy-or with a small leak)::

    P(toxic) = 1 - exp(-(LEAK + sum of excess))      excess = max(0, softplus(logit) - softplus(background))

Long sentences are judged in parts of ``LONGEST`` words.  Weights are never negative, so no word hides another, and clean
sentences below the background do not add up to a toxic text.  Weights are fitted to document labels by full-batch
gradient descent, in two rounds: ``TURNS`` turns without a background, which is then set to the ``BACKGROUND`` quantile of
the clean training sentences, and ``LAST_TURNS`` turns on the likelihood above, the one that scores are taken from.  The
training documents' features are a staged table, each turn is one job that sums gradients by partition, and the driver
holds one weight vector of fixed size.  The fitted sentence scores then locate the offending sentences.

The fit reads at most ``MOST_TRAINING`` documents of each label, those whose ids have the smallest hashes.

Edge cases: a null or empty text has no sentence, and gets the score of the leak alone; documents with several labels
count as toxic if any label says so, null labels and ids are no labels; without both labels all
scores are those of the leak; repeated rows get equal scores; an empty table gives an empty one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import column, map_arrow
from tokenloom.staging import stage

BITS = 18
MOST_TRAINING = 4_000
TURNS, LAST_TURNS = 40, 15
RATE, LAST_RATE = 0.05, 0.02
#: What the noisy-or has besides the sentences; it bounds the pull of a toxic document without any excess.
LEAK = 1e-3
DECAY = 1e-4
#: A feature counts if so many training documents have it.
FEWEST_DOCUMENTS = 3
#: Documents that a feature's first log odds are drawn to zero by.
PRIOR = 2.0
LONGEST = 40
BACKGROUND = 0.999
#: Logits of the background are counted in steps of 1 / FINE between -LIMIT and LIMIT.
LIMIT, FINE = 64, 128
BLANK_LOGIT = -6.0

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"\w+")
_PART = re.compile(rf"(?:\W*+\w++){{1,{LONGEST}}}\W*+")


def features(word: str) -> list[int]:
    """Feature numbers of a lower-case word: itself, and its beginnings of four and five letters."""
    parts = {"w" + word, "4" + word[:4], "5" + word[:5]} if len(word) > 3 else {"w" + word}
    return [xxhash.xxh32_intdigest(p) >> (32 - BITS) for p in sorted(parts)]


class _Words(dict):
    """Weights of words under one model; bounded by ``trim``."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        v = self[word] = float(self.weights[features(word)].sum())
        return v


def sentences(text: str) -> list[tuple[int, int]]:
    """Sentences with a word, or their parts of at most ``LONGEST`` words, as spans of code points."""
    spans = [m.span() for m in SENTENCE.finditer(text) if _WORD.search(m[0])]
    if all(e - s <= 2 * LONGEST for s, e in spans):
        return spans
    return [part for s, e in spans for part in ([(s, e)] if e - s <= 2 * LONGEST else [m.span() for m in _PART.finditer(text, s, e)])]


def logits(text: str, words: dict[str, float], bias: float) -> tuple[list[tuple[int, int]], np.ndarray]:
    spans = sentences(text)
    z = [bias + sum(map(words.__getitem__, set(_WORD.findall(text[s:e].lower())))) for s, e in spans]
    return spans, np.array(z, float)


def excess(z: np.ndarray, floor: float) -> np.ndarray:
    """What each sentence's -log(1 - p) exceeds that of a sentence with the logit ``floor`` by."""
    return np.maximum(np.logaddexp(0, z) - np.logaddexp(0, floor), 0.0)


def noisy_or(z: np.ndarray, floor: float = -np.inf) -> float:
    """Probability that any sentence is toxic: 1 - prod(1 - p) over what exceeds the background, and the leak."""
    return float(-np.expm1(-(LEAK + excess(z, floor).sum())))


# --- fit ----------------------------------------------------------------------


def _encoded(docs: DataFrame) -> DataFrame:
    """``(y, ids, words, sizes)``: feature numbers, how many each word has, and how many words each sentence."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = [], []
        for text in b.column("text").to_pylist():
            own, sizes = [], []
            for s, e in sentences(text or ""):
                found = [f for w in sorted(set(_WORD.findall(text[s:e].lower()))) for f in features(w)]
                own += found
                sizes.append(len(found))
            ids.append(own)
            counts.append(sizes)
        arrays = [b.column("y"), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(arrays, ["y", "ids", "sizes"])

    return map_arrow(docs.select("y", "text"), batch, "y int, ids array<int>, sizes array<int>")


def _flat(column_: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All elements of a list column, and the list lengths."""
    return column_.flatten().to_numpy(), np.diff(column_.offsets.to_numpy())


def _sums(per: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``sizes`` elements."""
    total = np.concatenate([[0.0], np.cumsum(per)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def gradient(b: pa.RecordBatch, weights: np.ndarray, bias: float, balance: float, floor: float = -np.inf) -> np.ndarray:
    """Gradient of the negative log likelihood over one batch, the bias last; ``floor`` is the background's logit."""
    ids, _ = _flat(b.column("ids"))
    sizes, per_doc = _flat(b.column("sizes"))
    y = b.column("y").to_numpy()
    z = bias + _sums(weights[ids], sizes)
    over = excess(z, floor)
    whole = LEAK + np.maximum(_sums(over, per_doc), 0.0)
    # d(-log P(y)) / d(sum of excess): 1 for clean documents, -1 / (exp(sum) - 1) for toxic ones.
    pull = np.where(y == 1, -balance / np.expm1(np.minimum(whole, 50.0)), 1.0)
    by_sentence = np.where(over > 0, np.repeat(pull, per_doc) / (1 + np.exp(-z)), 0.0)
    out = np.bincount(ids, np.repeat(by_sentence, sizes), len(weights))
    return np.append(out, by_sentence.sum())


def _summed(train: DataFrame, each) -> np.ndarray:
    """Sum over the partitions of vectors of one fixed length."""

    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                v = each(b)
                total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["v"])

    vectors = train.mapInArrow(run, "v binary").collect()
    return np.sum([np.frombuffer(bytes(r.v), np.float32).astype(float) for r in vectors], axis=0)


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, held_out: Column | None) -> DataFrame:
    """``(y, text)`` of at most ``MOST_TRAINING`` labelled documents of each label."""
    named = labels.select(column(key).alias("id"), column(label).cast("int").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    named = named.groupBy("id").agg(F.max("y").alias("y"))
    if held_out is not None:
        named = named.filter(~held_out)
    named = named.withColumn("y", (F.col("y") == 1).cast("int"))
    order = [F.xxhash64("id"), F.col("id")]
    parts = [named.filter(F.col("y") == y).orderBy(*order).limit(MOST_TRAINING) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.select(column(key).alias("id"), column(text).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select("id", "y", "text")  # at most 2 * MOST_TRAINING small rows


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", held_out: Column | None = None):
    """``(weights, bias, floor)`` from the labelled documents; ``held_out`` is a condition on the column ``id``."""
    train = stage(_encoded(training_rows(docs, labels, key, text, label, held_out)), "training")
    counts = {r.y: r.n for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = 1 << BITS
    if not counts.get(0) or not counts.get(1):
        return np.zeros(size, np.float32), -40.0, -40.0
    parts = max(1, min(64, (counts[0] + counts[1]) // 500))
    train = stage(train.repartition(parts), "training")
    clean, toxic = _summed(train, lambda b: _document_counts(b, size)).reshape(2, size)
    known = np.append(clean + toxic >= FEWEST_DOCUMENTS, True)
    balance = counts[0] / counts[1]
    scale = 1.0 / (2 * counts[0])
    # Start from the log odds of a feature between toxic and clean documents.
    prior = PRIOR * counts[1] / (counts[0] + counts[1])
    odds = np.log((toxic + prior) / (counts[1] + PRIOR)) - np.log((clean + PRIOR - prior) / (counts[0] + PRIOR))
    state = np.append(np.where(known[:-1], np.maximum(odds, 0.0), 0.0), BLANK_LOGIT)
    state = _turned(train, state, known, balance, scale, -np.inf, TURNS, RATE)
    floor = _background(train, state)
    state = _turned(train, state, known, balance, scale, floor, LAST_TURNS, LAST_RATE)
    return state[:-1].astype(np.float32), float(state[-1]), floor


def _turned(train: DataFrame, state: np.ndarray, known: np.ndarray, balance: float, scale: float, floor: float, turns: int, rate: float):
    """Weights and bias after so many turns of gradient descent with moments, one job each."""
    context = train.sparkSession.sparkContext
    mean, square = np.zeros(len(state)), np.zeros(len(state))
    for turn in range(1, turns + 1):
        shared = context.broadcast(state.astype(np.float32))
        g = _summed(train, lambda b, s=shared: gradient(b, s.value[:-1], float(s.value[-1]), balance, floor)) * scale
        shared.unpersist()
        g = np.where(known, g + DECAY * np.append(state[:-1], 0.0), 0.0)
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        step = (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-5)
        state = state - rate * (1 - 0.5 * turn / turns) * step
        state[:-1] = np.maximum(state[:-1], 0.0)
    return state


def _background(train: DataFrame, state: np.ndarray) -> float:
    """The ``BACKGROUND`` quantile of the clean training sentences' logits; that of a blank one if there is none."""
    weights, bias = state[:-1].astype(np.float32), float(state[-1])
    shared = train.sparkSession.sparkContext.broadcast(weights)
    seen = np.cumsum(_summed(train.filter("y = 0"), lambda b: _logit_counts(b, shared.value, bias)))
    if not seen[-1]:
        return bias
    return float(np.searchsorted(seen, BACKGROUND * seen[-1]) + 1) / FINE - LIMIT


def _logit_counts(b: pa.RecordBatch, weights: np.ndarray, bias: float) -> np.ndarray:
    """How many sentences of a batch have each logit, in steps of 1 / ``FINE``."""
    ids, _ = _flat(b.column("ids"))
    sizes, _ = _flat(b.column("sizes"))
    z = bias + _sums(weights[ids], sizes)
    return np.bincount(np.clip((z + LIMIT) * FINE, 0, 2 * LIMIT * FINE - 1).astype(int), minlength=2 * LIMIT * FINE).astype(float)


def _document_counts(b: pa.RecordBatch, size: int) -> np.ndarray:
    """Documents with each feature: clean ones, then toxic ones."""
    out = np.zeros((2, size))
    for y, ids in zip(b.column("y").to_pylist(), b.column("ids").to_pylist(), strict=True):
        out[y, np.unique(np.array(ids, np.int64))] += 1
    return out.ravel()


# --- scores ---------------------------------------------------------------------

_MODEL: dict = {}


def _words(shared) -> tuple[_Words, float, float]:
    weights, bias, floor = shared.value
    if _MODEL.get("of") is not weights:
        _MODEL.update(of=weights, words=_Words(weights))
    if len(_MODEL["words"]) > 1 << 18:
        _MODEL["words"].clear()
    return _MODEL["words"], bias, floor


def score(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, score, n_sentences, offending)``; ``offending`` lists sentences at 0.5 or more as (start, end, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        words, bias, floor = _words(shared)
        scores, n, bad = [], [], []
        for t in b.column("text").to_pylist():
            spans, z = logits(t or "", words, bias)
            scores.append(noisy_or(z, floor))
            n.append(len(spans))
            each = -np.expm1(-excess(z, floor))
            at = np.flatnonzero(each >= 0.5) if len(z) else []
            bad.append([{"start": spans[i][0], "end": spans[i][1], "score": float(each[i])} for i in at])
        arrays = [b.column("id"), pa.array(scores, pa.float64()), pa.array(n, pa.int64()), pa.array(bad, pa.list_(span))]
        return pa.RecordBatch.from_arrays(arrays, ["id", "score", "n_sentences", "offending"])

    light = docs.select(column(key).alias("id"), column(text).alias("text"))
    out = f"id {kind}, score double, n_sentences long, offending array<struct<start:int,end:int,score:double>>"
    return map_arrow(light, batch, out).withColumnRenamed("id", key)
