"""Toxicity scores from a hashed linear classifier that is regularised by counterfactuals.

Features are words and their beginnings, hashed; a document's value for one is ``log(1 + count)``. Training minimises the
logistic loss, an L1 term, and the squared changes of the score when identity terms (of one or more words) in a labelled text
are swapped for each of the others of their groups, so that naming a group does not by itself move a score.

Bounds, all parameters: ``per_class`` labelled documents of each class train the model (the lowest hashes of their ids),
``features`` buckets are kept. Every document is scored, and over its whole text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.llm.common import Batches, stored, texts_of, with_columns

HELD_OUT = 2  # of crc32(doc_id) mod 4
THRESHOLD = 0.3
SPACE = 1 << 20
STRIPPED = ".,;:!?|#*$%&\"'()[]{}<>«»“”„¿¡-"
CACHED_WORDS = 500_000

# Identity terms by group, one form per person or people; swaps stay within a group. No word is in all terms
# of a group, so that each word of a term is swapped away sometimes.
IDENTITY_GROUPS = tuple(
    tuple(term.strip() for term in group.split(","))
    for group in (
        "muslim, christian, jewish, hindu, buddhist, atheist, catholic",
        "muslims, christians, jews, hindus, buddhists, atheists, catholics",
        "women, men",
        "woman, man",
        "girls, boys",
        "gay, lesbian, straight, bisexual, transgender",
        "gays, lesbians, bisexuals, gay people, transgender people, trans women, trans men",
        "black, white, asian, latino, arab, african, european, african american, native american",
        "africans, asians, europeans, latinos, arabs, african americans, asian americans, native americans",
        "immigrants, refugees, foreigners, natives",
        "old people, young people, poor people, disabled people, deaf people, pensioners, teenagers",
        "femmes, hommes",
        "femme, homme",
        "musulmans, chrétiens, juifs, bouddhistes, athées",
        "personnes âgées, personnes handicapées, retraités, jeunes",
        "mujeres, hombres",
        "mujer, hombre",
        "musulmanes, cristianos, judíos, budistas, ateos",
        "personas mayores, personas con discapacidad, jubilados, jóvenes",
        "frauen, männer",
        "frau, mann",
        "muslime, christen, juden, buddhisten, atheisten",
        "alte menschen, behinderte menschen, rentner, jugendliche",
    )
)
# The most counterfactuals of a text: enough to swap a term for each of the others of the largest group.
SWAPS = max(map(len, IDENTITY_GROUPS)) - 1
_TERMS = {tuple(term.split()): (number, place) for number, group in enumerate(IDENTITY_GROUPS) for place, term in enumerate(group)}
_LENGTHS: dict[str, list[int]] = {}
for _term in sorted(_TERMS, key=len, reverse=True):
    if len(_term) not in _LENGTHS.setdefault(_term[0], []):
        _LENGTHS[_term[0]].append(len(_term))


def normal(word: str) -> str:
    return word.lower().strip(STRIPPED)


def buckets(word: str) -> tuple[int, ...]:
    """Of a normalised word: one for the word, one for each beginning of three to six characters."""
    if not word:
        return ()
    parts = [word, *("^" + word[:n] for n in range(3, min(6, len(word)) + 1))]
    return tuple(xxhash.xxh64_intdigest(part) % SPACE for part in parts)


def feature_counts(words: Iterable[str]) -> Counter:
    counts: Counter = Counter()
    for word, n in Counter(map(normal, words)).items():
        for bucket in buckets(word):
            counts[bucket] += n
    return counts


def identity_terms(normals: list[str]) -> list[tuple[int, int, int, int]]:
    """(start, end, group, place in the group) of the terms in normalised words, the longest at each place."""
    found, at = [], 0
    while at < len(normals):
        for length in _LENGTHS.get(normals[at], ()):
            term = _TERMS.get(tuple(normals[at : at + length]))
            if term is not None:
                found.append((at, at + length, *term))
                at += length
                break
        else:
            at += 1
    return found


def counterfactuals(words: list[str]) -> list[list[str]]:
    """The normalised words with their identity terms swapped for others of the same groups; none without such terms.

    In the n-th one each term is replaced by the n-th after it in its group, so that over all of them a term meets every
    other one of its group, and terms of one group stay different ones.
    """
    normals = [normal(word) for word in words]
    terms, others = identity_terms(normals), []
    for shift in range(1, SWAPS + 1):
        pieces, at = [], 0
        for start, end, number, place in terms:
            group = IDENTITY_GROUPS[number]
            if shift < len(group):
                pieces += [*normals[at:start], *group[(place + shift) % len(group)].split()]
                at = end
        if at:
            others.append(pieces + normals[at:])
    return others


def held_out(doc_id: str | Column) -> Column:
    """Whether a document's label may not be learned from; an id that is null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == HELD_OUT


@dataclass
class ToxicityModel:
    bias: float
    weights: dict[int, float] = field(default_factory=dict)
    _words: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"bias": self.bias, "weights": self.weights, "_words": {}}

    def score(self, text: str | None) -> float:
        """Probability-like score between 0 and 1; null and empty texts get the bias alone."""
        counts: dict[int, int] = {}
        cache, weights = self._words, self.weights
        for word, n in Counter((text or "").split()).items():
            own = cache.get(word)
            if own is None:
                own = tuple(b for b in buckets(normal(word)) if b in weights)
                if len(cache) >= CACHED_WORDS:
                    cache.clear()
                cache[word] = own
            for bucket in own:
                counts[bucket] = counts.get(bucket, 0) + n
        total = self.bias + sum(weights[b] * math.log1p(counts[b]) for b in sorted(counts))
        return 1 / (1 + math.exp(-min(max(total, -40.0), 40.0)))


@dataclass
class Sparse:
    """Rows of (column, value) pairs, stored one after the other."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    rows: int
    columns: int

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * weights[self.column], self.rows)

    def transposed_dot(self, residual: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.value * residual[self.row], self.columns)


def fit(
    x: Sparse, labels: np.ndarray, weight: np.ndarray, swaps: Sparse, l1: float, counterfactual: float, steps: int = 200
) -> tuple[np.ndarray, float]:
    """Weights and bias by proximal gradient steps with a step size per feature."""
    prior = (float((weight * labels).sum()) + 0.1) / (float(weight.sum()) + 2)
    weights, bias = np.zeros(x.columns), math.log(prior / (1 - prior))
    if labels.min(initial=1) == labels.max(initial=0) or not len(labels):
        return weights, bias
    weight = weight / weight.sum()
    seen = np.full(x.columns, 1e-8)
    for _ in range(steps):
        margin = np.clip(x.dot(weights) + bias, -40, 40)
        residual = (1 / (1 + np.exp(-margin)) - labels) * weight
        gradient = x.transposed_dot(residual)
        if swaps.rows:
            gradient += 2 * counterfactual / swaps.rows * swaps.transposed_dot(swaps.dot(weights))
        seen += gradient * gradient
        step = np.minimum(0.5 / np.sqrt(seen), 50)
        weights = weights - step * gradient
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * l1, 0)
        bias -= 2 * residual.sum()
    return weights, bias


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """Up to ``per_class`` labelled, not held-out documents of each class with their texts, and all counts by class.

    A document with several labels has the largest, one with several texts the smallest. Only ids and labels are
    shuffled; the sample, whose size is bounded, is sent to the texts.
    """
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known.join(docs.select("doc_id"), "doc_id", "left_semi"), "toxic-labels")
    totals = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picks = [known.filter(F.col("toxic") == kind).orderBy(*order).limit(per_class) for kind in (0, 1)]
    picked = F.broadcast(picks[0].unionByName(picks[1]))
    texts = docs.select("doc_id", "text").join(picked, "doc_id")
    return stored(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "toxic-sample"), totals


def _frequencies(batches: Batches) -> Batches:
    """Documents of the batch that hold each bucket, by class."""
    for batch in batches:
        by_class = {0: Counter(), 1: Counter()}
        for text, toxic in zip(texts_of(batch), texts_of(batch, "toxic")):
            by_class[toxic].update(feature_counts((text or "").split()).keys())
        names = sorted(by_class[0].keys() | by_class[1].keys())
        arrays = [pa.array(names, pa.int32()), *(pa.array([by_class[k][b] for b in names], pa.int64()) for k in (0, 1))]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "clean", "toxic"])


def train(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 2000,
    features: int = 8192,
    l1: float = 3e-4,
    counterfactual: float = 1.0,
) -> ToxicityModel:
    """Learn from the labels of ``docs`` that are not held out. Without labels of both classes only a prior is learned."""
    sample, totals = labelled_sample(docs, labels, per_class)
    counted = sample.mapInArrow(_frequencies, "bucket int, clean bigint, toxic bigint")
    counted = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Documents with and without the bucket, observed against expected, in both classes alike.
    size = {k: min(totals.get(k, 0), per_class) or 1 for k in (0, 1)}
    gap = F.abs(F.col("toxic") / size[1] - F.col("clean") / size[0])
    spread = F.sqrt((F.col("toxic") + F.col("clean")) / (size[0] + size[1]))
    ranked = counted.filter("clean + toxic >= 3").orderBy((gap / spread).desc(), "bucket").limit(features)
    identity = {b for term in _TERMS for word in term for b in buckets(word)}
    chosen = sorted({row["bucket"] for row in ranked.select("bucket").collect()} | identity)
    place = {bucket: i for i, bucket in enumerate(chosen)}

    def vector(words: list[str]) -> dict[int, float]:
        return {place[b]: math.log1p(n) for b, n in feature_counts(words).items() if b in place}

    def rows(batches: Batches) -> Batches:
        for batch in batches:
            own, changes = [], []
            for text in texts_of(batch):
                words = (text or "").split()
                before = vector(words)
                own.append(sorted(before.items()))
                others = map(vector, counterfactuals(words))
                differences = [{b: after.get(b, 0) - before.get(b, 0) for b in {*before, *after}} for after in others]
                changes.append([sorted((b, v) for b, v in change.items() if v) for change in differences])
            number, value = pa.list_(pa.int32()), pa.list_(pa.float32())
            new = {
                "xb": pa.array([[b for b, _ in row] for row in own], number),
                "xv": pa.array([[v for _, v in row] for row in own], value),
                "swapb": pa.array([[[b for b, _ in change] for change in row] for row in changes], pa.list_(number)),
                "swapv": pa.array([[[v for _, v in change] for change in row] for row in changes], pa.list_(value)),
            }
            yield with_columns(batch.select(["doc_id", "toxic"]), new)

    kind = dict(sample.dtypes)["doc_id"]
    arrays = "xb array<int>, xv array<float>, swapb array<array<int>>, swapv array<array<float>>"
    vectors = sample.mapInArrow(rows, f"doc_id {kind}, toxic int, {arrays}")
    return _trained(vectors, totals, chosen, l1, counterfactual)


def _trained(vectors: DataFrame, totals: dict, chosen: list[int], l1: float, counterfactual: float) -> ToxicityModel:
    """Fetch the sample's vectors, whose number and length are bounded, and fit."""
    fetched = vectors.toArrow().sort_by("doc_id").combine_chunks()
    labels = fetched["toxic"].to_numpy().astype(float)

    def sparse(name: str, nested: bool) -> Sparse:
        lists, values = (fetched[name + part].combine_chunks() for part in "bv")
        if nested:
            lists, values = lists.flatten(), values.flatten()
        sizes = lists.value_lengths().to_numpy()
        values = values.flatten().to_numpy().astype(float)
        places = np.repeat(np.arange(len(sizes)), sizes)
        return Sparse(places, lists.flatten().to_numpy(), values, len(sizes), len(chosen))

    sampled = {k: max(int((labels == k).sum()), 1) for k in (0, 1)}
    weight = np.array([totals.get(int(k), 0) / sampled[int(k)] for k in labels])
    x, swaps = sparse("x", nested=False), sparse("swap", nested=True)
    weights, bias = fit(x, labels, weight, swaps, l1, counterfactual)
    return ToxicityModel(bias, {chosen[i]: float(weights[i]) for i in np.flatnonzero(weights)})


def score_documents(docs: DataFrame, model: ToxicityModel, score: str = "toxicity") -> DataFrame:
    """``docs`` with a score between 0 and 1 for each row, from its whole text alone.

    Null and empty texts get the score of the bias; equal texts get equal scores; other columns pass through, and a
    column already called ``score`` is replaced. No shuffle.
    """
    wanted = docs.drop(score)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield with_columns(batch, {score: pa.array([model.score(x) for x in texts_of(batch)], pa.float64())})

    return wanted.mapInArrow(run, StructType([*wanted.schema.fields, *StructType.fromDDL(f"`{score}` double").fields]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns.

    Null and empty texts score as the bias says, so they go together; equal texts stay or go together; without labels of both
    classes the score is their prior for every text; an empty table stays empty; other columns pass through.
    """
    model = train(docs, labels)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.filter(pa.array([model.score(x) < threshold for x in texts_of(batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: whether it is held out, its score, and the prediction at the threshold.

    Null and empty texts score as the bias says; a null id counts as the empty text and is not learned from; repeated rows are
    judged alike; of several labels of a document the largest counts; other columns are not looked at; an empty table gives
    an empty one.
    """
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels), "score")
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
