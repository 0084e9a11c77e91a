"""Quality classifier without labels: heuristic voters, their accuracies by expectation-maximisation, a hashed scorer.

Eight heuristics vote good, bad or nothing on each document. Votes and features come from one pass over the texts and are
stored. All documents' vote patterns are counted (at most 3 ** 8 of them), and EM over the counts estimates how often each heuristic votes what on good and on bad documents. The posterior
of a pattern labels its documents. A hashed linear model on word shapes learns these soft labels from a bounded sample
(``sample`` documents, a parameter: the lowest hashes of their ids) and scores every document over its whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from itertools import groupby, islice
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import Batches, stored, texts_of, with_columns
from headway.llm.toxicity import Sparse, fit

SAMPLE = 4000
SPACE = 1 << 14
THRESHOLD = 0.5
TOLERANCE = 1e-9  # EM ends when no posterior changes by more
MOST_ROUNDS = 2000
VOTES = "gb-"
SYMBOLS = "#*$%&|<>!"
CACHED_WORDS = 500_000

# What a heuristic measures, and from where on its value is good or bad: (name, good up to, bad from).
LIMITS = (
    ("symbols per word", 0.05, 0.15),
    ("words that are not letters only", 0.45, 0.75),
    ("capital letters in a word", 1.2, 2.0),
    ("words equal to the one before", 0.02, 0.10),
    ("words seen before in the text", 0.75, 0.90),
    ("share of the most frequent word", 0.09, 0.15),
    ("lines seen before in the text", 0.10, 0.35),
    ("distance of the mean word length from 6", 3.0, 6.0),
)
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]+")


def measures(text: str | None) -> list[float] | None:
    """The value of each heuristic; None for texts without a word."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return None
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        sum(map(text.count, SYMBOLS)) / n,
        1 - sum(map(str.isalpha, words)) / n,
        sum(map(len, _CAPITAL.findall(text))) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(counts) / n,
        max(counts.values()) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        abs(sum(map(len, words)) / n - 6),
    ]


def votes(text: str | None) -> str:
    """One letter a heuristic: ``g`` good, ``b`` bad, ``-`` nothing. Texts without a word get no vote."""
    values = measures(text)
    if values is None:
        return "-" * len(LIMITS)
    return "".join("g" if v <= good else "b" if v >= bad else "-" for v, (_, good, bad) in zip(values, LIMITS))


def estimate(patterns: dict[str, int], tolerance: float = TOLERANCE) -> tuple[dict[str, float], np.ndarray]:
    """Posterior of good for each pattern, and P(vote | class) of each heuristic as [class, heuristic, vote].

    EM begins with the balance of the votes, which fixes which class is the good one, and goes on until no posterior
    changes by more than ``tolerance``. Each round raises the likelihood; if it still changes after ``MOST_ROUNDS`` rounds,
    the last one stands.
    """
    names = sorted(patterns)
    weight = np.array([patterns[name] for name in names], float)
    seen = np.array([[[c == vote for vote in VOTES] for c in name] for name in names], float).reshape(len(names), len(LIMITS), 3)
    balance = np.array([name.count("g") - 2 * name.count("b") for name in names], float)
    good = 1 / (1 + np.exp(-balance))
    tables = np.full((2, len(LIMITS), 3), 1 / 3)
    for _ in range(MOST_ROUNDS if names else 0):
        mass = np.stack([(1 - good) * weight, good * weight])
        tables = np.einsum("cp,phv->chv", mass, seen) + 1.0
        tables /= tables.sum(axis=2, keepdims=True)
        prior = (mass.sum(axis=1) + 1) / (weight.sum() + 2)
        log = np.einsum("phv,chv->cp", seen, np.log(tables)) + np.log(prior)[:, None]
        before, good = good, 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(good - before).max() <= tolerance:
            break
    return dict(zip(names, good.tolist())), tables


def _lower(word: str) -> bool:
    """Whether a word is letters only, none of them a capital: its shape is one run."""
    return word.isalpha() and word.islower()


def shape(word: str) -> str:
    """Letters as a or A, digits as 0, runs of one kind once, other characters as they are; the first 12 characters of that."""
    if _lower(word):
        return "a"
    if word[:1].isupper() and _lower(word[1:]):
        return "Aa"
    kinds = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return "".join(islice((kind for kind, _ in groupby(kinds)), 12))


def _bucket(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) % SPACE


class Shapes:
    """Features of a text: how often each word shape and ending occurs, and how much repeats, as shares of the words."""

    def __init__(self):
        self.cache: dict[str, tuple[int, int]] = {}
        self.buckets = lru_cache(maxsize=1 << 16)(lambda kind: (_bucket("shape " + kind), _bucket("end " + kind[-2:])))
        self.same, self.again = _bucket("=before"), _bucket("=seen")

    def __call__(self, text: str | None) -> dict[int, float]:
        words = (text or "").split()
        if not words:
            return {}
        counts: dict[int, float] = {}
        distinct = Counter(words)
        for word, n in distinct.items():
            own = self.cache.get(word)
            if own is None:
                if len(self.cache) >= CACHED_WORDS:
                    self.cache.clear()
                own = self.cache[word] = self.buckets(shape(word))
            for bucket in own:
                counts[bucket] = counts.get(bucket, 0) + n
        counts[self.same] = sum(map(eq, words, words[1:]))
        counts[self.again] = len(words) - len(distinct)
        return {bucket: math.sqrt(n / len(words)) for bucket, n in counts.items() if n}


FEATURES = "votes string, b array<int>, v array<float>"


def with_features(docs: DataFrame) -> DataFrame:
    """(doc_id, votes, b, v) for every row: the votes, and the text's features as buckets and values."""

    def run(batches: Batches) -> Batches:
        shapes = Shapes()
        for batch in batches:
            texts = texts_of(batch)
            vectors = [sorted(shapes(text).items()) for text in texts]
            new = {
                "votes": pa.array(map(votes, texts), pa.string()),
                "b": pa.array([[b for b, _ in v] for v in vectors], pa.list_(pa.int32())),
                "v": pa.array([[x for _, x in v] for v in vectors], pa.list_(pa.float32())),
            }
            yield with_columns(batch.select(["doc_id"]), new)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {FEATURES}")


def train(features: DataFrame, posterior: dict[str, float], sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Weights of all buckets and the bias of the scorer, from the soft labels of a bounded sample of documents.

    A document with several texts counts once, with the smallest of their votes and features; rows without an id are not
    drawn.
    """
    ids = features.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    picked = F.broadcast(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    drawn = features.join(picked, "doc_id").groupBy("doc_id").agg(F.min(F.struct("votes", "b", "v")).alias("x"))
    rows = drawn.select("doc_id", "x.*").toArrow().sort_by("doc_id").combine_chunks()
    lists = {name: rows[name].combine_chunks() for name in ("b", "v")}
    places = np.repeat(np.arange(len(rows)), lists["b"].value_lengths().to_numpy())
    labels = np.array([posterior.get(x, 0.5) for x in rows["votes"].to_pylist()], float)
    values = lists["v"].flatten().to_numpy().astype(float)
    x = Sparse(places, lists["b"].flatten().to_numpy(), values, len(rows), SPACE)
    none = Sparse(*(np.zeros(0, int),) * 2, np.zeros(0), 0, SPACE)
    return fit(x, labels, np.ones(len(rows)), none, l1=1e-4, counterfactual=0.0)


def judge(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, votes, posterior, score, kept) for every row of ``docs``.

    Texts that are null, empty or blank have no votes and score as the bias alone says; repeated rows are judged alike;
    an empty table gives an empty one; other columns are not looked at. Kept is what scores at least ``threshold``.
    """
    features = stored(with_features(docs), "weak-features")
    counted = features.groupBy("votes").count()
    posterior, _ = estimate({row["votes"]: row["count"] for row in counted.collect()})
    weights, bias = train(features, posterior, sample)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            own = texts_of(batch, "votes")
            lists = batch.column(2)
            ends = np.concatenate([[0.0], np.cumsum(weights[lists.flatten().to_numpy()] * batch.column(3).flatten().to_numpy())])
            offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            margins = np.clip(bias + ends[offsets[1:]] - ends[offsets[:-1]], -40, 40)
            scores = 1 / (1 + np.exp(-margins))
            new = {
                "votes": pa.array(own, pa.string()),
                "posterior": pa.array([posterior.get(x, 0.5) for x in own], pa.float64()),
                "score": pa.array(scores, pa.float64()),
                "kept": pa.array(scores >= threshold, pa.bool_()),
            }
            yield with_columns(batch.select(["doc_id"]), new)

    kind = dict(docs.dtypes)["doc_id"]
    return features.mapInArrow(run, f"doc_id {kind}, votes string, posterior double, score double, kept boolean")
