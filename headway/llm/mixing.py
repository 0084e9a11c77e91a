"""Mixing sources to target weights by Poisson replication.

Each listed source has a target share of the result, the other sources share the rest by size. A source's mean repetition
is its share of the budget over its size, both in code points of text. A document's number of copies inverts the
cumulative Poisson distribution with that mean at a number hashed from the seed and its id. The copies are put into one
global order by another hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import row_key, unused

SEED = 20_240_601
DIGITS = 13  # hexadecimal digits of the hash: numbers below 2 ** 52
RANGE = 1 << 4 * DIGITS
TAIL = 12  # standard deviations below the mean beyond which no number below ``RANGE`` falls


def poisson_thresholds(mean: float) -> tuple[int, list[int]]:
    """Events that are certain, and cumulative probabilities of that many, one more, ... times ``RANGE``.

    The list ends where all of ``RANGE`` is reached. Its length follows the square root of the mean: what lies further
    below the mean has a probability of less than one in ``RANGE``.
    """
    if mean < 0 or not math.isfinite(mean):
        raise ValueError(f"no Poisson mean: {mean}")
    if mean == 0:
        return 0, [RANGE]
    certain = max(0, math.floor(mean - TAIL * math.sqrt(mean)))
    total, thresholds, k = 0.0, [], certain
    while (term := math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))) * RANGE >= 1 or k <= mean:
        total += term
        thresholds.append(min(RANGE, math.floor(total * RANGE)))
        k += 1
    thresholds.append(RANGE)
    return certain, thresholds[: thresholds.index(RANGE) + 1]


def mean_repetitions(
    docs: DataFrame, targets: dict[str, float], budget: float | None = None, text: str = "text", source: str = "source"
) -> tuple[dict[str, float], float]:
    """Mean copies of each listed source, and of all others. One row for each listed source reaches the driver.

    A source without text, which no number of copies can bring to a share, is repeated once on average.
    """
    if any(w < 0 for w in targets.values()) or sum(targets.values()) > 1 + 1e-9:
        raise ValueError("target weights must not be negative, nor sum to more than one")
    listed = F.when(F.col(source).isin(*targets), F.col(source)) if targets else F.lit(None).cast("string")
    sizes = docs.groupBy(listed.alias("name")).agg(F.sum(F.length(text)).alias("size"))
    found = {row["name"]: row["size"] or 0 for row in sizes.collect()}
    whole = sum(found.values()) if budget is None else budget
    rest = max(0.0, 1 - sum(targets.values()))
    share = {**targets, None: rest}
    means = {name: share[name] * whole / found[name] if found.get(name) else 1.0 for name in share}
    return {name: means[name] for name in targets}, means[None]


def _hash(seed: int, *parts: str | Column) -> Column:
    texts = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))


def copies(docs: DataFrame, means: dict[str, float], other: float, seed: int = SEED, source: str = "source") -> Column:
    """Number of copies of each row: how many cumulative probabilities its hashed number has reached."""
    certain, reached = map(list, zip(*(poisson_thresholds(mean) for mean in (other, *means.values()))))

    def of_source(values: list[Column]) -> Column:
        chosen = values[0]
        for name, value in zip(means, values[1:]):
            chosen = F.when(F.col(source) == name, value).otherwise(chosen)
        return chosen

    thresholds = of_source([F.from_json(F.lit(str(t)), "array<bigint>") for t in reached])
    number = F.conv(F.substring(_hash(seed, "doc_id"), 1, DIGITS), 16, 10).cast("bigint")
    return of_source([F.lit(n) for n in certain]) + F.size(F.filter(thresholds, lambda t: t <= number))


def mix(
    docs: DataFrame, targets: dict[str, float], budget: float | None = None, seed: int = SEED, extra: bool = False
) -> DataFrame:
    """The copies of all rows in a global order that depends on the seed alone.

    ``extra`` adds ``copy`` (from 1) and ``mix_key``, by which the result is sorted; where a column has that name
    already, the added one gets an underscore. Rows with one id get one number of
    copies each; a null id counts as the empty text; a null source is one of the others; null texts have no size and are
    copied like any other row; an empty table gives an empty one. All columns pass through.
    """
    means, other = mean_repetitions(docs, targets, budget)
    count = copies(docs, means, other, seed)
    copy, key = unused(docs, "copy", "mix_key")
    number = F.explode(F.when(count > 0, F.sequence(F.lit(1), count)))
    copied = docs.select(*[F.col(f"`{name}`") for name in docs.columns], number.alias(copy))
    keyed = copied.withColumn(key, _hash(seed + 1, "doc_id", copy))
    # Rows of one id differ in the last key only.
    ordered = keyed.orderBy(key, "doc_id", copy, row_key(docs))
    return ordered if extra else ordered.drop(copy, key)


def digest_columns(docs: DataFrame, targets: dict[str, float]) -> DataFrame:
    mixed = mix(docs.select("doc_id", "source", "text"), targets, extra=True)
    return mixed.select("doc_id", "source", "copy", "mix_key", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))
