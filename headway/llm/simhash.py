"""Near-duplicates by SimHash: fingerprints within a few bits of each other are linked, links form groups.

Candidate search is a generalised pigeonhole. Correlated bits are grouped into partitions; partition i gets a threshold
t_i (-1: not probed) with ``sum(t_i + 1) = distance + 1``, so that two fingerprints within ``distance`` bits differ in at
most t_i bits of some partition i. The thresholds come from a dynamic programme over estimated probes and candidates;
the estimates rest on the joint bit frequencies of all fingerprints. A probe looks up the partition's bits with up to t_i
of them flipped, and candidates are verified on all 64 bits.

A bucket with more than ``BUCKET`` fingerprints is not paired out. What probes it is linked over shared neighbours: two
fingerprints lie within ``distance`` bits exactly if some value lies within half of that of both, and all that meet at one
value are linked to one of them. That is exact too and grows with the fingerprints, not with their pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import Batches, row_key, stored, texts_of, unused, with_columns
from headway.llm.components import connected_components

BITS = 64
SHINGLE = 3
DISTANCE = 2
SEED = 42
BUCKET = 128
PARTITION_COUNTS = range(1, 9)
HASHES_AT_ONCE = 1 << 16


# --- Fingerprints


def fingerprint(text: str | None, length: int = SHINGLE) -> int:
    """Bit-wise majority over the hashes of all word shingles; zero for texts without a word."""
    # On bytes, lower() and split() know ASCII letters and the six ASCII blanks only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = [b" ".join(words)] if len(words) < length else map(b" ".join, zip(*(words[i:] for i in range(length))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), "<u8")
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        part = hashes[start : start + HASHES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, length: int = SHINGLE, text: str = "text") -> DataFrame:
    """(doc_id, row, row2, fp): the fingerprint as a signed 64-bit number, and two hashes of the whole row."""
    narrow = docs.select("doc_id", row_key(docs).alias("row"), row_key(docs, 1).alias("row2"), F.col(text).alias("text"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = np.fromiter((fingerprint(x, length) for x in texts_of(batch)), "<u8", batch.num_rows)
            yield with_columns(batch.select(["doc_id", "row", "row2"]), {"fp": pa.array(found.view("<i8"))})

    return narrow.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, row bigint, row2 bigint, fp bigint")


# --- Partitions and thresholds


@dataclass
class Plan:
    """Bit masks of the probed partitions and the threshold of each."""

    masks: list[int]
    thresholds: list[int]
    cost: float = math.inf


def joint_counts(fingerprints: DataFrame) -> np.ndarray:
    """How often bits i and j are set together, over all fingerprints: 64 x 64 sums are all that reaches the driver."""

    def run(batches: Batches) -> Batches:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            total += bits.T @ bits
        i, j = np.indices((BITS, BITS))
        arrays = [pa.array(x.ravel(), kind) for x, kind in ((i, pa.int32()), (j, pa.int32()), (total.astype(np.int64), pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "n"])

    sums = fingerprints.select("fp").mapInArrow(run, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n"))
    counts = np.zeros((BITS, BITS))
    for row in sums.collect():
        counts[row["i"], row["j"]] = row["n"]
    return counts


def _groups(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of equal size; each group grows by the bit most correlated with it."""
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        first = max(sorted(left), key=lambda b: correlation[b, sorted(left)].sum())
        group = [first]
        left.remove(first)
        while len(group) < size:
            bit = max(sorted(left), key=lambda b: correlation[b, group].max())
            group.append(bit)
            left.remove(bit)
        groups.append(group)
    return groups


def _differing(group: list[int], agree: np.ndarray, most: int) -> list[float]:
    """Estimated probabilities that two fingerprints differ in exactly 0..most bits of the group.

    The bits form a chain in which agreement depends on the bit before.
    """
    ways = np.zeros((2, most + 1))
    a = agree[group[0], group[0]]
    ways[1, 0] = a
    if most:
        ways[0, 1] = 1 - a
    for before, bit in zip(group, group[1:]):
        a, b, both = agree[before, before], agree[bit, bit], agree[before, bit]
        stay = (min(1, both / a) if a else 0.0, min(1, max(0.0, (b - both) / (1 - a))) if a < 1 else 0.0)
        ways_next = np.zeros_like(ways)
        ways_next[1] = ways[1] * stay[0] + ways[0] * stay[1]
        ways_next[0, 1:] = (ways[1] * (1 - stay[0]) + ways[0] * (1 - stay[1]))[:-1]
        ways = ways_next
    return ways.sum(axis=0).tolist()


def make_plan(counts: np.ndarray, number: int, distance: int) -> Plan:
    """The cheapest partitions and thresholds, in rows shuffled for probes plus candidates to verify."""
    p = counts / max(number, 1)
    ones = np.diag(p)
    cells = p, ones[:, None] - p, ones[None, :] - p, 1 - ones[:, None] - ones[None, :] + p
    agree = sum(cell * cell for cell in cells)
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-12))
    correlation = np.abs(p - np.outer(ones, ones)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 0)
    best = Plan([], [])
    for parts in PARTITION_COUNTS:
        groups = _groups(correlation, parts)
        # chosen[u]: the least cost with u of distance + 1 units handed out, and the thresholds so far.
        chosen: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            differing = _differing(group, agree, distance)
            options = {0: 0.0}
            for t in range(min(distance, len(group)) + 1):
                probes = 1 + sum(math.comb(len(group), k) for k in range(t + 1))
                options[t + 1] = number * probes + number * number / 2 * sum(differing[: t + 1])
            following: dict[int, tuple[float, list[int]]] = {}
            for used, (cost, taken) in chosen.items():
                for units, price in options.items():
                    total = used + units
                    if total <= distance + 1 and cost + price < following.get(total, (math.inf,))[0]:
                        following[total] = (cost + price, [*taken, units - 1])
            chosen = following
        cost, thresholds = chosen.get(distance + 1, (math.inf, []))
        if cost < best.cost:
            probed = [(sum(1 << b for b in group), t) for group, t in zip(groups, thresholds) if t >= 0]
            best = Plan([mask for mask, _ in probed], [t for _, t in probed], cost)
    return best


# --- Links


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _flips(mask: int, most: int) -> list[int]:
    """All values with up to ``most`` of the mask's bits set."""
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    return [_signed(sum(chosen)) for k in range(most + 1) for chosen in combinations(bits, k)]


def _near(values: list[int]) -> Column:
    """``fp`` with each of the values flipped; the values are one constant, not a plan node each."""
    constant = F.from_json(F.lit(f"[{','.join(map(str, values))}]"), "array<bigint>")
    return F.transform(constant, lambda flip: F.col("fp").bitwiseXOR(flip))


def _keys(fingerprints: DataFrame, plan: Plan, flipped: bool) -> DataFrame:
    """(part, key, fp): the bits of each partition, as they are or with every allowed flip."""
    frames = []
    for part, (mask, t) in enumerate(zip(plan.masks, plan.thresholds)):
        near = _near(_flips(mask, t if flipped else 0))
        keyed = fingerprints.select("fp", F.explode(near).alias("near"))
        key = F.col("near").bitwiseAND(F.lit(_signed(mask)))
        frames.append(keyed.select(F.lit(part).alias("part"), key.alias("key"), "fp"))
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def _links_over_neighbours(fingerprints: DataFrame, distance: int) -> DataFrame:
    """Exact links without pairs: at each value, all within half the distance are linked to the smallest of them.

    For an odd distance the further half must meet one of the nearer half, which is the head then.
    """
    inner, outer = distance // 2, distance - distance // 2
    every = (1 << BITS) - 1
    near = set(_flips(every, inner))
    flips = _flips(every, outer)
    marked = fingerprints.select("fp", F.posexplode(_near(flips)).alias("place", "value"))
    count = len(near)  # values with fewer flips come first
    head = F.min(F.when(F.col("place") < count, F.col("fp")))
    members = marked.groupBy("value").agg(head.alias("head"), F.collect_set("fp").alias("members"))
    # At most one member for each flip: the set is as bounded as the list of flips.
    linked = members.filter("head IS NOT NULL AND size(members) > 1")
    pairs = linked.select(F.col("head").alias("a"), F.explode("members").alias("b"))
    return pairs.filter("a != b").distinct()


def links(fingerprints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (a, b) whose connected components are those of all pairs within ``distance`` bits.

    ``fingerprints`` has one distinct ``fp`` a row. Pairs in buckets of ordinary size are all listed.
    """
    number = fingerprints.count()
    plan = make_plan(joint_counts(fingerprints), number, distance)
    data = _keys(fingerprints, plan, flipped=False)
    full = data.groupBy("part", "key").count().filter(F.col("count") > BUCKET).select("part", "key")
    full = stored(full, "full-buckets")
    probes = _keys(fingerprints, plan, flipped=True)
    thin = stored(data.join(full, ["part", "key"], "left_anti"), "thin-buckets")
    a, b = thin.withColumnRenamed("fp", "a"), probes.withColumnRenamed("fp", "b")
    joined = a.join(b, (a.part == b.part) & (a.key == b.key) & (a.a < b.b) & (F.bit_count(a.a.bitwiseXOR(b.b)) <= distance))
    crowded = probes.join(full, ["part", "key"], "left_semi").select("fp").distinct()
    return joined.select("a", "b").unionByName(_links_over_neighbours(crowded, distance))


def groups(fingerprinted: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root) for every distinct fingerprint of a stored table; the root is the smallest fingerprint of the group."""
    distinct = stored(fingerprinted.select("fp").distinct(), "fingerprints")
    roots = connected_components(links(distinct, distance))
    named = distinct.join(roots, distinct.fp == roots.node, "left")
    return named.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, length: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) for every row: the group is named by its smallest ``doc_id``.

    Texts that are null, empty or blank have fingerprint zero and are linked like any other. Rows may repeat. A group of
    rows without ids has a null name. An empty table gives an empty one; other columns are not read into the result.
    """
    rows = stored(with_fingerprints(docs, length), "simhash")
    rooted = groups(rows, distance)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    of_fp = stored(rooted.join(least, "fp"), "simhash-groups")
    names = of_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    named = of_fp.select("fp", "root").join(names, "root").select("fp", "component_id")
    return rows.select("doc_id", "fp").join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, length: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group, with all columns: the smallest ``doc_id`` (rows without one last), then the row's hash.

    Of rows equal in every column one stays. Texts that are null, empty or blank are one group, as they share a fingerprint;
    an empty table stays empty; other columns pass through, whatever their names.
    """
    rows = stored(with_fingerprints(docs, length), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row", "row2")
    least = rows.groupBy("fp").agg(F.min(order).alias("least"))
    rooted = stored(groups(rows, distance).join(least, "fp"), "simhash-groups")
    kept = rooted.groupBy("root").agg(F.min("least").alias("least"))
    keys = unused(docs, "_row", "_row2")
    kept = kept.select(F.col("least.row").alias(keys[0]), F.col("least.row2").alias(keys[1]))
    keyed = docs.withColumns({keys[0]: row_key(docs), keys[1]: row_key(docs, 1)})
    # Repeated rows share both hashes. They go before the join, each task's own before the shuffle, and the join finds its
    # rows dealt out by these hashes already.
    return keyed.dropDuplicates(keys).join(kept, keys, "left_semi").drop(*keys)


def digest_columns(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row, as ``near_duplicates`` defines them; fingerprints as 16 hex digits."""
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
