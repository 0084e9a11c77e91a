"""Exact top-k inner products by an impact-ordered index, processed score at a time.

Vectors become integers, ``floor(1024 x)``. The index is cut into blocks of at most ``BLOCK`` vectors. A block holds postings
(vector, weight) by impact, the quantised ``|weight|``: its levels are gathered into about ``SEGMENTS`` segments of equal
length, each ordered by dimension, and for each vector and segment the norm of what comes after. It is written once.

A batch of queries adds up a block's segments by descending impact. After each one the unprocessed rest of a score is bounded
by the norm of the query times the vector's remaining norm (Cauchy-Schwarz). Every query brings a threshold that it has proven
elsewhere: the k-th best score in one block that all queries meet first. Once few enough vectors of the block can still reach
the thresholds, the remaining postings are skipped and these vectors are scored exactly. Each block gives its k best, and a
window over the blocks the k best of all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import Batches, stored

SCALE = 1024
K = 10
QUERY_STEP = 100
BLOCK = 16384  # places in a block fit 16 bits
QUERIES = 16384
LEVELS = 256
SEGMENTS = 16
AT_ONCE = 128
POSSIBLE_SHARE = 1 / 16  # score exactly as soon as no larger share of the vectors is possible
EXACT = 2**53
MOST = 2**63 - 1


def integer_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the usable vectors of a list column, and their components as integers in float64.

    A vector is of no use if it is null or holds a null or a number that is not finite, be it only when scaled.
    """
    places, vectors = [], []
    values = column.values.cast(pa.float64())
    flat = values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(flat * SCALE)
    good = np.isfinite(whole)
    if values.null_count:
        good &= values.is_valid().to_numpy(zero_copy_only=False)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        part = slice(offsets[i], offsets[i + 1])
        if valid[i] and good[part].all():
            places.append(i)
            vectors.append(whole[part])
    return np.array(places, np.int64), vectors


# --- Weights as bytes, in the narrowest type that holds them

_KINDS = {"<i2": 2**15, "<i4": 2**31}


def to_bytes(weights: np.ndarray) -> tuple[str, bytes]:
    largest = float(np.abs(weights).max(initial=0))
    kind = next((kind for kind, bound in _KINDS.items() if largest < bound), "<f8")
    return kind, weights.astype(kind).tobytes()


def from_bytes(kind: str, data: bytes) -> np.ndarray:
    return np.frombuffer(data, kind).astype(np.float64)


# --- The index

BLOCK_SCHEMA = (
    "ids binary, width int, kind string, weights binary, places binary, starts binary, rests binary, size int"
)
_BLOCK_TYPES = dict(
    ids=pa.binary(), width=pa.int32(), kind=pa.string(), weights=pa.binary(), places=pa.binary(), starts=pa.binary(),
    rests=pa.binary(), size=pa.int32(),
)


def block_row(ids: list[int], vectors: list[np.ndarray]) -> dict:
    """The postings of some vectors; shorter ones count as padded with zeros."""
    width = max(map(len, vectors))
    matrix = padded(vectors, width)
    rows, columns = np.nonzero(matrix)
    weights = matrix[rows, columns]
    top = float(np.abs(weights).max(initial=0))
    level = np.minimum((np.abs(weights) / top * LEVELS).astype(np.int64), LEVELS - 1) if top else np.zeros(0, np.int64)
    # Levels by descending impact, as many to a segment as make up its share of the postings.
    before = np.cumsum(np.bincount(LEVELS - 1 - level, minlength=LEVELS)) - np.bincount(LEVELS - 1 - level, minlength=LEVELS)
    segment = (before * SEGMENTS // max(len(weights), 1))[LEVELS - 1 - level]
    segment = np.unique(segment, return_inverse=True)[1]
    count = int(segment.max(initial=-1)) + 1
    order = np.lexsort((rows, columns, segment))
    rows, columns, weights, segment = rows[order], columns[order], weights[order], segment[order]
    starts = np.searchsorted(segment * width + columns, np.arange(count * width + 1))
    squares = np.zeros((count, len(ids)))
    with np.errstate(over="ignore"):
        np.add.at(squares, (segment, rows), weights * weights)
        rests = np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1]) * (1 + 1e-6)
    rests = np.vstack([rests[1:], np.zeros((1, len(ids)))])[:count]
    kind, data = to_bytes(weights)
    # 32 bits, rounded up: the bound must not become smaller.
    narrow = np.nextafter(np.minimum(rests, np.finfo(np.float32).max).astype("<f4"), np.float32(np.inf)) * (rests > 0)
    return dict(
        ids=np.array(ids, "<i8").tobytes(), width=width, kind=kind, weights=data, places=rows.astype("<u2").tobytes(),
        starts=starts.astype("<i4").tobytes(), rests=narrow.astype("<f4").tobytes(), size=len(ids),
    )


def padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    matrix = np.zeros((len(vectors), width))
    for i, vector in enumerate(vectors):
        matrix[i, : len(vector)] = vector
    return matrix


def gathered(batches: Batches, size: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Usable vectors with an id, up to ``size`` at a time, from batches of (id, vector)."""
    ids: list[int] = []
    vectors: list[np.ndarray] = []
    for batch in batches:
        places, found = integer_vectors(batch.column(1))
        names = batch.column(0).to_pylist()
        for place, vector in zip(places.tolist(), found):
            if names[place] is not None:
                ids.append(names[place])
                vectors.append(vector)
        while len(ids) >= size:
            yield ids[:size], vectors[:size]
            ids, vectors = ids[size:], vectors[size:]
    if ids:
        yield ids, vectors


def _one_row(row: dict, types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([row[name]], kind) for name, kind in types.items()], names=list(types))


def index_blocks(vectors: DataFrame) -> DataFrame:
    """The index: one row a block, see ``BLOCK_SCHEMA``."""

    def run(batches: Batches) -> Batches:
        for ids, found in gathered(batches, BLOCK):
            yield _one_row(block_row(ids, found), _BLOCK_TYPES)

    blocks = vectors.select("vec_id", "embedding").mapInArrow(run, BLOCK_SCHEMA)
    return blocks.withColumn("block", F.monotonically_increasing_id())


TILE_SCHEMA = "q_ids binary, q_width int, q_kind string, q_data binary, q_floor binary"


def query_tiles(queries: DataFrame) -> DataFrame:
    """Up to ``QUERIES`` queries a row, with no threshold yet."""
    types = dict(q_ids=pa.binary(), q_width=pa.int32(), q_kind=pa.string(), q_data=pa.binary(), q_floor=pa.binary())

    def run(batches: Batches) -> Batches:
        for ids, found in gathered(batches, QUERIES):
            width = max(map(len, found))
            kind, data = to_bytes(padded(found, width))
            row = dict(q_ids=np.array(ids, "<i8").tobytes(), q_width=width, q_kind=kind, q_data=data)
            yield _one_row(row | {"q_floor": np.full(len(ids), -np.inf, "<f8").tobytes()}, types)

    tiles = queries.select("vec_id", "embedding").mapInArrow(run, TILE_SCHEMA)
    return tiles.withColumn("tile", F.monotonically_increasing_id())


# --- A batch of queries on a block


@dataclass
class Block:
    """A stored block, ready to be searched."""

    ids: np.ndarray
    width: int
    weights: np.ndarray
    places: np.ndarray
    starts: np.ndarray
    rests: np.ndarray
    processed: int = 0  # postings that were added up, and all that searches met
    met: int = 0

    @classmethod
    def of(cls, row: dict) -> Block:
        ids = np.frombuffer(row["ids"], "<i8")
        weights, places = from_bytes(row["kind"], row["weights"]), np.frombuffer(row["places"], "<u2")
        rests = np.frombuffer(row["rests"], "<f4").astype(np.float64).reshape(-1, len(ids))
        return cls(ids, row["width"], weights, places, np.frombuffer(row["starts"], "<i4"), rests)

    def vectors(self) -> np.ndarray:
        matrix = np.zeros((len(self.ids), self.width))
        if self.width:
            columns = np.repeat(np.arange(len(self.starts) - 1) % self.width, np.diff(self.starts))
            matrix[self.places, columns] = self.weights
        return matrix

    def best(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query: places of its k best vectors that may be among the k best of all, and their exact scores."""
        vectors = self.vectors()
        possible = self._possible(queries, own, floor, k)
        return [self._exact(vectors, query, np.flatnonzero(possible[:, i]), k) for i, query in enumerate(queries)]

    def _possible(self, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> np.ndarray:
        """[vector, query]: which vectors may be a member, after as few segments as prove that there are few.

        Sums are in 32 bits, which only widens the bounds: their rounding stays far below a hundred-thousandth of the
        largest product for each thousand dimensions.
        """
        n, wide = len(self.ids), min(self.width, queries.shape[1])
        others = self.ids[:, None] != own[None, :]
        with np.errstate(over="ignore", invalid="ignore"):
            norms = np.sqrt((queries * queries).sum(axis=1))
            largest = float(norms.max(initial=0)) * float(self.rests.max(initial=0) + np.abs(self.weights).max(initial=0))
        if not largest < 1e30 or not np.abs(self.weights).max(initial=0) < 1e30:
            return others  # beyond what such sums can bound
        rounding = np.float32(largest * 1e-5 * (1 + wide // 1024))
        scores = np.zeros((n, len(queries)), np.float32)
        weights, columns, norms = self.weights.astype(np.float32)[:, None], queries.T.astype(np.float32), norms.astype(np.float32) * np.float32(1 + 1e-6)
        rests = self.rests.astype(np.float32) * np.float32(1 + 1e-6)
        # A threshold rounded down loses no member.
        least = np.nextafter(np.maximum(floor, -3e38).astype(np.float32), np.float32(-np.inf))
        possible = others
        self.met += len(self.weights)
        for number, rest in enumerate(rests):
            for d in range(wide):
                part = slice(*self.starts[number * self.width + d : number * self.width + d + 2])
                scores[self.places[part]] += weights[part] * columns[d]
                self.processed += part.stop - part.start
            if number + 1 < len(rests) // 4:
                continue  # proves nothing yet
            slack = np.outer(rest, norms) + rounding
            proven = least
            if n > k and not np.isfinite(floor).all():  # the block has to prove a threshold by itself
                lower = np.where(others, scores - slack, np.float32(-np.inf))
                proven = np.maximum(least, np.partition(lower, n - k, axis=0)[n - k])
            possible = others & (scores + slack >= proven)
            if possible.sum() <= POSSIBLE_SHARE * possible.size:
                break
        return possible

    def _exact(self, vectors: np.ndarray, query: np.ndarray, members: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        wide = min(self.width, len(query))
        chosen, query = vectors[members, :wide], query[:wide]
        bound = float(np.abs(query).max(initial=0)) * float(np.abs(chosen).max(initial=0)) * max(wide, 1)
        if bound < EXACT:
            exact = (chosen @ query).astype(np.int64)
        else:  # beyond double precision: whole numbers of any length, held to the range of a long
            numbers = [sum(int(a) * int(b) for a, b in zip(v, query)) for v in chosen]
            exact = np.array([min(max(x, -MOST - 1), MOST) for x in numbers], np.int64)
        if len(members) > k:
            least = np.partition(exact, len(exact) - k)[len(exact) - k]
            members, exact = members[exact >= least], exact[exact >= least]
        order = np.lexsort((self.ids[members], ~exact))[:k]
        return members[order], exact[order]


def _answers(row: dict, k: int) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], Block]]:
    """Some queries of a tile at a time, with what the block has for them."""
    block = Block.of(row)
    own, floor = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_floor"], "<f8")
    queries = from_bytes(row["q_kind"], row["q_data"]).reshape(len(own), row["q_width"])
    for start in range(0, len(own), AT_ONCE):
        part = slice(start, start + AT_ONCE)
        yield own[part], block.best(queries[part], own[part], floor[part], k), block


def with_thresholds(tiles: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """The tiles, each query with its k-th best score in the largest block: no member of the k best can have less.

    That block is of bounded size and goes to all tiles.
    """
    first = index.orderBy(F.desc("size"), "block").limit(1).drop("block")
    met = tiles.join(F.broadcast(first), F.lit(True), "left")
    columns = [name.split()[0] for name in TILE_SCHEMA.split(", ")]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                floors = []
                for _, found, _ in _answers(row, k) if row["ids"] is not None else ():
                    # One less than the score: sums of doubles may be off by less than that, and ties stay possible.
                    floors += [math.floor(float(s[-1]) * (1 - 1e-12 if s[-1] > 0 else 1 + 1e-12)) - 1 if len(s) == k else -math.inf for _, s in found]
                row["q_floor"] = np.array(floors, "<f8").tobytes() if floors else row["q_floor"]
                types = dict(zip(columns, (pa.binary(), pa.int32(), pa.string(), pa.binary(), pa.binary())))
                yield _one_row(row, types | {"tile": pa.int64()})

    return met.mapInArrow(run, f"{TILE_SCHEMA}, tile bigint")


def top_k(vectors: DataFrame, k: int = K, step: int = QUERY_STEP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each ``vec_id`` divisible by ``step``, its k best among all other vectors.

    Vectors without an id, null ones, and ones with a null or non-finite component (before or after scaling) take no part;
    shorter vectors count as padded with zeros. Rows with one id are candidates each, but never for a query of that id; a
    repeated query row is answered once, by the row of the smallest vector. Equal scores rank by id; scores beyond a long are
    held to its range. An empty table gives an empty one; other columns are not looked at.

    Queries and index both grow with the table. Blocks of the one meet tiles of the other on a key for each pair of places,
    so that every pair is a task's worth of bounded work and no side is broadcast.
    """
    table = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) != math.inf)
    usable = F.col("embedding").isNotNull() & F.forall("embedding", finite)
    asked = table.filter((F.col("vec_id") % step == 0) & usable).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    index = stored(index_blocks(table), "topk-index")
    tiles = stored(with_thresholds(stored(query_tiles(asked), "topk-queries"), index, k), "topk-tiles")
    counts = [max(rows.count(), 1) for rows in (index, tiles)]
    left = _spread(index, "block", "i", counts[0], "q", counts[1])
    right = _spread(tiles, "tile", "q", counts[1], "i", counts[0])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                for own, best, block in _answers(row, k):
                    sizes = [len(places) for places, _ in best]
                    places, scores = (np.concatenate([x[i] for x in best]).astype(np.int64) for i in (0, 1))
                    columns = np.repeat(own, sizes), block.ids[places], scores
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    met = left.join(right.hint("merge"), ["i", "q"]).drop("i", "q", "block", "tile")
    found = met.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"), F.col("n"))
    ranked = found.withColumn("n", F.lit(0)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _spread(rows: DataFrame, name: str, own: str, own_count: int, other: str, other_count: int) -> DataFrame:
    """Each row once for every place of the other side, keyed by its own place and the other's."""
    placed = rows.withColumn(own, F.pmod(F.xxhash64(name), F.lit(own_count)).cast("int"))
    return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_count - 1))))
