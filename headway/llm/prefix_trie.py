"""Prefix trie of conversations, from sorted matrices of turn ids.

Conversations are rebuilt so that neighbours share their first turns, cut into segments of ``WIDTH`` turns, and laid out as
rows of padded matrices. A segment's rows are grouped by the turns before it, so that one very long conversation is many
rows, and every level of segments is worked on at once. The rows are range-sharded by their turn ids; within a shard numpy
sorts them lexicographically, marks of change accumulated column by column show where the nodes of each depth start, and
``reduceat`` aggregates them. Only nodes on the path of a shard's first or last row can reach into another shard: these
are summed up over all shards, and their sums are passed on to their ancestors, which lie on such a path too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import Batches, stored

# Conversations in a family, and one more than the most turns they share.
FAMILY = 5
SHARED = 9

WIDTH = 32
ROWS_PER_SHARD = 1 << 15
TURNS_PER_PART = 1 << 18
IDS_PER_CHUNK = 256
NO_ENDS = hashlib.sha256(b"").hexdigest()
GROUP = ("level", "g1", "g2")
NODE = (*GROUP, "path")


def _parts(rows: DataFrame, size: int) -> int:
    return max(1, -(-rows.count() // size))


# --- Rebuilt conversations


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, place, hi, lo, size): turn ids, and each turn's place among its conversation's turns of one part.

    The turn id is half of a SHA-256 digest of role and text. Parts are ranges of (conversation, turn), so that turns of one
    conversation may fill many of them.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda start: F.conv(F.substr("digest", F.lit(start), F.lit(16)), 16, -10).cast("bigint")
    told = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("bigint").alias("size")
    )
    turns = stored(told.select("conv_id", "turn", half(1).alias("hi"), half(17).alias("lo"), "size"), "trie-turns")
    order = ["conv_id", F.asc_nulls_first("turn"), "hi", "lo"]
    spread = turns.repartitionByRange(_parts(turns, TURNS_PER_PART), *order).sortWithinPartitions(*order)
    schema = "conv_id bigint, part int, place bigint, hi bigint, lo bigint, size bigint"
    return stored(spread.select("conv_id", "hi", "lo", "size").mapInArrow(_placed, schema), "trie-numbered")


def _placed(batches: Batches) -> Batches:
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch.column(0).to_numpy()
        if not len(ids):
            continue
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        lengths = np.diff(np.r_[starts, len(ids)])
        places = np.arange(1, len(ids) + 1) - np.repeat(starts, lengths)
        if ids[0] == last:
            places[: lengths[0]] += seen
        last, seen = ids[-1], int(places[-1])
        columns = [batch.column(0), pa.array(np.full(len(ids), part, np.int32)), pa.array(places), *batch.columns[1:]]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "place", "hi", "lo", "size"])


def rebuilt_turns(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (conv_id, total, depth, hi, lo, size), and all conversations as (conv_id, total).

    With h from the hash of its id, a conversation is the first h turns of its family's head, then its own after the first h.
    """
    runs = numbered.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    sizes = runs.groupBy("conv_id").agg(F.sum("n").alias("own"))
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("own").alias("head_turns"))
    h = F.crc32(F.col("conv_id").cast("string")) % SHARED
    known = sizes.withColumns({"h": h, "head": F.col("conv_id") - F.col("conv_id") % FAMILY}).join(heads, "head", "left")
    known = known.withColumn("shared", F.least("h", F.coalesce("head_turns", F.lit(0))))
    total = F.col("shared") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    known = stored(known.select("conv_id", "head", "h", "shared", total.alias("total")), "trie-conversations")

    starts = runs.withColumn("before", before).join(known, "conv_id")
    turns = numbered.join(starts, ["conv_id", "part"]).withColumn("number", F.col("before") + F.col("place"))
    is_head, number = F.col("conv_id") == F.col("head"), F.col("number")
    depth = F.when(is_head, number).otherwise(F.col("shared") + number - F.col("h"))
    own = turns.filter(is_head | (number > F.col("h"))).select("conv_id", "total", depth.alias("depth"), "hi", "lo", "size")
    first = turns.filter(is_head & (F.col("place") < SHARED) & (number < SHARED)).select("head", "number", "hi", "lo", "size")
    heirs = known.filter("conv_id != head AND shared > 0").select("head", "conv_id", "shared", "total")
    taken = first.join(heirs, (first["head"] == heirs["head"]) & (number <= F.col("shared")))
    taken = taken.select("conv_id", "total", number.alias("depth"), "hi", "lo", "size")
    return own.unionByName(taken), known.select("conv_id", "total")


# --- Rows of the matrices


def matrix_rows(turns: DataFrame, known: DataFrame, width: int) -> DataFrame:
    """(level, g1, g2, ids, sizes, conv_id, open): each conversation in segments of ``width`` turns.

    ``ids`` has two numbers a turn. ``g1`` and ``g2`` are hashes of all turns before the segment, so that (level, g1, g2) is
    the node that the segment starts from; every conversation that reaches this node has a row there, of no turns if it
    ends there. ``open`` rows go on in the next level.
    """
    told = turns.withColumn("level", ((F.col("depth") - 1) / width).cast("int")).groupBy("conv_id", "total", "level")
    packed = told.agg(F.sort_array(F.collect_list(F.struct("depth", "hi", "lo", "size"))).alias("turns")).select(
        "conv_id",
        "total",
        "level",
        F.flatten(F.transform("turns", lambda t: F.array(t["hi"], t["lo"]))).alias("ids"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
    )
    nothing = F.array().cast("array<bigint>")
    ending = known.filter(F.col("total") % width == 0)
    ending = ending.select("conv_id", "total", (F.col("total") / width).cast("int").alias("level"), nothing.alias("ids"), nothing.alias("sizes"))
    segments = stored(packed.unionByName(ending), "trie-segments")

    earlier = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    seed = lambda number: F.xxhash64(F.lit(number), "level", "ids")
    mark = lambda number: F.coalesce(F.bit_xor(seed(number)).over(earlier), F.lit(0).cast("bigint"))
    long = segments.filter(F.col("total") >= width).withColumns({"g1": mark(1), "g2": mark(2)})
    zero = F.lit(0).cast("bigint")
    short = segments.filter(F.col("total") < width).withColumns({"g1": zero, "g2": zero})
    going_on = F.col("total") > (F.col("level") + 1) * width
    return stored(long.unionByName(short).select(*GROUP, "ids", "sizes", "conv_id", going_on.alias("open")), "trie-rows")


# --- One shard

NODES = pa.schema(
    [
        ("edge", pa.bool_()),
        ("shard", pa.int32()),
        ("side", pa.int32()),
        ("level", pa.int32()),
        ("g1", pa.int64()),
        ("g2", pa.int64()),
        ("path", pa.list_(pa.int64())),
        ("d", pa.int32()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("parent_side", pa.int32()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved", pa.int64()),
        ("size", pa.int64()),
        ("open", pa.bool_()),
        ("ends", pa.list_(pa.string())),
    ]
)
NODES_DDL = (
    "edge boolean, shard int, side int, level int, g1 bigint, g2 bigint, path array<bigint>, d int, conv_id bigint,"
    " parent_conv_id bigint, parent_side int, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, size bigint,"
    " open boolean, ends array<string>"
)


def padded(column: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A list column as a matrix of ``width`` columns, and the lengths. Beyond each list stands the least number, so that
    a list sorts before those that it is the start of."""
    lengths = np.diff(column.offsets.to_numpy())
    matrix = np.full((len(column), width), np.iinfo(np.int64).min)
    matrix[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return matrix, lengths


def _chunks(ids: np.ndarray) -> list[str]:
    return [",".join(map(str, ids[i : i + IDS_PER_CHUNK].tolist())) for i in range(0, len(ids), IDS_PER_CHUNK)]


def shard_nodes(rows: pa.Table, shard: int, width: int) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard's rows, a batch for each depth, deepest first.

    A node that no other shard can have is final but for the ``parent_conv_id`` of one whose parent may be elsewhere too;
    that parent is named by ``parent_side``. Nodes on the first row's path (side 0) and on the last row's (side 1) are
    ``edge`` ones: what they have of their subtree's sums leaves out the edge nodes themselves.
    """
    whole = rows.combine_chunks()
    column = lambda name: whole[name].combine_chunks()
    matrix, lengths = padded(column("ids"), 2 * max(1, int(np.diff(column("ids").offsets.to_numpy()).max()) // 2))
    depth = lengths // 2
    sizes, _ = padded(column("sizes"), matrix.shape[1] // 2)
    conv, level, g1, g2 = (column(name).to_numpy() for name in ("conv_id", *GROUP))
    goes_on = column("open").to_numpy(zero_copy_only=False)
    order = np.lexsort((conv, goes_on, lengths, *matrix.T[::-1], g2, g1, level))
    matrix, depth, sizes, conv, level, g1, g2, goes_on = (x[order] for x in (matrix, depth, sizes, conv, level, g1, g2, goes_on))
    extra = {name: column(name).to_numpy()[order] for name in ("x_children", "x_leaves", "x_saved")}
    n = len(conv)

    # Top down: the nodes of each depth.
    changed = np.ones(n, bool)
    changed[1:] = (level[1:] != level[:-1]) | (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])
    layers: list[dict] = []
    for d in range(int(depth.max()) + 1):
        if d:
            pair = matrix[:, 2 * d - 2 : 2 * d]
            changed[1:] |= (pair[1:] != pair[:-1]).any(axis=1) | (depth[:-1] < d)
        there = np.flatnonzero(depth >= d)
        first = np.flatnonzero(changed[there])
        at = there[first]
        ended = (depth[there] == d) & ~goes_on[there]
        side = np.full(len(at), -1, np.int32)
        if there[-1] == n - 1:
            side[-1] = 1
        if at[0] == 0:
            side[0] = 0
        layers.append(
            {
                "there": there,
                "first": first,
                "at": at,
                "side": side,
                "n_convs": np.diff(np.r_[first, len(there)]),
                "conv_id": np.minimum.reduceat(conv[there], first),
                "n_ends": np.add.reduceat(ended.astype(np.int64), first),
                "open": np.logical_or.reduceat((d == width) & goes_on[there], first),
                "size": sizes[at, d - 1] if d else np.zeros(len(at), np.int64),
                "parent": np.searchsorted(layers[-1]["at"], at, side="right") - 1 if d else None,
            }
        )

    # Bottom up: sums over subtrees.
    below = None
    for d in range(len(layers) - 1, -1, -1):
        layer = layers[d]
        edge, nodes = layer["side"] >= 0, len(layer["at"])
        children, any_child, leaves, saved = (np.zeros(nodes, np.int64) for _ in range(4))
        if below is not None:
            np.add.at(children, below["parent"], (below["side"] < 0).astype(np.int64))
            np.add.at(any_child, below["parent"], 1)
            np.add.at(leaves, below["parent"], below["n_leaves"])
            np.add.at(saved, below["parent"], below["saved"])
        if d == width:
            children, added, more = (np.add.reduceat(extra[name][layer["there"]], layer["first"]) for name in extra)
            leaves += added
            saved += more
        is_leaf = ~layer["open"] & (any_child == 0) & ((level[layer["at"]] == 0) | (d > 0))
        layer["n_children"] = children
        layer["n_leaves"] = leaves + (is_leaf & ~edge)
        layer["saved"] = saved + np.where(edge, 0, (layer["n_convs"] - 1) * layer["size"])
        below = layer

    for d in range(len(layers) - 1, -1, -1):
        layer, above = layers[d], layers[d - 1] if d else None
        at, edge, nodes = layer["at"], layer["side"] >= 0, len(layer["at"])
        parent_side = above["side"][layer["parent"]] if d else np.full(nodes, -1, np.int32)
        asks = (parent_side >= 0) & ~edge
        parent = above["conv_id"][layer["parent"]] if d else np.zeros(nodes, np.int64)
        ends = []
        for i in range(nodes):
            ids = conv[at[i] : at[i] + layer["n_ends"][i]]  # those that end come first, by id
            chunks = _chunks(ids)
            ends.append(chunks if edge[i] else [hashlib.sha256(",".join(chunks).encode()).hexdigest() if chunks else NO_ENDS])
        values = {
            "edge": edge,
            "shard": np.full(nodes, shard, np.int32),
            "side": pa.array(layer["side"], mask=~edge),
            "level": level[at],
            "g1": g1[at],
            "g2": g2[at],
            "path": [matrix[row, : 2 * d] if on else None for row, on in zip(at, edge)],
            "d": np.full(nodes, d, np.int32),
            "conv_id": layer["conv_id"],
            "parent_conv_id": pa.array(parent, mask=edge | asks | (d == 0)),
            "parent_side": pa.array(parent_side, mask=~asks),
            "ends": ends,
        } | {name: layer[name] for name in ("n_convs", "n_children", "n_leaves", "saved", "size", "open")}
        yield pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) for f in NODES], schema=NODES)


def _shards(rows: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """All shards' nodes: those that are final, and the parts of edge nodes."""

    def run(batches: Batches) -> Batches:
        read = [batch for batch in batches if batch.num_rows]
        if read:
            yield from shard_nodes(pa.Table.from_batches(read), TaskContext.get().partitionId(), width)

    # The id comes last in the order: equal conversations without number still part into shards, and by ascending id.
    spread = rows.repartitionByRange(_parts(rows, ROWS_PER_SHARD), *GROUP, "ids", "conv_id")
    nodes = stored(spread.mapInArrow(run, NODES_DDL), "trie-nodes", partition_by="edge")
    return nodes.filter("NOT edge"), nodes.filter("edge")


# --- Nodes on the edges of shards


def edge_nodes(parts: DataFrame, width: int) -> DataFrame:
    """Edge nodes with their sums over all shards, (level, g1, g2, path) for each once."""
    whole = parts.groupBy(*NODE, "d").agg(
        *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved")],
        F.min("conv_id").alias("conv_id"),
        F.max("size").alias("size"),
        F.bool_or("open").alias("open"),
    )
    whole = stored(whole, "trie-edges")
    upto = lambda d: F.slice("path", F.lit(1), F.lit(2) * d)
    children = whole.filter("d > 0").select(*GROUP, upto(F.col("d") - 1).alias("path")).groupBy(*NODE).agg(F.count("*").alias("more"))
    known = whole.join(children, [*NODE], "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    is_leaf = F.when(F.col("d") == width, ~F.col("open")).otherwise(F.col("n_children") == 0) & ((F.col("level") == 0) | (F.col("d") > 0))
    own = known.select(*GROUP, "path", "d", is_leaf.cast("bigint").alias("leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("spared"))
    passed = own.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("d")))).select(*GROUP, upto(F.col("k")).alias("path"), "leaf", "spared")
    sums = passed.groupBy(*NODE).agg(F.sum("leaf").alias("leaf"), F.sum("spared").alias("spared"))
    told = known.join(sums, [*NODE]).withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved": F.col("saved") + F.col("spared")})
    return stored(told.drop("more", "leaf", "spared"), "trie-edge-nodes")


def _digests(batches: Batches) -> Batches:
    """One digest for each run of rows of one node; its chunks come in order."""
    key, state = None, None

    def done() -> pa.RecordBatch:
        kinds = [NODES.field(name).type for name in NODE]
        arrays = [pa.array([value], kind) for value, kind in zip(key, kinds)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([state.hexdigest()])], names=[*NODE, "ends_sha256"])

    for batch in batches:
        for *node, chunk in zip(*(column.to_pylist() for column in batch.columns)):
            if node != key:
                if key is not None:
                    yield done()
                key, state = node, hashlib.sha256(chunk.encode())
            else:
                state.update(b"," + chunk.encode())
    if key is not None:
        yield done()


def edge_digests(parts: DataFrame) -> DataFrame:
    """(level, g1, g2, path, ends_sha256) of the edge nodes at which conversations end; a running hash over chunks of ids."""
    chunks = parts.select(*NODE, "shard", F.posexplode("ends").alias("place", "chunk"))
    ordered = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "shard", "place")
    schema = "level int, g1 bigint, g2 bigint, path array<bigint>, ends_sha256 string"
    return ordered.select(*NODE, "chunk").mapInArrow(_digests, schema)


# --- The trie

RESULT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _with_deeper(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with what lies below their segment: children of its last turn, and leaves and saved bytes below it.

    The segments of one group hang below one node. Their sums are taken to the row of the group's smallest member, and from
    there to all its rows of earlier levels, which lie on the way up.
    """
    nothing = {name: F.lit(0).cast("bigint") for name in ("x_children", "x_leaves", "x_saved")}
    if rows.filter("level > 0").isEmpty():
        return rows.withColumns(nothing)
    final, parts = _shards(rows.filter("level > 0").withColumns(nothing), width)
    sums = ("level", "conv_id", "n_children", "n_leaves", "saved")
    roots = final.filter("d = 0").select(*sums).unionByName(edge_nodes(parts, width).filter("d = 0").select(*sums))
    long = rows.filter("open OR level > 0").join(roots, ["conv_id", "level"], "left").fillna(0, list(sums[2:]))
    up = Window.partitionBy("conv_id").orderBy(F.desc("level"))
    deeper = up.rowsBetween(Window.unboundedPreceding, -1)
    below = {
        "x_children": F.lag("n_children", 1, 0).over(up),
        "x_leaves": F.coalesce(F.sum("n_leaves").over(deeper), F.lit(0).cast("bigint")),
        "x_saved": F.coalesce(F.sum("saved").over(deeper), F.lit(0).cast("bigint")),
    }
    long = long.withColumns(below).select(*rows.columns, *below)
    return stored(rows.filter("NOT open AND level = 0").withColumns(nothing).unionByName(long), "trie-deep-rows")


def prefix_trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, see ``RESULT``.

    ``conversations`` has conv_id, turn, role and text; other columns are not looked at. Null roles and texts are empty ones;
    rows without a conv_id take no part; turns are ordered by ``turn``, null first, equal ones by the hash of their
    content; repeated rows are turns each; ids of either sign belong to the family of the id less its remainder, which has
    the id's sign. A conversation without turns is a member of the root alone. An empty table gives an empty result.
    """
    rows = _with_deeper(matrix_rows(*rebuilt_turns(numbered_turns(conversations)), width), width)
    final, parts = _shards(rows, width)
    edges = edge_nodes(parts, width)
    # A level's first nodes hang below its group's root, which the level before has as its last turn.
    told = (F.col("d") > 0) | (F.col("level") == 0)

    def result(nodes: DataFrame, digest: Column) -> DataFrame:
        depth = F.col("level").cast("bigint") * width + F.col("d")
        return nodes.filter(told).select(
            "conv_id",
            depth.alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            F.col("saved").alias("saved_tokens"),
            digest.alias("ends_sha256"),
        )

    inner = final.filter("parent_side IS NULL")
    places = parts.select(*NODE, "shard", F.col("side").alias("parent_side"), (F.col("d") + 1).alias("d"))
    parents = places.join(edges.select(*NODE, F.col("conv_id").alias("found")), [*NODE]).select("shard", "parent_side", "d", "found")
    asking = final.filter("parent_side IS NOT NULL").join(parents, ["shard", "parent_side", "d"]).withColumn("parent_conv_id", F.col("found"))
    above = edges.select(*GROUP, F.col("path").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    up = edges.withColumn("above", F.when(F.col("d") > 0, F.slice("path", F.lit(1), F.lit(2) * F.col("d") - 2)))
    outer = up.join(above, [*GROUP, "above"], "left").join(edge_digests(parts), [*NODE], "left")
    return (
        result(inner, F.get("ends", F.lit(0)))
        .unionByName(result(asking, F.get("ends", F.lit(0))))
        .unionByName(result(outer, F.coalesce("ends_sha256", F.lit(NO_ENDS))))
    )


def trie_sql() -> str:
    """The same in SQL, with every prefix of every conversation as a row."""
    crc = (
        "xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(unicode(s) AS BIGINT)),"
        " lambda c, b: list_reduce(range(8), lambda e, k: CASE WHEN e % 2 = 1 THEN xor(e >> 1, 3988292384) ELSE e >> 1 END, xor(c, b)),"
        " 4294967295), 4294967295)"
    )
    return f"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, strlen(coalesce(text, '')) AS size,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
    translate(id[1], '0123456789abcdef', '89abcdef01234567') || id[2:]) AS number FROM turns),
known AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS head, {crc} % {SHARED} AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT k.conv_id, n.number AS place, n.id, n.size FROM known k JOIN numbered n ON n.conv_id = k.head AND n.number <= k.h
  UNION ALL
  SELECT k.conv_id, 1000000000 + n.number, n.id, n.size FROM known k JOIN numbered n ON n.conv_id = k.conv_id AND n.number > k.h),
listed AS (
  SELECT k.conv_id, coalesce(list(id ORDER BY place) FILTER (id IS NOT NULL), []) AS ids,
         coalesce(list(size ORDER BY place) FILTER (id IS NOT NULL), []) AS sizes
  FROM known k LEFT JOIN rebuilt r ON k.conv_id = r.conv_id GROUP BY k.conv_id),
prefixes AS (
  SELECT conv_id, d AS depth, sha256(array_to_string(ids[1:d], ',')) AS node, sha256(array_to_string(ids[1:d - 1], ',')) AS parent,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, d = len(ids) AS ends
  FROM listed, unnest(range(0, len(ids) + 1)) AS u(d)),
nodes AS (
  SELECT node, depth, CASE WHEN depth > 0 THEN any_value(parent) END AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(size) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT DISTINCT a.node AS top, b.node FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
  SELECT top, sum(saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
  FROM below b JOIN nodes n ON b.node = n.node LEFT JOIN children c ON b.node = c.node GROUP BY top)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.parent = p.node LEFT JOIN children c ON n.node = c.node JOIN sums s ON s.top = n.node"""
