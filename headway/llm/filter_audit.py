"""How five filters interact: what each removes, finds redundant or removes alone, under every order of them.

One pass of a table-driven transducer over a text's UTF-8 bytes counts words, capitals, code points and symbols, and
marks where words start and end. The word spans go into an open-addressed hash table whose hits are verified byte by
byte, which gives the number of distinct words. Each document is thereby reduced to five bits, one for each filter; all
orders are evaluated on the counts of the 32 combinations and never on documents.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import Batches, stored

FILTERS = "ABCDE"
# Fixed values of the filters.
LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOLS = b"#$%&*|"

# --- The transducer: what each byte means, as bits

BLANK, CAPITAL, FIRST, SYMBOL = 1, 2, 4, 8
MEANING = np.zeros(256, np.uint8)
MEANING[[0x20, *range(0x09, 0x0E)]] |= BLANK
MEANING[ord("A") : ord("Z") + 1] |= CAPITAL
MEANING[:0x80] |= FIRST  # a code point starts at every byte that does not continue one
MEANING[0xC0:] |= FIRST
MEANING[list(SYMBOLS)] |= SYMBOL

LANE = 8  # bytes of a word that are compared at once
LONGEST = 16 * LANE  # longer words are compared as bytes objects
BYTES_AT_ONCE = 1 << 22


def _per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marks each text has."""
    counts = np.zeros(len(offsets) - 1, np.int64)
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(filled):
        counts[filled] = np.add.reduceat(marks, offsets[filled], dtype=np.int64)
    return counts


def scan(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per text; text i is ``data[offsets[i]:offsets[i + 1]]``, offsets from 0 to the end of ``data``."""
    meaning = MEANING[data]
    inside = (meaning & BLANK) == 0
    before = np.empty_like(inside)  # the state that a byte is read in
    before[:1], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    leaving = np.flatnonzero(inside[:-1] & ~(before[1:] & inside[1:])) + 1
    ends = np.append(leaving, len(data)) if len(data) and inside[-1] else leaving
    owners = np.searchsorted(offsets, starts, side="right") - 1
    return {
        "words": np.bincount(owners, minlength=len(offsets) - 1),
        "distinct": distinct_words(data, starts, ends, owners, len(offsets) - 1),
        "capitals": _per_text((meaning & CAPITAL) != 0, offsets),
        "points": _per_text((meaning & FIRST) != 0, offsets),
        "symbols": _per_text((meaning & SYMBOL) != 0, offsets),
    }


# --- The hash table of word spans


def _lane(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, number: int) -> np.ndarray:
    """Bytes 8n to 8n + 7 of each word as one number, zeros beyond its end."""
    lanes = np.ndarray((len(padded) - LANE + 1,), "<u8", padded.data, strides=(1,))
    left = np.clip(lengths - number * LANE, 0, LANE).astype(np.uint64)
    keep = np.where(left == LANE, ~np.uint64(0), (np.uint64(1) << (left * np.uint64(8))) - np.uint64(1))
    return np.where(left > 0, lanes[np.minimum(starts + number * LANE, len(lanes) - 1)] & keep, np.uint64(0))


def _hashes(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> np.ndarray:
    factor = np.uint64(0x9E3779B97F4A7C15)
    h = (owners.astype(np.uint64) << np.uint64(20)) + lengths.astype(np.uint64)
    for number in range(-(-int(lengths.max(initial=0)) // LANE)):
        h = (h ^ _lane(padded, starts, lengths, number)) * factor
        h ^= h >> np.uint64(29)
    return h


def _same(padded: np.ndarray, starts: np.ndarray, lengths: np.ndarray, owners: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a[i] and b[i] are of one text and equal, byte by byte."""
    equal = (owners[a] == owners[b]) & (lengths[a] == lengths[b])
    for number in range(-(-int(lengths[a].max(initial=0)) // LANE)):
        open_ = np.flatnonzero(equal & (lengths[a] > number * LANE))
        if not len(open_):
            break
        left, right = a[open_], b[open_]
        equal[open_] = _lane(padded, starts[left], lengths[left], number) == _lane(padded, starts[right], lengths[right], number)
    return equal


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
    """Number of distinct words of each text.

    All words probe at once: those that meet an empty slot write themselves into it, those that meet an equal word are
    done, and the others go on to the next slot.
    """
    lengths = ends - starts
    counts = np.zeros(texts, np.int64)
    long = np.flatnonzero(lengths > LONGEST)
    spelled = {(int(owners[i]), data[starts[i] : ends[i]].tobytes()) for i in long}
    for owner, _ in spelled:
        counts[owner] += 1
    short = lengths <= LONGEST
    starts, lengths, owners = starts[short], lengths[short], owners[short]
    if not len(starts):
        return counts
    padded = np.concatenate([data, np.zeros(LANE, np.uint8)])
    slots = 1 << int(2 * len(starts)).bit_length()
    table = np.full(slots, -1, np.int64)
    at = (_hashes(padded, starts, lengths, owners) >> np.uint64(8)).astype(np.int64) & (slots - 1)
    pending = np.arange(len(starts))
    while len(pending):
        free = table[at] < 0
        table[at[free]] = pending[free]
        there = table[at]
        mine = there == pending
        counts += np.bincount(owners[pending[mine]], minlength=texts)
        rest = np.flatnonzero(~mine)
        rest = rest[~_same(padded, starts, lengths, owners, pending[rest], there[rest])]
        pending, at = pending[rest], (at[rest] + 1) & (slots - 1)
    return counts


# --- On tables

def _failing(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Bits 0 to 3: whether each text fails A to D."""
    conditions = (
        counts["words"] < LEAST_WORDS,
        100 * counts["distinct"] < LEAST_DISTINCT_PERCENT * counts["words"],
        100 * counts["capitals"] > MOST_CAPITALS_PERCENT * counts["points"],
        counts["symbols"] > 0,
    )
    return sum(condition.astype(np.int32) << bit for bit, condition in enumerate(conditions))


def _scanned(batches: Batches) -> Batches:
    for batch in batches:
        texts = batch.column(2).cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        fails, digests, first = [np.zeros(0, np.int32)], [], 0
        while first < len(texts):  # some megabytes at a time
            last = max(int(np.searchsorted(offsets, offsets[first] + BYTES_AT_ONCE, side="right")) - 1, first + 1)
            part = offsets[first : last + 1]
            fails.append(_failing(scan(data[part[0] : part[-1]], part - part[0])))
            digests += [hashlib.sha256(data[a:b]).digest() for a, b in itertools.pairwise(part.tolist())]
            first = last
        arrays = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(np.concatenate(fails))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "part", "digest", "fails"])


def failing_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, good, toxic, n): documents by the filters they fail, as bits, and by their labels.

    The texts are read once and leave their task as five bits and a SHA-256 digest. Rows are added up by id and text
    before anything is joined, and a text's first document is found by a join on text *and* id, so that neither a repeated
    document nor a text that very many documents share makes a hot key.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    scanned = wanted.mapInArrow(_scanned, f"doc_id {kind}, part string, digest binary, fails int")
    rows = stored(scanned.groupBy("doc_id", "part", "digest", "fails").agg(F.count("*").alias("n")), "audit-rows")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marked = rows.join(first, ["digest", "doc_id"], "left")
    known = labels.select(
        "doc_id", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic")
    )
    known = known.groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    copied = F.when(F.col("doc_id").isNotNull() & F.col("is_first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    joined = marked.withColumn("fails", F.col("fails").bitwiseOR(copied)).join(known, "doc_id", "left").fillna(False, ["good", "toxic"])
    return joined.groupBy("part", "fails", "good", "toxic").agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step in it, with the documents kept, removed and so on.

    ``docs`` has doc_id, text and lang, ``labels`` has doc_id, quality and toxic; other columns are not looked at, whatever
    their names. Null texts are empty ones; a null lang is the part of the empty string; a row without an id never counts
    as a copy and has no labels; repeated rows each count and are no copies of each other; of several labels of one
    document the greatest count; an empty table gives an empty one.
    """
    fails, n = F.col("fails"), F.col("n")
    counts = failing_counts(docs, labels)
    orders = F.array(*[F.lit("".join(order)) for order in itertools.permutations(FILTERS)])
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.array(*[F.lit(i) for i in range(1, len(FILTERS) + 1)]))
    )

    def bits(letters: Column) -> Column:
        """The filters named in a text, as bits."""
        return sum((F.when(letters.contains(name), 1 << bit).otherwise(0) for bit, name in enumerate(FILTERS)), F.lit(0))

    steps = steps.withColumns(
        {
            "own": bits(F.expr("substr(filter_order, step, 1)")),
            "earlier": bits(F.expr("left(filter_order, step - 1)")),
        }
    )
    failing = fails.bitwiseAND(F.col("own")) != 0
    gone = fails.bitwiseAND(F.col("earlier")) != 0
    removed = failing & ~gone

    def total(condition: Column, value: Column = n) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("bigint")

    # Of the orders, the share in which a filter comes first of those that a document fails: one in as many as they are.
    share = F.lit(len(list(itertools.permutations(FILTERS)))) / F.greatest(F.bit_count("fails"), F.lit(1))
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~failing & ~gone).alias("kept"),
        total(removed).alias("removed"),
        total(failing & gone).alias("redundant"),
        total(fails == F.col("own")).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        total(failing, n * share.cast("bigint")).alias("shapley"),
    )


def audit_sql() -> str:
    """The same in SQL, with regular expressions for the transducer."""
    word = r"[^\x20\x09-\x0D]+"
    letters = ", ".join(f"('{name}', {1 << bit})" for bit, name in enumerate(FILTERS))
    order = " || ".join(f"{alias}.name" for alias in "vwxyz")
    apart = " AND ".join(f"{a}.name <> {b}.name" for a, b in itertools.combinations("vwxyz", 2))
    earlier = " + ".join(f"CASE WHEN s.step > {i} THEN {a} ELSE 0 END" for i, a in enumerate(("b1", "b2", "b3", "b4"), 1))
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (SELECT *, regexp_extract_all(text, '{word}') AS words FROM texts),
first_ids AS (SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text),
known AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(k.toxic, false) AS toxic,
         CASE WHEN len(words) < {LEAST_WORDS} THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < {LEAST_DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > {MOST_CAPITALS_PERCENT} * length(w.text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(w.text, '[{SYMBOLS.decode()}]') THEN 8 ELSE 0 END
         + CASE WHEN first_id < w.doc_id THEN 16 ELSE 0 END AS fails
  FROM worded w JOIN first_ids f ON w.text = f.text LEFT JOIN known k ON w.doc_id = k.doc_id),
letters(name, bit) AS (VALUES {letters}),
orders AS (
  SELECT {order} AS filter_order, v.bit AS b1, w.bit AS b2, x.bit AS b3, y.bit AS b4, z.bit AS b5
  FROM letters v, letters w, letters x, letters y, letters z WHERE {apart}),
steps AS (
  SELECT filter_order, s.step, CASE s.step WHEN 1 THEN b1 WHEN 2 THEN b2 WHEN 3 THEN b3 WHEN 4 THEN b4 ELSE b5 END AS own,
         {earlier} AS earlier
  FROM orders, (VALUES (1), (2), (3), (4), (5)) AS s(step)),
counted AS (SELECT part, fails, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
told AS (
  SELECT part, filter_order, step, own,
         CAST(sum(n) FILTER (fails & (own | earlier) = 0) AS BIGINT) AS kept,
         CAST(sum(n) FILTER (fails & own > 0 AND fails & earlier = 0) AS BIGINT) AS removed,
         CAST(sum(n) FILTER (fails & own > 0 AND fails & earlier > 0) AS BIGINT) AS redundant,
         CAST(sum(n) FILTER (fails = own) AS BIGINT) AS unique_fails,
         CAST(sum(n) FILTER (good AND fails & own > 0 AND fails & earlier = 0) AS BIGINT) AS good_lost,
         CAST(sum(n) FILTER (toxic AND fails & own > 0 AND fails & earlier = 0) AS BIGINT) AS toxic_lost
  FROM counted, steps GROUP BY ALL),
summed AS (SELECT part, own, sum(removed) AS shapley FROM told GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed,
       coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
       coalesce(toxic_lost, 0) AS toxic_lost, CAST(coalesce(shapley, 0) AS BIGINT) AS shapley
FROM told JOIN summed USING (part, own)"""
