"""Secrets in texts: plain ones by pattern, and weak candidates that count only beside the other parts of a credential.

A credential has up to three parts: an identifier, a secret and an endpoint. Assignments, access keys and long hexadecimal
numbers are reported wherever they stand. Forty characters that look like a key, logins and endpoints are common in clean
text; they are reported only if complementary parts stand in the same paragraph, within ``REACH`` code points. That
interval join is made of window functions over the parts of a text in order (the nearest part of each role before and
after), so its work is linear and no pairs are formed. DataFrame functions only.

Positions come from what a pattern leaves between its matches: a match starts where the pieces and matches before it end.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REACH = 256


class Part(NamedTuple):
    """A pattern, the group whose text ``keeps`` judges, and the part's role in a credential."""

    kind: str
    role: str
    pattern: str
    group: int
    keeps: Callable[[Column], Column]
    sql: str


IDENTIFIER, SECRET, ENDPOINT, NONE = "identifier", "secret", "endpoint", ""
QUOTED_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
# The patterns of the plain kinds. ``[0-9a-f]{24,}`` finds the runs of ``[0-9a-f]+`` that are long enough.
BASE = (
    Part(
        "assign",
        SECRET,
        rf"(?i:password|passwd|secret|token|api_?key){QUOTED_VALUE}([A-Za-z0-9+/_.=-]+)",
        1,
        lambda value: F.length(value) >= 6,
        "length({}) >= 6",
    ),
    Part("access", IDENTIFIER, "AKIA[A-Z0-9]+", 0, lambda value: F.length(value) >= 20, "length({}) >= 20"),
    Part("hex", SECRET, "[0-9a-f]{24,}", 0, lambda value: F.length(value) >= 24, "length({}) >= 24"),
)
_MIXED = ("[0-9]", "[A-Z]", "[a-z]")
WEAK = (
    Part(
        "key",
        SECRET,
        "[A-Za-z0-9+/=_-]{40,}",
        0,
        lambda value: (F.length(value) == 40) & ~value.rlike("[=_-]") & value.rlike(_MIXED[0]) & value.rlike(_MIXED[1]) & value.rlike(_MIXED[2]),
        "length({0}) = 40 AND NOT regexp_matches({0}, '[=_-]')" + "".join(f" AND regexp_matches({{0}}, '{x}')" for x in _MIXED),
    ),
    Part(
        "login",
        IDENTIFIER,
        rf"(?i:user(?:name)?|login|account|client_?id){QUOTED_VALUE}([A-Za-z0-9@._+-]+)",
        1,
        lambda value: F.length(value) >= 2,
        "length({}) >= 2",
    ),
    Part(
        "endpoint",
        ENDPOINT,
        r"(?i:https?|ftp|sftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://([A-Za-z0-9.-]+)(?::[0-9]+)?",
        1,
        lambda value: F.length(value) >= 3,
        "length({}) >= 3",
    ),
)
# What a weak candidate needs beside it.
COMPLEMENTS = {"key": (IDENTIFIER,), "login": (SECRET,), "endpoint": (IDENTIFIER, SECRET)}
BREAK = Part("break", NONE, r"\n[\x20\t\r]*\n", 0, lambda value: F.lit(True), "true")
PARTS = (*BASE, *WEAK, BREAK)
KINDS = tuple(part.kind for part in (*BASE, *WEAK))
N_BASE = len(BASE)


def _matches(text: Column, number: int, part: Part) -> Column:
    """An element for each match of a part: what was left before it, its length, and whether it is kept.

    The last element has no match; it is what was left at the end. ``arrays_zip`` searches the text once for each array and
    not once for each element.
    """
    pattern = F.lit(part.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    values = found if part.group == 0 else F.regexp_extract_all(text, pattern, F.lit(part.group))
    zipped = F.arrays_zip(
        F.transform(F.split(text, part.pattern), F.length).alias("gap"),
        F.transform(found, F.length).alias("size"),
        F.transform(values, part.keeps).alias("kept"),
    )
    told = F.transform(
        zipped,
        lambda x, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("place"),
            x["gap"].cast("bigint").alias("gap"),
            x["size"].cast("bigint").alias("size"),
            x["kept"].alias("kept"),
        ),
    )
    kept = F.filter(told, lambda x: x["size"].isNotNull())
    # Most texts have no match; they are searched once.
    return F.when(text.rlike(part.pattern), kept).otherwise(F.array().cast("array<struct<kind:int,place:int,gap:bigint,size:bigint,kept:boolean>>"))


def _is_role(role: str) -> Column:
    return F.col("kept") & F.col("kind").isin([i for i, part in enumerate(PARTS) if part.role == role])


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, secrets): for each row of ``docs`` the spans found in its whole text, as an array of structs.

    A span has start and end in code points (end exclusive), the number of its kind in ``KINDS`` and its ``kind``; spans are
    ordered by start, kind and end, plain ones and weak candidates alike. Within a kind, spans are leftmost and do not
    overlap. A weak candidate that overlaps a plain span is left out. Null and empty texts have no spans; repeated rows and
    rows that share an id are each searched by themselves; other columns are not looked at, whatever their names; an empty
    table gives an empty one. Each row is identified by its place in the input, and all rows go through one shuffle as
    (id, part), never as texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text.alias("text"))
    found = F.concat(*[_matches(F.col("text"), number, part) for number, part in enumerate(PARTS)])
    parts = texts.select("doc_id", "row", F.explode_outer(found).alias("part")).select("doc_id", "row", "part.*")
    parts = parts.repartition("row")

    of_kind = Window.partitionBy("row", "kind").orderBy("place")
    end = F.sum(F.col("gap") + F.col("size")).over(of_kind)
    placed = parts.select("doc_id", "row", "kind", F.coalesce("kept", F.lit(False)).alias("kept"), (end - F.col("size")).alias("start"), end.alias("end"))

    in_text = Window.partitionBy("row").orderBy("start", "kind")
    is_break = F.col("kind") == PARTS.index(BREAK)
    scoped = placed.withColumn("scope", F.coalesce(F.sum(is_break.cast("int")).over(in_text), F.lit(0)))

    # Frames that grow from the start of the order are linear; those that shrink towards its end are not.
    scope = Window.partitionBy("row", "scope")
    before = scope.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = scope.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    is_base = F.col("kept") & (F.col("kind") < N_BASE)
    near = {
        role: (F.col("start") - F.max(F.when(_is_role(role), F.col("end"))).over(before) <= REACH,
               F.min(F.when(_is_role(role), F.col("start"))).over(after) - F.col("end") <= REACH)
        for role in (IDENTIFIER, SECRET)
    }
    sides = scoped.withColumns(
        {f"{role}_before": sides[0] for role, sides in near.items()}
        | {"base_before": F.max(F.when(is_base, F.col("end"))).over(before) > F.col("start")}
        | {f"{role}_after": sides[1] for role, sides in near.items()}
        | {"base_after": F.min(F.when(is_base, F.col("start"))).over(after) < F.col("end")}
    )

    def either(name: str) -> Column:
        return F.coalesce(F.col(f"{name}_before"), F.lit(False)) | F.coalesce(F.col(f"{name}_after"), F.lit(False))

    linked = F.lit(False)
    for kind, roles in COMPLEMENTS.items():
        all_near = F.lit(True)
        for role in roles:
            all_near = all_near & either(role)
        linked = linked | ((F.col("kind") == KINDS.index(kind)) & all_near)
    reported = F.col("kept") & ((F.col("kind") < N_BASE) | (linked & ~either("base")))
    names = F.array(*[F.lit(kind) for kind in KINDS])
    span = F.struct("start", F.col("kind").alias("number"), "end", F.get(names, F.col("kind")).alias("kind"))
    spans = F.array_sort(F.collect_list(F.when(reported, span)))
    return sides.groupBy("row", "doc_id").agg(spans.alias("secrets")).select("doc_id", "secrets")


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts per plain kind, the digest of the plain spans and all spans as text, from ``find_secrets``."""

    def as_text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(number: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["number"] == number)).cast("bigint")

    base = F.filter("secrets", lambda s: s["number"] < N_BASE)
    return found.select(
        "doc_id",
        *[count(number).alias(f"n_{part.kind}") for number, part in enumerate(BASE)],
        F.sha2(as_text(base), 256).alias("base_sha256"),
        as_text(F.col("secrets")).alias("spans"),
    )


def digest_sql() -> str:
    """``find_secrets`` and ``digest_columns`` in SQL."""
    text = lambda pattern: pattern.replace("'", "''")
    each = "\nUNION ALL ".join(
        f"""SELECT row, {number} AS kind, i, gaps[i] AS gap, length(found[i]) AS size, {part.sql.format("vals[i]")} AS kept
FROM (SELECT row, list_transform(string_split_regex(text, '{text(part.pattern)}'), lambda x: length(x)) AS gaps,
             regexp_extract_all(text, '{text(part.pattern)}', 0) AS found,
             regexp_extract_all(text, '{text(part.pattern)}', {part.group}) AS vals FROM texts), unnest(range(1, len(found) + 1)) AS u(i)"""
        for number, part in enumerate(PARTS)
    )
    roles = {role: ", ".join(str(i) for i, part in enumerate(PARTS) if part.role == role) for role in (IDENTIFIER, SECRET)}
    near = lambda role: (
        f"EXISTS (SELECT 1 FROM scoped o WHERE o.row = s.row AND o.scope = s.scope AND o.kept AND o.kind IN ({roles[role]})"
        f" AND (o.start, o.kind) <> (s.start, s.kind) AND CASE WHEN (o.start, o.kind) < (s.start, s.kind)"
        f" THEN s.start - o.stop <= {REACH} ELSE o.start - s.stop <= {REACH} END)"
    )
    linked = " OR ".join(f"(kind = {KINDS.index(kind)} AND {' AND '.join(map(near, needs))})" for kind, needs in COMPLEMENTS.items())
    names = "[" + ", ".join(f"'{kind}'" for kind in KINDS) + "]"
    counts = ", ".join(f"count(*) FILTER (kind = {number}) AS n_{part.kind}" for number, part in enumerate(BASE))
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
matches AS (
{each}),
placed AS (
  SELECT row, kind, kept, CAST(sum(gap + size) OVER w - size AS BIGINT) AS start, CAST(sum(gap + size) OVER w AS BIGINT) AS stop
  FROM matches WINDOW w AS (PARTITION BY row, kind ORDER BY i)),
scoped AS (
  SELECT *, sum(CASE WHEN kind = {PARTS.index(BREAK)} THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY start, kind) AS scope FROM placed),
reported AS (
  SELECT row, kind, start, {names}[kind + 1] || ':' || start || ':' || stop AS span FROM scoped s
  WHERE kept AND (kind < {N_BASE} OR ({linked}) AND NOT EXISTS (
    SELECT 1 FROM scoped b WHERE b.row = s.row AND b.kept AND b.kind < {N_BASE} AND b.start < s.stop AND s.start < b.stop))),
summed AS (
  SELECT row, {counts},
         string_agg(span, ',' ORDER BY start, kind) FILTER (kind < {N_BASE}) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM reported GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{part.kind}, 0) AS n_{part.kind}" for part in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN summed USING (row)"""
