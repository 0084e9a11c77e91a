"""URL verdicts: rules where one fits, else propagation of trust and distrust over the links between hosts.

Hosts whose pages the rules mostly allow are trusted seeds, those they mostly block are blocked seeds. Trust flows along
links (personalised PageRank from the trusted seeds), distrust against them (from the blocked seeds to hosts that link to
them). All scores are integers, in millionths of a seed, so that they do not depend on the order of rows. DataFrame
functions only.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import forget, stored


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
UNIT = 1_000_000
DAMPING_PERCENT = 85
LEAST_DISTRUST = UNIT // 100
# The host of an absolute or protocol-relative link in a page, as group 1.
_GAP = r"[\x20\t\r\n\f]*"
LINK = rf"(?i)(?:href|src){_GAP}={_GAP}[\"']?{_GAP}(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'<>\x20\t\r\n\f]+)"


def _after_scheme(url: str | Column) -> Column:
    return F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))


def ascii_lower(text: str | Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: str | Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case; empty without one."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def path_of(url: str | Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty where the host is."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _by_rule(rules: tuple[Rule, ...], value) -> Column:
    """``value`` of the longest rule that fits ``host`` and ``path``, null where none does."""
    longest = sorted(rules, key=lambda rule: (-len(rule.name), rule.name))
    fits = [
        F.when(
            ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path),
            F.lit(value(rule)),
        )
        for rule in longest
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


def with_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, and of the rule that fits its name and verdict."""
    placed = pages.withColumns({"host": host_of("url"), "path": path_of("url")})
    return placed.withColumns({"rule": _by_rule(rules, lambda r: r.name), "ruled": _by_rule(rules, lambda r: r.verdict)})


def host_links(ruled: DataFrame) -> DataFrame:
    """Distinct (src, dst): different hosts of the table, the first with a page that links to the second.

    A link is the value of an ``href`` or ``src`` that names a host; hosts that are only mentioned in the text are none.
    """
    linked = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), ascii_lower))
    found = ruled.filter("host != ''").select(F.col("host").alias("src"), F.explode(linked).alias("dst"))
    known = ruled.filter("host != ''").select(F.col("host").alias("dst")).distinct()
    return found.filter("src != dst").distinct().join(known, "dst", "left_semi").select("src", "dst")


def host_scores(ruled: DataFrame) -> DataFrame:
    """(host, trust, distrust) of the hosts that either reaches, at the fixed point of the propagation.

    Shares are rounded down and no score ever falls, so scores stop changing: what a seed passes on shrinks by 15 % with
    each link and is gone after some seventy. A round is a join and a grouping of host links; the last one is known by no
    score having changed.
    """
    seeds = ruled.groupBy("host").agg(
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("allowed"), F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked")
    )
    kind = F.when(F.col("allowed") > F.col("blocked"), "trust").when(F.col("blocked") > F.col("allowed"), "distrust")
    share = UNIT * (100 - DAMPING_PERCENT) // 100
    base = seeds.select(kind.alias("kind"), "host", F.lit(share).cast("bigint").alias("score")).filter("kind IS NOT NULL")
    base = stored(base, "host-seeds")
    links = stored(host_links(ruled), "host-links")
    forward = links.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"))
    backward = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"))
    both_ways = forward.unionByName(backward)
    degrees = both_ways.groupBy("kind", "host").agg(F.count("*").alias("degree"))
    arcs = stored(both_ways.join(degrees, ["kind", "host"]), "host-arcs")
    forget(links)
    none = F.lit(0).cast("bigint")
    scores, moving = base.withColumn("was", none), not arcs.isEmpty()
    while moving:
        passed = F.expr(f"score * {DAMPING_PERCENT} div (100 * degree)")
        flow = arcs.join(scores, ["kind", "host"]).select("kind", F.col("to").alias("host"), passed.alias("score"), none.alias("was"))
        before = scores.select("kind", "host", none.alias("score"), F.col("score").alias("was"))
        summed = flow.unionByName(base.withColumn("was", none)).unionByName(before).groupBy("kind", "host")
        after = stored(summed.agg(F.sum("score").alias("score"), F.sum("was").alias("was")), "host-scores")
        moving = not after.filter("score != was").isEmpty()
        forget(scores)
        scores = after

    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0).cast("bigint")).alias(kind)

    return scores.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for every row of ``pages``.

    Without a rule, a page is blocked if its host has more distrust than trust and at least a hundredth of a seed of it.
    Links of a page are the hosts of its ``href`` and ``src`` values. Null urls and urls without ``://`` have an empty host and path and are allowed; null and empty pages have no links;
    repeated pages count once as links and each as a seed's vote; an empty table gives an empty one.
    """
    ruled = with_rules(pages.select("page_id", "url", "html"), rules)
    placed = ruled.select("page_id", "host", "path", "rule", "ruled").join(host_scores(ruled), "host", "left")
    placed = placed.fillna(0, ["trust", "distrust"])
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= LEAST_DISTRUST)
    verdict = F.coalesce("ruled", F.when(bad, "block").otherwise("allow"))
    return placed.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")


def judge_sql() -> str:
    """The same in SQL; the recursion ends when the sum of all scores, none of which ever falls, stays as it is."""
    longest = sorted(RULES, key=lambda rule: (-len(rule.name), rule.name))
    fit = lambda r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"
    cases = lambda value: "CASE " + " ".join(f"WHEN {fit(r)} THEN '{value(r)}'" for r in longest) + " END"
    lower = f"translate({{}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return rf"""
WITH RECURSIVE cut AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
placed AS (
  SELECT page_id, html, {lower.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
ruled AS (SELECT *, {cases(lambda r: r.name)} AS rule, {cases(lambda r: r.verdict)} AS ruled FROM placed),
votes AS (
  SELECT host, count(*) FILTER (ruled = 'allow') AS allowed, count(*) FILTER (ruled = 'block') AS blocked FROM ruled GROUP BY host),
s0 AS (
  SELECT CASE WHEN allowed > blocked THEN 'trust' ELSE 'distrust' END AS kind, host,
         CAST({UNIT * (100 - DAMPING_PERCENT) // 100} AS BIGINT) AS score
  FROM votes WHERE allowed <> blocked),
named AS (
  SELECT host AS src, unnest(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1)) AS name FROM ruled WHERE host <> ''),
links AS (
  SELECT DISTINCT src, {lower.format("name")} AS dst FROM named
  WHERE {lower.format("name")} IN (SELECT host FROM ruled) AND src <> {lower.format("name")}),
both_ways AS (
  SELECT 'trust' AS kind, src AS host, dst AS dest FROM links UNION ALL SELECT 'distrust', dst, src FROM links),
degrees AS (SELECT kind, host, count(*) AS degree FROM both_ways GROUP BY kind, host),
arcs AS (SELECT b.kind, b.host, b.dest, d.degree FROM both_ways b JOIN degrees d ON b.kind = d.kind AND b.host = d.host),
rounds AS (
  SELECT 0 AS round, kind, host, score FROM s0
  UNION ALL
  SELECT round, kind, host, score FROM (
    SELECT round, kind, host, CAST(sum(score) AS BIGINT) AS score, CAST(sum(sum(score)) OVER () AS BIGINT) AS total, any_value(before) AS before
    FROM (
      SELECT s.round + 1 AS round, a.kind, a.dest AS host, s.score * {DAMPING_PERCENT} // (100 * a.degree) AS score, t.before
      FROM arcs a JOIN rounds s ON a.kind = s.kind AND a.host = s.host, (SELECT sum(score) AS before FROM rounds) t
      UNION ALL SELECT t.round + 1, s0.kind, s0.host, s0.score, t.before
      FROM s0, (SELECT max(round) AS round, sum(score) AS before FROM rounds) t WHERE t.round IS NOT NULL)
    GROUP BY round, kind, host)
  WHERE total > before),
last_round AS (SELECT * FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
scores AS (
  SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS trust, coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS distrust
  FROM last_round GROUP BY host)
SELECT page_id, r.host AS host, path, rule,
       coalesce(ruled, CASE WHEN coalesce(distrust, 0) > coalesce(trust, 0) AND coalesce(distrust, 0) >= {LEAST_DISTRUST}
                            THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(coalesce(trust, 0) AS BIGINT) AS trust, CAST(coalesce(distrust, 0) AS BIGINT) AS distrust
FROM ruled r LEFT JOIN scores s ON r.host = s.host"""
