"""URL filter: host and path rules, and for what no rule judges, trust and distrust spread over the host graph.

Edges are links between hosts, and one each way between a host and the domain above it. Trust is a personalised PageRank
along the edges from hosts whose pages the rules allow, as a share of the PageRank that the host has if every host is
trusted. Distrust goes against the edges: a host has its blocked share, and for the share of its pages that no rule
judges the damped mean distrust of what it links to. Both lie between 0 and 1 and shrink neither with the number of
hosts nor with how many link to the same one. A host is blocked where its distrust reaches a threshold and passes its
trust. Everything is a DataFrame expression; per round there is one join on the source host and one pre-aggregated sum.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut

#: Fixed rules of the production list: host and path, and what pages under them get.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: An anchor with an absolute or protocol-relative target; the group is its host.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
DAMPING = 0.85
#: What is left out after so many rounds is DAMPING ** ROUNDS (under 4 %) of a score at most.
ROUNDS = 20
ROUNDS_A_CUT = 5
#: A host without links is blocked if the rules block at least this share of its pages.
THRESHOLD = 0.5
#: Scores are compared after rounding to so many digits, so the order of a sum does not matter.
DIGITS = 9


def lower_ascii(s: Column) -> Column:
    return F.translate(s, string.ascii_uppercase, string.ascii_lowercase)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Add host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; and path: from there up to `?`,
    `#` or the end. Null url, or no `://`: both empty."""
    rest = F.expr("CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END")
    return pages.withColumn("host", lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0))).withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def longest_rule(rules: dict[str, str]) -> Column:
    """The longest rule that fits host and path, or null: a rule fits its host and all subdomains if the path starts
    with the rule's. The rules are a parameter, so the expression's size does not grow with the data."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        host, _, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        found = F.when(fits, rule).otherwise(found)
    return found


def verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    verdict = F.lit(None).cast("string")
    for name, says in rules.items():
        verdict = F.when(rule == name, says).otherwise(verdict)
    return verdict


def domain_edges(hosts: DataFrame) -> DataFrame:
    """src, dst, n: an edge each way between every host (and domain above a host) and the domain above it, down to
    domains of two labels. Numeric hosts have none above."""
    rows = hosts.where("NOT host RLIKE '^[0-9.:]*$'").select(F.split("host", r"\.").alias("p")).where("size(p) > 2")
    rows = rows.select("p", F.explode(F.expr("sequence(1, size(p) - 2)")).alias("k"))
    up = rows.select(F.expr("array_join(slice(p, k, size(p)), '.')").alias("src"), F.expr("array_join(slice(p, k + 1, size(p)), '.')").alias("dst")).distinct()
    return up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("n", F.lit(1).cast("long"))


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts, counted before the shuffle, and the edges to the domains above."""
    links = pages.where("html LIKE '%//%' AND host <> ''").select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst"))
    links = links.withColumn("dst", lower_ascii(F.col("dst"))).where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))
    return links.unionByName(domain_edges(hosts)).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def spread(base: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """kind, host, score: score = base + damping * (weighted scores that come over the edges), `rounds` times.

    base: kind, host, score; edges: kind, source, target, weight. Scores of a kind depend on base and edges of that kind
    alone. No edges: the base.
    """
    base, edges = cut(base.where("score > 0"), "base"), cut(edges.where("weight > 0"), "edges")
    if edges.isEmpty():
        return base
    now = base
    for k in range(1, rounds + 1):
        moved = edges.join(now.withColumnRenamed("host", "source"), ["kind", "source"])
        moved = moved.select("kind", F.col("target").alias("host"), (damping * F.col("weight") * F.col("score")).alias("score"))
        now = base.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if k % ROUNDS_A_CUT == 0 and k < rounds:
            now = cut(now, "scores")
    return now


def host_scores(hosts: DataFrame, edges: DataFrame) -> DataFrame:
    """host, trust, distrust (0 to 1) of hosts (host, allowed, blocked: shares of their pages) and other ends of edges
    (src, dst, n)."""
    out_of = edges.groupBy("src").agg(F.sum("n").alias("all"))
    edges = edges.join(out_of, "src").withColumn("w", F.col("n") / F.col("all")).join(hosts.withColumnRenamed("host", "src"), "src", "left")
    open_share = F.lit(1.0) - F.coalesce("allowed", F.lit(0.0)) - F.coalesce("blocked", F.lit(0.0))
    kinds = F.array(
        *(F.struct(F.lit(kind).alias("kind"), F.col("src").alias("source"), F.col("dst").alias("target"), F.col("w").alias("weight")) for kind in ("trust", "rank")),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("source"), F.col("src").alias("target"), (F.col("w") * open_share).alias("weight")),
    )
    base = hosts.select("host", F.expr("stack(3, 'trust', allowed, 'rank', 1.0D, 'distrust', blocked) AS (kind, score)")).select("kind", "host", "score")
    scores = spread(base, edges.select(F.inline(kinds)))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    scores = scores.groupBy("host").agg(of("trust").alias("trust"), of("rank").alias("rank"), of("distrust").alias("distrust"))
    return scores.select("host", F.round(F.when(F.col("rank") > 0, F.col("trust") / F.col("rank")).otherwise(0.0), DIGITS).alias("trust"), F.round("distrust", DIGITS).alias("distrust"))


def judge_pages(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages (page_id, url, html, ...).

    Verdict: the longest rule's, else `block` if the host is blocked over the graph, else `allow`. A url without a host
    gets `allow`. Null html has no links. Repeated rows are judged each by itself, and count in their host's shares; so
    does page_id, which may be null or repeat. No rows give no rows; other columns are dropped.
    """
    judged = with_host_and_path(pages.select("page_id", "url", "html")).withColumn("rule", longest_rule(rules)).withColumn("by_rule", verdict_of(F.col("rule"), rules))
    share = lambda says: F.avg(F.when(F.col("by_rule") == says, 1.0).otherwise(0.0))
    hosts = cut(judged.where("host <> ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked")), "hosts")
    scores = host_scores(hosts, cut(host_edges(judged, hosts), "links"))
    blocked = scores.where((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= THRESHOLD))
    blocked = cut(blocked.select("host", F.lit("block").alias("by_host")), "blocked")
    return judged.drop("url", "html").join(blocked, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_host", F.lit("allow")).alias("verdict"))


def _sql() -> str:
    """The same over DuckDB's view `pages`, the rounds written out."""
    fits, says = "CASE", "CASE rule"
    for rule in sorted(RULES, key=lambda r: (-len(r), r)):
        host, _, path = rule.partition("/")
        fits += f" WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') THEN '{rule}'"
        says += f" WHEN '{rule}' THEN '{RULES[rule]}'"
    lower = lambda x: f"translate({x}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    link = LINK.replace("'", "''")
    rounds = ", ".join(
        f"r{k} AS MATERIALIZED (SELECT kind, host, sum(score) AS score FROM (SELECT * FROM r0 UNION ALL SELECT e.kind, e.target, {DAMPING} * e.weight * r.score FROM e JOIN r{k - 1} r ON e.kind = r.kind AND e.source = r.host) GROUP BY ALL)"
        for k in range(1, ROUNDS + 1)
    )
    return f"""
WITH rest AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, {lower("regexp_extract(rest, '^[^/?#]*', 0)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
ruled AS (SELECT *, {fits} END AS rule FROM parts),
judged AS MATERIALIZED (SELECT *, {says} END AS by_rule FROM ruled),
hosts AS MATERIALIZED (SELECT host, avg(CASE WHEN by_rule = 'allow' THEN 1.0 ELSE 0.0 END) AS allowed, avg(CASE WHEN by_rule = 'block' THEN 1.0 ELSE 0.0 END) AS blocked FROM judged WHERE host <> '' GROUP BY host),
links AS (SELECT host AS src, {lower("unnest(regexp_extract_all(html, '" + link + "', 1))")} AS dst FROM judged WHERE host <> ''),
above AS (SELECT DISTINCT array_to_string(p[k:], '.') AS src, array_to_string(p[k + 1:], '.') AS dst FROM (SELECT p, unnest(range(1, len(p) - 1)) AS k FROM (SELECT string_split(host, '.') AS p FROM hosts WHERE NOT regexp_full_match(host, '[0-9.:]*')))),
edges AS (SELECT src, dst, count(*) AS n FROM (SELECT * FROM links WHERE src <> dst UNION ALL SELECT src, dst FROM above UNION ALL SELECT dst, src FROM above) GROUP BY ALL),
w AS MATERIALIZED (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS w, 1.0 - coalesce(allowed, 0.0) - coalesce(blocked, 0.0) AS free FROM edges LEFT JOIN hosts ON src = host),
e AS MATERIALIZED (SELECT 'trust' AS kind, src AS source, dst AS target, w AS weight FROM w UNION ALL SELECT 'rank', src, dst, w FROM w UNION ALL SELECT 'distrust', dst, src, w * free FROM w),
r0 AS MATERIALIZED (SELECT 'trust' AS kind, host, allowed AS score FROM hosts UNION ALL SELECT 'rank', host, 1.0 FROM hosts UNION ALL SELECT 'distrust', host, blocked FROM hosts),
{rounds},
both_ AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS t, coalesce(sum(score) FILTER (kind = 'rank'), 0) AS p, round(coalesce(sum(score) FILTER (kind = 'distrust'), 0), {DIGITS}) AS distrust FROM r{ROUNDS} GROUP BY host),
bad AS (SELECT host FROM both_ WHERE distrust >= {THRESHOLD} AND distrust > CASE WHEN p > 0 THEN round(t / p, {DIGITS}) ELSE 0 END)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' END, 'allow') AS verdict FROM judged
"""


ORACLE_SQL = _sql()
