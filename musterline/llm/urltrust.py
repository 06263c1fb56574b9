"""URL filters: explicit rules, and link-graph propagation for hosts that no rule settles, in DataFrame operations only.

Trust is personalised PageRank from hosts with allowed pages along host edges; distrust is the same from hosts with
blocked pages along reversed edges. Host edges are links between hosts (absolute or protocol-relative ``href``) weighted
by number, and one edge each way between a host and its parent domain. A host whose distrust outweighs its trust is blocked.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import saved, shared_dir, text_of

#: The rules of the registered query: verdict and pattern (host, then path prefix).
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))

TOLERANCE = 1e-6
ROUNDS = 8  # walked in one plan, between two looks at what has moved
SPLIT = 1 << 18  # edges of a source that stay together

LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (verdict, rule) that fits host and path, null if none does; ties go to the first given."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, _, prefix = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + prefix)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url_col: str = "url", html_col: str | None = "html") -> DataFrame:
    """(a, b, n): the pages of host a that link to host b, and as (a, a) the pages of host a; one pass over the pages."""
    to = F.array_distinct(F.transform(F.regexp_extract_all(text_of(html_col), F.lit(LINK), 1), lower_ascii)) if html_col else F.array().cast("array<string>")
    own = pages.select(host_of(F.col(url_col)).alias("a"), to.alias("to")).where("a != ''")
    return own.select("a", F.explode(F.array_union(F.array("a"), "to")).alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))


def host_edges(links: DataFrame) -> DataFrame:
    """(a, b, w): weighted edges between different hosts of ``links`` (a, b, n), links and the domain tree together."""
    labels = F.split("b", r"\.", -1)
    # the name from each label on and its parent, as long as no label is empty
    chain = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.when(~F.array_contains(F.slice(labels, 1, i), ""), F.struct(
        F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("a"), F.array_join(F.slice(labels, i + 1, F.size(labels)), ".").alias("b"))))
    up = links.select("b").distinct().select(F.explode(chain).alias("e")).select("e.a", "e.b")
    up = up.where("b like '%.%'").distinct().withColumn("w", F.lit(1.0))
    linked = links.where("a != b and b != ''").select("a", "b", F.col("n").cast("double").alias("w"))
    return up.union(up.select("b", "a", "w")).union(linked).groupBy("a", "b").agg(F.sum("w").alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, threshold: float = 1.0, tolerance: float = TOLERANCE, damping: float = 0.85) -> DataFrame:
    """(host, trust, distrust) of edges (a, b, w) and seeds (host, good, bad).

    Both walks start from their seeds' own share and go over one table of directed shares, so ranks only grow and no host
    ever moves by a larger part of itself than the largest move of the round before. The walk ends when that largest move is
    at most ``tolerance``, or when every host is reached and twice the geometric rest of the largest move turns no host's
    comparison of distrust with ``threshold`` * trust. A source of many edges is split, its rank going to every part. Mass
    at a host without edges stays out of the walk.
    """
    shared_dir(edges.sparkSession)
    edges = saved(edges.where("w > 0"))
    out = saved(edges.groupBy("a").agg(F.sum("w").alias("total")))  # written, so that adaptive execution may split the join
    into = saved(edges.groupBy("b").agg(F.sum("w").alias("total")))
    forward = edges.join(out, "a").select(F.col("a").alias("src"), F.col("b").alias("dst"), (F.col("w") / F.col("total")).alias("t"), F.lit(0.0).alias("d"))
    backward = edges.join(into, "b").select(F.col("b").alias("src"), F.col("a").alias("dst"), F.lit(0.0).alias("t"), (F.col("w") / F.col("total")).alias("d"))
    flow = saved(forward.union(backward).groupBy("src", "dst").agg(F.sum("t").alias("t"), F.sum("d").alias("d")))
    parts = saved(flow.groupBy("src").agg((1 + F.count("*") / SPLIT).cast("int").alias("parts")))
    flow = saved(flow.join(parts, "src").select("src", F.pmod(F.xxhash64("dst"), "parts").cast("int").alias("part"), "dst", "t", "d"))
    sums = seeds.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).first()
    share = lambda c, total: (1 - damping) * F.coalesce(F.col(c) / F.lit(float(total or 1)), F.lit(0.0))
    hosts = parts.select(F.col("src").alias("host"), "parts").union(flow.select("dst", F.lit(1))).union(seeds.select("host", F.lit(1))).groupBy("host").agg(F.max("parts").alias("parts"))
    nodes = saved(hosts.join(seeds, "host", "left").select("host", "parts", share("good", sums["g"]).alias("trust"), share("bad", sums["b"]).alias("distrust")))
    own = nodes.select("host", "parts", "trust", "distrust", F.lit(0.0).alias("old_t"), F.lit(0.0).alias("old_d"))
    ranks = nodes
    for i in count(1):
        spread = ranks.select(F.col("host").alias("src"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "trust", "distrust")
        sent = flow.join(spread, ["src", "part"]).select(F.col("dst").alias("host"), F.lit(1).alias("parts"), (damping * F.col("t") * F.col("trust")).alias("trust"), (damping * F.col("d") * F.col("distrust")).alias("distrust"), F.lit(0.0), F.lit(0.0))
        both = own.union(sent)
        if i % ROUNDS == 0:
            both = both.union(ranks.select("host", "parts", F.lit(0.0), F.lit(0.0), "trust", "distrust"))
        ranks = both.groupBy("host").agg(F.max("parts").alias("parts"), *[F.sum(c).alias(c) for c in ("trust", "distrust", "old_t", "old_d")])
        if i % ROUNDS == 0:
            ranks = ranks.checkpoint()
            move = lambda new, old: F.coalesce(F.abs(F.col(new) - F.col(old)) / F.nullif(F.col(new), F.lit(0.0)), F.lit(0.0))
            good, bad = threshold * F.col("trust"), F.col("distrust")
            found = ranks.agg(
                F.coalesce(F.max(F.greatest(move("trust", "old_t"), move("distrust", "old_d"))), F.lit(0.0)).alias("move"),
                F.coalesce(F.min(F.abs(bad - good) / F.nullif(bad + good, F.lit(0.0))), F.lit(1.0)).alias("margin"),
            ).first()
            if found["move"] <= tolerance or found["move"] < 1 and found["margin"] > 2 * found["move"] * damping / (1 - damping):
                return ranks.select("host", "trust", "distrust")


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", threshold: float = 1.0) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust.

    The longest fitting rule decides; without one the page's host is blocked if distrust > ``threshold`` * trust and allowed
    otherwise, so a host that no walk reaches is allowed. Null urls and urls without ``://`` have empty host and path and
    are allowed; null html has no links; null ids and repeated rows stay. An empty table gives no rows.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    own = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")).withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    tally = lambda v: F.sum((F.col("found.verdict") == v).cast("double"))
    seeds = saved(own.where("host != '' and found is not null").groupBy("host").agg(tally("allow").alias("good"), tally("block").alias("bad")))
    ranks = propagate(host_edges(saved(host_links(pages, url_col, html_col))), seeds, threshold)
    blocked = F.col("distrust") > threshold * F.col("trust") * (1 + 10 * TOLERANCE)  # what the walks have left to move decides nothing
    verdicts = ranks.select(F.col("host").alias("of"), F.when(blocked, "block").otherwise("allow").alias("method"), "trust", "distrust")
    return own.join(verdicts, F.col("host") == F.col("of"), "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", "method", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


#: The walk of the query in a hundred rounds, which leave less than a ten-millionth to move.
ORACLE = r"""
WITH RECURSIVE p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, coalesce(html, '') AS html
  FROM pages
), rules(verdict, rule, domain, prefix) AS (
  VALUES ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'), ('allow', 'net/de/', 'net', '/de/'),
         ('block', 'example.net/de/8', 'example.net', '/de/8'), ('block', 'org/es/', 'org', '/es/')
), own AS (
  SELECT p.page_id, p.host, p.path, (
    SELECT max_by({'verdict': verdict, 'rule': rule}, length(rule)) FROM rules
    WHERE (p.host = domain OR ends_with(p.host, '.' || domain)) AND starts_with(p.path, prefix)
  ) AS found FROM p
), links AS (
  SELECT host AS a, translate(unnest(list_distinct(regexp_extract_all(html, '(?i)href\s*=\s*["'']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"''\s<>]+)', 1))),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS b, rowid_ FROM (SELECT *, row_number() OVER () AS rowid_ FROM p) WHERE host != ''
), linked AS (
  SELECT a, b, count(DISTINCT rowid_)::DOUBLE AS w FROM links WHERE a != b AND b != '' GROUP BY a, b
), labels AS (
  SELECT DISTINCT string_split(h, '.') AS l FROM (SELECT host AS h FROM p WHERE host != '' UNION SELECT b FROM linked)
), chain AS (
  SELECT l, unnest(range(1, len(l))) AS i FROM labels
), up AS (
  SELECT DISTINCT array_to_string(l[i:], '.') AS a, array_to_string(l[i + 1:], '.') AS b FROM chain WHERE NOT list_contains(l[1:i], '') AND len(l) - i >= 2
), edges AS (
  SELECT a, b, sum(w) AS w FROM (SELECT a, b, 1.0::DOUBLE AS w FROM up UNION ALL SELECT b, a, 1.0 FROM up UNION ALL SELECT * FROM linked) GROUP BY a, b
), flow AS (
  SELECT src, dst, sum(t) AS t, sum(d) AS d FROM (
    SELECT a AS src, b AS dst, w / sum(w) OVER (PARTITION BY a) AS t, 0.0::DOUBLE AS d FROM edges
    UNION ALL SELECT b, a, 0.0, w / sum(w) OVER (PARTITION BY b) FROM edges
  ) GROUP BY src, dst
), seeds AS (
  SELECT host, 0.15 * good / nullif(sum(good) OVER (), 0) AS st, 0.15 * bad / nullif(sum(bad) OVER (), 0) AS sd FROM (
    SELECT host, count(*) FILTER (found.verdict = 'allow')::DOUBLE AS good, count(*) FILTER (found.verdict = 'block')::DOUBLE AS bad
    FROM own WHERE host != '' AND found IS NOT NULL GROUP BY host
  )
), nodes AS (
  SELECT host, coalesce(st, 0) AS st, coalesce(sd, 0) AS sd FROM (SELECT src AS host FROM flow UNION SELECT host FROM seeds) LEFT JOIN seeds USING (host)
), walk(i, host, trust, distrust) AS (
  SELECT 0, host, st, sd FROM nodes
  UNION ALL
  SELECT s.i, n.host, n.st + coalesce(s.t, 0), n.sd + coalesce(s.d, 0) FROM nodes n JOIN (
    SELECT (SELECT max(i) + 1 FROM walk) AS i, m.host, sum(0.85 * f.t * w.trust) AS t, sum(0.85 * f.d * w.distrust) AS d
    FROM nodes m LEFT JOIN flow f ON f.dst = m.host LEFT JOIN walk w ON w.host = f.src GROUP BY m.host
  ) s USING (host) WHERE s.i <= 100
), verdicts AS (
  SELECT host, CASE WHEN distrust > trust * 1.00001 THEN 'block' ELSE 'allow' END AS method FROM walk WHERE i = 100
)
SELECT own.page_id, own.host, own.path, own.found.rule AS rule, coalesce(own.found.verdict, v.method, 'allow') AS verdict
FROM own LEFT JOIN verdicts v ON v.host = own.host
"""
