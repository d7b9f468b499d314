"""URL filters: path rules first, then the reputation of the host.

Rules such as ``org/`` or ``example.org/en/1`` fit a host and its subdomains
where the url's path starts with the rule's; the longest wins.  A url without
a rule is judged by its host.  Labelled page outcomes are shrunk through
beta-binomial priors from suffix to registered domain to host (empirical
Bayes): each level's prior mean is its parent's posterior mean, each level's
prior strength comes from the method of moments over all groups of the level.
A host is blocked where the odds of a bad page at a lower bound of its posterior
are above a multiple of the overall odds, so a host with few labels follows its
domain and is not blocked for one bad page.

DataFrame functions only.  Pages are aggregated to one row per host before
anything is joined; a host with a third of all pages is one row of counts, and
the join of that table back to the pages is a broadcast where its bytes are
below Spark's threshold and else a sort-merge join whose hot partitions
adaptive execution splits.

Defined results: a null url or one without ``://`` has an empty host and path
(and as the empty host's pages it gets that host's verdict); null page ids and
repeated rows are kept as they are; null labels count for nothing, pages
labelled more than once count each time; without any label every posterior is
the neutral prior mean and nothing is blocked by it; columns other than the
ones named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith.llm.registry import ascii_lower, materialise, query, table

#: Second-level labels under which names are registered (fixed values, a documented subset).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def registered_domain(host: Column) -> Column:
    """The last two labels, or three below a second-level label such as co.uk."""
    labels = F.split(host, "\\.")
    n = F.size(labels)
    second = F.element_at(labels, F.when(n >= 2, -2).otherwise(-1))
    short = (F.length(F.element_at(labels, -1)) == 2) & second.isin(*SECOND_LEVEL)
    keep = F.least(n, F.when(short, 3).otherwise(2))
    return F.array_join(F.slice(labels, n - keep + 1, keep), ".")


def domain_suffix(domain: Column) -> Column:
    """What follows the registered name (a name of one label is its own suffix)."""
    rest = F.regexp_extract(domain, "^[^.]*\\.(.*)$", 1)
    return F.when(rest == "", domain).otherwise(rest)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(length, rule, verdict) of the longest rule that fits, else null.

    The rules are the caller's list, so they are part of the expression: no
    join and no shuffle.  Of two equally long rules the greater text wins.
    """
    fits = []
    for verdict, rule in rules:
        at, slash, rest = rule.partition("/")
        ok = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        fits.append(F.when(ok, F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"),
                                        F.lit(verdict).alias("verdict"))))
    if not fits:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    return F.array_max(F.array(*fits))


def _strength(groups: DataFrame, n: str, k: str) -> DataFrame:
    """Method-of-moments prior strength (a + b) of a beta-binomial over groups with n > 0."""
    g = groups.where(F.col(n) > 0).agg(
        F.count("*").alias("g"), F.sum(n).cast("double").alias("n"), F.sum(k).cast("double").alias("k"),
        F.sum(F.col(k) * F.col(k) / F.col(n)).alias("kk"),
        F.sum((F.col(n) * F.col(n)).cast("double")).alias("nn"))
    p = F.col("k") / F.col("n")
    var = p * (1 - p)
    spread = F.col("kk") - F.col("n") * p * p
    room = F.col("n") - F.col("nn") / F.col("n") - (F.col("g") - 1)
    rho = F.when((var > 0) & (room > 0), (spread / var - (F.col("g") - 1)) / room)
    rho = F.greatest(F.lit(0.001), F.least(F.lit(0.9), F.coalesce(rho, F.lit(0.001))))
    return g.select((1 / rho - 1).alias("strength"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """One row per host: n, bad, the posterior's mean and its lower bound, and the overall rate.

    pages: page_id, host.  outcomes: page_id, bad (0, 1 or null).
    """
    lab = outcomes.where(F.col("bad").isNotNull()).select(F.col("page_id").alias("_p"), "bad")
    lab = lab.groupBy("_p").agg(F.count("*").alias("_n"), F.sum("bad").alias("_k"))
    hosts = (pages.select("page_id", "host").join(lab, F.col("page_id") == F.col("_p"), "left")
             .groupBy("host").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
                                  F.coalesce(F.sum("_k"), F.lit(0)).alias("bad"))
             .withColumn("domain", registered_domain(F.col("host")))
             .withColumn("suffix", domain_suffix(F.col("domain"))))
    hosts = materialise(hosts, "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("d_n"), F.sum("bad").alias("d_k"))
    tops = domains.groupBy("suffix").agg(F.sum("d_n").alias("s_n"), F.sum("d_k").alias("s_k"))
    # three numbers and the overall rate: one row, whatever the input
    one = (tops.agg(F.sum("s_n").alias("n"), F.sum("s_k").alias("k")).first())
    mean = (one.k / one.n) if one.n else 0.5
    s_w = _strength(tops, "s_n", "s_k").first().strength
    d_w = _strength(domains, "d_n", "d_k").first().strength
    h_w = _strength(hosts, "n", "bad").first().strength

    tops = tops.withColumn("s_mean", (F.col("s_k") + mean * s_w) / (F.col("s_n") + s_w))
    domains = (domains.join(tops.select("suffix", "s_mean"), "suffix")
               .withColumn("d_mean", (F.col("d_k") + F.col("s_mean") * d_w) / (F.col("d_n") + d_w)))
    hosts = hosts.join(domains.select("domain", "d_mean"), "domain")
    a = F.col("bad") + F.col("d_mean") * h_w
    b = F.col("n") - F.col("bad") + (1 - F.col("d_mean")) * h_w
    return (hosts.withColumn("overall", F.lit(float(mean))).withColumn("mean", a / (a + b))
            .withColumn("bound", F.col("mean") - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]],
                z: float = 1.645, excess: float = 2.0) -> DataFrame:
    """pages (page_id, url) -> page_id, host, path, rule, verdict, mean, bound.

    A host is blocked if the odds at its lower bound are above ``excess`` times the overall odds.
    """
    p = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rep = materialise(host_reputation(p, outcomes, z).select("host", "mean", "bound", "overall"), "reputation")
    hit = matched_rule(F.col("host"), F.col("path"), rules)
    worse = F.col("bound") * (1 - F.col("overall")) > excess * F.col("overall") * (1 - F.col("bound"))
    by_host = F.when(worse, F.lit("block")).otherwise(F.lit("allow"))
    return (p.join(rep, "host", "left").withColumn("_hit", hit)
            .select("page_id", "host", "path", F.col("_hit.rule").alias("rule"),
                    F.coalesce(F.col("_hit.verdict"), by_host).alias("verdict"), "mean", "bound"))


SQL = f"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
lab AS (SELECT doc_id, count(*) AS n,
               sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS k
        FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
h0 AS (SELECT host, coalesce(sum(n), 0)::DOUBLE AS n, coalesce(sum(k), 0)::DOUBLE AS k,
              string_split(host, '.') AS l
       FROM p LEFT JOIN lab ON page_id = doc_id GROUP BY host),
h1 AS (SELECT *, CASE WHEN len(l) >= 3 AND length(l[-1]) = 2
                       AND l[-2] IN ({", ".join(f"'{x}'" for x in SECOND_LEVEL)}) THEN 3 ELSE 2 END AS m FROM h0),
h AS (SELECT host, n, k, array_to_string(l[greatest(len(l) - m + 1, 1):], '.') AS domain FROM h1),
d0 AS (SELECT domain, CASE WHEN strpos(domain, '.') = 0 THEN domain
                          ELSE substr(domain, strpos(domain, '.') + 1) END AS suffix,
              sum(n) AS n, sum(k) AS k FROM h GROUP BY 1),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d0 GROUP BY 1),
lev AS (SELECT 's' AS lev, n, k FROM s0 UNION ALL SELECT 'd', n, k FROM d0 UNION ALL SELECT 'h', n, k FROM h),
m0 AS (SELECT lev, count(*) - 1 AS g, sum(n) AS n, sum(k) / sum(n) AS p, sum(k * k / n) AS kk, sum(n * n) AS nn
       FROM lev WHERE n > 0 GROUP BY lev),
m1 AS (SELECT lev, ((kk - n * p * p) / (p * (1 - p)) - g) / (n - nn / n - g) AS rho,
              n - nn / n - g AS room, p * (1 - p) AS var FROM m0),
w AS (SELECT lev, 1 / greatest(0.001, least(0.9, CASE WHEN var > 0 AND room > 0 THEN rho ELSE 0.001 END)) - 1 AS w
      FROM m1),
s AS (SELECT suffix, (k + (SELECT sum(k) / sum(n) FROM s0) * w) / (n + w) AS mean FROM s0, w WHERE lev = 's'),
d AS (SELECT domain, (k + s.mean * w) / (n + w) AS mean FROM d0 JOIN s USING (suffix), w WHERE lev = 'd'),
b AS (SELECT host, k + d.mean * w AS a, n - k + (1 - d.mean) * w AS b FROM h JOIN d USING (domain), w WHERE lev = 'h'),
rep AS (SELECT host, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM b),
rules(rule, rhost, rpath, rv) AS (VALUES {", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for v, r in RULES)}),
fit AS (SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(rv, length(rule)) AS rv
        FROM (SELECT DISTINCT host, path FROM p), rules
        WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY 1, 2)
SELECT page_id, p.host, p.path, rule,
       coalesce(rv, CASE WHEN bound * (1 - rate) > 2.0 * rate * (1 - bound) THEN 'block' ELSE 'allow' END) AS verdict
FROM p CROSS JOIN (SELECT sum(k) / sum(n) AS rate FROM s0) LEFT JOIN rep USING (host) LEFT JOIN fit ON fit.host = p.host AND fit.path = p.path
"""


@query("op10_url_filters", SQL)
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages; outcomes: ``labels`` read by page_id = doc_id, bad if low quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = (table(spark, sf_dir, "labels").where("quality IS NOT NULL AND toxic IS NOT NULL")
                .select(F.col("doc_id").alias("page_id"), bad.alias("bad")))
    out = filter_urls(table(spark, sf_dir, "pages"), outcomes, RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")
