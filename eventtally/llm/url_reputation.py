"""URL filter: fixed rules first, then the reputation of the host.

The reputation of a host is the rate of bad outcomes among its labelled pages, shrunk
by beta-binomial priors: a host towards its registered domain, that towards its suffix, that
towards all pages. How hard a level shrinks is estimated from how much the rates of its members
differ beyond chance, and how unsure a prior is is passed on to what it is a prior of. A host is blocked when the lower bound of its posterior is above
the rate a user accepts.

Defined cases: a null url or one without "://" has an empty host and path and fits no rule; all
such pages share the empty host's reputation. A page or outcome counts as often as it occurs.
With no outcomes at all the rate is the prior's, 0.5 with a wide bound, and nothing is blocked.
Columns of the input keep their names unless they clash with host, path, rule or verdict, which
are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.functions.skew import lookup_join
from eventtally.llm.common import ascii_lower, query, table
from eventtally.session import stored

# Up to the first "://", then the host, then the path.
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

# A strength is held within these, so that neither one page nor any number decides alone.
WEAKEST, STRONGEST = 1.0, 10000.0


@dataclass(frozen=True)
class Rule:
    """Fits a host with all its subdomains, below a path."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    empty = F.lit("")
    host = F.coalesce(ascii_lower(F.regexp_extract(url, URL, 1)), empty)
    return host, F.coalesce(F.regexp_extract(url, URL, 2), empty)


def decided(rules: tuple[Rule, ...], host: Column, path: Column, pick: str) -> Column:
    """One attribute of the longest rule that fits, or null."""
    first = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (len(rule.text), rule.text)):
        first = F.when(rule.fits(host, path), F.lit(getattr(rule, pick))).otherwise(first)
    return first


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def domain_of(host: Column) -> Column:
    """The label before the suffix, with the suffix."""
    return F.substring_index(host, ".", -2)


def shrunk(level: DataFrame, key: str) -> DataFrame:
    """The posterior mean and variance of each member, given its prior mean and how sure that is.

    `level` has key, n, bad, prior and doubt (the variance of prior). The strength follows from the spread of the
    members' rates by moments: X = sum n (rate - prior)^2 / (prior (1 - prior)) is the number of
    members when they differ by chance alone.
    """
    room = F.greatest(F.col("prior") * (1 - F.col("prior")), F.lit(1e-9))
    rate = F.col("bad") / F.col("n")
    spread = level.filter("n > 0").agg(
        F.sum(F.col("n") * (rate - F.col("prior")) * (rate - F.col("prior")) / room).alias("x"),
        F.count(F.lit(1)).alias("members"),
        F.sum(F.col("n") - 1).alias("freedom"),
    )
    excess = F.greatest((F.col("x") - F.col("members")) / F.col("freedom"), F.lit(1e-9))
    found = spread.select(
        F.when(
            F.col("freedom") > 0,
            F.least(F.greatest(1 / excess - 1, F.lit(WEAKEST)), F.lit(STRONGEST)),
        )
        .otherwise(F.lit(WEAKEST))
        .alias("strength")
    ).first()["strength"]
    total = F.col("n") + F.lit(found)
    share = F.lit(found) / total
    return level.withColumn("mean", (F.col("bad") + F.lit(found) * F.col("prior")) / total).withColumn(
        "variance",
        F.col("mean") * (1 - F.col("mean")) / (total + 1) + share * share * F.col("doubt"),
    )


def host_reputation(outcomes: DataFrame, bound: float = 1.645) -> DataFrame:
    """host, rate and lowest (the posterior's lower bound) of every host in `outcomes`.

    `outcomes` has host and bad; a null bad is a page without a label. Rows of a host are
    summed before they are shuffled; above that, each level holds one row per member.
    """
    hosts = stored(
        outcomes.groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad"))
        .withColumn("domain", domain_of(F.col("host")))
        .withColumn("suffix", suffix_of(F.col("host"))),
        "hosts",
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    every = suffixes.agg(*sums).first()
    labelled = every["n"] or 0
    overall = ((every["bad"] or 0) + 1) / (labelled + 2)
    doubt = overall * (1 - overall) / (labelled + 3)
    passed_on = [F.col("mean").alias("prior"), F.col("variance").alias("doubt")]
    top = shrunk(suffixes.withColumns({"prior": F.lit(overall), "doubt": F.lit(doubt)}), "suffix")
    middle = shrunk(domains.join(top.select("suffix", *passed_on), "suffix"), "domain")
    low = shrunk(hosts.join(middle.select("suffix", "domain", *passed_on), ["suffix", "domain"]), "host")
    return low.select(
        "host",
        F.col("mean").alias("rate"),
        (F.col("mean") - bound * F.sqrt("variance")).alias("lowest"),
    )


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    accepted_rate: float = 0.25,
    url: str = "url",
) -> DataFrame:
    """The pages with host, path, rule, verdict and the rate of the host.

    `outcomes` has url and bad (boolean or null). The table of hosts is measured before
    it is sent to the pages; a large one is joined with hot hosts cut into parts.
    """
    host, path = host_and_path(F.col(url))
    labelled = outcomes.select(host_and_path(F.col("url"))[0].alias("host"), "bad")
    reputation = host_reputation(labelled).select("host", F.col("rate").alias("host_rate"), "lowest")
    # All columns in one, so that none can clash with those added here.
    packed = pages.select(F.struct("*").alias("page"), host.alias("host"), path.alias("path"))
    known = lookup_join(packed, reputation, ["host"], ["path"], "left")
    by_rule = decided(rules, F.col("host"), F.col("path"), "verdict")
    by_host = F.when(F.col("lowest") > accepted_rate, F.lit("block")).otherwise(F.lit("allow"))
    added = ("host", "path", "host_rate", "rule", "verdict")
    return known.select(
        *(F.col(f"page.`{c}`").alias(c) for c in pages.columns if c not in added),
        "host",
        "path",
        "host_rate",
        decided(rules, F.col("host"), F.col("path"), "text").alias("rule"),
        F.coalesce(by_rule, by_host).alias("verdict"),
    )


OP2_SQL = """
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
      THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/')
      THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule FROM parts),
hosts AS (
  SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
    string_split(host, '.')[-1] AS suffix,
    count(doc_id) AS n, coalesce(sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END), 0) AS bad
  FROM parts LEFT JOIN labels ON page_id = doc_id GROUP BY ALL),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
every AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS o, coalesce(sum(n), 0) AS labelled FROM suffixes),
top0 AS (SELECT suffixes.*, o AS prior, o * (1 - o) / (labelled + 3) AS doubt FROM suffixes, every),
top AS (SELECT *, (bad + k * prior) / (n + k) AS mean,
  mean * (1 - mean) / (n + k + 1) + (k / (n + k)) * (k / (n + k)) * doubt AS variance FROM top0, (
  SELECT CASE WHEN sum(n - 1) > 0 THEN least(greatest(1 / greatest(
    (sum(n * (bad / n - prior) * (bad / n - prior) / greatest(prior * (1 - prior), 1e-9)) - count(*)) / sum(n - 1), 1e-9) - 1, 1), 10000) ELSE 1 END AS k
  FROM top0 WHERE n > 0)),
mid0 AS (SELECT d.*, t.mean AS prior, t.variance AS doubt FROM domains d JOIN top t USING (suffix)),
mid AS (SELECT *, (bad + k * prior) / (n + k) AS mean,
  mean * (1 - mean) / (n + k + 1) + (k / (n + k)) * (k / (n + k)) * doubt AS variance FROM mid0, (
  SELECT CASE WHEN sum(n - 1) > 0 THEN least(greatest(1 / greatest(
    (sum(n * (bad / n - prior) * (bad / n - prior) / greatest(prior * (1 - prior), 1e-9)) - count(*)) / sum(n - 1), 1e-9) - 1, 1), 10000) ELSE 1 END AS k
  FROM mid0 WHERE n > 0)),
low0 AS (SELECT h.*, m.mean AS prior, m.variance AS doubt FROM hosts h JOIN mid m USING (suffix, domain)),
low AS (SELECT host, (bad + k * prior) / (n + k) AS mean,
  mean * (1 - mean) / (n + k + 1) + (k / (n + k)) * (k / (n + k)) * doubt AS variance FROM low0, (
  SELECT CASE WHEN sum(n - 1) > 0 THEN least(greatest(1 / greatest(
    (sum(n * (bad / n - prior) * (bad / n - prior) / greatest(prior * (1 - prior), 1e-9)) - count(*)) / sum(n - 1), 1e-9) - 1, 1), 10000) ELSE 1 END AS k
  FROM low0 WHERE n > 0))
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN mean - 1.645 * sqrt(variance) > 0.25 THEN 'block'
  ELSE 'allow' END AS verdict
FROM ruled JOIN low USING (host)
"""


@query(OP2_SQL)
def op2_url_reputation(spark, sf_dir):
    """Every page's verdict; a page is bad when its label says low quality or toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), "quality", "toxic")
    bad = (
        F.when(F.col("quality").isNull() & F.col("toxic").isNull(), None)
        .otherwise(F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
    )
    outcomes = pages.join(labels, "page_id", "left").select("url", bad.alias("bad"))
    return judge_urls(pages, outcomes).select("page_id", "host", "path", "rule", "verdict")
