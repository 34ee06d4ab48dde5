"""URL filters with rules and empirical-Bayes host reputation.

A rule (host and path) fits its host and all subdomains where the url's path
starts with the rule's; of several the longest wins.  Other urls are judged
by their host's reputation: labelled page outcomes are shrunk from host to
registered domain to suffix to the whole by beta-binomial priors.  Each level's
prior strength is estimated from how much more its units differ than chance
would have them, and what a prior leaves uncertain is added below it.  A host is blocked when the lower bound of its posterior
share of bad pages is above the share of the whole, so it is so with fair
certainty worse than pages in general.

A suffix is a host's last label, or its last two where the last is a country's (two
letters) and the one before a general one (``co.uk``, ``com.au``); the registered domain
has one label more.  An address is a domain of its own, and all addresses have one suffix.

The pages are grouped by host before anything is joined, so a hot host is a
row; the verdict comes back to the pages by a join on the host, whose skew
adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import col, materialize

# The bound may be this many times the share of bad pages in the whole.
MAX_RATIO = 1.0
Z = 1.645
# A prior weighs at least so many labels.
MIN_STRENGTH = 4.0
# Second-level labels under which countries register domains, and address forms.
GENERAL = "ac|co|com|edu|gob|gouv|gov|govt|go|id|info|ltd|me|mil|ne|net|nhs|nom|or|org|plc|sch|school"
LONG_SUFFIX = rf"(^|\.)({GENERAL})\.[a-z][a-z]$"
ADDRESS = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[[0-9a-f:.]+\])$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # verdict, host, path


def with_url_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """``pages`` as a struct ``row``, with ``host`` (A-Z lower-cased) and ``path``; both
    empty without ``://`` or for a null url."""
    rows = pages.select(F.struct(*[col(c) for c in pages.columns]).alias("row"),
                        F.coalesce(col(url_col), F.lit("")).alias("url"))
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    return rows.withColumn("rest", rest).select(
        "row", F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), _UPPER, _LOWER).alias("host"),
        F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def with_domain(hosts: DataFrame) -> DataFrame:
    """Adds ``domain`` (registered) and ``suffix`` to rows with a ``host``; a port is
    left aside.  A host that is a suffix itself is its own domain."""
    bare = F.regexp_replace("host", ":[0-9]*$", "")
    labels = F.when(F.col("_bare").rlike(LONG_SUFFIX), 2).otherwise(1)
    address = F.col("_bare").rlike(ADDRESS)

    def last(n: Column) -> Column:
        return F.when(n == 1, F.substring_index("_bare", ".", -1)).when(
            n == 2, F.substring_index("_bare", ".", -2)).otherwise(F.substring_index("_bare", ".", -3))

    return (hosts.withColumn("_bare", bare).withColumn("_n", labels)
            .withColumn("suffix", F.when(address, "address").otherwise(last(F.col("_n"))))
            .withColumn("domain", F.when(address, F.col("_bare")).otherwise(last(F.col("_n") + 1)))
            .drop("_bare", "_n"))


def _strength(units: DataFrame) -> float:
    """The prior's weight in labels, by moments over units ``(n, bad, prior)``: at
    most the number of labels it was learnt from, as with no more spread than
    chance, and at least ``MIN_STRENGTH``."""
    spread = units.agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("prior"), F.lit(2.0))
              - F.col("n") * F.col("prior") * (1 - F.col("prior"))),
        F.sum(F.col("n") * (F.col("n") - 1) * F.col("prior") * (1 - F.col("prior"))), F.sum("n")).first()
    rho = spread[0] / spread[1] if spread[1] else 0.0
    most = float(spread[2] or 0)
    return max(min((1 - rho) / rho, most) if rho > 0 else most, MIN_STRENGTH)


def _shrunk(units: DataFrame, strength: float) -> tuple[Column, Column]:
    """The posterior mean of the share of bad pages, and its variance: that of a beta
    distribution around it, and what the prior's own uncertainty adds."""
    total = F.col("n") + F.lit(strength)
    mean = (F.col("bad") + F.lit(strength) * F.col("prior")) / total
    return mean, mean * (1 - mean) / (total + 1) + F.pow(F.lit(strength) / total, F.lit(2.0)) * F.col("prior_var")


def _as_prior(units: DataFrame, *keys: str) -> DataFrame:
    mean, var = _shrunk(units, _strength(units))
    return units.select(*keys, mean.alias("prior"), var.alias("prior_var"))


def host_reputation(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """``(host, n, bad, mean, low, whole)`` for every distinct non-empty host of ``hosts``
    from ``outcomes`` (``host``, ``bad`` 0 or 1): the posterior mean of the share of bad pages
    and its lower bound, and the share of the whole.  Null outcomes count nothing; without any outcome the
    share is one half and its bound 0, as one label's weight is all there is."""
    seen = (outcomes.filter("host != '' AND bad IS NOT NULL").groupBy("host")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")))
    every = hosts.select("host").filter("host != ''").distinct()
    units = materialize(with_domain(every.join(seen, "host", "left").na.fill(0, ["n", "bad"])), "host-units")
    domains = units.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    n, bad = whole[0] or 0, whole[1] or 0
    share = (bad + 0.5) / (n + 1.0)
    suffixes = suffixes.withColumn("prior", F.lit(share)).withColumn("prior_var", F.lit(share * (1 - share) / (n + 2.0)))
    domains = domains.join(_as_prior(suffixes, "suffix"), "suffix")
    units = units.join(_as_prior(domains, "domain", "suffix"), ["domain", "suffix"])
    mean, var = _shrunk(units, _strength(units))
    low = F.greatest(mean - Z * F.sqrt(var), F.lit(0.0))
    return units.select("host", "n", "bad", mean.alias("mean"), low.alias("low"), F.lit(share).alias("whole"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], id_col: str = "page_id",
               url_col: str = "url", max_ratio: float = MAX_RATIO) -> DataFrame:
    """``(row, host, path, rule, verdict, n, bad, mean, low)`` for every row of ``pages``;
    ``outcomes`` has ``(page_id, bad)``.  ``verdict`` is ``allow`` or ``block``, and the last four
    are the host's labelled pages, the bad ones, its posterior mean and the bound.

    An empty host (null url, no ``://``) fits no rule, has no reputation and is allowed.  A page's
    repeated rows and outcomes all count.  An empty table gives no rows.
    """
    rows = with_url_parts(pages, url_col)
    labelled = rows.select(F.col("row")[id_col].alias("id"), "host").join(
        outcomes.select(F.col("page_id").alias("id"), "bad"), "id").select("host", "bad")
    known = host_reputation(labelled, rows).withColumn(
        "bad_host", F.col("low") > max_ratio * F.col("whole"))
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bad_host"), "block").otherwise("allow")
    return rows.join(known, "host", "left").select(
        "row", "host", "path", name.alias("rule"), F.coalesce(verdict, learned).alias("verdict"),
        "n", "bad", "mean", "low")


def allowed(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], **options) -> DataFrame:
    """The allowed rows of ``pages``, all columns as they are."""
    return judge_urls(pages, outcomes, rules, **options).filter("verdict = 'allow'").select("row.*")


def judge_sql(rules: list[Rule]) -> str:
    """DuckDB SQL for ``page_id, host, path, rule, verdict, n, bad, mean, low``; bad pages are those whose
    label (``labels.doc_id`` is the page id) is toxic or of quality 0."""
    name = verdict = "NULL"
    for what, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        name = f"CASE WHEN {fits} THEN '{host}{path}' ELSE {name} END"
        verdict = f"CASE WHEN {fits} THEN '{what}' ELSE {verdict} END"
    address, long = f"regexp_matches(bare, '{ADDRESS}')", f"regexp_matches(bare, '{LONG_SUFFIX}')"
    tail = lambda n: f"array_to_string(list_slice(string_split(bare, '.'), -{n}, -1), '.')"
    strength = f"""(SELECT greatest(CASE WHEN rho > 0 THEN least((1 - rho) / rho, most) ELSE most END, {MIN_STRENGTH})
    FROM (SELECT CAST(coalesce(sum(n), 0) AS DOUBLE) AS most, coalesce(sum(pow(bad - n * prior, 2.0) - n * prior * (1 - prior))
          / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0), 0) AS rho FROM {{0}}))"""
    mean = "((bad + k * prior) / (n + k))"
    shrunk = f"{mean} AS mean, {mean} * (1 - {mean}) / (n + k + 1) + pow(k / (n + k), 2.0) * prior_var AS var"
    return f"""WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
seen AS (
  SELECT host, count(*) AS n, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM parts JOIN labels ON labels.doc_id = page_id WHERE host <> '' GROUP BY host),
hosts AS (
  SELECT host, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad, regexp_replace(host, ':[0-9]*$', '') AS bare
  FROM (SELECT DISTINCT host FROM parts WHERE host <> '') LEFT JOIN seen USING (host)),
named AS (
  SELECT host, n, bad, CASE WHEN {address} THEN 'address' WHEN {long} THEN {tail(2)} ELSE {tail(1)} END AS suffix,
         CASE WHEN {address} THEN bare WHEN {long} THEN {tail(3)} ELSE {tail(2)} END AS domain FROM hosts),
domain0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY domain, suffix),
suffix0 AS (
  SELECT *, share * (1 - share) / (total + 2.0) AS prior_var, share AS prior FROM (
    SELECT suffix, sum(n) AS n, sum(bad) AS bad, sum(sum(n)) OVER () AS total,
           (sum(sum(bad)) OVER () + 0.5) / (sum(sum(n)) OVER () + 1.0) AS share FROM domain0 GROUP BY suffix)),
suffix1 AS (SELECT suffix, {shrunk} FROM suffix0, (SELECT {strength.format('suffix0')} AS k)),
domain1 AS (SELECT domain, suffix, n, bad, mean AS prior, var AS prior_var FROM domain0 JOIN suffix1 USING (suffix)),
domain2 AS (SELECT domain, suffix, {shrunk} FROM domain1, (SELECT {strength.format('domain1')} AS k)),
host1 AS (SELECT host, n, bad, mean AS prior, var AS prior_var FROM named JOIN domain2 USING (domain, suffix)),
lows AS (SELECT host, n, bad, mean, greatest(mean - {Z} * sqrt(var), 0.0) AS low
         FROM (SELECT host, n, bad, {shrunk} FROM host1, (SELECT {strength.format('host1')} AS k))),
whole AS (SELECT max(prior) AS share FROM suffix0)
SELECT page_id, host, path, {name} AS rule, coalesce({verdict},
         CASE WHEN low > {MAX_RATIO} * (SELECT share FROM whole) THEN 'block' ELSE 'allow' END) AS verdict,
       CAST(n AS BIGINT) AS n, CAST(bad AS BIGINT) AS bad, round(mean, 6) AS mean, round(low, 6) AS low
FROM parts LEFT JOIN lows USING (host)"""
