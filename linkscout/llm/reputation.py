"""Host reputation by empirical Bayes: page outcomes shrunk from host to registered domain to suffix, and fixed URL rules."""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rule (host and path) and verdict.
RULES = (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"),
)
#: A host is blocked if its share of bad pages lies above this with about 95 % posterior probability.
MAX_BAD = 0.5
Z = 1.645
#: Strength of a prior, in pages, where the table gives no estimate, and its range.
STRENGTH = 10.0
WEAKEST, STRONGEST = 1.0, 1000.0


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, ascii_uppercase, ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def domain(name: Column) -> Column:
    """Registered domain: the last two labels."""
    return F.substring_index(name, ".", -2)


def suffix(name: Column) -> Column:
    return F.substring_index(name, ".", -1)


def rule(name: Column, where: Column, rules: Sequence[tuple[str, str]], what: int) -> Column:
    """Text (``what`` 0) or verdict (1) of the longest rule that fits; null if none does. Of equally long ones, the first."""
    found = F.lit(None).cast("string")
    for entry in sorted(reversed(rules), key=lambda r: len(r[0])):
        top, slash, rest = entry[0].partition("/")
        fits = ((name == top) | name.endswith(f".{top}")) & where.startswith(slash + rest)
        found = F.when(fits, F.lit(entry[what])).otherwise(found)
    return found


def _strength(groups: DataFrame) -> DataFrame:
    """One row ``k``: the strength of the prior that fits how far groups ``(n, x)`` stray from their ``prior`` share.

    For a beta-binomial, ``n (x/n - p)^2`` has mean ``p (1 - p) (1 + (n - 1) rho)`` with ``rho = 1 / (1 + strength)``.
    """
    p, n = F.col("prior"), F.col("n")
    spread = p * (1 - p)
    sums = groups.where("n > 0").agg(
        F.sum(n * (F.col("x") / n - p) * (F.col("x") / n - p) - spread).alias("over"), F.sum((n - 1) * spread).alias("room")
    )
    rho = F.col("over") / F.col("room")
    fitted = F.when(rho > 0, F.least(F.greatest(1 / rho - 1, F.lit(WEAKEST)), F.lit(STRONGEST))).otherwise(F.lit(STRONGEST))
    return sums.select(F.when(F.col("room") > 0, fitted).otherwise(F.lit(STRENGTH)).alias("k"))


def _shrunk(groups: DataFrame) -> DataFrame:
    """Adds ``prior`` and ``k``, the prior share of a group and its strength in pages.

    ``groups`` has ``(n, x)`` and its parent's ``(pn, px, pprior, pk)``. The prior is the parent's posterior without the
    group's own pages, and no stronger than what that posterior rests on.
    """
    rest = F.col("pn") - F.col("n") + F.col("pk")
    with_prior = groups.withColumn("prior", (F.col("px") - F.col("x") + F.col("pk") * F.col("pprior")) / rest)
    fitted = with_prior.withColumn("_k", _strength(with_prior).scalar())
    return fitted.withColumn("k", F.least(F.col("_k"), rest)).drop("_k", "pn", "px", "pprior", "pk")


def _parent(level: DataFrame, key: str) -> DataFrame:
    return level.select(key, *[F.col(c).alias(f"p{c}") for c in ("n", "x", "prior", "k")])


def reputations(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(host, n, x, mean, bound)`` per host: labelled pages, bad ones, posterior mean and lower bound of the bad share.

    ``outcomes`` has ``(id_col, bad)`` with ``bad`` 0 or 1. Counts are combined in each task before they are sent.
    A suffix is shrunk to the share of all pages, a domain to its suffix, a host to its domain, each without its own pages.
    """
    known = outcomes.where(F.col(id_col).isNotNull() & F.col("bad").isNotNull())
    known = known.groupBy(id_col).agg(F.max("bad").alias("bad"))
    seen = pages.select(id_col, host(F.col(url_col)).alias("host")).join(known, id_col, "left")
    hosts = seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("x"))
    hosts = hosts.withColumns({"domain": domain(F.col("host")), "suffix": suffix(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    every = {"pn": F.sum("n"), "px": F.sum("x")}
    for name, total in every.items():
        suffixes = suffixes.withColumn(name, hosts.agg(total).scalar())
    suffixes = _shrunk(suffixes.withColumns({"pprior": F.lit(0.5), "pk": F.lit(1.0)}))
    domains = _shrunk(domains.join(_parent(suffixes, "suffix"), "suffix"))
    rated = _shrunk(hosts.join(_parent(domains, "domain"), "domain"))
    weight = F.col("n") + F.col("k")
    mean = (F.col("x") + F.col("k") * F.col("prior")) / weight
    bound = F.col("mean") - F.lit(Z) * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return rated.withColumn("mean", mean).withColumn("bound", bound).select("host", "n", "x", "mean", "bound")


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, max_bad: float = MAX_BAD,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """``(page_id, url, host, path, rule, verdict, n_labelled, n_bad, mean, bound)`` per row of ``pages``.

    The longest fitting rule decides; elsewhere a page is blocked if its host's lower posterior bound of the bad share is
    above ``max_bad``. Null urls, and those without ``://``, have an empty host and path and share that host's reputation.
    Repeated rows are kept. Rows without an id have no outcome. Without any outcome nothing is blocked but by rules. Other
    columns are not read.
    """
    rated = reputations(pages, outcomes, id_col, url_col)
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"))
    named = named.withColumn("path", path(F.col("url"))).withColumn("rule", rule(F.col("host"), F.col("path"), rules, 0))
    by_method = F.when((F.col("n") >= 0) & (F.col("bound") > max_bad), "block").otherwise("allow")
    by_rule = rule(F.col("host"), F.col("path"), rules, 1)
    return named.join(rated, "host", "left").withColumn("verdict", F.coalesce(by_rule, by_method)).select(
        "page_id", "url", "host", "path", "rule", "verdict", F.col("n").alias("n_labelled"), F.col("x").cast("long").alias("n_bad"),
        "mean", "bound",
    )
