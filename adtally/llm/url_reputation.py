"""URL filters: rules first, then empirical-Bayes host reputation (DataFrame functions only).

A url's host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; its path
follows, up to ``?``, ``#`` or the end. A rule fits its host and all subdomains if the path starts with the rule's
path; of several the longest decides. Where no rule fits, the host's reputation does.

Labelled page outcomes (1: junk, 0: good, null: not labelled) are counted by host, registered domain and suffix.
Each level's junk rates are taken as beta-binomial around the level above: a suffix around the whole, a domain around
its suffix, a host around its domain. The strength of each prior is the method of moments' for that level, so hosts
with few pages are drawn to their domain, and these to their suffix. A host is blocked if a lower bound of its
posterior junk rate lies above ``max_rate``; the bound is Cantelli's, which holds for every distribution:
the rate lies below ``mean - sqrt((1 - risk) / risk) * sd`` with a probability of at most ``risk``.

``junk_outcome`` labels a page by its html where no labels are given: runs of symbols among its words.

Defined results: a null url or one without ``://`` has empty host and path, is fitted by no rule, and shares the
reputation of the empty host; ports and user names stay in the host but not in its registered domain; an address of
digits or brackets is its own domain, with an empty suffix; a host without labelled pages has its domain's rate. Pages
are not changed: repeated rows stay, every column of the input is kept in struct ``row``.

Scale: pages are counted by host with a partial aggregate before the shuffle, so a host with a third of all pages is
a row for each task; the levels above are built from the counts. Only level means and strengths, a few numbers, reach the
driver. Verdicts return to the pages by a join on the host that Spark broadcasts under its size threshold and
whose hot keys it splits otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored

MAX_RATE = 0.2  # junk rate that a host may have
RISK = 0.1  # probability that the bound overstates the rate
WEAKEST, STRONGEST = 1.0, 1000.0  # limits of a prior's strength, in pages
JUNK_SHARE = 0.1  # runs of symbols for each word of a junk page
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# fixed values: suffixes of two labels, under which registered domains have three
LONG_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx",
                 "com.tr", "com.tw", "gov.uk", "net.au", "or.jp", "org.au", "org.uk")
# fixed values: a run of symbols, a word
SYMBOL_RUN = r"%%%|\*\*\*|###|\$\$\$|&amp;&amp;&amp;"
HTML_WORD = r"[^\x00-\x20<>]+"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    found = F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(found, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if there is none; ``rules``: (verdict, host and path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for given, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(given)).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without user name, port and last dot."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"(:[0-9]*|\.)+$", "")
    address = bare.rlike(r"^([0-9.]+|\[.*)$")
    long = F.substring_index(bare, ".", -2).isin(*long_suffixes)
    domain = F.when(address, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))
    suffix = F.when(address, F.lit("")).when(long, F.substring_index(bare, ".", -2)).otherwise(F.substring_index(bare, ".", -1))
    return domain, suffix


def junk_outcome(html: Column) -> Column:
    """1 if a page has a run of symbols for every ten words or fewer, else 0; null html: null."""
    runs, words = F.regexp_count(html, F.lit(SYMBOL_RUN)), F.regexp_count(html, F.lit(HTML_WORD))
    return ((words > 0) & (runs >= words * F.lit(JUNK_SHARE))).cast("int")


def _strength(level: DataFrame, parent: str = "parent_rate") -> float:
    """Pages that a level's prior weighs, from the spread of its rates (n, y) around their parents' by moments."""
    rate, spread = F.col("y") / F.col("n"), F.col(parent) * (1 - F.col(parent))
    seen = level.where("n > 0").agg(F.sum(F.col("n") * (rate - F.col(parent)) * (rate - F.col(parent))).alias("squares"),
                                    F.sum(spread).alias("noise"), F.sum(spread * (F.col("n") - 1)).alias("room")).first()
    if not seen["room"]:
        return STRONGEST
    likeness = (seen["squares"] - seen["noise"]) / seen["room"]
    return STRONGEST if likeness <= 0 else min(STRONGEST, max(WEAKEST, (1 - likeness) / likeness))


def _shrunk(level: DataFrame, strength: float) -> Column:
    return (F.col("y") + F.col("parent_rate") * strength) / (F.col("n") + strength)


def host_reputation(outcomes: DataFrame, risk: float = RISK, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Stored:
    """(host, domain, suffix, n, y, rate, bound) of every host in ``outcomes`` (host, outcome); a stored table."""
    domain, suffix = domain_and_suffix(F.col("host"), long_suffixes)
    counted = Stored(outcomes.groupBy("host").agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).cast("long").alias("y"))
                     .select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "y"), "hosts")
    hosts = counted.df

    def level(rows: DataFrame, *names: str) -> DataFrame:
        return rows.groupBy(*names).agg(F.sum("n").alias("n"), F.sum("y").alias("y"))

    whole = hosts.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    suffixes = level(hosts, "suffix").withColumn("parent_rate", F.lit(whole["y"] / whole["n"] if whole["n"] else 0.0))
    suffix_rate = suffixes.select("suffix", _shrunk(suffixes, _strength(suffixes)).alias("parent_rate"))
    domains = level(hosts, "domain", "suffix").join(suffix_rate, "suffix")
    domain_rate = domains.select("domain", _shrunk(domains, _strength(domains)).alias("parent_rate"))
    placed = hosts.join(domain_rate, "domain")
    strength = _strength(placed)
    a = F.col("y") + F.col("parent_rate") * strength
    b = F.col("n") - F.col("y") + (1 - F.col("parent_rate")) * strength
    rate, whole_weight = a / (a + b), a + b
    sd = F.sqrt(a * b / (whole_weight * whole_weight * (whole_weight + 1)))
    done = Stored(placed.select("host", "domain", "suffix", "n", "y", rate.alias("rate"),
                                (rate - F.lit(((1 - risk) / risk) ** 0.5) * sd).alias("bound")), "reputation")
    counted.drop()
    return done


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], outcome: Column, url_col: str = "url",
                max_rate: float = MAX_RATE, risk: float = RISK) -> DataFrame:
    """(row, host, path, rule, verdict, labelled, junk, bound) of every page; ``outcome``: column of ``pages``."""
    url = F.col(url_col).cast("string")
    known = host_reputation(pages.select(host_of(url).alias("host"), outcome.alias("outcome")), risk).df
    known = known.select(F.col("host").alias("host"), F.col("n").alias("labelled"), F.col("y").alias("junk"), "bound")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bound") > max_rate, F.lit("block")).otherwise(F.lit("allow"))
    return (pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host_of(url).alias("host"), path_of(url).alias("path"))
            .join(known, "host", "left")
            .select("row", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "labelled", "junk", "bound"))
