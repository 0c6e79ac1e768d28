"""URL filters: explicit rules first, then empirical-Bayes reputation of hosts.

Labelled page outcomes are counted by host, registered domain and suffix: the last label of the host, or the last two if
they are in a bounded list of suffixes under which unrelated registrants stand, and one label more. A port is no
part of them; an IP address is its own domain under the suffix `ip`. At each level a unit's rate has a beta
prior whose mean is the posterior mean of the unit above (suffix under the whole, domain under suffix, host under
domain) and whose strength is estimated from the spread between units by moments. A page is blocked when the
upper posterior bound of its host's good rate lies below a threshold, so hosts with little evidence follow
their domain and are blocked only where evidence is strong.

Defined cases: a null url or one without `://` has an empty host and path, and no rule fits it; hosts without
labels take their domain's posterior, domains without labels their suffix's; a page labelled more than once counts
each time; repeated pages are returned as often as they came; the longest fitting rule wins, of equal ones the
first; without any label the prior mean is 1/2; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, salted_join


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (UrlRule("allow", "org", "/"), UrlRule("block", "example.org", "/es/"), UrlRule("block", "example.org", "/en/1"), UrlRule("allow", "com", "/fr/"), UrlRule("block", "com", "/de/"))
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UP, _LOW)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


#: Suffixes of two labels under which unrelated registrants stand.
SUFFIXES = tuple(f"{a}.{b}" for b, own in {
    "uk": "ac co gov ltd me net nhs org plc police sch", "au": "com edu gov id net org", "nz": "ac co geek gen govt net org school", "jp": "ac co ed go gr lg ne or",
    "br": "com gov net org", "cn": "ac com edu gov net org", "in": "ac co edu gov net org", "kr": "ac co go ne or", "za": "ac co gov net org", "tr": "com edu gov net org",
    "mx": "com edu gob net org", "ar": "com edu gob net org", "sg": "com edu gov net org", "hk": "com edu gov net org", "tw": "com edu gov net org", "il": "ac co gov net org",
    "id": "ac co go or web", "th": "ac co go in or", "my": "com edu gov net org", "pl": "com edu gov net org", "ua": "com edu gov net org", "es": "com edu gob nom org",
    "io": "github gitlab", "com": "blogspot wordpress tumblr", "app": "netlify vercel web", "dev": "pages workers",
}.items() for a in own.split())
_IP = r"^([0-9]{1,3}([.][0-9]{1,3}){3}|\[.*\])$"


def bare(host: Column) -> Column:
    """The host without its port."""
    return F.regexp_replace(host, r":[0-9]*$", "")


def suffix_of(host: Column) -> Column:
    host = bare(host)
    two = F.substring_index(host, ".", -2)
    return F.when(host.rlike(_IP), "ip").when(two.isin(*SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    host = bare(host)
    two = F.substring_index(host, ".", -2)
    return F.when(host.rlike(_IP), host).when(two.isin(*SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):  # later ones override: longer ones, and of equal ones the first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def strength(units: DataFrame, low: float = 1.0, high: float = 1000.0) -> float:
    """Prior strength from units (n, y) by moments, within [low, high]; sums of all units, one row, come to the driver."""
    units = units.where("n > 0").select(F.col("n").cast("double").alias("n"), F.col("y").cast("double").alias("y"))
    r = units.agg(F.sum("n").alias("n"), F.sum("y").alias("y"), F.count("*").alias("h"), F.sum(F.col("y") * F.col("y") / F.col("n")).alias("yy")).first()
    if not r["n"]:
        return high
    m = r["y"] / r["n"]
    spread, v = r["yy"] / r["n"] - m * m, m * (1 - m)
    between = spread - v * r["h"] / r["n"]
    return max(low, min(high, (v - spread) / between)) if between > 0 and v > spread else high


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[UrlRule, ...] = RULES, threshold: float = 0.7, z: float = 1.645) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, n_labels, reputation, upper).

    `outcomes` has (page_id, good): 1 for a good page, 0 for a bad one.
    """
    url = F.col("url").cast("string")
    pages = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    hosts = pages.join(outcomes.where("good is not null").select("page_id", "good"), "page_id").groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("y"))
    # every host with its counts; at most one row for each host from here on
    every = pages.groupBy("host").agg(F.count("*").alias("pages")).join(hosts, "host", "left").select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("y", F.lit(0)).alias("y"))
    every = Scratch(pages.sparkSession, "urls").write(every, "hosts")  # one row a host, read several times below
    domains = every.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    m0 = total["y"] / total["n"] if total["n"] else 0.5
    k1, k2, k3 = (strength(x) for x in (suffixes, domains, every))
    post = lambda k, m: (F.col("y") + k * m) / (F.col("n") + k)
    s = suffixes.select("suffix", post(k1, F.lit(m0)).alias("m1"))
    d = domains.join(s, "suffix").select("domain", post(k2, F.col("m1")).alias("m2"))
    h = every.join(d, "domain").select("host", "n", post(k3, F.col("m2")).alias("m3"), (F.col("n") + k3).alias("w"))
    h = h.select("host", F.col("n").alias("n_labels"), F.col("m3").alias("reputation"), (F.col("m3") + z * F.sqrt(F.col("m3") * (1 - F.col("m3")) / (F.col("w") + 1))).alias("upper"))
    out = salted_join(pages, h, "host", "page_id")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    bound = F.when(F.col("upper") < threshold, "block").otherwise("allow")
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, bound).alias("verdict"), "n_labels", F.round("reputation", 6).alias("reputation"), F.round("upper", 6).alias("upper"))
