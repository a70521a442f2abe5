"""URL filter: host and path rules first, then the reputation of the host by empirical Bayes.

Outcomes of labelled pages (good or not) are counted by host. A host's share of good pages is shrunk towards that of its
registered domain, the domain's towards that of its suffix, and the suffix's towards the overall share: each level has a beta
prior around the mean of the level above, whose strength is found from the outcomes by moments, so hosts that
hardly differ are judged alike, and a host with few labels is judged by its neighbours. A host is blocked where the upper
bound of its posterior lies below ``least_good``: doubt never blocks.

Defined results: a null url or one without ``://`` has an empty host and path, which are judged like any other; a host
without labels has the prior of its domain; several labels of one page count as one, good if all are; null
labels and ids count for nothing; repeated pages are judged each; without any label nothing is blocked by the method; an
empty table gives an empty one. Columns but page_id and url are not looked at. Of rules of equal length the first given wins.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftledger.llm.common import stage
from shiftledger.operators.joins import lookup


@dataclass(frozen=True)
class Rule:
    action: str
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
#: Suffixes of two labels under which names are registered, beside all of one label.
WIDE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "or.jp", "com.br", "co.in", "co.kr", "com.cn", "com.mx", "co.za", "com.tr")
#: A share of good pages that a host must not be surely below.
LEAST_GOOD = 0.5
#: Standard deviations from the posterior mean to the bound: 95 % one-sided.
DEVIATIONS = 1.645
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 10_000.0


def url_parts(pages: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep``, host (A-Z lower-cased) and path of each url."""
    at = F.instr("url", "://")
    rest = F.coalesce(F.when(at > 0, F.col("url").substr(at + 3, F.length("url"))), F.lit(""))
    parts = pages.select(*keep, rest.alias("_rest"))
    host = F.translate(F.regexp_extract("_rest", "^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return parts.select(*keep, host.alias("host"), F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1).alias("path"))


def fits(rule: Rule) -> Column:
    """Whether a rule holds for host and path: its host and all subdomains, where the path starts with the rule's."""
    host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return host & F.col("path").startswith(rule.path)


def rule_of(rules: tuple[Rule, ...]) -> Column:
    """Name and action of the longest rule that fits, else null. Rules are few: they are one expression."""
    found = F.lit(None).cast("struct<name:string,action:string>")
    for rule in sorted(rules, key=lambda r: -len(r.name))[::-1]:  # the longest is asked first
        found = F.when(fits(rule), F.struct(F.lit(rule.name).alias("name"), F.lit(rule.action).alias("action"))).otherwise(found)
    return found


def with_domain(hosts: DataFrame, wide: tuple[str, ...] = WIDE_SUFFIXES) -> DataFrame:
    """Add domain and suffix of host; user and port are left out, an address is a domain of its own without a suffix."""
    name = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    labels = F.split(name, r"\.")
    last_two = F.substring_index(name, ".", -2)
    address = name.rlike(r"^[0-9.]*$") | name.contains("[")
    wide_one = last_two.isin(*wide) & (F.size(labels) > 2)
    return hosts.withColumns(
        {
            "suffix": F.when(address, F.lit("")).when(wide_one, last_two).otherwise(F.substring_index(name, ".", -1)),
            "domain": F.when(address, name).when(wide_one, F.substring_index(name, ".", -3)).otherwise(last_two),
        }
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """page_id and good (0 or 1) from labels of pages by the same id: good quality and not toxic."""
    known = labels.where("doc_id is not null and quality is not null")
    good = F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)
    return known.groupBy(F.col("doc_id").alias("page_id")).agg(F.min(good).alias("good"))


def host_counts(parts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, pages, labelled, good: one row per host, summed before the shuffle."""
    counted = parts.groupBy("host").agg(F.count("*").alias("pages"))
    labelled = parts.where("page_id is not null").join(outcomes, "page_id").groupBy("host")
    seen = labelled.agg(F.count("*").alias("labelled"), F.sum("good").cast("long").alias("good"))
    return counted.join(seen, "host", "left").fillna(0, ["labelled", "good"])


def strength(groups: DataFrame) -> float:
    """Strength of the prior around ``mean`` that the spread of ``good`` of ``labelled`` over groups shows, by moments.

    Shares of n outcomes vary by m(1-m)/n * (1 + (n-1) r) where r = 1/(strength+1). One row goes to the driver.
    """
    n, mean = F.col("labelled"), F.col("mean")
    single = mean * (1 - mean)
    seen = groups.where("labelled > 0").agg(
        F.sum((F.col("good") - n * mean) * (F.col("good") - n * mean) / n - single).alias("excess"),
        F.sum((n - 1) * single).alias("most"),
    )
    row = seen.first()
    if not row["most"]:
        return WEAKEST
    shared = row["excess"] / row["most"]
    return STRONGEST if shared <= 0 else min(max(1 / shared - 1, WEAKEST), STRONGEST)


def shrunk(groups: DataFrame, strong: float, *keys: str) -> DataFrame:
    """``keys`` with posterior mean and spread (variance) of groups whose prior has that strength around ``mean``.

    The spread of the level above counts as far as the prior does: a group without labels, in a domain without labels, is in doubt.
    """
    total = F.lit(strong) + F.col("labelled")
    mean = (F.lit(strong) * F.col("mean") + F.col("good")) / total
    share = F.lit(strong) / total
    moved = groups.select(*keys, mean.alias("mean"), total.alias("_total"), share.alias("_share"), "spread")
    spread = F.col("mean") * (1 - F.col("mean")) / (F.col("_total") + 1) + F.col("_share") * F.col("_share") * F.col("spread")
    return moved.select(*keys, "mean", spread.alias("spread"))


def reputations(hosts: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """host, labelled, good, share (posterior mean of the share of good pages) and its upper bound; ``hosts`` as ``host_counts`` gives them, stored."""
    tree = with_domain(hosts)
    sums = [F.sum("labelled").alias("labelled"), F.sum("good").alias("good")]
    domains = stage(tree.groupBy("suffix", "domain").agg(*sums), "domains")
    whole = domains.agg(*sums).first()
    labelled = whole["labelled"] or 0
    overall = ((whole["good"] or 0) + 1) / (labelled + 2)

    top = {"mean": F.lit(overall), "spread": F.lit(overall * (1 - overall) / (labelled + 3))}
    suffixes = domains.groupBy("suffix").agg(*sums).withColumns(top)
    domains = stage(domains.join(shrunk(suffixes, strength(suffixes), "suffix"), "suffix"), "domain-means")
    tree = stage(tree.join(shrunk(domains, strength(domains), "suffix", "domain"), ["suffix", "domain"]), "host-means")
    upper = F.col("mean") + deviations * F.sqrt("spread")
    return shrunk(tree, strength(tree), "host", "labelled", "good").select(
        "host", "labelled", "good", F.col("mean").alias("share"), F.least(upper, F.lit(1.0)).alias("upper")
    )


def judged_parts(parts: DataFrame, labels: DataFrame, rules: tuple[Rule, ...], least_good: float) -> DataFrame:
    """Add rule, verdict, labelled, good, share and upper to page_id, host, path and whatever else ``parts`` carries."""
    kept = parts.columns
    parts = stage(parts, "urls")
    hosts = stage(host_counts(parts, page_outcomes(labels)), "hosts")
    judged = lookup(parts, stage(reputations(hosts), "reputations"), "host")
    by_method = F.when(F.col("upper") < least_good, F.lit("block")).otherwise(F.lit("allow"))
    ruled = judged.withColumn("_rule", rule_of(rules))
    return ruled.select(
        *kept,
        F.col("_rule.name").alias("rule"),
        F.coalesce("_rule.action", by_method).alias("verdict"),
        "labelled",
        "good",
        "share",
        "upper",
    )


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, least_good: float = LEAST_GOOD
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, labelled and good (of its host), share, upper."""
    return judged_parts(url_parts(pages), labels, rules, least_good)


def allowed_pages(
    pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, least_good: float = LEAST_GOOD
) -> DataFrame:
    """``pages`` without those that are blocked; other columns are carried whatever their names.

    Rows are judged by a written number, so pages with repeated or null ids keep their own verdict.
    """
    rows = stage(pages.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), "pages")
    parts = url_parts(rows.select("row.page_id", "row.url", "number"), ("page_id", "number"))
    blocked = judged_parts(parts, labels, rules, least_good).where("verdict = 'block'")
    return rows.join(blocked.select("number"), "number", "left_anti").select("row.*")
