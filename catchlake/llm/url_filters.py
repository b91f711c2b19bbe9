"""URL filters as a sort-merge range join.

A host is written with its labels reversed, each label ended by a zero character, so a rule's host and all its subdomains
are one interval of keys and intervals nest. Rules and pages are sorted together by key; a sweep over the sorted rows
keeps a stack of the rules whose interval is open. The stack has a slot for each number of labels that rule hosts have: the
slot holds the last rule host of that many labels, which is open as long as keys begin with it, because an open
one is always the last of its slot. The sweep is one window over range partitions of the sort, and each partition begins with
the slots that the partitions before it left. Rows equal in the key are told apart by the page, so a host with any share of
the pages is spread over many partitions.

For the open hosts of a page, prefixes of its path, of the lengths that the host's rules have, are looked up among the
rules. Of all rules that fit the longest wins (host and path together), then the longer host.

Cases: a null URL and one without "://" have an empty host and path; rules with a null host or path, or without a verdict,
are left out; of two rules with the same host and path block wins; a rule with an empty host fits every page whose path
fits; pages that no rule fits get the default verdict; repeated rows keep one row each; without rules all pages get the
default; without pages there are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchlake.llm.common import lower_ascii
from catchlake.llm.positions import part_of, with_sorted_ids
from catchlake.operators.sizing import measured
from catchlake.session import materialize

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
ZERO = "\u0000"


def host_of(url: str) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), URL, 1))


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), URL, 2)


def key_of(host: str) -> Column:
    """Labels from the last to the first, each ended by a zero; the empty host's key is empty."""
    labels = F.reverse(F.split(F.col(host), r"\."))
    return F.when(F.col(host) == "", F.lit("")).otherwise(F.concat(F.array_join(labels, ZERO), F.lit(ZERO)))


def clean_rules(rules: DataFrame) -> DataFrame:
    """Columns rule_host, rule_path, block: one row for each host and path."""
    own = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin("allow", "block"))
    return own.groupBy(lower_ascii(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path")).agg(
        F.max(F.col("verdict") == "block").alias("block"))


def judged_pages(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """For each page: host, path, the rule that decides (null if none) and the verdict. rules has host, path and verdict."""
    rules = materialize(clean_rules(rules), "rules")
    depth = F.when(F.col("rule_host") == "", F.lit(0)).otherwise(F.size(F.split("rule_host", r"\.")))
    # distinct lengths only, so the list is bounded by the length of a path
    hosts = rules.groupBy("rule_host").agg(F.array_sort(F.collect_set(F.length("rule_path"))).alias("_lengths")).withColumn("_depth", depth)
    depths = [r["_depth"] for r in hosts.select("_depth").distinct().orderBy("_depth").collect()]  # numbers of labels: 127 in DNS
    opened = hosts.select(key_of("rule_host").alias("_key"), F.lit(0).alias("_kind"), F.lit(None).cast(pages.schema[key].dataType).alias("_page"),
                          F.col("rule_host").alias("host"), F.lit(None).cast("string").alias("path"), "_lengths", "_depth")
    seen = pages.select(F.col(key).alias("_page"), host_of(url).alias("host"), path_of(url).alias("path"))
    seen = seen.select(key_of("host").alias("_key"), F.lit(1).alias("_kind"), "_page", "host", "path",
                       F.lit(None).cast("array<int>").alias("_lengths"), F.lit(None).cast("int").alias("_depth"))
    swept = with_sorted_ids(opened.unionByName(seen), ["_key", "_kind", "_page", "path"], "_at").withColumn("_part", part_of("_at"))

    slot = lambda d: F.when((F.col("_kind") == 0) & (F.col("_depth") == d), F.struct("host", "_lengths"))
    left = swept.groupBy("_part").agg(*[F.max_by(slot(d), F.when(slot(d).isNotNull(), F.col("_at"))).alias(f"_left{d}") for d in depths],
                                      F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row for each partition
    carried = left.select("_part", *[F.last(f"_left{d}", ignorenulls=True).over(before).alias(f"_carried{d}") for d in depths])
    sweep = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)
    stack = swept.withColumns({f"_slot{d}": F.last(slot(d), ignorenulls=True).over(sweep) for d in depths}).filter("_kind = 1")
    stack = stack.join(F.broadcast(carried), "_part")  # as many rows as partitions
    top = [F.coalesce(f"_slot{d}", f"_carried{d}") for d in depths]
    open_ = lambda x: (x["host"] == "") | (F.col("host") == x["host"]) | F.endswith(F.col("host"), F.concat(F.lit("."), x["host"]))
    slots = F.array(*top) if top else F.array().cast("array<struct<host:string,_lengths:array<int>>>")
    stack = stack.select("_at", F.col("_page").alias(key), "host", "path", F.filter(slots, lambda x: x.isNotNull() & open_(x)).alias("_open"))

    tries = F.flatten(F.transform("_open", lambda x: F.transform(
        F.filter(x["_lengths"], lambda n: n <= F.length("path")),
        lambda n: F.struct(x["host"].alias("rule_host"), F.substring(F.col("path"), F.lit(1), n).alias("rule_path")))))
    tried = stack.select("_at", key, "host", "path", F.explode_outer(tries).alias("_try")).select("_at", key, "host", "path", "_try.*")
    found = tried.join(measured(rules=rules)["rules"], ["rule_host", "rule_path"], "left")
    rank = F.when(F.col("block").isNotNull(), F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("a"), F.length("rule_host").alias("b"),
        F.concat("rule_host", "rule_path").alias("rule"), F.col("block").alias("block")))
    # the tries of a page lie side by side, so they are joined before the shuffle
    best = found.groupBy("_at").agg(F.max(rank).alias("_best"), F.first(key).alias(key), F.first("host").alias("host"), F.first("path").alias("path"))
    verdict = F.when(F.col("_best.block"), F.lit("block")).when(~F.col("_best.block"), F.lit("allow")).otherwise(F.lit(default))
    return best.select(key, "host", "path", F.col("_best.rule").alias("rule"), verdict.alias("verdict"))
