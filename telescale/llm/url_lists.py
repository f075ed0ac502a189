"""URL filters over time: dated list entries become intervals, and each capture meets those active when fetched.

A list names domains; an entry is added on one day and may be removed on a later one. The dated entries of a domain
are turned into segments of time in which the lists that name it do not change, and segments are cut at the borders
of periods of ``PERIOD`` days. A capture then meets at most one segment of each of its domain's parents by equality
of domain and period and a comparison of days: an as-of join without a range join, and without a hot key, since a
domain of many captures is spread over the periods and Spark may split its captures further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 32
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without a dot at its end; null if it has none."""
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    return F.when(host != "", host)


def domains_of(host: Column) -> Column:
    """The host and all its parent domains; the top level alone is none of them."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.when(n < 2, F.array(host)).otherwise(
        F.array_append(
            F.transform(
                F.filter(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda k: k < n),
                lambda k: F.concat_ws(".", F.slice(labels, n - k + 1, k)),
            ),
            host,
        )
    )


def validity(entries: DataFrame) -> DataFrame:
    """Intervals (list, domain, since, until) from dated entries (list, domain, day, added).

    Of several entries of a list and domain on one day an addition counts. An addition while listed, and a removal
    while not, change nothing. ``until`` is the first day on which it is no longer listed, null if it still is.
    """
    daily = entries.filter("list is not null and domain is not null and day is not null and added is not null")
    daily = daily.groupBy("list", F.rtrim(F.lower("domain"), F.lit(".")).alias("domain"), "day")
    daily = daily.agg(F.max("added").alias("added"))
    by = Window.partitionBy("list", "domain").orderBy("day")
    changed = daily.withColumn("_was", F.lag("added", 1, False).over(by)).filter("added <> _was")
    spans = changed.withColumn("until", F.lead("day").over(by))
    return spans.filter("added").select("list", "domain", F.col("day").alias("since"), "until")


def segments(intervals: DataFrame) -> DataFrame:
    """(domain, since, until, lists): stretches of days with the same lists, those without any left out."""
    starts = intervals.select("domain", F.col("since").alias("day"), "list", F.lit(1).alias("change"))
    ends = intervals.filter("until is not null").select("domain", F.col("until").alias("day"), "list", F.lit(-1))
    by = Window.partitionBy("domain").orderBy("day")
    # At each day of change, lists with the balance of their changes; there are few lists.
    changes = starts.union(ends).groupBy("domain", "day", "list").agg(F.sum("change").alias("change"))
    days = changes.select("domain", "day").distinct().withColumn("until", F.lead("day").over(by))
    pairs = changes.select("domain", "list").distinct().join(days, "domain")
    balance = Window.partitionBy("domain", "list").orderBy("day")
    known = pairs.join(changes, ["domain", "list", "day"], "left")
    known = known.withColumn("_on", F.sum(F.coalesce("change", F.lit(0))).over(balance)).filter("_on > 0")
    lists = F.sort_array(F.collect_set("list")).alias("lists")
    return known.groupBy("domain", F.col("day").alias("since"), "until").agg(lists)


def _period(day: Column) -> Column:
    return F.floor(day / PERIOD)


def matches(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Captures (page_id, url, day) with a listed domain: page_id, url, day, domain, list; each match once."""
    cut = segments(validity(entries))
    # An open segment ends behind the last capture.
    last = captures.agg(F.max("day")).first()[0]
    cut = cut.withColumn("until", F.coalesce("until", F.lit(-1 if last is None else last) + 1)).filter("since < until")
    cut = cut.withColumn("period", F.explode(F.sequence(_period(F.col("since")), _period(F.col("until") - 1))))
    asked = captures.filter("day is not null").select("page_id", "url", "day", host_of(F.col("url")).alias("_host"))
    asked = asked.filter("_host is not null").withColumn("domain", F.explode(domains_of(F.col("_host"))))
    asked = asked.withColumn("period", _period(F.col("day")))
    met = asked.join(cut, ["domain", "period"]).filter("since <= day and day < until")
    return met.select("page_id", "url", "day", "domain", F.explode("lists").alias("list"))


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Each distinct capture with the lists active on the day it was fetched: page_id, url, day, host, lists, blocked.

    ``lists`` joins the names of the lists, sorted, by commas; it is empty where none is active. Captures without
    host or day meet no list. Repeated rows of captures come out once; entries with a null are ignored. Of entries of one
    list, domain and day the one that adds counts. Other columns of either table are not read; URLs of any length are
    taken whole; empty captures give no rows.
    """
    keys = ["page_id", "url", "day"]
    captures = captures.select(*keys)
    found = matches(captures, entries).groupBy(*keys).agg(F.collect_set("list").alias("_lists"))
    found = found.select(*(F.col(k).alias(f"_{k}") for k in keys), F.concat_ws(",", F.sort_array("_lists")).alias("lists"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = captures.distinct().join(found, same[0] & same[1] & same[2], "left")
    lists = F.coalesce("lists", F.lit(""))
    return joined.select(*keys, host_of(F.col("url")).alias("host"), lists.alias("lists"), (lists != "").alias("blocked"))
