"""Leaving out URLs of blocked hosts by a table of them, which may hold millions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.urls import BLOCKED_HOSTS, BLOCKED_PATHS, any_of, domain_from_url, text_of


def default_hosts(spark: SparkSession) -> DataFrame:
    """``host``: the hosts that ``functions.urls.is_blocked_url`` knows."""
    return spark.createDataFrame([(h,) for h in BLOCKED_HOSTS], "host string")


def blocked_path(url: Column) -> Column:
    """What a URL shows by itself: documents, news and the like, and no host at all."""
    low = F.lower(text_of(url))
    return low.endswith(".pdf") | any_of(low, BLOCKED_PATHS) | domain_from_url(url).isNull()


def hosts_below(hosts: DataFrame, listed: DataFrame) -> DataFrame:
    """``_host``: those of ``hosts`` that are a listed ``host`` or a subdomain of one.

    Each of the distinct hosts meets the list by its own ends, as many labels as the longest listed host has, so that both sides
    join by equality.
    """
    known = listed.select(F.lower("host").alias("_end")).filter("_end <> ''").distinct()
    most = known.agg(F.max(F.size(F.split("_end", "[.]")))).first()[0] or 0
    labels = F.split("_host", "[.]")
    ends = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(1, most)))), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    return hosts.select("_host").distinct().select("_host", F.explode(ends).alias("_end")).join(known, "_end", "left_semi").select("_host").distinct()


def drop_blocked(rows: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """``rows`` whose URL isn't blocked, as they were.

    ``listed`` has a column ``host``. Null and empty URLs are blocked, as they have no host; repeated rows stay so. An empty list
    blocks no host. Rows move only if the hosts found on them are too many for a broadcast.
    """
    carried = rows.select(F.struct("*").alias("_row"), domain_from_url(F.col(url)).alias("_host"), blocked_path(F.col(url)).alias("_by_path")).filter("not _by_path")
    return carried.join(hosts_below(carried, listed), "_host", "left_anti").select("_row.*")
