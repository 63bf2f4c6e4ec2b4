"""URL filters as a temporal join against dated lists.

List entries are dated events (``list, kind, pattern, action, day``). The events
of one pattern become validity intervals; a capture is evaluated against the
entries that are active on its own fetch day, by an as-of join of its lookup
keys with the intervals.

Kinds: ``url`` (the whole URL), ``domain`` (a host and its subdomains),
``prefix`` (host and leading path segments). The as-of join runs on the distinct
``(kind, key, day)`` of the captures, so a host with very many captures costs
one lookup a day; its captures then meet the few active keys in an equi-join
that the adaptive planner can split.

A NULL or malformed URL has no host and matches only a ``url`` entry equal to
it; a NULL fetch day matches nothing. An event whose day or pattern is NULL is
left out; of several events of one pattern and day an ``add`` wins. Repeated
captures each get a row; an empty list blocks nothing; other columns of the
captures are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def segments_of(url: Column) -> Column:
    """The non-empty path segments."""
    return F.array_remove(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/"), "")


def domains_of(host: Column) -> Column:
    """The host and its parent domains, down to the last label."""
    labels = F.split(host, r"\.")
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))


def prefixes_of(host: Column, segments: Column) -> Column:
    """``host/a``, ``host/a/b`` and so on."""
    return F.when((host == "") | (F.size(segments) == 0), F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size(segments)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/"))))


def validity(events: DataFrame) -> DataFrame:
    """``list, kind, pattern, since, until``: the half-open intervals in which
    the pattern is listed (``until`` NULL: still listed)."""
    e = events.where("day IS NOT NULL AND pattern IS NOT NULL").groupBy("list", "kind", "pattern", "day").agg(
        F.max(F.col("action") == "add").alias("on"))
    until = F.lead("day").over(Window.partitionBy("list", "kind", "pattern").orderBy("day"))
    return e.withColumn("until", until).where("on").select("list", "kind", "pattern", F.col("day").alias("since"), "until")


def evaluate(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "day") -> DataFrame:
    """One row per capture: ``id, url, host, day, matches`` (sorted ``list:kind:pattern``)."""
    c = captures.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(day_col).alias("day"))
    c = c.withColumn("host", host_of(F.col("url"))).withColumn("segments", segments_of(F.col("url")))

    def keyed(kind, keys):
        return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))

    # every capture has a url key of its own, so none is lost where nothing matches
    own = F.array(F.coalesce("url", F.concat(F.lit("#"), F.col("row").cast("string"))))
    keys = F.concat(keyed("url", own), keyed("domain", domains_of(F.col("host"))), keyed("prefix", prefixes_of(F.col("host"), F.col("segments"))))
    flat = c.select("row", "id", "url", "host", "day", F.explode(keys).alias("k")).select("row", "id", "url", "host", "day", "k.kind", "k.key")
    asked = flat.where("day IS NOT NULL").select("kind", F.col("key").alias("pattern"), "day").distinct()
    active = asked.join(validity(events), ["kind", "pattern"]).where("day >= since AND (until IS NULL OR day < until)")
    active = active.groupBy("kind", F.col("pattern").alias("key"), "day").agg(F.collect_set(F.concat_ws(":", "list", "kind", "pattern")).alias("hits"))
    met = flat.join(active, ["kind", "key", "day"], "left")
    return met.groupBy("row").agg(F.first("id").alias("id"), F.first("url").alias("url"), F.first("host").alias("host"), F.first("day").alias("day"),
                                  F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("matches")).drop("row")
