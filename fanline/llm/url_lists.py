"""URL filter lists over time: every capture against the entries valid when it was fetched.

A list is a log of dated entries (pattern, day, action): ``add`` puts a pattern
on the list from that day on, ``remove`` takes it off. Entries become validity
intervals, and an as-of join finds the pattern's state on the capture's day.
A pattern is a domain, which covers its subdomains, or a host followed by
``/segment``, which covers that first path segment of the host and its
subdomains. Everything is DataFrame functions: parsing, suffixes, intervals,
joins.

Skew. Captures are first reduced to distinct (host, segment, day) triples
(combined on the map side), so a host with a third of all captures sends at
most one row per day and segment into the pattern join; the verdicts are
joined back on the triple. A pattern's interval rows are at most one per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fanline.llm import common as c

#: more labels than a valid host name can have (253 characters): no host
MOST_LABELS = 127

_AUTHORITY = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
_SEGMENT = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/([^/?#]+)"


def url_host(url: Column) -> Column:
    """Lower-case host of a URL without user, port and final dots; '' if it has none."""
    authority = F.regexp_extract(F.trim(url), _AUTHORITY, 1)
    bare = F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", "")
    return F.coalesce(F.lower(F.regexp_replace(bare, "[.]+$", "")), F.lit(""))


def url_segment(url: Column) -> Column:
    """First path segment of a URL; '' if it has none."""
    return F.coalesce(F.regexp_extract(F.trim(url), _SEGMENT, 1), F.lit(""))


def suffix_patterns(host: Column, segment: Column) -> Column:
    """All patterns that cover a host and segment."""
    labels = F.split(host, "[.]")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    deep = F.transform(domains, lambda d: F.concat(d, F.lit("/"), segment))
    found = F.when(segment == "", domains).otherwise(F.concat(domains, deep))
    return F.when((host != "") & (n <= MOST_LABELS), found).otherwise(F.array().cast("array<string>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(pattern, start date, stop date or NULL) during which a pattern is listed.

    entries: (pattern, day, action). Of several entries of a pattern on one day
    an ``add`` counts. Rows with a NULL or with another action are left out;
    repeated entries change nothing. Patterns are taken in lower case up to the
    slash. The window holds one row per pattern and day.
    """
    host = F.substring_index("pattern", "/", 1)
    name = F.concat(F.lower(host), F.expr("substring(pattern, length(substring_index(pattern, '/', 1)) + 1)"))
    daily = (
        entries.select(F.col("pattern"), F.col("day").cast("date").alias("day"), F.col("action"))
        .where("pattern IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy(name.alias("pattern"), "day")
        .agg(F.max((F.col("action") == "add").cast("int")).alias("listed"))
    )
    following = Window.partitionBy("pattern").orderBy("day")
    spans = daily.withColumn("stop", F.lead("day").over(following))
    return spans.where("listed = 1").select("pattern", F.col("day").alias("start"), "stop")


def filter_captures(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "day"
) -> DataFrame:
    """(id_col, host, day date, listed boolean, pattern, since date) per capture.

    pattern is the longest pattern that covers the capture and is listed on its
    day (of equal length, the first in order), since the day of the entry that
    put it there. NULL or host-less URLs, hosts of more than 127 labels and NULL
    days are never listed; each capture row is returned, NULL and repeated ids
    included; other columns are not read; an empty list lists nothing.
    """
    rows = captures.select(
        F.col(id_col).alias(id_col),
        url_host(F.col(url_col)).alias("host"),
        url_segment(F.col(url_col)).alias("segment"),
        F.col(day_col).cast("date").alias("day"),
    )
    spans = validity_intervals(entries)
    asked = rows.where("host != '' AND day IS NOT NULL").select("host", "segment", "day").distinct()
    reach = asked.withColumn("pattern", F.explode(suffix_patterns(F.col("host"), F.col("segment"))))
    met = reach.join(spans, "pattern").where("start <= day AND (stop IS NULL OR day < stop)")
    # intervals of one pattern do not overlap, so a pattern is met once per triple
    first = F.min(F.struct((-F.length("pattern")).alias("n"), F.col("pattern"), F.col("start").alias("since")))
    verdicts = met.groupBy("host", "segment", "day").agg(first.alias("v"))
    verdicts = c.materialise(verdicts.select("host", "segment", "day", "v.pattern", "v.since"), "verdicts")
    return rows.join(verdicts, ["host", "segment", "day"], "left").select(
        id_col, "host", "day", F.col("pattern").isNotNull().alias("listed"), "pattern", "since"
    )
