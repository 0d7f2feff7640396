"""URL filters over time: dated list entries become validity intervals, captures are judged as of their fetch day.

A rule is a host suffix at a label border (``example.com`` covers
``a.example.com``) or a whole host with leading path segments
(``a.example.com/x``). A list's log says on which day a rule was added or
removed. ``validity_intervals`` turns the log into half-open day intervals;
``judge_captures`` finds, for every capture, the rules in force on its day.

How it runs. The log shrinks first to one state per list, rule and day, so the
window that orders a rule's states holds at most one row a day. Captures shrink
to distinct (url, day) pairs, which expand to the few keys a rule could have (no
more labels or segments than the longest rule), and meet the intervals in an
equi-join on the key with the day as a range condition: the as-of step. A host
with a third of all captures is a skewed join key there, which adaptive
execution splits; its rows are ids, days and keys only. Nothing is broadcast by
hint and nothing collected but two small maxima.

Cases with a defined result: a NULL or unparsable url, or a NULL day, matches no
rule; an empty list blocks nothing; a rule added and removed on one day counts as
removed; repeated log rows count once; repeated captures are judged alike, one
row each; several matching rules: the longest is named, ties by list and rule;
very long urls cost no more than the longest rule; other columns are kept, but for
those named like a result column, which the result replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def url_segments(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def rule_keys(url: Column, labels_most: int, segments_most: int) -> Column:
    """The rules that would cover a url: host suffixes, and the host with leading path segments."""
    host, segments = url_host(url), url_segments(url)
    labels = F.split(host, r"\.")
    count = F.least(F.size(labels), F.lit(labels_most))
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
                           lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    depth = F.least(F.size(segments), F.lit(segments_most))
    prefixes = F.when(depth > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(depth, F.lit(1))),
        lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), n), "/")))).otherwise(
        F.array().cast("array<string>"))
    return F.when(host != "", F.concat(suffixes, prefixes)).otherwise(F.array().cast("array<string>"))


def validity_intervals(log: DataFrame) -> DataFrame:
    """``list, rule, valid_from, valid_to`` from ``list, rule, action, day``; ``valid_to`` is open (NULL) or excluded."""
    usable = log.filter("list IS NOT NULL AND rule IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')")
    states = usable.groupBy("list", "rule", "day").agg((~F.bool_or(F.col("action") == "remove")).alias("on"))
    by_day = Window.partitionBy("list", "rule").orderBy("day")
    changes = (states.withColumn("was", F.lag("on", 1, False).over(by_day)).filter(F.col("on") != F.col("was"))
               .withColumn("valid_to", F.lead("day").over(by_day)))
    return changes.filter("on").select("list", "rule", F.col("day").alias("valid_from"), "valid_to")


def judge_captures(captures: DataFrame, intervals: DataFrame, url: str = "url", day: str = "fetched") -> DataFrame:
    """The captures plus ``n_rules, blocked, list, rule, since`` as of each capture's day."""
    longest = intervals.agg(
        F.max(F.size(F.split(F.regexp_extract("rule", "^[^/]*", 0), r"\."))).alias("labels"),
        F.max(F.size(F.split("rule", "/")) - 1).alias("segments")).first()
    asked = captures.select(F.col(url).alias("_url"), F.col(day).alias("_day")).filter(
        "_url IS NOT NULL AND _day IS NOT NULL").distinct()
    keyed = asked.withColumn("_key", F.explode(rule_keys(F.col("_url"), longest["labels"] or 1, longest["segments"] or 0)))
    in_force = keyed.alias("c").join(
        intervals.alias("i"), (F.col("c._key") == F.col("i.rule")) & (F.col("c._day") >= F.col("i.valid_from"))
        & (F.col("i.valid_to").isNull() | (F.col("c._day") < F.col("i.valid_to"))))
    best = F.struct(-F.length("i.rule"), "i.list", "i.rule", "i.valid_from")
    verdicts = in_force.groupBy("c._url", "c._day").agg(F.count("*").alias("_n"), F.min(best).alias("_best"))
    own = captures.drop("n_rules", "blocked", "list", "rule", "since")
    joined = own.alias("own").join(verdicts.alias("v"), (F.col(f"own.{url}") == F.col("v._url"))
                                   & (F.col(f"own.{day}") == F.col("v._day")), "left")
    return joined.select("own.*", F.coalesce("v._n", F.lit(0)).alias("n_rules"), F.col("v._n").isNotNull().alias("blocked"),
                         F.col("v._best.list").alias("list"), F.col("v._best.rule").alias("rule"),
                         F.col("v._best.valid_from").alias("since"))


# --- the query's dated lists and fetch days, which the tables do not have -----------------------------------------

#: First day of the made-up calendar, and its length.
FIRST_DAY, DAYS = "2024-01-01", 366


def _digits(text: Column, start: int) -> Column:
    """A number below 65,536 from four hex digits of the text's MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), start, 4), 16, 10).cast("int")


def fetch_days(pages: DataFrame) -> DataFrame:
    """``page_id, url, fetched``: the page's id spreads its fetch over the calendar."""
    return pages.select("page_id", "url", F.date_add(F.lit(FIRST_DAY).cast("date"),
                                                     F.pmod(F.col("page_id"), F.lit(DAYS)).cast("int")).alias("fetched"))


def list_log(pages: DataFrame) -> DataFrame:
    """Dated entries on the hosts, domains and host/segment prefixes that occur in the pages.

    Every rule has up to four entries (add, remove, add, remove), each there or
    not, and dated, by digits of a hash of the rule.
    """
    host = url_host(F.col("url"))
    first = F.get(url_segments(F.col("url")), F.lit(0))
    rules = (pages.filter("url IS NOT NULL").select(F.explode(F.array(
        host, F.regexp_extract(host, r"[^.]+\.[^.]+$", 0), F.concat(host, F.lit("/"), first))).alias("rule"))
        .filter("rule IS NOT NULL AND rule != ''").distinct())
    entries = rules.withColumn("n", F.explode(F.array(*[F.lit(n) for n in range(4)])))
    mark = F.concat(F.col("rule"), F.lit("#"), F.col("n").cast("string"))
    return entries.filter(_digits(mark, 1) % 2 == 0).select(
        F.concat(F.lit("list"), (_digits(F.col("rule"), 1) % 3).cast("string")).alias("list"), "rule",
        F.when(F.col("n") % 2 == 0, "add").otherwise("remove").alias("action"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), _digits(mark, 5) % DAYS).alias("day"))
