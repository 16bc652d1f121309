"""Boilerplate lines by their frequency on a site.

A page's markup is reduced to text lines; a line that occurs on more than ``RATIO`` of the pages of
its host, and on ``LEAST_PAGES`` at least, is dropped from all pages of that host. Everything is
built from DataFrame functions. Pages travel once; the lines travel as hashes, and only those
of boilerplate come back to their pages. A hot host adds partial counts, not rows.

Defined results: null markup has no lines; a null or unreadable address is the host ``''``; equal
lines of one page count once; repeated pages count as often as they occur; blank lines vanish; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import join_on
from punctua.sources.storage import staged

RATIO = 0.3
LEAST_PAGES = 3
# Fixed patterns, in the syntax that Java and RE2 share.
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
SPACES = r"[\x20\x09\x0B\x0C\x0D]+"
BREAKS = (r"(?i)</?(?:p|br|div|li|ul|ol|h[1-6]|tr|td|th|table|nav|article|section|header|footer|title|head|body"
          r"|html|main|aside|form|pre|blockquote)\b[^>]*>")
TAGS = r"<[^>]*>"


def host_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


def lines_of(html: Column) -> Column:
    """Non-blank text lines of a page, trimmed."""
    text = F.coalesce(html, F.lit(""))
    for pattern, by in ((HIDDEN, " "), (BREAKS, "\n"), (TAGS, ""), (SPACES, " ")):
        text = F.regexp_replace(text, pattern, by)
    return F.filter(F.transform(F.split(text, "\n"), lambda line: F.trim(line)), lambda line: line != "")


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id, host, n_lines, n_dropped, kept_text`` of every page of ``page_id, url, html``."""
    cut = staged(
        pages.select("page_id", host_of(F.col("url")).alias("host"), lines_of(F.col("html")).alias("lines"))
        .withColumn("marks", F.array_distinct(F.transform("lines", lambda line: F.xxhash64(line)))), "lines")
    marks = cut.select("page_id", "host", F.explode("marks").alias("mark"))
    counts = marks.groupBy("host", "mark").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    totals = cut.groupBy("host").agg(F.count("*").alias("total"))
    common = join_on(counts, totals, ["host"]).where(F.col("pages") > F.lit(ratio) * F.col("total")).select("host", "mark")
    # Pages that share an id and a host share this list; it holds lines of that host only, so that
    # each page still loses exactly its own.
    dropped = join_on(marks, common, ["host", "mark"]).groupBy("page_id", "host").agg(F.collect_set("mark").alias("dropped"))
    joined = join_on(cut.drop("marks"), dropped, ["page_id", "host"], "left")
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains(F.col("dropped"), F.xxhash64(line))))
    return joined.withColumn("kept", kept).select(
        "page_id", "host", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("kept_text"))
