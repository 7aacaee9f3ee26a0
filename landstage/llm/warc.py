"""Not-modified revisit resolution for web archives (operator 7).

A crawl stores a full response once and later only "not modified" revisits.  Each
revisit is joined as of its time to the latest earlier full response of the same
canonical URL; its validators are checked against that response, and its headers are
merged into the stored ones as far as an update may change them.

The as-of join has two levels, so that no task holds all records of a hot URL.  Time
is cut into steps of ``step`` units.  The last full response of each (URL, step) is
found by a partial aggregate, and a window over the steps of a URL (not over its
records) carries the last one of earlier steps forward.  Inside a (URL, step), a window
over its records finds a later one.

Outcomes: ``resolved`` (the validator agrees: entity tags compared weakly, else equal
Last-Modified), ``unverified`` (the revisit has no validator), ``changed`` (the
validator disagrees: nothing is merged), ``orphan`` (no earlier full response).

Defined results: a null URL, time or record id cannot be joined, such a revisit is an
``orphan``.  Responses at the same time as the revisit are not earlier; of
responses at one time the largest record id wins.  Repeated rows give
repeated results.  Null headers count as none; of header names that differ by case only,
the one that comes last in ASCII order (so the one in lower case) counts.  Either kind may be absent; an empty table
gives an empty table.  Only the named columns are read, whatever others are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STEP = 1000

# Header fields that describe the stored body or one connection, and so stay as stored.
FIXED_HEADERS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "etag", "keep-alive",
                 "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")


def canonical_url(url: Column) -> Column:
    """One spelling for the URLs of a page.

    Scheme dropped, host in lower case without ``www.`` and default port, no fragment, no trailing
    slash, no ``utm_`` parameters, the other parameters sorted.
    """
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)(\?[^#]*)?"
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(url, parts, 1)), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, parts, 2), r"/+$", "")
    fields = F.array_sort(F.filter(F.split(F.substr(F.regexp_extract(url, parts, 3), F.lit(2)), "&"), lambda x: (x != "") & ~x.startswith("utm_")))
    return F.concat(host, path, F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&"))).otherwise(""))


def opaque_tag(tag: Column) -> Column:
    """An entity tag without its weakness mark."""
    return F.regexp_replace(tag, r"^W/", "")


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored headers with the update's fields over them, except those of ``FIXED_HEADERS``; names in lower case."""
    def lower(m: Column) -> Column:
        entries = F.map_entries(F.coalesce(m, F.create_map().cast("map<string,string>")))
        named = F.array_sort(F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["key"].alias("as"), e["value"].alias("value"))))
        # of names that differ by case only the last is kept
        last = F.filter(named, lambda e, i: (i == F.size(named) - 1) | (F.get(named, i + 1)["key"] != e["key"]))
        return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))

    allowed = F.map_filter(lower(update), lambda k, _: ~k.isin(*FIXED_HEADERS))
    kept = F.map_filter(lower(stored), lambda k, _: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(kept, allowed))))


def resolve_revisits(records: DataFrame, step: int = STEP) -> DataFrame:
    """One row per revisit of ``records`` (record_id, kind, url, at, etag, last_modified, digest, headers).

    ``kind`` is ``response`` (a full response) or ``revisit``; ``at`` a whole number that grows with time.
    """
    r = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", (F.col("kind") == "response").alias("full"), canonical_url(F.col("url")).alias("page"), "at",
        F.floor(F.col("at") / F.lit(step)).alias("slot"), "etag", "last_modified", "digest", "headers")
    joinable = F.col("page").isNotNull() & F.col("at").isNotNull() & F.col("record_id").isNotNull()
    whole = F.struct("at", "record_id", "etag", "last_modified", "digest", "headers")
    ok = r.where(joinable).withColumn("own", F.when(F.col("full"), whole))
    last = ok.groupBy("page", "slot").agg(F.max_by("own", F.when(F.col("full"), F.struct("at", "record_id"))).alias("last"))
    earlier = Window.partitionBy("page").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("page", "slot", F.last("last", ignorenulls=True).over(earlier).alias("carried"))
    inside = Window.partitionBy("page", "slot").orderBy("at", "full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    found = (ok.withColumn("inside", F.last("own", ignorenulls=True).over(inside)).where(~F.col("full"))
             .join(carried, ["page", "slot"]).withColumn("base", F.coalesce("inside", "carried")))
    columns = ["record_id", "page", "at", "etag", "last_modified", "headers"]
    orphans = r.where(~F.col("full")).where(~joinable).select(*columns, F.lit(None).cast(found.schema["base"].dataType).alias("base"))
    out = found.select(*columns, "base").union(orphans)
    agrees = (F.when(F.col("base").isNull(), "orphan")
              .when(F.col("etag").isNotNull(), F.when(opaque_tag(F.col("etag")) == opaque_tag(F.col("base.etag")), "resolved").otherwise("changed"))
              .when(F.col("last_modified").isNotNull(), F.when(F.col("last_modified") == F.col("base.last_modified"), "resolved").otherwise("changed"))
              .otherwise("unverified"))
    out = out.withColumn("outcome", agrees)
    merges = F.col("outcome").isin("resolved", "unverified")
    return out.select("record_id", "page", F.col("at"), F.col("base.record_id").alias("refers_to"), "outcome",
                      F.when(merges, F.col("base.digest")).alias("digest"),
                      F.when(merges, merged_headers(F.col("base.headers"), F.col("headers"))).alias("headers"))


def header_lines(headers: Column) -> Column:
    """Headers as sorted ``name: value`` lines; null for none."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat_ws(": ", e["key"], e["value"])), "\n")


def records_of_pages(pages: DataFrame) -> DataFrame:
    """A crawl's records derived from a table of pages (page_id, url, html).

    Every page is fetched in full at ten times its id, and asked for again at a time up to
    450 earlier or 3,600 later, by a URL with a tracking parameter.  One revisit in eleven has another
    tag, one in seven only a date, one in thirteen no validator.
    """
    i, body = F.col("page_id"), F.coalesce(F.col("html"), F.lit(""))
    digest = F.md5(body)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    stamp = F.concat(F.lit("day "), F.floor(i / 100).cast("string"))
    full = pages.select((2 * i).alias("record_id"), F.lit("response").alias("kind"), F.col("url"), (10 * i).alias("at"), tag.alias("etag"), stamp.alias("last_modified"), digest.alias("digest"),
                        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.octet_length(body).cast("string"), F.lit("Date"), F.concat(F.lit("t"), (10 * i).cast("string")),
                                     F.lit("Cache-Control"), F.lit("max-age=60"), F.lit("X-Server"), F.concat(F.lit("s"), (i % 5).cast("string"))).alias("headers"))
    at = 10 * i + F.pmod(i * 37, F.lit(406)) * 10 - 455
    again = pages.select((2 * i + 1).alias("record_id"), F.lit("revisit").alias("kind"), F.concat(F.regexp_replace("url", "#.*$", ""), F.when(F.col("url").contains("?"), "&").otherwise("?"), F.lit("utm_medium=again")).alias("url"),
                         at.alias("at"), F.when(i % 13 == 0, None).when(i % 7 == 0, None).when(i % 11 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag)).alias("etag"),
                         F.when(i % 13 == 0, None).otherwise(stamp).alias("last_modified"), F.lit(None).cast("string").alias("digest"),
                         F.create_map(F.lit("date"), F.concat(F.lit("t"), at.cast("string")), F.lit("Content-Length"), F.lit("0"), F.lit("Connection"), F.lit("close"),
                                      F.lit("Cache-Control"), F.concat(F.lit("max-age="), (i % 9).cast("string")), F.lit("Age"), F.lit("1")).alias("headers"))
    return full.union(again)
