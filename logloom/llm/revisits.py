"""Not-modified revisits of a web archive: which full response does a revisit stand for?

A revisit record says that a resource had not changed, and carries no body. It is resolved by an
as-of join on the canonical URL: the latest full response captured earlier. The validators of both
are compared, and the headers that a 304 response may update are merged into those of the response.

The join needs no range join and no window over all captures of a URL. Captures are split into
(URL, time span) groups; the last response of every group is carried to the later groups of its
URL over a table of one row per group, and within a group a running maximum finds the latest
response. A URL with a third of all captures is as many groups as it has time spans.

Contract: captures without a URL or time resolve to nothing. Of responses with the same time the
largest record id is the latest; a response at the very time of the revisit is not earlier. Null
headers count as none. Every revisit gives a row, repeated ones too; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

# Seconds per group of a URL.
SPAN = 6 * 3600
# The headers that a not-modified response may carry for the stored one.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "set-cookie", "vary")
# Query parameters that do not name another resource.
TRACKING = ("ref", "fbclid", "gclid", "sessionid")

_FULL = "struct<at:bigint,record_id:bigint,digest:string,n_bytes:bigint,headers:map<string,string>>"


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port in lower case, path without a closing slash, sorted query.

    Scheme, user, fragment and tracking parameters are left out.
    """
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^(?:[^/?@]*@)?([^/?]*)", 1)), r"^www\.|:(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    dropped = r"^(?:utm_[^=]*|" + "|".join(TRACKING) + r")(?:=|$)"
    kept = F.array_sort(F.filter(query, lambda x: (x != "") & ~x.rlike(dropped)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _lower(headers: Column) -> Column:
    return F.transform_keys(F.coalesce(headers, F.create_map().cast("map<string,string>")), lambda k, v: F.lower(k))


def resolve_revisits(captures: DataFrame, span: int = SPAN) -> DataFrame:
    """The revisits of ``captures`` with the response each stands for.

    ``captures`` has record_id, url, at (seconds), kind ('response' or 'revisit'), status, digest, n_bytes,
    headers. Only responses with status 200 count as full. The result has record_id, url_key, at,
    response_id, response_at, digest, n_bytes, validator (the first that both have: etag,
    last-modified, digest), state (resolved, changed, unchecked, missing) and headers.
    """
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    events = captures.filter(full | (F.col("kind") == "revisit")).select(
        canonical_url(F.col("url")).alias("url_key"),
        F.col("at").cast("bigint").alias("at"),
        F.floor(F.col("at") / span).cast("bigint").alias("span"),
        F.col("record_id").cast("bigint").alias("record_id"),
        (F.col("kind") == "revisit").alias("asks"),
        "digest", F.col("n_bytes").cast("bigint").alias("n_bytes"), _lower(F.col("headers")).alias("headers"),
    )
    # Maps have no order, so the order stands in front and the rest is taken along.
    rank = F.when(~F.col("asks"), F.struct("at", "record_id"))
    own = F.when(~F.col("asks"), F.struct("at", "record_id", "digest", "n_bytes", "headers").cast(_FULL))
    usable = events.filter(F.col("url_key").isNotNull() & F.col("at").isNotNull())
    groups = usable.groupBy("url_key", "span").agg(F.max_by(own, rank).alias("last"))
    earlier = W.partitionBy("url_key").orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    carried = groups.select("url_key", "span", F.last("last", ignorenulls=True).over(earlier).alias("carried")).filter("carried IS NOT NULL")
    # A carried response stands in front of its group.
    lead = carried.select(
        "url_key", F.col("span"), F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("bigint").alias("record_id"), F.lit(False).alias("asks"),
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("bigint").alias("n_bytes"),
        F.lit(None).cast("map<string,string>").alias("headers"), F.col("carried").alias("own"),
    )
    rows = usable.withColumn("own", own).unionByName(lead)
    # Times order; revisits stand before responses of their own second.
    place = W.partitionBy("url_key", "span").orderBy(F.col("at").asc_nulls_first(), F.col("asks").desc(), F.col("record_id").asc_nulls_first())
    seen = F.last("own", ignorenulls=True).over(place.rowsBetween(W.unboundedPreceding, W.currentRow))
    found = rows.withColumn("full", seen).filter("asks").drop("own")
    lost = events.filter("asks").filter(F.col("url_key").isNull() | F.col("at").isNull()).withColumn("full", F.lit(None).cast(_FULL))
    asked = found.unionByName(lost)
    pairs = [
        ("etag", F.col("headers")["etag"], F.col("full.headers")["etag"]),
        ("last-modified", F.col("headers")["last-modified"], F.col("full.headers")["last-modified"]),
        ("digest", F.col("digest"), F.col("full.digest")),
    ]
    validator, same = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for name, mine, theirs in reversed(pairs):
        both = mine.isNotNull() & theirs.isNotNull()
        # Weak and strong forms of an entity tag are compared weakly.
        equal = F.regexp_replace(mine, "^W/", "") == F.regexp_replace(theirs, "^W/", "")
        validator = F.when(both, F.lit(name)).otherwise(validator)
        same = F.when(both, equal).otherwise(same)
    state = (
        F.when(F.col("full").isNull(), "missing").when(validator.isNull(), "unchecked").when(same, "resolved").otherwise("changed")
    )
    permitted = F.map_filter("headers", lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter("full.headers", lambda k, v: ~F.coalesce(F.map_contains_key(permitted, k), F.lit(False)))
    merged = F.when(state == "resolved", F.map_concat(kept, permitted))
    return asked.select(
        "record_id", "url_key", "at",
        F.col("full.record_id").alias("response_id"), F.col("full.at").alias("response_at"),
        F.when(state == "resolved", F.col("full.digest")).alias("digest"),
        F.when(state == "resolved", F.col("full.n_bytes")).alias("n_bytes"),
        validator.alias("validator"), state.alias("state"), merged.alias("headers"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """A capture log of crawled pages: every page as a response, and a later revisit of it.

    Page n is captured n minutes after the start; its revisit follows after 1 to 9 hours. One
    revisit in five gives only the time of change, one in eleven a tag of another version.
    """
    n = F.col("page_id")
    body = F.coalesce(F.col("html"), F.lit(""))
    tag = F.concat(F.lit('"'), F.substring(F.md5(body), 1, 16), F.lit('"'))
    changed = (n * 60 - n % 5000).cast("string")
    at = n * 60
    later = at + (n % 9 + 1) * 3600
    stored = F.create_map(
        F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), tag, F.lit("Last-Modified"), changed,
        F.lit("Date"), at.cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"),
    )
    answered = F.map_filter(
        F.create_map(
            F.lit("ETag"), F.when(n % 5 == 0, F.lit(None)).when(n % 11 == 0, F.lit('"stale"')).otherwise(tag),
            F.lit("Last-Modified"), changed, F.lit("Date"), later.cast("string"), F.lit("Content-Type"), F.lit("text/plain"),
        ),
        lambda k, v: v.isNotNull(),
    )
    response = F.struct(
        (n * 2).alias("record_id"), at.alias("at"), F.lit("response").alias("kind"), F.lit(200).alias("status"),
        F.sha1(body).alias("digest"), F.octet_length(body).cast("bigint").alias("n_bytes"), stored.alias("headers"),
    )
    revisit = F.struct(
        (n * 2 + 1).alias("record_id"), later.alias("at"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.lit(None).cast("string").alias("digest"), F.lit(0).cast("bigint").alias("n_bytes"), answered.alias("headers"),
    )
    return pages.select("url", F.explode(F.array(response, revisit)).alias("capture")).select("url", "capture.*")
