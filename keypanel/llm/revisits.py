"""Not-modified revisits in web archives, resolved against the latest earlier full response.

A revisit record holds headers of a 304 answer but no payload.  It is matched by
canonical URL to the latest full response of an earlier date; validators decide
whether that response may stand in for it, and the headers a 304 may change are
merged into the stored ones.

The as-of join works in blocks of time.  Inside a block it is a window over the
distinct dates of one URL in one hour, which bounds the rows; what earlier blocks
leave is carried in by a window over one row per URL and block.  Headers and
payloads join afterwards by record id.

Defined cases: a missing URL or date, and a URL without an earlier full response,
give ``no-response``; records of the same date are not earlier.  Of several
responses with one date the greatest record id counts.  If both sides have an
entity tag, tags decide by weak comparison; else both dates of last modification
decide; without a common validator the state is ``unvalidated``, on a difference
``mismatch``, else ``resolved``.  Only resolved rows get merged headers and a
payload.  Repeated revisits stay, one result each; record ids of responses are
taken to be unique (of equal ones the first headers in sorted order count).  Headers and
payloads of any length are carried whole; an empty table gives no rows, and columns
of ``records`` beyond those named are left out.

Both joins have an exchange on either side, so Spark splits a partition that a popular
URL or response makes large; revisits without a partner are dealt to all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keypanel.llm.words import apart, nought

BLOCK_SECONDS = 3600

# Fields that belong to one connection, and those a 304 must not change.
HOP_BY_HOP = ("connection", "keep-alive", "proxy-authenticate", "proxy-authentication-info", "proxy-authorization",
              "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade")
OF_THE_PAYLOAD = ("content-encoding", "content-length", "content-range", "content-type")


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no default port, no fragment, parameters in order, a path at least ``/``."""
    scheme = F.lower(F.regexp_extract(url, r"^([^:/?#]+)://", 1))
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[^:/?#]+://([^/?#]*)", 1)), r":$", "")
    host = (F.when(scheme == "http", F.regexp_replace(host, r":80$", ""))
            .when(scheme == "https", F.regexp_replace(host, r":443$", "")).otherwise(host))
    path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    query = F.array_join(F.sort_array(F.split(query, "&")), "&")
    return F.when(scheme != "", F.concat(
        scheme, F.lit("://"), host, F.when(path == "", F.lit("/")).otherwise(path),
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))))


def field(headers: Column, name: str) -> Column:
    """The first value of a header field, or null."""
    return F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]


def _weak(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def latest_earlier(responses: DataFrame, revisits: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """(url, date, response_id) for the distinct (url, date) of ``revisits``; both sides have url and date."""
    block = F.floor(F.unix_seconds(F.col("date").cast("timestamp")) / block_seconds)
    at = F.unix_micros(F.col("date").cast("timestamp"))
    offered = responses.groupBy("url", "date").agg(F.max("record_id").alias("response_id"))
    events = offered.select("url", "date", "response_id", F.lit(False).alias("asked")).unionByName(
        revisits.select("url", "date").distinct().select("url", "date", F.lit(None).cast("long").alias("response_id"), F.lit(True).alias("asked")))
    events = events.select("url", "date", "response_id", "asked", block.alias("block"), at.alias("at"))
    carried = events.groupBy("url", "block").agg(F.max_by("response_id", F.when(F.col("response_id").isNotNull(), F.col("at"))).alias("last"))
    earlier_blocks = Window.partitionBy("url").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select("url", "block", F.last("last", ignorenulls=True).over(earlier_blocks).alias("carried"))
    in_block = Window.partitionBy("url", "block").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = events.withColumn("inside", F.last("response_id", ignorenulls=True).over(in_block)).where("asked")
    return found.join(carried, ["url", "block"], "left").select(
        "url", "date", F.coalesce("inside", "carried").alias("response_id"))


def merged_headers(stored: Column, update: Column) -> Column:
    """Stored fields with those of a 304 in place of fields of the same name."""
    names = F.flatten(F.transform(F.filter(update, lambda h: F.lower(h["name"]) == "connection"),
                                  lambda h: F.transform(F.split(F.lower(h["value"]), ","), F.trim)))
    barred = F.concat(F.array(*[F.lit(n) for n in HOP_BY_HOP + OF_THE_PAYLOAD]), names)
    allowed = F.filter(update, lambda h: ~F.array_contains(barred, F.lower(h["name"])))
    changed = F.transform(allowed, lambda h: F.lower(h["name"]))
    return F.concat(F.filter(stored, lambda h: ~F.array_contains(changed, F.lower(h["name"]))), allowed)


def resolve_revisits(records: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per revisit: (record_id, url, date, response_id, state, headers, payload).

    ``records`` has record_id, type (``response`` or ``revisit``), uri, date, status,
    headers (array of name and value) and payload.
    """
    known = records.select("record_id", "type", canonical_url(F.col("uri")).alias("url"), "date", "status",
                           F.coalesce("headers", F.array().cast("array<struct<name:string,value:string>>")).alias("headers"), "payload")
    responses = known.where("type = 'response' and status = 200 and url is not null and date is not null")
    revisits = known.where("type = 'revisit'").select("record_id", "url", "date", "headers")
    latest = latest_earlier(responses.select("record_id", "url", "date"),
                            revisits.where("url is not null and date is not null"), block_seconds)
    latest = latest.withColumn("apart", nought("url", "date"))
    asked = revisits.withColumn("apart", apart(revisits, F.col("url").isNotNull() & F.col("date").isNotNull())).join(
        latest, ["url", "date", "apart"], "left").drop("apart")
    kept = responses.groupBy(F.col("record_id").alias("response_id")).agg(
        F.min(F.struct("headers", "payload")).alias("kept")).withColumn("apart", nought("response_id"))
    pairs = asked.withColumn("apart", apart(asked, F.col("response_id").isNotNull())).join(kept, ["response_id", "apart"], "left")
    theirs, ours = F.col("kept.headers"), F.col("headers")
    tag, other = _weak(field(ours, "etag")), _weak(field(theirs, "etag"))
    changed, before = field(ours, "last-modified"), field(theirs, "last-modified")
    state = (F.when(F.col("kept").isNull(), "no-response")
             .when(tag.isNotNull() & other.isNotNull(), F.when(tag == other, "resolved").otherwise("mismatch"))
             .when(changed.isNotNull() & before.isNotNull(), F.when(changed == before, "resolved").otherwise("mismatch"))
             .otherwise("unvalidated"))
    pairs = pairs.withColumn("state", state)
    good = F.col("state") == "resolved"
    return pairs.select("record_id", "url", "date", "response_id", "state",
                        F.when(good, merged_headers(theirs, ours)).alias("headers"),
                        F.when(good, F.col("kept.payload")).alias("payload"))
