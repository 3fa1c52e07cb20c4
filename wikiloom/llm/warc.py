"""Not-modified revisits resolved to the latest earlier full response of the same page.

Records have record_id, url, ts, kind ("response" or "revisit"), etag, digest and headers (a map).
Records are sorted by canonical URL, time and kind over all tasks; the place of the latest response
before a record is a running maximum over chunks of that order, so a page with any number of records
is never gathered. A revisit is resolved if that response has the same canonical URL and an
earlier time and its validators agree: equal entity tags (compared weakly) where both have one, else
equal Last-Modified headers where both have one, else equal payload digests where both have one.
Other revisits are reported as ``no_response`` or ``changed``.

The merged headers are those of the response, with the headers that a 304 answer may update taken
from the revisit. Of responses at one time the one with the greatest id is the latest (a null id is the
smallest), of equal ones the last row. Null or empty URLs resolve nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikiloom.llm.ordered import running_max
from wikiloom.scale import landed, lookup, with_index

# Headers that an answer "not modified" may update
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
TRACKING = "utm_[^=&]*|ref"


def canonical_url(url: Column) -> Column:
    """Lower-case host without a leading www, no scheme, default port, fragment, tracking
    parameters, index.html or slash at the end."""
    bare = F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r":(80|443)$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.html$", "/"), r"/+$", "")
    params = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.filter(
        F.split(params, "&"),
        lambda p: (p != "") & ~F.regexp_like(p, F.lit(rf"^({TRACKING})(=|$)")),
    )
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def merged_headers(full: Column, update: Column) -> Column:
    """Headers of the response, with the permitted ones of the revisit over them; lower-case names."""
    names = F.array(*[F.lit(n) for n in PERMITTED])

    def plain(headers: Column) -> Column:
        return F.transform(
            F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>"))),
            lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
        )

    new = F.filter(plain(update), lambda e: F.array_contains(names, e["key"]))
    old = F.filter(plain(full), lambda e: ~F.exists(new, lambda n: n["key"] == e["key"]))
    return F.array_sort(F.concat(old, new))


def last_modified(headers: Column) -> Column:
    """The Last-Modified header, whatever the case of its name; null without one."""
    named = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == "last-modified")
    return F.trim(F.get(named, F.lit(0))["value"])


def same_content(mine: dict[str, Column], theirs: dict[str, Column]) -> Column:
    """Whether validators agree: the first of entity tag, date of change and digest that both have decides."""
    agree = F.lit(False)
    for name in ("digest", "modified", "etag"):
        a, b = mine[name], theirs[name]
        agree = F.when(a.isNotNull() & b.isNotNull(), a == b).otherwise(agree)
    return agree


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Per revisit row: record_id, page (canonical URL), status, response_id, headers (sorted array of
    key, value; null unless resolved).

    Rows are told apart by a key of their own, so ids may be null or repeated: each revisit row gives one
    row. A record without a kind is a revisit. A record without a time resolves nothing and is
    not resolved. An empty table gives none.
    """
    rows = landed(
        records.select(
            F.monotonically_increasing_id().alias("row"), "record_id",
            canonical_url(F.coalesce("url", F.lit(""))).alias("page"), "ts",
            F.coalesce(F.col("kind") == "response", F.lit(False)).cast("int").alias("full"),
            F.regexp_replace("etag", "^W/", "").alias("etag"), last_modified(F.col("headers")).alias("modified"),
            "digest", "headers",
        ),
        "warc-records",
    )
    # At one time a revisit stands before a response, which is not earlier than it.
    narrow = rows.select("page", "ts", "full", "record_id", "row")
    placed = with_index(narrow, ["page", "ts", "full", "record_id", "row"], "place")
    placed = landed(placed, "warc-places")
    timed = (F.col("full") == 1) & F.col("ts").isNotNull()
    marked = placed.withColumn("_full_at", F.when(timed, F.col("place")))
    latest = running_max(marked, [], "place", "_full_at", "latest", placed.count())
    visits = landed(
        latest.where("full = 0 and page <> '' and ts is not null and latest is not null")
        .select("row", F.col("page").alias("_page"), "latest"), "warc-visits",
    )
    full = placed.where("full = 1").select(
        F.col("place").alias("latest"), F.col("page").alias("_of"), F.col("row").alias("_response")
    )
    sized = visits.groupBy("latest").agg(F.count(F.lit(1)).alias("_n"))
    paired = lookup(visits, full, ["latest"], ["row"], "inner", counts=sized).where("_of = _page")
    paired = landed(paired.select("row", "_response"), "warc-pairs")
    bodies = rows.where("full = 1").select(
        F.col("row").alias("_response"), F.col("record_id").alias("response_id"),
        *[F.col(c).alias(f"_{c}") for c in ("etag", "modified", "digest", "headers")],
    )
    joined = lookup(paired, bodies, ["_response"], ["row"], "inner")
    both = rows.where("full = 0").join(joined, "row", "left")
    names = ("etag", "modified", "digest")
    agree = same_content({c: F.col(c) for c in names}, {c: F.col(f"_{c}") for c in names})
    status = F.when(F.col("_response").isNull(), "no_response").when(agree, "resolved").otherwise("changed")
    return both.select(
        "record_id", "page", status.alias("status"), "response_id",
        F.when(status == "resolved", merged_headers(F.col("_headers"), F.col("headers"))).alias("headers"),
    )
