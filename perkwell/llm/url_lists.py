"""Which list entries were active when a page was fetched.

A list is a log of dated entries: from ``since`` on, ``key`` is blocked, allowed
or no longer listed (``remove``). A key is a host (which covers its subdomains)
or a host and the beginning of a path, such as ``example.com/ads``. Entries of a
key become validity intervals ``[valid_from, valid_to)``; an as-of join finds for
each capture the interval of each of its keys that holds the day of the fetch.
The longest listed key decides. Only keys as long as some listed key are looked up, so a very long URL has no more
of them than a short one.

Edge cases: of several entries of one key on one day, ``allow`` goes before
``block`` before ``remove``; entries with a NULL part are ignored; a capture
without a usable URL or without a date is kept with decision ``unlisted``;
repeated captures become one row with their count; unknown extra columns are not
read; empty tables give empty or unlisted results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from perkwell.llm.common import let

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)"
SALTS = 32


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dots; empty where there is none."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), F.lit("."))


def list_keys(url: Column, labels: Column | None = None, depths: Column | None = None) -> Column:
    """All keys a list may hold for a URL: the host, its parents, the host with beginnings of the path.

    With ``labels`` and ``depths`` only keys of so many host labels, and so many path segments, are made.
    """
    def keys(host: Column) -> Column:
        return F.when(host == "", F.array().cast("array<string>")).otherwise(F.concat(parents(host), deep(host)))

    def parents(host: Column) -> Column:
        def made(parts: Column) -> Column:
            sizes = F.sequence(F.size(parts), F.lit(1)) if labels is None else F.filter(labels, lambda n: n <= F.size(parts))
            return F.transform(sizes, lambda n: F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "."))

        return let(F.split(host, r"\."), made)

    def deep(host: Column) -> Column:
        def made(path: Column) -> Column:
            every = F.when(F.size(path) > 0, F.sequence(F.lit(1), F.greatest(F.size(path), F.lit(1)))).otherwise(F.array().cast("array<int>"))
            sizes = every if depths is None else F.filter(depths, lambda n: (n > 0) & (n <= F.size(path)))
            return F.transform(sizes, lambda n: F.concat(host, F.lit("/"), F.array_join(F.slice(path, F.lit(1), n), "/")))

        return let(F.filter(F.split(F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1), "/"), lambda p: p != ""), made)

    return let(host_of(url), keys)


def listed_sizes(entries: DataFrame) -> tuple[Column, Column]:
    """The numbers of host labels and of path segments that listed keys have, as two arrays.

    A URL of any length has one beginning of each such depth, so its keys do not grow with it.
    """
    key = F.col("key")
    sizes = entries.where(key.isNotNull()).agg(
        F.collect_set(F.size(F.split(F.substring_index(key, "/", 1), r"\."))).alias("labels"),
        F.collect_set(F.size(F.split(key, "/")) - 1).alias("depths"),
    )
    return sizes.select("labels").scalar(), sizes.select("depths").scalar()


def intervals(entries: DataFrame) -> DataFrame:
    """key, action, valid_from, valid_to (NULL: still valid) from entries (key, action, since).

    Entries are first brought down to one per key and day, so that a key has no
    more rows than there are days, however long its log is.
    """
    precedence = F.when(F.col("action") == "allow", 2).when(F.col("action") == "block", 1).when(F.col("action") == "remove", 0)
    daily = (
        entries.select("key", F.to_date("since").alias("valid_from"), precedence.alias("_rank"))
        .dropna().groupBy("key", "valid_from").agg(F.max("_rank").alias("_rank"))
    )
    by_key = Window.partitionBy("key").orderBy("valid_from")
    return (
        daily.withColumn("valid_to", F.lead("valid_from").over(by_key)).filter("_rank > 0")
        .select("key", F.when(F.col("_rank") == 2, "allow").otherwise("block").alias("action"), "valid_from", "valid_to")
    )


def evaluate(captures: DataFrame, entries: DataFrame, salts: int = SALTS) -> DataFrame:
    """Decision for each capture (page_id, url, fetched): ``blocked``, ``allowed`` or ``unlisted``.

    One host may hold a third of the captures, so its rows are dealt over ``salts`` parts.
    """
    labels, depths = listed_sizes(entries)
    sized = captures.select("page_id", "url", F.to_date("fetched").alias("fetched"), labels.alias("_labels"), depths.alias("_depths"))
    keyed = sized.select(
        "page_id", "url", "fetched", F.xxhash64("page_id", "url").alias("_row"),
        F.posexplode_outer(list_keys(F.col("url"), F.col("_labels"), F.col("_depths"))).alias("_n", "_key"),
    )
    listed = intervals(entries).select(F.col("key").alias("_key"), "action", "valid_from", "valid_to")
    part = F.pmod("_row", F.lit(salts)).cast("int")
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    left = keyed.withColumn("_salt", part)
    right = listed.withColumn("_part", parts).withColumnRenamed("_key", "_listed")
    active = (
        (F.col("_key") == F.col("_listed")) & (F.col("_salt") == F.col("_part"))
        & (F.col("fetched") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to")))
    )
    hit = F.when(F.col("_listed").isNotNull(), F.struct(
        F.length("_listed").alias("size"), F.col("_listed").alias("key"), "action", "valid_from"
    ))
    best = left.join(right, active, "left").groupBy("page_id", "url", "fetched").agg(
        F.max(hit).alias("_hit"), F.sum(F.when(F.coalesce("_n", F.lit(0)) == 0, 1).otherwise(0)).alias("n_captures"),
    )
    decision = F.when(F.col("_hit.action") == "block", "blocked").when(F.col("_hit.action") == "allow", "allowed")
    return best.select(
        "page_id", "url", "fetched", F.coalesce(decision, F.lit("unlisted")).alias("decision"),
        F.col("_hit.key").alias("entry"), F.col("_hit.valid_from").alias("listed_since"), "n_captures",
    )
