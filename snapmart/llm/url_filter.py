"""URL filters with dated lists.

A list is a history: each entry says that from a day on a pattern is blocked,
allowed, or no longer listed. Entries become validity intervals, and every capture
is judged by the entries in force on the day it was fetched. Patterns name a URL,
a directory, a host, or a domain with all below it; the narrowest one in force decides.

The as-of join is an equi-join on the pattern, whose history is one row however old
it is: its entries in order of their days, among which a capture finds the one in force
by halving. Captures below a busy host or domain are dealt out by a salt, for which
only the entries below such names are repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of pattern, from wide to narrow.
KINDS = ("domain", "host", "prefix", "url")
#: Of entries for one pattern on one day the first of these counts.
ACTIONS = ("block", "allow", "remove")
#: A host or domain with one in so many of the captures is hot; copies of the entries below it, over which its captures are dealt.
HOT_SHARE = 256
SALTS = 32
#: Halving steps; 2 ** 22 days are more than dates can hold.
_STEPS = [1 << k for k in reversed(range(22))]

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)"
_QUERY = r"^[^?#]*(\?[^#]*)"


def host_of(url: Column) -> Column:
    """Host in lower case, without user and port; '' where the URL has none."""
    return F.lower(F.regexp_extract(url, _AUTHORITY, 1))


def url_key(url: Column) -> Column:
    """The URL without scheme, user, port and fragment."""
    return F.concat(host_of(url), F.regexp_extract(url, _PATH, 1), F.regexp_extract(url, _QUERY, 1))


def domains_of(host: Column) -> Column:
    """The host and the domains above it, down to two labels."""
    labels = F.split(host, r"\.")
    return F.when(F.size(labels) >= 2, F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )).otherwise(F.array().cast("array<string>"))


def prefixes_of(url: Column, deepest: int | None = None) -> Column:
    """host/dir/, host/dir/dir/ and so on, for every directory of the path, or for those down to ``deepest``."""
    dirs = F.filter(F.split(F.regexp_extract(F.regexp_extract(url, _PATH, 1), r"^(.*)/", 1), "/"), lambda d: d != "")
    depth = F.size(dirs) if deepest is None else F.least(F.size(dirs), F.lit(deepest))
    return F.when(depth >= 1, F.transform(
        F.sequence(F.lit(1), depth),
        lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(dirs, 1, i), "/"), F.lit("/")),
    )).otherwise(F.array().cast("array<string>"))


def _deepest(entries: DataFrame) -> int:
    """Directories of the deepest prefix listed, so that no capture is looked up further down than that."""
    slashes = F.length("pattern") - F.length(F.replace(F.col("pattern"), F.lit("/"), F.lit("")))
    return max(0, (entries.where(F.col("kind") == "prefix").agg(F.max(slashes)).first()[0] or 0) - 1)


def _patterns(url: Column, deepest: int) -> Column:
    """array<struct<kind, pattern>> of everything a list could name a capture by, its prefixes down to ``deepest``."""
    def named(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("pattern")))

    host = host_of(url)
    return F.when(host != "", F.concat(
        named("url", F.array(url_key(url))), named("prefix", prefixes_of(url, deepest)),
        named("host", F.array(host)), named("domain", domains_of(host)),
    )).otherwise(F.array().cast("array<struct<kind:string,pattern:string>>"))


def _rank(value: Column, order: tuple[str, ...]) -> Column:
    out = F.lit(None).cast("int")
    for i, name in enumerate(order):
        out = F.when(value == name, F.lit(i)).otherwise(out)
    return out


def histories(entries: DataFrame) -> DataFrame:
    """(kind, pattern, history): a row for each pattern, its entries array<struct<day, rank>> in order of their days.

    An entry holds up to the next one's day. Entries are first reduced to one for each
    pattern and day, so a history has at most as many entries as the list has days,
    however many rows name the pattern. Entries with a null, an unknown kind or an
    unknown action are ignored.
    """
    known = entries.select(
        F.col("kind"), F.col("pattern"), F.to_date("listed_at").alias("day"), _rank(F.col("action"), ACTIONS).alias("rank"),
    ).where(F.col("kind").isin(*KINDS) & F.col("pattern").isNotNull() & F.col("day").isNotNull() & F.col("rank").isNotNull())
    daily = known.groupBy("kind", "pattern", "day").agg(F.min("rank").alias("rank"))
    return daily.groupBy("kind", "pattern").agg(F.sort_array(F.collect_list(F.struct("day", "rank"))).alias("history"))


def _in_force(history: Column, day: Column) -> Column:
    """The last entry of ``history`` up to ``day``, found by halving; null if there is none."""
    last = F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), lambda at, step: F.when(
        F.get(history, at + step - 1)["day"] <= day, at + step).otherwise(at))
    return F.get(history, last - 1)


def hot_names(urls: DataFrame, url_col: str = "url") -> list[str]:
    """Hosts and domains with at least one in HOT_SHARE of the rows; at most HOT_SHARE times the labels of a host."""
    hosts = urls.groupBy(host_of(F.col(url_col)).alias("host")).agg(F.count("*").alias("n"))
    names = hosts.select("n", F.explode(F.array_union(F.array("host"), domains_of(F.col("host")))).alias("name"))
    counted = names.groupBy("name").agg(F.sum("n").alias("n"))
    return [r["name"] for r in counted.where(F.col("n") * HOT_SHARE >= urls.select(F.count("*")).scalar()).collect()]


def judge(
    captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at",
) -> DataFrame:
    """(id, url, fetched_on, blocked, kind, pattern, listed_on), a row for each row of ``captures``.

    ``entries`` has kind, pattern, action and listed_at (date or timestamp); an
    entry holds from the start of its day. The narrowest pattern in force that isn't
    removed decides: url before prefix (longer first) before host before domain
    (longer first). Without one, ``blocked`` is false and the last three are null.

    A null URL, one without host, and a null time match nothing. Repeated rows
    keep a row each. Other columns of either table are ignored. An empty list
    blocks nothing. Directories are looked up as far down as the list goes, which
    takes one small job at once, as do the hot names.
    """
    rows = captures.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.to_date(F.col(time_col)).alias("fetched_on"))
    distinct = rows.groupBy("id", "url", "fetched_on").agg(F.count("*").alias("copies"))
    hot = F.substring_index("pattern", "/", 1).isin(hot_names(rows))
    salts = F.explode(F.sequence(F.lit(0), F.when(hot, F.lit(SALTS - 1)).otherwise(F.lit(0))))
    listed = histories(entries).select("*", salts.alias("salt"))
    named = distinct.select(
        "id", "url", "fetched_on", F.explode(_patterns(F.col("url"), _deepest(entries))).alias("p"),
    ).select("id", "url", "fetched_on", "p.kind", "p.pattern").withColumn(
        "salt", F.when(hot, F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    met = named.join(listed, ["kind", "pattern", "salt"]).select(
        "id", "url", "fetched_on", "kind", "pattern", _in_force(F.col("history"), F.col("fetched_on")).alias("entry"))
    removed = ACTIONS.index("remove")
    deciding = met.groupBy("id", "url", "fetched_on").agg(F.max(F.when(F.col("entry.rank") != removed, F.struct(
        _rank(F.col("kind"), KINDS).alias("narrow"), F.length("pattern").alias("chars"),
        F.col("entry.rank").alias("rank"), F.col("kind"), F.col("pattern"), F.col("entry.day").alias("listed_on"),
    ))).alias("d"))
    # a capture with a null in its key meets nothing above, so plain equality serves here
    judged = distinct.join(deciding, ["id", "url", "fetched_on"], "left")
    return judged.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "fetched_on",
        F.coalesce(F.col("d.rank") == ACTIONS.index("block"), F.lit(False)).alias("blocked"),
        F.col("d.kind").alias("kind"), F.col("d.pattern").alias("pattern"), F.col("d.listed_on").alias("listed_on"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")
