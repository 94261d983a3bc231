"""URL lists that change over time.

List entries are dated: an address is put on a list on one day and may be taken off on another.
Per address they become validity intervals; a capture is judged by the entries that were active
on the day it was fetched, not by the list of today. An entry for a host covers the hosts below
it, an entry for a page that page. The most specific active entry decides; between equals, a
block does.

Only DataFrame functions are used. Intervals are made from at most one row for an address and
day. They are cut at months, so that capture and interval meet on (address, month) by equality and
no address gathers all its captures in one place; an address with a great share of them is dealt
out further. Addresses that no list ever names are sifted out before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonal.llm.common import HOT_SHARE, free_name, sift
from zonal.operators.staging import stage

# Parts into which the captures of a hot (address, month) are dealt.
SALTS = 32

BLOCK, ALLOW, REMOVE = "block", "allow", "remove"


def host_of(url: Column) -> Column:
    """Host in lower case, without user, port or a last dot; NULL if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def page_of(url: Column) -> Column:
    """Host and path, without query and fragment; the key of an entry for one page."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.concat(host_of(url), F.when(path == "", F.lit("/")).otherwise(path))


def keys_of(url: Column) -> Column:
    """All addresses an entry may name to cover the URL, each with its rank: 0 for the page,
    then the host, then each domain above it. At most one per label of the host."""
    labels = F.split(host_of(url), r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("address"), i.alias("rank")),
    )
    return F.when(host_of(url).isNotNull(), F.concat(F.array(F.struct(page_of(url).alias("address"), F.lit(0).alias("rank"))), hosts))


def validity(entries: DataFrame) -> DataFrame:
    """Entries (address, day, action: block, allow or remove) to disjoint intervals (address,
    action, from_day, to_day), end excluded and NULL while the entry stands. Of several entries
    on one day a removal loses to an allowance and that to a block. Repeated actions melt into
    one interval. Unknown actions, NULL addresses and NULL days are no entries."""
    strength = F.when(F.col("action") == BLOCK, 2).when(F.col("action") == ALLOW, 1).when(F.col("action") == REMOVE, 0)
    known = entries.select("address", "day", strength.alias("state")).where("address is not null and day is not null and state is not null")
    # partial maxima first: an address has at most one row per day from here on
    daily = known.groupBy("address", "day").agg(F.max("state").alias("state"))
    along = Window.partitionBy("address").orderBy("day")
    turns = daily.withColumn("was", F.coalesce(F.lag("state").over(along), F.lit(0))).where("state <> was")
    spans = turns.withColumn("to_day", F.lead("day").over(along)).where("state > 0")
    action = F.when(F.col("state") == 2, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return spans.select("address", action.alias("action"), F.col("day").alias("from_day"), "to_day")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", day: str = "day") -> DataFrame:
    """Every row of `captures` with `blocked`, `decided_by` (address of the deciding entry, NULL
    if none was active), `decided_rank` (0 page, 1 host, 2 the domain above, ...) and
    `active_entries`, the number of entries active for it on its day.

    A URL without a host, a NULL URL or a NULL day is covered by nothing: not blocked. Repeated
    captures are judged each; added names that are taken get an underscore. No captures: no rows;
    no entries: nothing blocked."""
    row = free_name(captures, "capture_row")
    held = stage(captures.withColumn(row, F.monotonically_increasing_id()))
    intervals = stage(validity(entries))
    asked = held.select(F.col(row).alias("row"), F.col(day).cast("date").alias("day"), F.inline(keys_of(F.col(url))))
    # only addresses that are on some list can meet; the month keeps any of them apart by time
    asked = asked.where(F.col("day").isNotNull()).withColumn("month", F.trunc("day", "month"))
    asked = stage(sift(asked, "address", intervals, intervals.count()))
    last = held.agg(F.max(F.col(day).cast("date")).alias("last"))
    open_until = F.greatest("from_day", F.coalesce(F.date_sub("to_day", 1), "last"))
    cut = intervals.join(F.broadcast(last)).where("from_day <= last")  # one row
    cut = cut.withColumn("month", F.explode(F.sequence(F.trunc("from_day", "month"), F.trunc(F.least(open_until, "last"), "month"), F.expr("interval 1 month"))))
    cut = cut.select("address", F.col("month").cast("date").alias("month"), "action", "from_day", "to_day")

    sizes = stage(asked.groupBy("address", "month").agg(F.count(F.lit(1)).alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # at most HOT_SHARE rows by construction
    hot = F.broadcast(sizes.where(F.col("n") * F.lit(HOT_SHARE) > F.lit(total)).select("address", "month", F.lit(SALTS).alias("salts")))
    salts = F.coalesce("salts", F.lit(1))
    asked = asked.join(hot, ["address", "month"], "left").withColumn("salt", F.pmod(F.xxhash64("row"), salts).cast("int"))
    cut = cut.join(hot, ["address", "month"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    met = asked.drop("salts").join(cut.drop("salts"), ["address", "month", "salt"])
    met = met.where("from_day <= day and (to_day is null or day < to_day)")
    first = F.struct("rank", F.when(F.col("action") == BLOCK, 0).otherwise(1).alias("mild"), "address")
    verdicts = met.groupBy("row").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("active"))

    named = {n: free_name(captures, n) for n in ("blocked", "decided_by", "decided_rank", "active_entries")}
    verdicts = verdicts.select(
        F.col("row").alias(row),
        (F.col("first.mild") == 0).alias(named["blocked"]),
        F.col("first.address").alias(named["decided_by"]),
        F.col("first.rank").alias(named["decided_rank"]),
        F.col("active").alias(named["active_entries"]),
    )
    judged = held.join(verdicts, row, "left").drop(row)
    return judged.withColumns({
        named["blocked"]: F.coalesce(named["blocked"], F.lit(False)),
        named["active_entries"]: F.coalesce(named["active_entries"], F.lit(0).cast("bigint")),
    })
