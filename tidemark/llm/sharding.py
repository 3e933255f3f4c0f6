"""Balanced label propagation with DataFrame functions only.

Documents with equal texts are linked. Every document starts with a shard by hash. In
each round the groups of linked documents that have not settled propose to move to the
shard where most of their documents are, among the shards with room for all of them; a
shard takes whole groups, in an order of their own, up to its capacity, and these have
settled. What a shard cannot take proposes again. Groups go by size, in tiers of a
factor of two, the largest first; a tier's rounds end when all have settled or none
of the rest fits anywhere. Unlinked documents fill what is left.

A group larger than a shard is cut. Of the others fewer than the number of shards are:
each of those was larger than any room left when its tier ended, rooms only shrink, and
together they are no more than all rooms. These few and the cut ones are given the rooms
left by a plan on the driver. So the counts end at most one apart (law `rows`), and
where groups fit they stay whole.

Rounds work on one row a group, with the number of its documents by shard. Ranks
and sums that decide quotas are taken in two levels, over bins and inside them, so no
task sorts a shard or a group; only bin counts are added up along a shard.

Defined results: a null text counts as the empty text, however long texts are compared
by hash and length; repeated rows are rows of their own; other columns are never read;
an empty table gives no rows. Which group comes first in a quota follows from its hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

SHARDS = 8
ROW_BINS = 256
ROWS_A_BIN = 100_000


def _choose(key: Column, values: dict[int, int]) -> Column:
    """The value of a small integer key; 0 for others."""
    out = F.lit(0).cast("long")
    for k, v in values.items():
        out = F.when(key == k, F.lit(v).cast("long")).otherwise(out)
    return out


def _ranked(rows: DataFrame, key: str, bin_: Column) -> DataFrame:
    """Add `rank`, from 1 within `key`, by bin and then by row number."""
    rows = rows.withColumn("bin", bin_)
    sizes = rows.groupBy(key, "bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(key, "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy(key, "bin").orderBy("uid"))
    return rows.join(sizes, [key, "bin"]).withColumn("rank", inside + F.col("before")).drop("bin", "before")


def _counts(rows: DataFrame) -> dict[int, int]:
    return {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # a row a shard


def _round(groups: DataFrame, room: dict[int, int], bins: int) -> DataFrame:
    """Add `to`, where a group (gid, n, held) proposes to move, and `settled`, whether it is taken."""
    wishes = [
        F.when(F.col("n") <= room[s], F.struct(
            F.get("held", F.lit(s)).alias("n"), F.xxhash64("gid", F.lit(s)).alias("tie"), F.lit(s).alias("to")
        )) for s in room
    ]
    asked = groups.withColumn("to", F.array_max(F.array(*wishes))["to"])
    asked = asked.withColumn("spot", F.xxhash64("gid")).withColumn("bin", F.pmod("spot", F.lit(bins)))
    sums = asked.groupBy("to", "bin").agg(F.sum("n").alias("sum"))
    before = Window.partitionBy("to").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("to", "bin", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"))
    upto = F.sum("n").over(Window.partitionBy("to", "bin").orderBy("spot", "gid").rowsBetween(Window.unboundedPreceding, 0))
    ranked = asked.withColumn("upto", upto).join(sums, ["to", "bin"], "left")
    taken = F.col("upto") + F.col("before") <= _choose(F.col("to"), room)
    return ranked.select("gid", "n", "held", "to", F.coalesce(taken, F.lit(False)).alias("settled"))


def _settle(groups: DataFrame, room: dict[int, int]) -> tuple[DataFrame | None, list[tuple[int, int]]]:
    """Label groups (gid, n, held) that fit; `room` is used up. Returns gid and `to`, and the few (gid, n) left over."""
    tier = F.floor(F.log2("n")).alias("tier")
    tiers = groups.groupBy(tier).agg(F.count("*").alias("n")).orderBy(F.desc("tier")).collect()  # at most 63 rows
    parts, left = [], []
    for t in tiers:
        waiting = groups.where(F.floor(F.log2("n")) == t.tier)
        number, least = t.n, 1 << int(t.tier)
        while number and least <= max(room.values()):
            bins = max(16, number // ROWS_A_BIN)
            waiting = stage(_round(waiting, room, bins), "shard-round")
            taken = waiting.where("settled").groupBy("to").agg(F.sum("n").alias("n")).collect()  # a row a shard
            for r in taken:
                room[r.to] -= r.n
            parts.append(waiting.where("settled").select("gid", "to"))
            waiting = waiting.where(~F.col("settled")).select("gid", "n", "held")
            number, least = waiting.agg(F.count("*"), F.coalesce(F.min("n"), F.lit(0))).first()
        if number:
            left += [(r.gid, r.n) for r in waiting.select("gid", "n").collect()]  # fewer than shards in all tiers
    return (reduce(DataFrame.unionByName, parts) if parts else None), left


def _place_giants(sizes: list[tuple[int, int]], room: dict[int, int]) -> list[tuple[int, int, int]]:
    """(group, first rank after, shard) for groups by size: the tightest shard that holds one whole, else the emptiest."""
    places = []
    for gid, n in sorted(sizes, key=lambda g: (-g[1], g[0])):
        upto = 0
        while upto < n:
            fit = [s for s in room if room[s] >= n - upto]
            s = min(fit, key=lambda s: (room[s], s)) if fit else max(room, key=lambda s: (room[s], -s))
            take = min(room[s], n - upto)
            room[s] -= take
            upto += take
            places.append((gid, upto, s))
    return places


def _by_room(room: dict[int, int]) -> Column:
    """A shard by hash of the row number, in proportion to the room."""
    upto = sum(room.values())
    spot, out = F.pmod(F.xxhash64("uid"), F.lit(max(1, upto))), F.lit(max(room))
    for s in sorted(room, reverse=True):
        out = F.when(spot < upto, F.lit(s)).otherwise(out)
        upto -= room[s]
    return out.cast("int")


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """`keep`, size, text_crc32, shard, slot and whether the text has copies (`linked`), for every row."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    compact = docs.select(
        F.col(f"`{keep}`").alias("doc_id"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.xxhash64(whole).alias("hash"),
        F.monotonically_increasing_id().alias("uid"),
    )
    # Equal texts agree in two hashes and the length.
    rows = stage(compact.withColumn("gid", F.xxhash64("hash", "text_crc32", "size")).drop("hash"), "shard-rows")
    total = rows.count()
    cap = {s: total // shards + (s < total % shards) for s in range(shards)}
    row_bins = max(ROW_BINS, total // (ROWS_A_BIN * shards))
    row_bin = F.pmod(F.xxhash64("uid"), F.lit(row_bins))

    # Written first, as Spark splits a hot key of a join only if both sides come straight from a shuffle.
    start = F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")
    tally = rows.groupBy("gid", start.alias("label")).agg(F.count("*").alias("n"))
    held = [F.coalesce(F.sum(F.when(F.col("label") == s, F.col("n"))), F.lit(0)) for s in range(shards)]
    groups = stage(tally.groupBy("gid").agg(F.sum("n").alias("n"), F.array(*held).alias("held")).where("n > 1"), "shard-groups")
    room = dict(cap)
    large = F.col("n") > (max(cap.values()) if cap else 0)
    places = _place_giants([(r.gid, r.n) for r in groups.where(large).select("gid", "n").collect()], room)  # fewer than shards
    settled, left = _settle(groups.where(~large), room)
    places += _place_giants(left, room)
    label = groups.select("gid", F.lit(None).cast("int").alias("to")).where(F.lit(False)) if settled is None else settled
    cut = sorted({gid for gid, _, _ in places})
    label = label.unionByName(groups.where(F.col("gid").isin(cut)).select("gid", F.lit(-1).alias("to")))
    known = rows.join(stage(label, "shard-settled"), "gid", "left").select(
        "doc_id", "size", "text_crc32", "uid", "gid", F.col("to").isNotNull().alias("linked"),
        F.coalesce("to", _by_room(room)).cast("int").alias("label"),
    )
    known = stage(known, "shard-links")
    ranked = _ranked(known.where("label = -1"), "gid", row_bin)
    label = F.col("label")
    for gid, upto, s in reversed(places):
        label = F.when((F.col("gid") == gid) & (F.col("rank") <= upto), F.lit(s)).otherwise(label)
    giants = ranked.withColumn("label", label).drop("rank")

    every = known.where("label >= 0").unionByName(giants)
    every = stage(every, "shard-labels")
    have = _counts(every)
    ranked = _ranked(every, "label", F.when(F.col("linked"), row_bin).otherwise(row_bin + row_bins))
    # Rows beyond a shard's capacity are numbered through all shards and fill the gaps in order.
    over, gaps, n_over, n_gap = {}, [], 0, 0
    for s in range(shards):
        over[s] = n_over
        n_over += max(0, have.get(s, 0) - cap[s])
        if have.get(s, 0) < cap[s]:
            gaps.append((n_gap, s))
            n_gap += cap[s] - have.get(s, 0)
    stays = F.col("rank") <= _choose(F.col("label"), cap)
    number = F.col("rank") - _choose(F.col("label"), cap) + _choose(F.col("label"), over) - 1
    to, slot = F.lit(0), F.lit(0).cast("long")
    for begin, s in gaps:
        to = F.when(F.col("number") >= begin, F.lit(s)).otherwise(to)
        slot = F.when(F.col("number") >= begin, F.col("number") - begin + have.get(s, 0)).otherwise(slot)
    placed = ranked.withColumn("number", F.when(~stays, number))
    return placed.select(
        "doc_id", "size", "text_crc32",
        F.when(stays, F.col("label")).otherwise(to).cast("int").alias("shard"),
        F.when(stays, F.col("rank") - 1).otherwise(slot).cast("long").alias("slot"),
        "linked",
    )
