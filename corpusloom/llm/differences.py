"""Sets that share a leader, compared by how they differ from it.

A group is a leader and members that may be similar to it and to each other. Every member is compared with the leader, exactly; what is
left is decided from the differences alone, which are small where a group's members are copies of one another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import as_table, drop_table, materialise, release_driver
from corpusloom.llm.components import connected_components

#: Members of a leader's group whose differences are compared directly; in larger groups they are joined by what they share.
DIRECT = 32
#: What decides which member of a large group is its centre: one of so many parts, of so many members at most.
CENTRE_SHARE, CENTRE_MEMBERS = 4, 256
#: A part that so many of these members have is among the frequent ones.
FREQUENT = 4
#: 64-bit words of the sketch of a member's differences, in which each sets a bit.
SKETCH_WORDS = 4
#: Rows of 8 to 16 bytes that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def few(df: DataFrame) -> DataFrame:
    """df marked for a broadcast if its rows are few enough to."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def differences(both: DataFrame, least: float, *more: str) -> DataFrame:
    """(lead, key, size, plus, minus, alike, parts) of (lead, key, n, theirs, own): how a member's set differs from its leader's.

    ``own`` may hold repeats, ``theirs`` none; ``n`` counts the group's members. ``size`` counts the leader's elements, ``plus`` those
    only the member has, ``minus`` those it lacks; ``parts`` are these, the former first. A group of one member needs no parts.
    ``alike``: the similarity is at least ``least``. Columns named in ``more`` stay.
    """
    split = both.select("lead", "key", "n", *more, F.size("theirs").alias("size"), F.array_except("own", "theirs").alias("more"), F.array_except("theirs", "own").alias("less"))
    counted = split.select("*", F.size("more").alias("plus"), F.size("less").alias("minus"))
    alike = _alike(F.col("size"), F.col("plus"), F.col("minus"), least).alias("alike")
    return counted.select("lead", "key", "size", "plus", "minus", alike, F.when(F.col("n") > 1, F.concat("more", "less")).alias("parts"), *more)


def _alike(size: Column, plus: Column, minus: Column, least: float) -> Column:
    return size - minus >= F.lit(least) * (size + plus)


def _around(both: DataFrame, least: float) -> DataFrame:
    """both (members with the centre of their group, that is with the c_ columns) with the members' differences from the centre, not from the leader.

    They follow from what sets either apart from the leader.
    """
    has, lacks, c_has, c_lacks = (F.slice(p, F.lit(1) + (a if second else F.lit(0)), b if second else a) for p, a, b in (("parts", F.col("plus"), F.col("minus")), ("c_parts", F.col("c_plus"), F.col("c_minus"))) for second in (False, True))
    more = F.sort_array(F.concat(F.array_except(has, c_has), F.array_except(c_lacks, lacks)))
    less = F.sort_array(F.concat(F.array_except(c_has, has), F.array_except(lacks, c_lacks)))
    moved = both.select("lead", "key", "centre", "c_own", "n", "own", (F.col("size") + F.col("c_plus") - F.col("c_minus")).alias("size"), more.alias("more"), less.alias("less"))
    sized = moved.withColumn("plus", F.size("more")).withColumn("minus", F.size("less"))
    return sized.withColumn("alike", _alike(F.col("size"), F.col("plus"), F.col("minus"), least)).withColumn("parts", F.concat("more", "less")).drop("more", "less")


def _shared(centres: DataFrame, big: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """centres (lead, n, centre and the c_ columns) in which a group whose leader is a member of a larger group, alike to that one's centre,
    has this centre too; and big with a member once around a centre."""
    held = materialise(centres)
    leads = held.select(F.col("lead").alias("key"), F.col("n").alias("led"))
    inside = big.drop("n").join(few(leads), "key").join(held, "lead").where("n > led or n = led and lead > key")
    larger = _around(inside, least).where("alike")
    # what the centre has and the group's leader lacks is what sets the centre apart from this leader
    less, more = F.slice("parts", F.col("plus") + 1, F.col("minus")), F.slice("parts", F.lit(1), F.col("plus"))
    theirs = F.struct("centre", "c_own", F.col("minus").alias("c_plus"), F.col("plus").alias("c_minus"), F.concat(less, more).alias("c_parts"))
    taken = larger.groupBy(F.col("key").alias("lead")).agg(F.max_by(theirs, F.struct("n", "lead")).alias("theirs"))
    mine = F.struct("centre", "c_own", "c_plus", "c_minus", "c_parts")
    out = materialise(held.join(taken, "lead", "left").select("lead", F.coalesce("theirs", mine).alias("c")).select("lead", "c.*"))
    several = out.join(out.groupBy("centre").agg(F.count("*").alias("leads")).where("leads > 1"), "centre").select("lead", "centre")
    met = big.select("lead", "key").join(few(materialise(several)), "lead").groupBy("centre", "key").agg(F.sort_array(F.collect_set("lead")).alias("leads"))
    again = met.where(F.size("leads") > 1).select(F.explode(F.slice("leads", F.lit(2), F.size("leads"))).alias("lead"), "key")
    return out, big.join(few(materialise(again)), ["lead", "key"], "left_anti")


def recentred(big: DataFrame, least: float) -> DataFrame:
    """big (rows of ``differences`` with n and own) with every member's difference to its group's centre, which is in the component ``c_own``.

    The parts that more than half of a group have are what sets its leader apart; the centre is the member nearest to having just
    these, judged by some parts of some members (any centre gives right results). What sets a member apart from the centre follows from
    both differences to the leader. The leaders of one family of copies have many members in common: groups with one centre (see
    ``_shared``) are one group, which is named by it, and a member is in it once.
    """
    some = F.filter("parts", lambda p: F.pmod(p, F.lit(CENTRE_SHARE)) == 0)
    narrow = big.select("lead", "key", "n", some.alias("some"))
    each = F.ceil(F.col("n") / F.lit(CENTRE_MEMBERS))
    heard = narrow.where(F.pmod(F.xxhash64("key"), each) == 0).select("lead", (F.col("n") / each).alias("n"), F.explode("some").alias("part"))
    often = heard.groupBy("lead", "part").agg(F.count("*").alias("times"), F.max("n").alias("n")).where("2 * times > n")
    usual = often.groupBy("lead").agg(F.collect_list("part").alias("usual"))
    off = F.size("some") - 2 * F.coalesce(F.size(F.array_intersect("some", "usual")), F.lit(0))
    own = materialise(narrow.join(usual, "lead", "left").groupBy("lead").agg(F.min(F.struct(off.alias("off"), "key"))["key"].alias("key")))
    centres = big.join(few(own), ["lead", "key"]).select("lead", "n", F.col("key").alias("centre"), F.col("own").alias("c_own"), F.col("plus").alias("c_plus"), F.col("minus").alias("c_minus"), F.col("parts").alias("c_parts"))
    led = big.join(few(own.select(F.col("lead").alias("key"))), "key", "left_semi")
    centres, once = (centres, big) if led.isEmpty() else _shared(centres, big, least)
    return _around(once.join(centres.drop("n"), "lead").where("key <> centre"), least).withColumn("lead", F.col("centre")).drop("centre")


def rarest_first(rows: DataFrame) -> DataFrame:
    """rows with the parts that many of a group's members have, of some members counted, behind all others, the most frequent last.

    The order is one for all members of a group, as the prefixes of ``missed_pairs`` need; any such order gives right results.
    """
    each = F.ceil(F.col("members") / F.lit(CENTRE_MEMBERS))
    members = rows.groupBy("lead").agg(F.count("*").alias("members"))
    heard = rows.select("lead", "key", "parts").join(few(members), "lead").where(F.pmod(F.xxhash64("key"), each) == 0).select("lead", F.explode("parts").alias("part"))
    often = heard.groupBy("lead", "part").agg(F.count("*").alias("times")).where(F.col("times") >= FREQUENT)
    last = often.groupBy("lead").agg(F.sort_array(F.collect_list(F.struct("times", "part")))["part"].alias("last"))
    ordered = F.concat(F.array_except("parts", "last"), F.array_intersect("last", "parts"))
    return rows.join(last, "lead", "left").withColumn("parts", F.coalesce(ordered, "parts")).drop("last")


def sketched(rows: DataFrame) -> DataFrame:
    """rows with b0 ...: words in which every part has set a bit."""
    word = "aggregate(parts, 0L, (a, p) -> a | if((shiftright(p, 6) & {}) = {}, shiftleft(1L, cast(p & 63 as int)), 0L))"
    return rows.select("*", *[F.expr(word.format(SKETCH_WORDS - 1, w)).alias(f"b{w}") for w in range(SKETCH_WORDS)])


def _sides(apart: DataFrame, least: float) -> tuple[DataFrame, DataFrame, Column, Column]:
    """Members that are not alike to their leader, all members, which two may be similar and apart, and how many parts they need in common."""
    words = [f"b{w}" for w in range(SKETCH_WORDS)]
    rows = apart.select("*", (F.col("minus") + F.lit(least) * F.col("plus")).alias("weight"), F.size("parts").alias("all"))
    mine = rows.where("not alike").select("lead", "size", *[F.col(c).alias(f"{c}_x") for c in ("key", "own", "weight", "all", "parts", *words)])
    yours = rows.select("lead", F.col("size").alias("size_y"), *[F.col(c).alias(f"{c}_y") for c in ("key", "own", "weight", "all", "parts", "alike", *words)])
    apart_yet = (F.col("own_x") != F.col("own_y")) & (F.col("alike_y") | (F.col("key_x") < F.col("key_y")))
    needed = (F.col("weight_x") + F.col("weight_y") - F.lit(1 - least) * F.col("size")) / F.lit(1 + least) - F.lit(1e-6)
    # a bit that only one side has is of a part that only it has
    only = [sum(F.bit_count(F.col(f"{b}_{p}").bitwiseAND(F.bitwise_not(f"{b}_{q}"))) for b in words) for p, q in ("xy", "yx")]
    may_be = apart_yet & (F.col("all_x") - only[0] >= needed) & (F.col("all_y") - only[1] >= needed)
    return mine, yours, may_be, needed


def missed_pairs(apart: DataFrame, least: float) -> DataFrame:
    """(a, b): components that have similar members of one leader's group; apart has the columns of ``differences``, n, own and a sketch.

    With s parts in common, the members x and y have size - minus(x) - minus(y) + s shingles in common and size + plus(x) + plus(y) - s
    in all. They are similar only if s >= (weight(x) + weight(y) - 0.2 size) / 1.8, with weight = minus + 0.8 plus. Two that are alike to
    their leader are in its component, so of a pair one, x, is not: weight(x) > 0.2 size. Small groups are compared directly. In a
    large group, recentred, s is over weight(y) / 1.8, and at least weight - 0.2 size of either, so that the first parts of both (all
    but that many, and one) have one in common; they are joined on these. What only few members have comes first (``rarest_first``), and the
    place where two meet tells how many parts may follow.
    """
    spark, pairs = apart.sparkSession, ("lead", "key_x", "key_y")
    mine, yours, may_be, _ = _sides(apart.where(F.col("n") <= DIRECT), least)
    small = mine.drop("parts_x").join(yours.drop("parts_y"), "lead").where(may_be).select(*pairs)

    centred, first_path = as_table(recentred(apart.where(F.col("n") > DIRECT), least), "group-moved", plain=True)
    big, path = as_table(sketched(rarest_first(centred)), "group-centres", plain=True)
    drop_table(spark, first_path)
    release_driver(spark)
    near = big.where("alike").select(F.col("own").alias("a"), F.col("c_own").alias("b"))
    mine, yours, may_be, needed = _sides(big, least)
    least_x = F.greatest(F.ceil(F.col("weight_x") - F.lit(1 - least) * F.col("size") - F.lit(1e-6)), F.lit(1)).cast("int")
    least_y = F.greatest(F.ceil(F.col("weight_y") / F.lit(1 + least) - F.lit(1e-6)), F.ceil(F.col("weight_y") - F.lit(1 - least) * F.col("size_y") - F.lit(1e-6)), F.lit(1)).cast("int")
    first = lambda side, least: F.posexplode(F.slice(f"parts_{side}", F.lit(1), F.greatest(F.col(f"all_{side}") - least + 1, F.lit(0))))
    probes = mine.select(*[c for c in mine.columns if c != "parts_x"], first("x", least_x).alias("i", "part"))
    index = yours.select(*[c for c in yours.columns if c not in ("parts_y", "size_y")], first("y", least_y).alias("j", "part"))
    follow = F.least(F.col("all_x") - F.col("i"), F.col("all_y") - F.col("j"))
    large = probes.join(index, ["lead", "part"]).where(may_be & (follow >= needed)).select(*pairs).distinct()

    def decided(met: DataFrame, rows: DataFrame) -> DataFrame:
        held = materialise(met)
        ends = held.select("lead", F.col("key_x").alias("key")).unionByName(held.select("lead", F.col("key_y").alias("key"))).distinct()
        mine, yours, _, needed = _sides(rows.join(few(ends), ["lead", "key"], "left_semi"), least)
        both = held.join(mine, ["lead", "key_x"]).join(yours, ["lead", "key_y"])
        return both.where(F.size(F.array_intersect("parts_x", "parts_y")) >= needed).select(F.col("own_x").alias("a"), F.col("own_y").alias("b"))

    found = decided(small, apart).unionByName(decided(large, big))
    out = materialise(near.unionByName(found).where("a <> b").distinct())
    drop_table(spark, path)
    return out


def with_far_groups(both: DataFrame, least: float) -> DataFrame:
    """``differences`` in which members far from their leader form a group of their own, around the empty set.

    The share of elements in which sets differ, one less the similarity, is a metric: a member that differs from the leader by more
    than three times what similar sets may has no similar one that differs by less than twice that. So one
    group takes the members that differ by up to three times, the other those by twice and more, and every similar pair is in one.
    """
    found = differences(both.withColumn("own", F.array_distinct("own")).withColumn("whole", F.col("own")), least, "whole")
    alike = (F.col("size") - F.col("minus")) / F.greatest(F.col("size") + F.col("plus"), F.lit(1))
    near = found.where(alike >= F.lit(1 - 3 * (1 - least) - 1e-9)).drop("whole")
    far = found.where((alike <= F.lit(1 - 2 * (1 - least) + 1e-9)) & F.col("parts").isNotNull())
    around = far.select(F.xxhash64("lead", F.lit("far")).alias("lead"), "key", F.lit(0).alias("size"), F.size("whole").alias("plus"), F.lit(0).alias("minus"), F.lit(False).alias("alike"), F.col("whole").alias("parts"))
    return near.unionByName(around)


def components_of(compared: DataFrame, least: float, path: str | None = None) -> DataFrame:
    """(node, component) of the keys that are similar to others, from a table of the rows of ``differences``; the table at ``path``, if one
    is named, is dropped as soon as it is not needed.

    Members alike to their leader form components with it. Of what is left, every similar pair of a group is found (``missed_pairs``):
    none is lost, and no group is compared pair by pair but the smallest.
    """
    spark = compared.sparkSession
    links = compared.where("alike").select(F.col("key").alias("a"), F.col("lead").alias("b"))
    groups, held = as_table(connected_components(links), "group-components")
    own = compared.where("parts is not null").join(few(groups.select(F.col("node").alias("key"), "component")), "key", "left").withColumn("own", F.coalesce("component", "key")).drop("component")
    several = own.groupBy("lead").agg(F.count("*").alias("n"), F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo <> hi").select("lead", "n")
    apart, rest = as_table(sketched(own.join(few(materialise(several)), "lead")), "group-rest", plain=True)
    if path:
        drop_table(spark, path)
    release_driver(spark)
    more = missed_pairs(apart, least)
    drop_table(spark, rest)
    wider = materialise(connected_components(more))
    moved = groups.join(few(wider.select(F.col("node").alias("component"), F.col("component").alias("now"))), "component", "left")
    out = materialise(moved.select("node", F.coalesce("now", "component").alias("component")).unionByName(wider).distinct())
    drop_table(spark, held)
    return out
