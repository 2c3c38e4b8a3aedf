"""Links between documents that share a band key, and the classes that links make.

Buckets (the documents of a band key) are cut into blocks at random, so that no task holds a large
bucket: each pair of blocks of a bucket is one group of at most two blocks, handed to a function that
compares all its members at once. Groups with the same members, as bands of one cluster often have,
are compared once. Nothing is capped: a bucket of n documents takes about (n / block)^2 / 2 groups (``groups``).

Most pairs of a large bucket of copies need no comparison, as other pairs connect them. ``blocks`` compares only
within the blocks, each of which also holds some members that all blocks of its bucket share; a row per member
and a few per block. Buckets that are not one component then are ``unsettled``: of their members those that share
a symbol, by which all similar pairs can be found, meet in ``across``, unless both are of one component. Texts
made from one have most of their symbols in common; ``merged`` lets them meet once and not by each of these.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..sinks.files import stored
from .tasks import map_groups

#: Documents of a block.
BLOCK = 256
#: Members of a large bucket that are in each of its blocks.
SHARED = 16


def groups(bands: DataFrame, block: int = BLOCK) -> DataFrame:
    """``members``, sorted ids, of every group that is to be compared; ``bands`` has key and id."""
    bands = bands.select("key", "id")
    sizes = bands.groupBy("key").agg(F.count("*").alias("many")).filter("many > 1")
    placed = bands.join(sizes, "key").withColumn("blocks", F.ceil(F.col("many") / block).cast("int"))
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int")
    placed = placed.withColumn("own", own)
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    # A pair of different blocks also holds the pairs inside either of them.
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(others, F.col("own"))
    )
    placed = placed.select("key", "id", "own", F.explode(others).alias("other"))
    return (
        placed.groupBy("key", F.least("own", "other"), F.greatest("own", "other"))
        .agg(F.sort_array(F.collect_list("id")).alias("members"))
        .select("members").filter(F.size("members") > 1)
        .dropDuplicates(["members"])
    )


def buckets(bands: DataFrame, block: int = BLOCK) -> DataFrame:
    """key, id and the number of ``blocks`` of the bucket, for every member of a bucket of two or more."""
    bands = bands.select("key", "id")
    sizes = bands.groupBy("key").agg(F.count("*").alias("many")).filter("many > 1")
    return bands.join(sizes, "key").select("key", "id", F.ceil(F.col("many") / block).cast("int").alias("blocks"))


def blocks(members: DataFrame, shared: int = SHARED) -> DataFrame:
    """``members``, sorted ids, of every block of the buckets; those of large ones with the shared members."""
    own = members.select("key", "id", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int").alias("own"))
    nth = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(shared)).alias("nth")
    some = members.filter("blocks > 1").groupBy("key", "blocks", nth).agg(
        F.min(F.struct(F.xxhash64("id", "key", F.lit(13)), "id"))["id"].alias("id")
    )
    some = some.select("key", "id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"))
    return (
        own.union(some).groupBy("key", "own").agg(F.sort_array(F.collect_set("id")).alias("members"))
        .select("members").filter(F.size("members") > 1).dropDuplicates(["members"])
    )


def unsettled(members: DataFrame, roots: DataFrame, block: int = BLOCK) -> DataFrame:
    """key, id and root of the members of large buckets that hold several components.

    ``few`` marks buckets with no more than a block of members beside one large component: ``across`` compares
    them in a few rows a member.
    """
    large = members.filter("blocks > 1").join(roots, "id", "left")
    large = large.select("key", "id", F.coalesce("root", "id").alias("root"))
    heavy = F.col("many") > block
    mixed = large.groupBy("key", "root").agg(F.count("*").alias("many")).groupBy("key").agg(
        F.count("*").alias("roots"), F.count_if(heavy).alias("heavy"),
        F.sum(F.when(heavy, 0).otherwise(F.col("many"))).alias("light"),
    )
    few = (F.col("heavy") == 1) & (F.col("light") <= block)
    return large.join(mixed.filter("roots > 1").select("key", few.alias("few")), "key")


def merged(rows: DataFrame) -> DataFrame:
    """symbol, id and root, where symbols that nearly the same ids have are one; those of a single root are left out.

    Ids that share a symbol still do. Symbols become one if the least ids of both are the same by two hash
    functions, which is likelier the more of their ids they have in common.
    """
    own = Window.partitionBy("symbol")
    least = [F.min(F.xxhash64("id", F.lit(salt))).over(own) for salt in (17, 19)]
    several = F.min("root").over(own) < F.max("root").over(own)
    rows = rows.select("id", "root", F.xxhash64(*least).alias("symbol"), several.alias("several"))
    return rows.filter("several").select("symbol", "id", "root").distinct()


def across(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``members`` of groups in which any two ids of different roots meet that share a symbol.

    ``rows`` has symbol, id and root. Symbols are ``merged``. The ids of a symbol are cut into blocks, a large
    component into blocks of its own, and each two blocks make a group, unless both are of one component.
    """
    rows = stored(merged(rows), "symbols")
    sizes = rows.groupBy("symbol", "root").agg(F.count("*").alias("of_root"))
    light = F.sum(F.when(F.col("of_root") <= block, F.col("of_root")).otherwise(0)).alias("light")
    many = sizes.groupBy("symbol").agg(light, F.count("*").alias("roots")).filter("roots > 1")
    placed = rows.join(many, "symbol").join(sizes, ["symbol", "root"])
    heavy = F.col("of_root") > block
    part = F.when(heavy, F.pmod(F.xxhash64("id", F.lit(7)), F.ceil(F.col("of_root") / block))).otherwise(
        F.pmod(F.xxhash64("root", F.lit(7)), F.ceil(F.greatest("light", F.lit(1)) / block))
    )
    placed = placed.select(
        "symbol", "id", F.struct(F.when(heavy, F.hex("root")).otherwise("").alias("root"), part.alias("part")).alias("own")
    )
    each = placed.select("symbol", "own").distinct()
    other = each.select("symbol", F.col("own").alias("other"))
    # A group of two blocks also holds the pairs inside either of them.
    alone = F.count("*").over(Window.partitionBy("symbol")) == 1
    single = each.withColumn("alone", alone).filter("alone").select("symbol", "own", F.col("own").alias("other"))
    pairs = each.join(other, "symbol").filter("own < other AND (own.root = '' OR own.root <> other.root)").union(single)
    pairs = pairs.select("symbol", F.explode(F.array_distinct(F.array("own", "other"))).alias("own"), F.struct("own", "other").alias("pair"))
    return (
        placed.join(pairs, ["symbol", "own"]).groupBy("symbol", "pair")
        .agg(F.sort_array(F.collect_set("id")).alias("members"))
        .select("members").filter(F.size("members") > 1).dropDuplicates(["members"])
    )


def verified_links(found: DataFrame, payloads: Callable[[DataFrame], DataFrame], verify: Callable) -> DataFrame:
    """Links (a, b) among the members of ``found``.

    ``payloads(ids)`` gives id and payload of a table of ids; ``verify(list of payloads)`` the pairs
    of list positions that are linked, where pairs that others connect may be left out. Further columns of the
    payloads are handed to ``verify`` as further lists.
    """
    found = stored(found.withColumn("group", F.xxhash64("members")), "groups")
    members = found.select("group", F.explode("members").alias("id"))
    held = payloads(members.select("id").distinct())
    more = [c for c in held.columns if c not in ("id", "payload")]
    rows = held.join(members, "id")
    kind = dict(members.dtypes)["id"]

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id").drop_duplicates("id", ignore_index=True)
        pairs = verify(part["payload"].tolist(), *[part[c].tolist() for c in more])
        ids = part["id"].tolist()
        return pd.DataFrame({"a": [ids[i] for i, _ in pairs], "b": [ids[j] for _, j in pairs]}, dtype=object)

    return map_groups(rows, "group", compare, f"a {kind}, b {kind}").distinct()


def components(links: DataFrame) -> DataFrame:
    """id and root (the least id of its component) of every id that has a link.

    Alternating star contraction: each id hands its larger neighbours to its least one, then the
    smaller ones, until every id hangs on its root.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    signature = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = stored(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).distinct(),
            "edges",
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == signature:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        signature = now


def union_find(n: int) -> tuple[Callable[[int], int], Callable[[int, int], None]]:
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(a: int, b: int) -> None:
        parent[find(a)] = find(b)

    return find, join
