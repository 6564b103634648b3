"""Connected components of a link table, and links inside shared buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from creascope.llm.common import stored


def settled(edges: DataFrame) -> bool:
    """Whether the edges (u > v) are stars: no node has two smaller ends, none is both leaf and centre."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
    mixed = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return mixed.agg(F.count_if(F.col("leaf") + F.col("centre") > 1)).first()[0] == 0


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge.

    Alternating large-star and small-star steps, each a minimum per node followed by a join, so
    a node with very many links sends one row per task and its joined rows can be split. The
    edge table is stored after each round; the loop ends when it consists of stars, whose centres
    are the smallest nodes.
    """
    undirected = edges.select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    current = stored(undirected, "edges")
    while not settled(current):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour is linked to the smallest node around, a row per edge
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: the smaller neighbours, too
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = small.filter("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        current = stored(step, "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def components_of_buckets(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], close: Callable[..., Column],
    private: Callable[[DataFrame], DataFrame] | None = None, fits: Callable[..., Column] | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """(node, component) over all linked pairs (x, y) that share a bucket or are among ``pairs`` (a < b).

    ``members`` holds (key, node, size, bits) with distinct (key, node). ``verify`` takes pairs
    (a, b) and returns those that are linked. ``close`` is an exact bound, false only if a pair
    cannot be linked, from (size, common, bits) of either end, ``common`` being the part of the size
    that any other node has, too. ``private`` gives, for a table of nodes, (node, private, profile):
    how many elements none of the others has, and a profile for the second bound ``fits`` on
    (size, profile) of either end.

    No bucket is expanded into all its pairs. Every member is first compared with the centre of
    its bucket, the member with most company over all its buckets: around an original and its
    edited copies that is the original, and the bucket becomes few components. A pair whose ends are
    connected needs no test, so what remains are the members outside the largest component of
    their bucket; each is compared with the members in other components that ``close`` admits.
    After that every pair of every bucket is connected, excluded by the bound, or tested.
    """
    members = members.select("key", "node", "size", "bits")
    # most members are alone; stored, so that the join knows how few keys are left
    counts = stored(members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "keys")
    shared = stored(members.join(counts, "key"), "shared")
    company = shared.groupBy("node").agg(F.sum("n").alias("company"))
    heads = shared.join(company, "node").groupBy("key").agg(
        F.max(F.struct("company", (-F.col("node")).alias("minus"), "size", "bits")).alias("h")).select(
        "key", (-F.col("h.minus")).alias("head"), F.col("h.size").alias("head_size"), F.col("h.bits").alias("head_bits"))
    led = shared.join(heads, "key").filter("node <> head").filter(
        close(("size", "size", "bits"), ("head_size", "head_size", "head_bits")))
    led = led.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
    first = stored(verify((led if pairs is None else led.unionByName(pairs)).distinct()), "links")
    joined = connected_components(first)

    # buckets of two are settled by now
    placed = shared.filter("n > 2").join(joined, "node", "left").select(
        "key", "node", "size", "bits", F.coalesce("component", "node").alias("component"))
    main = placed.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("top")).filter("parts > 1")
    placed = stored(placed.join(main.select("key", F.col("top.component").alias("main")), "key").join(
        heads.select("key", "head"), "key"), "unsettled")
    if private is None:
        placed = placed.withColumn("common", F.col("size")).withColumn("profile", F.lit(0))
    else:
        alone = private(placed.select("node").distinct())
        placed = placed.join(alone, "node", "left").withColumn(
            "common", F.col("size") - F.coalesce("private", F.lit(0))).drop("private")
    placed = placed.filter("node <> head")
    outside = placed.filter("component <> main").select(
        "key", F.col("node").alias("x"), F.col("size").alias("x_size"), F.col("common").alias("x_common"),
        F.col("bits").alias("x_bits"), F.col("profile").alias("x_profile"), F.col("component").alias("x_component"))
    # two members outside the main component meet twice; the smaller node's row is enough
    possible = close(("x_size", "x_common", "x_bits"), ("size", "common", "bits"))
    if fits is not None:
        possible = possible & fits(("x_size", "x_profile"), ("size", "profile"))
    pairs = outside.join(placed, "key").filter(
        "component <> x_component and (component = main or x < node)").filter(possible).select(
        F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    # the components found so far stand for the first links
    return connected_components(joined.toDF("a", "b").unionByName(verify(pairs)))
