"""Connected components by contraction, with pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seqprep.session import write_shared


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links`` (a, b): the smallest node it is connected with.

    In each round every node takes its smallest neighbour, if that is smaller than
    itself, and the trees this makes become one node each, named by their root;
    links within a tree are gone and links between the same trees are one. Two
    rounds leave at most half the nodes, and a round reads only the links that the
    one before has left: of stars round their smallest node, none. Labels are
    combined before they are shuffled; the label side of each join has one row per
    key, so a node with very many links can be split. Every round is written to the
    shared folder; nothing is collected.
    """
    edges = write_shared(ordered(links, "a", "b"), "links")
    rounds = []
    while True:
        smaller = edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(edges.select("a", "a"))
        labels = roots(write_shared(smaller.groupBy("node").agg(F.min("label").alias("label")), "labels"))
        rounds.append(labels)
        between = edges.join(labels.toDF("a", "_a"), "a").join(labels.toDF("b", "_b"), "b")
        edges = write_shared(ordered(between, "_a", "_b"), "links")
        if edges.isEmpty():
            break
    labels = rounds.pop()
    while rounds:
        further = rounds.pop().join(labels.toDF("label", "_to"), "label", "left")
        labels = write_shared(further.select("node", F.coalesce("_to", "label").alias("label")), "labels")
    return labels


def ordered(links: DataFrame, a: str, b: str) -> DataFrame:
    """The distinct links between different nodes, the smaller one first."""
    return links.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def roots(labels: DataFrame) -> DataFrame:
    """The labels followed to their ends, in steps that double."""
    while True:
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        moved = write_shared(labels.join(jump, "label").select("node", F.col("label").alias("old"), F.col("far").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after further links: only the graph of the components that they join is solved."""
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    alone = ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))
    known = write_shared(labels.unionByName(alone), "labels")
    named = links.join(known.toDF("a", "_a"), "a").join(known.toDF("b", "_b"), "b")
    joined = write_shared(named.filter("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "joined")
    if joined.isEmpty():
        return known
    smaller = components(joined).toDF("label", "_to")
    return known.join(smaller, "label", "left").select("node", F.coalesce("_to", "label").alias("label"))
