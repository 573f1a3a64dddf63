"""From candidate groups of sets to exact links and components, without looking at all pairs of a group.

Nodes are compared with their group's most central node first. Groups whose nodes are then still in several
components get all comparisons between these components that are missing, but for those that small
bitmaps of the sets rule out. Within a component no comparison is needed, as it cannot change it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import written
from tidemart.llm.components import components
from tidemart.llm.hashing import mix

BITMAP = 1024
ONE = np.uint64(1)


def set_node(elements: np.ndarray) -> tuple[int, int]:
    """Two independent 63-bit names of a set; the first is its node."""
    if not len(elements):
        return 0, 0
    sums = np.array([np.sum(mix(elements + np.uint64(k))) for k in (1, 2)], np.uint64)
    first, second = mix(sums ^ np.uint64(len(elements))) >> ONE
    return int(first), int(second)


def bitmap(elements: np.ndarray) -> np.ndarray:
    """The parities of the numbers of elements that fall on each of BITMAP places, as 64-bit numbers."""
    places = (mix(elements + np.uint64(11)) % np.uint64(BITMAP)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=BITMAP) & 1).astype(np.uint8)).view(np.int64)


class Linker:
    """Links sets whose Jaccard similarity is at least num / den.

    ``sets`` are rows ``(node, rep, elements, bits)``: a set's node, the id that stands for it, its
    elements and their bitmap. If two sets share a node, both are compared.
    """

    def __init__(self, spark: SparkSession, num: int, den: int):
        self.spark, self.num, self.den = spark, num, den

    def links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """``(u, v, linked)`` of the representatives of each pair of nodes ``(a, b)``."""
        left = sets.select(F.col("node").alias("a"), F.col("rep").alias("u"), F.col("elements").alias("left"))
        right = sets.select(F.col("node").alias("b"), F.col("rep").alias("v"), F.col("elements").alias("right"))
        n, m = F.size("left"), F.size("right")
        both = pairs.join(right, "b").join(left, "a").where(F.least(n, m) * self.den >= F.greatest(n, m) * self.num)
        common = F.size(F.array_intersect("left", "right"))
        return written(
            self.spark,
            both.select("u", "v", (common * self.den >= (n + m - common) * self.num).alias("linked")),
            "set-links",
        )

    def central_pairs(self, members: DataFrame) -> DataFrame:
        """``(a, b)``: each group's nodes with its most central one, each pair once.

        Central is the node whose groups have the most nodes: among copies with different edits that is
        one near the original, which links with most of them.
        """
        sizes = written(self.spark, members.groupBy("signature").agg(F.count(F.lit(1)).alias("size")), "group-sizes")
        weights = members.join(sizes, "signature").groupBy("node").agg(F.sum("size").alias("weight"))
        weighted = members.join(written(self.spark, weights, "node-weights"), "node")
        leaders = weighted.groupBy("signature").agg(F.max_by("node", F.struct("weight", "node")).alias("leader"))
        met = members.join(written(self.spark, leaders, "group-leaders"), "signature").where("node <> leader")
        return met.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()

    def missing_pairs(self, members: DataFrame, reps: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
        """Pairs of nodes with a common signature whose components are still apart.

        Left out are pairs whose bitmaps show that they differ too much: a bit is the parity of a set's
        elements there, so two sets differ in at least as many elements as their bitmaps do in bits.
        """
        at = reps.join(labels, reps["rep"] == labels["node"], "left").select(
            reps["node"], F.coalesce("component", "rep").alias("component")
        )
        members = written(self.spark, members.join(written(self.spark, at, "set-labels"), "node"), "group-members")
        counts = members.groupBy("signature", "component").agg(F.count(F.lit(1)).alias("nodes"))
        main = counts.groupBy("signature").agg(
            F.count(F.lit(1)).alias("apart"), F.max_by("component", F.struct("nodes", "component")).alias("main")
        )
        main = written(self.spark, main.where("apart > 1").select("signature", "main"), "groups-apart")
        apart = written(self.spark, members.join(main, "signature"), "members-apart")

        sizes = sets.select("node", F.size("elements").alias("n"), "bits")
        apart = written(self.spark, apart.join(sizes, "node"), "sets-apart")
        others = apart.where("component <> main")
        others = others.select("signature", *(F.col(c).alias(f"x_{c}") for c in ("node", "component", "n", "bits")))
        different = sum(
            (F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("x_bits")[k])) for k in range(BITMAP // 64)), F.lit(0)
        )
        can_link = different * (self.den + self.num) <= (F.col("n") + F.col("x_n")) * (self.den - self.num)
        met = others.join(apart, "signature").where((F.col("x_component") != F.col("component")) & can_link)
        return met.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()

    def components(self, groups: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
        """``(node, component)`` of the representatives that are linked with any other.

        ``groups`` are rows ``(signature, leader, node)``, ``reps`` all ``(node, rep)``.
        """
        members = groups.select("signature", "node").union(groups.select("signature", F.col("leader").alias("node")))
        members = written(self.spark, members.distinct(), "set-groups")
        pairs = written(self.spark, self.central_pairs(members), "central-pairs")
        links = self.links(pairs, sets)
        labels = components(self.spark, links.where("linked").select("u", "v"))
        more = self.missing_pairs(members, reps, labels, sets).join(pairs, ["a", "b"], "left_anti")
        links = links.union(self.links(written(self.spark, more, "missing-pairs"), sets))
        return components(self.spark, links.where("linked").select("u", "v"))
