"""What stays on disk: shuffle files of written tables, and the sets of nodes that nothing is compared with."""

import time

import numpy as np
from pyspark.sql import functions as F

from patronlens.llm import components, jaccard_join
from patronlens.session import SHUFFLE_CLEANUP, materialise


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP, None)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    written = materialise(rows)
    for _ in range(50):  # they are removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    assert written.count() == 7 and rows.agg(F.sum("s")).first()[0] == 499500


def test_only_nodes_with_a_cell_to_look_at_are_described(spark):
    crowded = [(256, node) for node in range(1, 9)]  # the one cell that nodes 1 to 6 share with others, and may leave out
    rows = spark.createDataFrame([*crowded, (512, 7), (512, 8), (768, 1)], "cell bigint, node bigint")
    allowance = spark.createDataFrame([(node, 0, 1) for node in range(1, 9)], "node bigint, part int, spare int")
    asked = []

    def describe(nodes):
        asked.extend(r.node for r in nodes.collect())
        return nodes

    def verify(pairs, described):
        return pairs.join(described.toDF("a"), "a").join(described.toDF("b"), "b").select("a", "b")

    def pairs(dealt, described, forest):
        return dealt.select("cell", "i", "j", F.col("node").alias("a"), F.col("node").alias("b")).filter("false")

    links = components.links_in_cells(rows, describe, verify, pairs, allowance)
    assert {(r.a, r.b) for r in links.collect()} == {(7, 8)}
    assert sorted(asked) == [7, 8]


def test_what_a_set_may_leave_out_is_that_of_its_cells():
    for n in (1, 2, 5, 17, 80, 400, 3000):
        shingles = np.sort(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
        for percent in (80, 85):
            assert jaccard_join.may_leave_out(shingles, percent) == jaccard_join.cells(shingles, percent)[1]
