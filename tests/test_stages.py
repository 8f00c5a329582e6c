"""Stage tables and the pairs of neighbours: what they leave on disk and shuffle."""

import os
import time

from pyspark.sql import functions as F

from tidewater.operators import sequence as SQ
from tidewater.session import ensure_checkpoint_dir, next_stage, stage_folders, stage_table


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stage_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    stage = stage_table(rows.join(rows.withColumnRenamed("count", "n"), "k"), "t")
    for _ in range(40):  # removed in the background
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.25)
    assert not _shuffle_files(spark) - before and stage.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_next_stage_takes_the_place_of_what_it_read(spark):
    a, b = stage_table(spark.range(5), "a"), stage_table(spark.range(9), "b")
    folders = {x: next(iter(stage_folders(x))) for x in (a, b)}
    c = next_stage(a.join(b, "id"), "c", [b])
    base = ensure_checkpoint_dir(spark)
    there = {f for f in os.listdir(base.removeprefix("file:")) if f.startswith("stage-")}
    assert os.path.basename(folders[a]) not in there and os.path.basename(folders[b]) in there
    assert c.count() == 5 and b.count() == 9


def test_pairs_cross_blocks_and_need_no_join(spark):
    rows = [("p", r, float(r)) for r in range(23)] + [("q", r, -float(r)) for r in range(4)] + [("n", None, 1.0)]
    df = spark.createDataFrame(rows, "_k string, _rank long, v double")
    pairs = SQ.rank_pairs(df, ["v"], 5, block=3)  # more neighbours than rows of a block
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert pairs.columns == ["_k", "_ra", "v_a", "_rb", "v_b"] and "Join" not in plan
    want = {(k, a, s * a, a + d, s * (a + d)) for k, n, s in (("p", 23, 1.0), ("q", 4, -1.0))
            for a in range(n) for d in range(1, 6) if a + d < n}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(want) and set(got) == want
