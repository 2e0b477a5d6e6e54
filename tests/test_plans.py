"""Plan-shape regressions: pruning, no cartesian products, partitioned windows."""

import re

import __spark_entry__ as ent


def _plan(spark, df) -> str:
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_call_final_prunes_columns_and_partitions_windows(spark, small_dir):
    p = _plan(spark, ent.queries()["call_final"](spark, small_dir))
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,text:string>" in p
    # only the one row that counts the embeddings meets in one task
    assert all("Input [1]: [max" in block or "Input: []" in block for block in p.split("\n\n") if "SinglePartition" in block)


def test_weight_grid_has_no_cartesian_or_nested_loop(spark, small_dir):
    p = _plan(spark, ent.queries()["weight_grid_cv"](spark, small_dir))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert re.search(r"Generate", p)  # candidates are emitted in-stage, not joined


def test_bounded_windows_use_halo_buckets(spark, small_dir):
    p = _plan(spark, ent.queries()["rolling_voiced"](spark, small_dir))
    assert "_hb" in p  # window partitioned by (clip, halo bucket)


def test_array_functions_stay_in_the_jvm(spark, small_dir):
    for name in ("resize", "power_db", "band_mask", "softmax"):
        p = _plan(spark, ent.queries()[name](spark, small_dir))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_folds_and_grids_are_not_one_task(spark, small_dir):
    for name in ("kfold", "weight_grid_cv", "stratified_split"):
        tree = _plan(spark, ent.queries()[name](spark, small_dir)).split("\n\n")[0]
        # a single partition may only hold per-class totals, never the rows that a scan gives
        lines = tree.split("\n")
        for i, line in enumerate(lines):
            if "Window" in line:
                below = "\n".join(lines[i:i + 4])
                assert "Scan" not in below or "HashAggregate" in below, (name, below)
    p = _plan(spark, ent.queries()["kfold"](spark, small_dir))
    for block in p.split("\n\n"):
        if "SinglePartition" in block:
            # the (class, bucket) totals, not the rows
            assert "_t__n" in block or "sum" in block or "min" in block, block


def test_building_call_queries_starts_no_job(spark, small_dir):
    tracker = spark.sparkContext.statusTracker()
    for name in ("ended_calls", "call_running", "kfold", "weight_grid_cv", "voice_segments", "class_report", "roc_auc"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        ent.queries()[name](spark, small_dir)
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # reading a Parquet schema is a job of its own; it reads no rows
        infos = [tracker.getJobInfo(j) for j in jobs]
        assert all(len(i.stageIds) == 1 and (s := tracker.getStageInfo(i.stageIds[0])) and s.numTasks <= 1 and "parquet" in s.name for i in infos if i), name


def test_class_report_reads_its_input_once(spark, small_dir):
    p = _plan(spark, ent.queries()["class_report"](spark, small_dir))
    assert len(re.findall(r"Location: \w*FileIndex", p)) == 1
