"""Written steps are deleted when nothing reads them; executors need no repository."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from stellate.operators.components import connected_components
from stellate.session import checkpoint_root, create_file, materialize, read_file, release, scratch_path, tidy


def steps(spark):
    root = checkpoint_root(spark).removeprefix("file:") + "/stellate"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_tidy_keeps_what_the_result_reads(spark):
    before = steps(spark)

    @tidy
    def inner(n):
        a, b = materialize(spark.range(n), "step-a"), materialize(spark.range(n), "step-b")
        scratch_path(spark, "step-c")
        return a.join(spark.range(5), "id"), b.count()

    @tidy
    def outer(n):
        df, rows = inner(n)
        return materialize(df.withColumn("x", F.lit(rows)), "step-d")

    df, _ = inner(3)
    assert sorted(x.split("-")[1] for x in steps(spark) - before) == ["a"] and df.count() == 3
    release(df)
    assert steps(spark) == before
    df = outer(3)
    assert sorted(x.split("-")[1] for x in steps(spark) - before) == ["d"] and df.count() == 3
    release(df)

    @tidy
    def fails():
        materialize(spark.range(3), "step-e")
        raise KeyError

    with pytest.raises(KeyError):
        fails()
    assert steps(spark) == before


def test_components_leave_no_steps(spark):
    before = steps(spark)
    e = spark.range(100).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    labels = connected_components(e)
    assert labels.agg(F.max("cmp")).first()[0] == 0
    release(labels)
    assert steps(spark) == before


def test_create_file_once(spark, scratch):
    p = f"{scratch}/deep/file"
    assert create_file(spark, p, "é") and not create_file(spark, p, "other")
    assert read_file(spark, p) == "é" and [n for n in os.listdir(f"{scratch}/deep") if not n.startswith(".")] == ["file"]


def test_executors_need_no_repository(scratch):
    """Started from another folder, with the repository on the driver's path
    only, the Arrow functions run in workers that can't import it."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
        import sys
        sys.path.insert(0, {repo!r})
        from stellate.session import get_session
        from stellate.plans import catalog, stored
        spark = get_session("local[2]", shuffle_partitions=4, conf={{"spark.checkpoint.dir": {scratch + "/ck"!r}}})
        for q in ("components_order_customer", "snapshot_components"):
            assert catalog.QUERIES[q](spark, "/root/testdata/sf0.001").count() > 0
        print("all ran")
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=scratch, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "all ran" in run.stdout, run.stderr[-3000:]
