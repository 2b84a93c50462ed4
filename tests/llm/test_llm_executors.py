"""Started from another folder, with the repository on the driver's path only,
every operator runs in workers that cannot import it."""

from __future__ import annotations

import os
import subprocess
import sys
import textwrap


def test_executors_need_no_repository(scratch):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
        import sys
        sys.path.insert(0, {repo!r})
        from stellate.session import get_session
        spark = get_session("local[4]", shuffle_partitions=4, conf={{"spark.checkpoint.dir": {scratch + "/ck"!r}}})
        # A worker sees what executors see: the folder that it was started in.
        seen = spark.range(1).mapInPandas(lambda it: (d.assign(id=any("{repo}" in p for p in __import__("sys").path))
                                                     for d in it), "id boolean").first()[0]
        assert not seen, "the workers have the repository on their path"
        import __spark_entry__
        for name, query in __spark_entry__.queries().items():
            if name.startswith("op"):
                assert query(spark, "/root/testdata/sf0.001").count() > 0, name
                print("ran", name)
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=scratch, env=env, capture_output=True,
                         text=True, timeout=900)
    assert run.stdout.count("ran op") == 13, run.stdout + run.stderr[-3000:]
