from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stellate.session import get_session  # noqa: E402

SF = "/root/testdata"

# The message lines of the protocol's worked example, and their edges.
PROTOCOL_EXAMPLE = ["c1", "1 3;3 6;9 8", "3 5;2 4", "5 6", "4 7;7 10", "c2", "cTEST_EXIT"]
PROTOCOL_EDGES = [(1, 3), (3, 6), (9, 8), (3, 5), (2, 4), (5, 6), (4, 7), (7, 10)]


@pytest.fixture(scope="session")
def spark():
    ck = tempfile.mkdtemp(prefix="test-ck-", dir="/tmp")
    s = get_session("local[*]", app="stellate-tests", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": ck, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="test-run-", dir="/tmp")


def union_find(edges):
    """Brute-force labelling: vertex -> least vertex of its component."""
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent)}
