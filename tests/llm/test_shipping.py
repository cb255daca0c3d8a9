"""What tasks run must load in a process that cannot import the library."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql.classic import dataframe
from pyspark.sql.pandas import group_ops, map_ops

from rateweave.llm import mixing, secrets, simhash, toxicity
from tests.llm.test_edge_cases import ODD, OPERATORS, TABLES, documents, labels

LOAD = """
import pickle, sys
sys.path[:] = [p for p in sys.path if p not in ("", {repo!r})]
try:
    import rateweave
except ImportError:
    pass
else:
    raise SystemExit("the library can be imported here")
from pyspark.core import broadcast
broadcast._from_id = lambda number: None  # values of broadcasts come with a task, not here
for data in pickle.load(sys.stdin.buffer):
    pickle.loads(data)
"""
GIVEN_TO = [
    (map_ops.PandasMapOpsMixin, "mapInPandas"), (map_ops.PandasMapOpsMixin, "mapInArrow"),
    (dataframe.DataFrame, "mapInPandas"), (dataframe.DataFrame, "mapInArrow"),
    (group_ops.PandasGroupedOpsMixin, "applyInPandas"), (group_ops.PandasGroupedOpsMixin, "applyInArrow"),
    (group_ops.PandasCogroupedOps, "applyInPandas"),
]


@pytest.fixture
def shipped(monkeypatch):
    """Every function that a frame is mapped with, pickled as Spark pickles it."""
    seen = []

    def watch(owner, name):
        plain = getattr(owner, name)

        def watched(self, func, *args, **kwargs):
            seen.append(cloudpickle.dumps(func))
            return plain(self, func, *args, **kwargs)

        monkeypatch.setattr(owner, name, watched)

    for owner, name in GIVEN_TO:
        watch(owner, name)
    return seen


FILTERS = {
    "without_toxic": lambda docs: toxicity.without_toxic(docs, toxicity.train(docs, labels(docs.sparkSession))),
    "one_of_each": simhash.one_of_each,
    "hide_secrets": secrets.hide_secrets,
    "mixed": mixing.mixed,
}


@pytest.mark.parametrize("name", [*OPERATORS, *FILTERS, *TABLES])
def test_task_functions_load_without_the_library(spark, shipped, tmp_path, name):
    if name in TABLES:
        TABLES[name](spark)
    else:
        (OPERATORS | FILTERS)[name](documents(spark, ODD))
    if name != "pii":  # SQL functions only
        assert shipped
    repo = str(Path(__file__).resolve().parents[2])
    done = subprocess.run(
        [sys.executable, "-c", LOAD.format(repo=repo)], input=cloudpickle.dumps(shipped),
        capture_output=True, cwd=tmp_path, env={}, timeout=120,
    )
    assert done.returncode == 0, done.stderr.decode()
