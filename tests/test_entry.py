"""The entry works without the optional corpus package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_WITHOUT = """
import importlib.abc, importlib.util, sys

class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["martline", "llm"]:
            raise ModuleNotFoundError(name)

real = importlib.util.find_spec
importlib.util.find_spec = lambda name, package=None: None if name.startswith("martline.llm") else real(name, package)
sys.meta_path.insert(0, Hidden())
sys.path.insert(0, {repo!r})
import __spark_entry__ as e

assert "sales_mart" in e.queries() and set(e.oracle_sql()) <= set(e.queries())
assert not [q for q in e.queries() if q == "pipeline" or q.startswith("op")]
from martline.session import build_session

spark = build_session("without", cores=2, shuffle_partitions=2)
assert e.entry(spark).count() > 0
"""


def test_entry_without_the_corpus_package():
    done = subprocess.run([sys.executable, "-c", _WITHOUT.replace("{repo!r}", repr(REPO))], capture_output=True, text=True,
                          timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
