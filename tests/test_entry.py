"""The entry module without the optional parts."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).parents[1]
BLOCK = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in {names!r} or name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), sorted(q for q in e.queries() if q.startswith(("op", "pipe"))))
"""


def run(*names: str) -> subprocess.CompletedProcess:
    code = BLOCK.format(names=set(names))
    return subprocess.run([sys.executable, "-c", code], cwd=HERE, capture_output=True, text=True)


@pytest.mark.parametrize("absent", ["payrisk.llm", "xxhash", "public_tokenizers"])
def test_payment_queries_need_none_of_the_corpus_operators(absent):
    done = run(absent)
    assert done.returncode == 0, done.stderr
    assert done.stdout.endswith("[]\n") and "left out" in done.stderr


def test_the_pipeline_alone_may_be_absent():
    done = run("corpus_pipeline")
    assert done.returncode == 0 and "pipeline" not in done.stdout
