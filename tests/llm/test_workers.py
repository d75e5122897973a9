"""Queries with Python workers whose path does not hold the package."""

import os
import subprocess
import sys

import pytest

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from cargoline.session import local_session

spark = local_session(4)

def alone(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("cargoline") is None])], ["alone"])

assert spark.range(1).mapInArrow(alone, "alone boolean").first().alone
for name in sys.argv[1:]:
    print(name, entry.queries()[name](spark, {sf!r}).count())
"""


@pytest.mark.parametrize("names", [["op6_packing", "op9_quality_rules", "op7_quality_classifier"], ["op11_embedding_whitening", "op13_bpe_encoding", "op3_html_extraction"]])
def test_executors_need_no_copy_of_the_package(names, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(root=ROOT, sf=SF_SMALL))
    done = subprocess.run([sys.executable, str(script), *names], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == names
