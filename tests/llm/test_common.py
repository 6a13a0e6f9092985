import os
import subprocess
import sys

import pytest

SCRIPT = """
import sys
from ledgerloom.llm import common
from ledgerloom.session import local_session

spark = local_session(2, **{"spark.checkpoint.dir": sys.argv[1]})
kept = common.cut(spark.range(100).toDF("id"), rows=100)
common.stored(kept, common.new_folder(spark, "table"))
assert kept.count() == 100
import os
print("FILES", sum(len(f) for _, _, f in os.walk(sys.argv[1])))
if sys.argv[2] == "fail":
    raise ValueError("lost")
"""


@pytest.mark.parametrize("end", ["well", "fail"])
def test_stored_files_go_at_the_end(tmp_path, end):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {"PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path / "shared"), end], env=env, capture_output=True, text=True, timeout=180)
    assert "FILES" in done.stdout and "FILES 0" not in done.stdout and (done.returncode == 0) == (end == "well")
    assert not [f for _, _, files in os.walk(tmp_path) for f in files]
