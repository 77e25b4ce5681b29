"""Workers that start in another folder get the package from the driver."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from tarmaq.session import local_session, ship_package
spark = local_session(2, spark__sql__warehouse__dir={folder!r} + "/warehouse")
if {ship}:
    ship_package(spark)

def where(batches):
    from tarmaq import session
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_pydict({{"path": [session.__file__] * batch.num_rows}})

print("FOUND", spark.range(3).mapInArrow(where, "path string").first()["path"])
"""


@pytest.mark.parametrize("ship", [True, False])
def test_package_reaches_workers(tmp_path, ship):
    repo = str(Path(__file__).resolve().parents[1])
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(repo=repo, folder=str(tmp_path), ship=ship))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=clean, timeout=120,
                          capture_output=True, text=True, check=False)
    if ship:
        assert "FOUND" in done.stdout and ".zip/" in done.stdout, done.stderr[-2000:]
    else:
        assert "No module named 'tarmaq'" in done.stderr
