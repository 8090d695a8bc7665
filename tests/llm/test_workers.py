"""Operators on workers that cannot import this package, as on a cluster where only the driver holds it."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
_RUN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.checkpoint.dir", {scratch!r})
    .getOrCreate()
)
from wickline.llm.queries import QUERIES

def missing(batches):
    import importlib.util
    for batch in batches:
        yield batch.assign(id=int(importlib.util.find_spec("wickline") is None))

assert spark.range(1).mapInPandas(missing, "id BIGINT").first().id == 1
for name in {names!r}:
    print(name, QUERIES[name](spark, {sf!r}).count())
"""


@pytest.mark.parametrize("names", [["op2_bloom_lm", "op3_decontamination", "op11_divergence", "op12_minhash"]])
def test_workers_need_no_copy_of_the_package(tmp_path, names):
    known = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    script = tmp_path / "run.py"
    script.write_text(_RUN.format(root=str(ROOT), scratch=str(tmp_path / "scratch"), names=names, sf=SF_DIR))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=known, capture_output=True, text=True, timeout=400)
    assert done.returncode == 0, done.stderr[-3000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert set(counts) == set(names) and all(int(n) > 0 for n in counts.values())
