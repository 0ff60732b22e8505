"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_QUERIES="embargo_date,authority_top3", FOLIO_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=600)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1, out.stdout
    d = json.loads(lines[0])
    assert d["metric"] and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"embargo_date", "authority_top3"} and d["value"] > 0
    assert set(d["rows_out"]) == set(d["queries"]) and set(d["shuffle_bytes"]) == set(d["queries"])
