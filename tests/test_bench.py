import json
import os
import subprocess
import sys


def test_bench_prints_one_json_line():
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    done = subprocess.run([sys.executable, "bench.py", "category_top"], cwd=repo, env=env,
                          capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    lines = [ln for ln in done.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001 and set(out["queries"]) == {"category_top"}
    assert out["value"] == out["queries"]["category_top"]
