"""The driver contract: entry, queries/oracle_sql keys, and bench.py's single JSON line."""

import json
import os
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_and_sql_keys():
    q, sql = entry.queries(), entry.oracle_sql()
    own = set(q) - set(entry.LLM_QUERIES)
    assert own <= set(sql) <= set(q) and len(own) >= 30
    assert all(callable(f) for f in q.values())
    assert not any(n.startswith("op") and n[2:3].isdigit() for n in own)


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_QUERIES="code_profile",
               BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=str(tmp_path),
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout
    doc = json.loads(lines[0])
    assert doc["unit"] == "sec" and doc["sf"] == 0.001 and set(doc["queries"]) == {"code_profile"}
    assert doc["value"] >= 0
