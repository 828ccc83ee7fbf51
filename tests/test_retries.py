"""Failed tasks are retried and the results do not change (separate process: the
shared test session does not retry tasks)."""

import os
import subprocess
import sys


def test_results_survive_task_failures():
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run(
        [sys.executable, os.path.join(here, "retry_job.py"), "/root/testdata/sf0.001"],
        capture_output=True, text=True, timeout=900,
    )
    assert "RETRY-OK" in out.stdout, out.stdout[-2000:] + out.stderr[-3000:]
    assert "injected task failure" in out.stderr  # tasks really failed and were retried
