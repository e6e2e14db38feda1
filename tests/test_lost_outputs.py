"""Row counts stay exact when map outputs are lost and map tasks run again."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import DATA

SCRIPT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "lost_outputs.py")


def test_counts_survive_lost_map_outputs(tmp_path):
    done = subprocess.run(
        [sys.executable, SCRIPT, str(tmp_path), f"{DATA}/sf0.1"],
        capture_output=True,
        text=True,
        timeout=300,
        check=True,
    )
    result = json.loads(done.stdout.strip().splitlines()[-1])
    assert result["found"] == result["wanted"]
    assert result["rows"] == result["wanted"]["clean_rows"]
    assert result["reruns"] > 0
