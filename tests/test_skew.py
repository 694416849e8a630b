"""Skew regression: no skew-safe operator lets one task read most of a hot group.

Runs tools/skew_check.py in its own process (it needs an event-logging session) on a table
where one group holds a third of the rows.
"""

import os
import re
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_group_is_never_gathered_in_one_task():
    log_dir = tempfile.mkdtemp(prefix="run-skewtest-", dir="/tmp")  # a fresh event-log folder per run
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "skew_check.py"), "90000", log_dir],
                         capture_output=True, text=True, timeout=900, check=True).stdout
    shares = {m.group(1).strip(): float(m.group(2))
              for m in re.finditer(r"^(.+?)\s+largest task read\s+[\d,]+ records =\s+([\d.]+)%", out, re.M)}
    assert shares["naive window rank"] > 90.0  # the contrast really is skewed
    ours = {k: v for k, v in shares.items() if k != "naive window rank"}
    assert len(ours) == 7 and all(v < 50.0 for v in ours.values()), ours
