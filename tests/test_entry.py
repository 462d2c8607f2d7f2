"""The queries that do not need the text subpackage are there without it."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
for name in {hidden}:
    sys.modules[name] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert "A1_scan_field" in names and names >= set(entry.oracle_sql())
assert not any(n.startswith("op") for n in names) and "pipeline" not in names
"""


def run(hidden):
    done = subprocess.run([sys.executable, "-c", CODE.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_without_a_package_that_text_needs():
    run(["tokenizers"])


def test_without_the_subpackage():
    run(["gridlake.llm"])
