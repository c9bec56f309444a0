"""The entry point where a library of the optional part is missing."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys, warnings
for name in {blocked!r}:
    sys.modules[name] = None
warnings.simplefilter("ignore")
import __spark_entry__ as e
print(len([k for k in e.queries() if not k.startswith("op") and k != "pipeline"]), len([k for k in e.queries() if k.startswith("op")]))
"""


def loaded(*blocked):
    done = subprocess.run([sys.executable, "-c", CODE.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return tuple(map(int, done.stdout.split()))


def test_base_queries_load_without_optional_libraries():
    base, _ = loaded()
    assert base >= 75
    assert loaded("ahocorasick") == (base, 0)
    assert loaded("fillwise.llm") == (base, 0)
    assert loaded("xxhash") == (base, 0)
