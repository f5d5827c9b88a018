"""The driver contract: the entry module imports and builds every oracle without a jar or a JVM."""
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import glob, os, sys, builtins
sys.path.insert(0, {root!r})
real = glob.glob
glob.glob = lambda p, *a, **k: [] if str(p).endswith(".jar") else real(p, *a, **k)
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert set(o) <= set(q), set(o) - set(q)
assert "an_by_lang" in o and "f_porter_stem" in o
from pyspark import SparkContext
assert SparkContext._active_spark_context is None
import sheaf
for d, _, names in os.walk(os.path.dirname(sheaf.__file__)):
    for n in names:
        if n.endswith(".py"):
            assert "_" + "mllib_jar" not in open(os.path.join(d, n), encoding="utf-8").read()
print("ok", len(q))
"""


def test_entry_imports_without_the_spark_jars():
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT)], capture_output=True, text=True,
                         timeout=120)
    assert out.returncode == 0 and out.stdout.startswith("ok"), out.stderr[-2000:]
