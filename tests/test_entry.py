"""The registry without the optional subpackage's libraries."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_core_queries_survive_a_missing_library():
    code = (
        "import sys, warnings; sys.modules.update(zstandard=None, sentencepiece=None)\n"
        "with warnings.catch_warnings(record=True) as told:\n"
        "    warnings.simplefilter('always')\n"
        "    import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert len(names) > 90 and not any(n.startswith('op1_') for n in names), len(names)\n"
        "assert set(e.oracle_sql()) <= set(names)\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
