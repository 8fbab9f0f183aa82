"""The entry points without the training-data operators, or without a library of theirs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("blocked", ["holdfast.llm", "xxhash", "tokenizers", "corpus_pipeline"])
def test_core_queries_need_no_library_of_the_others(blocked):
    code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    n, any_operator = done.stdout.split()
    assert int(n) > 80 and (any_operator == "False")
