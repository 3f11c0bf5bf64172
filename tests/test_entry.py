"""The entry module without the text part, or without a library that it needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)


@pytest.mark.parametrize("module", ["regex", "ahocorasick", "tidemark.llm", "corpus_pipeline"])
def test_customer_queries_stay_without(module):
    code = (f"import sys; sys.modules[{module!r}] = None; sys.path.insert(0, {ROOT!r}); "
            "import __spark_entry__ as e; from tidemark.plans.catalog import QUERIES; "
            "assert set(QUERIES) <= set(e.queries()); assert set(e.oracle_sql()) <= set(e.queries()); "
            "print(len(e.queries()) - len(QUERIES))")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT)
    assert done.returncode == 0, done.stderr
    if module != "ahocorasick":        # that one is needed when texts are encoded
        assert done.stdout.strip() == "0"
