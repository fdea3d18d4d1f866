"""The optional part of the entry is optional."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = """
import sys
{block}
import __spark_entry__ as entry
from kpiloom.registry import CHECKS, QUERIES
assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())
print(len(entry.queries()) - len(QUERIES))
"""


def more_queries(block=""):
    done = subprocess.run(
        [sys.executable, "-W", "always", "-c", NAMES.format(block=block)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return int(done.stdout), done.stderr


@pytest.mark.parametrize("module", [
    "tiktoken", "regex", "xxhash", "public_tokenizers", "corpus_pipeline", "kpiloom.llm",
])
def test_without_a_module_of_the_corpus_part(module):
    n, said = more_queries(f"sys.modules[{module!r}] = None")
    assert n == 0
    assert ("left out" in said) == (module not in ("corpus_pipeline", "kpiloom.llm"))


def test_a_broken_core_module_is_an_error():
    done = subprocess.run(
        [sys.executable, "-c", NAMES.format(block="sys.modules['kpiloom.operators.cases'] = None")], cwd=ROOT, capture_output=True)
    assert done.returncode != 0
