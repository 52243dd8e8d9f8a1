"""The entry points without the optional part."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

BLOCKED = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


def entry_without(name):
    done = subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], cwd=ROOT, capture_output=True, text=True, check=True)
    return tuple(map(int, done.stdout.split()))


def test_engine_survives_missing_parts():
    """Without the text operators, or a library they need, the engine's queries are all there."""
    from checks import oracles, queries

    engine = len(queries.registered()), len(oracles.registered())
    for name in ("ledgerloom.llm", "corpus_pipeline", "xxhash", "zstandard", "public_tokenizers"):
        assert entry_without(name) == engine
