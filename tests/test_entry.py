"""The entry module with and without the optional part."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]

WITHOUT = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in {gone!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
names, sql = set(entry.queries()), set(entry.oracle_sql())
assert sql <= names, sql - names
print(len(names), sum(n.startswith("op") and n[2].isdigit() for n in names), "pipeline" in names)
"""


def counts(*gone):
    out = subprocess.run([sys.executable, "-c", WITHOUT.format(gone=gone)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    total, operators, pipeline = out.stdout.split()[-3:]
    return int(total), int(operators), pipeline == "True"


def test_other_queries_stay_without_the_optional_part():
    alone, operators, pipeline = counts("gaugeworks.llm")
    assert (operators, pipeline) == (0, False)
    assert counts("gaugeworks.llm", "corpus_pipeline") == (alone, 0, False)
    whole, operators, pipeline = counts()
    present = (ROOT / "gaugeworks" / "llm").is_dir()
    assert whole == alone + operators + pipeline and bool(operators) == present
    if present and pipeline:
        assert counts("corpus_pipeline") == (whole - 1, operators, False)


def test_nothing_else_imports_the_optional_part():
    for path in [*ROOT.glob("gaugeworks/**/*.py"), *ROOT.glob("tests/*.py"), *ROOT.glob("tools/*.py"), ROOT / "bench.py"]:
        if "llm" not in path.relative_to(ROOT).parts and path.name != "test_entry.py":
            assert "gaugeworks.llm" not in path.read_text(), path
