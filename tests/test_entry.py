"""The entry with parts of the repository taken away, each on a copy of its own."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
NAMES = "import __spark_entry__ as e; print(*e.queries())"


def names(tmp_path, without=(), code=NAMES):
    copy = tmp_path / "copy"
    hidden = shutil.ignore_patterns(".git", "__pycache__", "*.json", *[Path(w).name for w in without])

    def ignore(folder, inside):
        found = hidden(folder, inside)
        here = Path(folder).relative_to(ROOT)
        return {n for n in found if n in (".git", "__pycache__") or n.endswith(".json") or str(here / n) in without}

    shutil.copytree(ROOT, copy, ignore=ignore)
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    return done, copy


@pytest.mark.parametrize(
    "without", [("fleetgrain/llm", "tests/llm"), ("fleetgrain/llm", "tests/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)]
)
def test_the_rest_loads_without_parts(tmp_path, without):
    done, _ = names(tmp_path, without)
    assert done.returncode == 0, done.stderr
    found = set(done.stdout.split())
    assert "trip_walk" in found and "pipeline" not in found
    assert any(n.startswith("op") and n[2].isdigit() for n in found) == ("fleetgrain/llm" not in without and (ROOT / "fleetgrain/llm/queries.py").exists())


def test_a_left_over_folder_or_a_missing_library_is_no_fault(tmp_path):
    code = "import os; os.makedirs('fleetgrain/llm/__pycache__', exist_ok=True); " + NAMES
    done, _ = names(tmp_path, ("fleetgrain/llm", "tests/llm"), code)
    assert done.returncode == 0 and "trip_walk" in done.stdout, done.stderr


def test_a_missing_library_takes_only_the_queries_that_need_it(tmp_path):
    done, _ = names(tmp_path, (), "import sys; sys.modules['ahocorasick'] = None; " + NAMES)
    assert done.returncode == 0 and "trip_walk" in done.stdout and "pipeline" not in done.stdout.split(), done.stderr


@pytest.mark.skipif(not (ROOT / "fleetgrain/llm/queries.py").exists(), reason="subpackage absent")
def test_a_fault_inside_shows(tmp_path):
    code = "open('fleetgrain/llm/common.py', 'a').write('\\nfrom fleetgrain.session import no_such_name\\n'); " + NAMES
    done, _ = names(tmp_path, (), code)
    assert done.returncode != 0 and "no_such_name" in done.stderr
