from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[2]
# collects of a proven size: a row per language, per source (an error beyond a limit)
BOUNDED = {"language.py": 1, "mixing.py": 1}


def test_no_forbidden_calls():
    for f in [*(ROOT / "motefield" / "llm").glob("*.py"), ROOT / "corpus_pipeline.py"]:
        src = f.read_text()
        assert "localCheckpoint" not in src and ".crossJoin(" not in src and "except ImportError" not in src, f
        assert src.count(".collect()") == BOUNDED.get(f.name, 0), f


def test_nothing_else_imports_the_subpackage():
    for f in [*(ROOT / "motefield").rglob("*.py"), *(ROOT / "catalog").glob("*.py")]:
        if "llm" not in f.parts:
            assert "llm" not in f.read_text(), f


def test_a_query_for_each_operator():
    names = list(entry.LLM_QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14)) and "pipeline" in names
    assert set(entry.LLM_CHECKS) <= set(names)
