"""The pipeline: stages take effect, and the library stands without the subpackage."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from samples import prose, table
from test_neardup import edited

ROOT = Path(__file__).resolve().parents[2]


def rows_and_items():
    items = [(i, prose(700 + i, 40)) for i in range(3)]
    rows = [(i, prose(i, 60 + i), "en", "s", 0) for i in range(30)]
    rows += [(100 + i, edited(rows[i][1], i, 0.005), "en", "s", 0) for i in range(5)]
    rows += [(200 + i, f"{prose(40 + i, 50)} {items[i][1]}", "en", "s", 0) for i in range(3)]
    rows += [(300, prose(60, 50) + " password=1cfe32532b58a53af4 " + prose(61, 50), "en", "s", 0)]
    rows += [(400, None, None, None, None), (401, "", "en", "s", 0), (402, "12 34", "en", "s", 0)]
    return rows, items


def test_each_stage_acts_on_what_the_last_one_kept(spark, tmp_path):
    rows, items = rows_and_items()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = table(spark, rows)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
        kept[name] = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secret_scans", "packing"]
    clean = set(range(30))
    assert set(kept["language_id"]) == {r[0] for r in rows} - {400, 401, 402}
    assert len(kept["near_dedup"]) == 34 and all((i in kept["near_dedup"]) + (100 + i in kept["near_dedup"]) == 1 for i in range(5))
    left = {i % 100 for i in kept["decontamination"] if i < 200}
    assert left == clean and not {200, 201, 202} & set(kept["decontamination"]) and 300 in kept["decontamination"]
    assert set(kept["secret_scans"]) == set(kept["decontamination"])
    text = kept["secret_scans"][300].text
    assert "[secret]" in text and "1cfe32532b58a53af4" not in text and kept["secret_scans"][300].n_chars == len(text)
    assert set(kept["packing"]) == set(kept["secret_scans"])


def test_run_and_empty_documents(spark, tmp_path):
    rows, items = rows_and_items()
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table(spark, rows[:0]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_nothing_else_imports_the_subpackage():
    for path in [*ROOT.glob("*.py"), *(ROOT / "tidemark").rglob("*.py"), *(ROOT / "tests").glob("*.py")]:
        if "llm" not in path.parts and path.name not in ("__spark_entry__.py", "corpus_pipeline.py"):
            assert not re.search(r"^\s*(from|import) .*\bllm\b", path.read_text(), re.M), path


def test_entry_works_without_the_subpackage(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.split('.')[:2] == ['tidemark', 'llm'] or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') and n[2].isdigit() for n in e.queries()) and 'pipeline' not in e.queries()\n"
        "assert set(e.queries()) == set(e.oracle_sql())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
