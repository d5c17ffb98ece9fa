import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from bench import HEADLINE
from upkeep.registry.oracles import all_oracles
from upkeep.registry.queries import all_queries
from compare import rows_of
from helpers import formatted

ROWS_ONLY = {"leaderboard"}


def test_entry_gives_the_labelled_matrix(spark):
    frame = contract.entry(spark)
    assert frame.columns[-1] == "label"
    assert frame.count() == 279 and frame.where("label = 1").count() == 90


def test_all_but_the_solvers_have_sql():
    assert set(all_queries()) - set(all_oracles()) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(HEADLINE) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(all_queries()) - {"leaderboard"}))
def test_query_equals_its_sql(spark, tables, oracle, name):
    found = contract.queries()[name](spark, tables).toArrow()
    if name in ROWS_ONLY:
        assert found.num_rows > 0
    else:
        assert rows_of(found) == rows_of(oracle.sql(contract.oracle_sql()[name]).to_arrow_table())


def test_leaderboard_ranks_all_six(spark, tables):
    board = contract.queries()["leaderboard"](spark, tables).collect()
    assert len(board) == 6
    assert [r["F1-Score"] for r in board] == sorted((r["F1-Score"] for r in board), reverse=True)


@pytest.mark.parametrize(
    "name", ["forward_label_matrix", "forward_label_matrix_expanded", "score_batch", "weighted_f1", "request_features"]
)
def test_plans_hold_no_python_and_no_cross_join(spark, tables, name):
    plan = formatted(contract.queries()[name](spark, tables))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@pytest.mark.parametrize("gone", [["upkeep/llm", "tests/llm"], ["upkeep/llm", "tests/llm", "corpus_pipeline.py"]])
def test_the_rest_works_without_the_training_data_folders(tmp_path, gone):
    copy = tmp_path / "copy"
    root = Path(contract.__file__).resolve().parent
    shutil.copytree(root, copy, ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__") or str((Path(folder) / n).relative_to(root)) in gone
    ])
    script = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    run = subprocess.run([sys.executable, "-c", script], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split() == [str(len(all_queries())), str(len(all_oracles())), "False"]
