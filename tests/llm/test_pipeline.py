"""The pipeline: stages one after another, planted cases, and the entry without it."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from conftest import SF
from pyspark.sql import functions as F

ROOT = Path(corpus_pipeline.__file__).parent


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The small tables with copies, a passage that recurs, and labels."""
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    letters = str.maketrans("0123456789", "abcdefghij")
    body = lambda n, salt: " ".join(f"word{salt}x{i}".translate(letters) for i in range(n))
    passage = "The passage " + body(55, "p")
    rows = [(900_000 + i, body(80, "copy"), "en", "src1") for i in range(5)]
    rows += [(900_100 + i, body(80, "near") + f" edit{i}", "en", "src2") for i in range(5)]
    rows += [(900_200 + i, f"{body(60, f'own{i}')}\n{passage}\n{body(20, f'end{i}')}", "en", "src3") for i in range(6)]
    rows += [(900_300, None, None, None), (900_301, "", "en", "src1")]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    extra = extra.withColumn("n_chars", F.length("text").cast("long"))
    docs.unionByName(extra).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.01/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder, passage


def test_stages(spark, planted, scratch):
    folder, passage = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        found[name] = docs
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
    ids = lambda name, low, n: {r["doc_id"] for r in found[name].where(F.col("doc_id").between(low, low + n)).collect()}
    assert len(ids("toxicity", 900_000, 400)) == 18
    assert found["line_dedup"].where(F.contains("text", F.lit(passage))).count() == 0
    assert len(ids("line_dedup", 900_200, 50)) == 6
    assert ids("near_duplicates", 900_000, 50) == {900_000}
    assert ids("near_duplicates", 900_100, 50) == {900_100}
    assert len(ids("near_duplicates", 900_200, 50)) == 6
    assert ids("near_duplicates", 900_300, 50) == {900_300, 900_301}
    last = found["encoding"]
    assert last.where("not round_trip").count() == 0
    assert last.count() == found["mixing"].count()


def test_run(spark, planted):
    assert corpus_pipeline.run(spark, planted[0]).where("n_tokens > 0").count() > 0


def test_no_documents(spark, planted, scratch):
    folder, _ = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path) if name != "encoding" else spark.read.parquet(path)
        assert docs.count() == 0


def test_entry_without_the_folders(tmp_path):
    """With the operators and the pipeline gone, the other queries are still there."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('lexweave.llm', 'corpus_pipeline') or name.startswith('lexweave.llm.'):\n"
        "            raise ImportError(name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 't4_cases' in names and not any(n.startswith('op') for n in names) and 'pipeline' not in names\n"
        "assert set(e.oracle_sql()) <= names\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_operators():
    for path in ROOT.glob("lexweave/**/*.py"):
        if "llm" not in path.parts:
            assert "lexweave.llm" not in path.read_text(), path
