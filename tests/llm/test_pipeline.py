"""The pipeline stage by stage against plain Python, and the registration guard."""

import re
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paperlake.llm import decontaminate, mixing, nbsvm, queries, secrets
from paperlake.session import materialize
from test_jaccard import brute

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), "pipeline-test"))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    docs = queries.table(spark, SF, "documents").withColumns({"size": F.lit("x"), "key": F.lit(1), "copy": F.lit(None).cast("int")})
    odd = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), *docs.columns[2:])
    return stages(spark, docs.union(odd).union(docs.where("doc_id < 3")))


def rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_quality_keeps_what_the_classifier_accepts(spark, tables):
    model = nbsvm.train(tables[0], queries.table(spark, SF, "labels"))
    scored = tables[0].select("doc_id", "text", nbsvm.score(tables[0], F.col("text"), model).alias("p")).collect()
    assert rows(tables[1]) == sorted(((r.doc_id, r.text) for r in scored if r.p >= corpus_pipeline.MIN_QUALITY), key=str)
    assert tables[1].columns == tables[0].columns


def test_one_document_of_each_group_stays(tables):
    named = brute(rows(tables[1]))
    assert sorted({str(r[0]) for r in rows(tables[2])}) == sorted({str(d) for d, n, least in named if d == least or not n})
    assert tables[2].columns == tables[0].columns


def test_contaminated_documents_go(spark, tables):
    found = decontaminate.contaminated(tables[2], queries.table(spark, SF, "benchmark")).select("doc_id").distinct().collect()
    assert found and rows(tables[3]) == [r for r in rows(tables[2]) if r[0] not in {x.doc_id for x in found}]


def test_secrets_are_gone_and_the_rest_is_unchanged(tables):
    before, after = dict(rows(tables[3])), dict(rows(tables[4]))
    assert before.keys() == after.keys()
    for doc, text in before.items():
        assert (after[doc] == text) == (not secrets.spans_of(text)) and not secrets.spans_of(after[doc])
    assert all(r.n_chars == len(r.text) for r in tables[4].collect() if r.text is not None)


def test_the_mix_comes_last(tables):
    last = tables[5].collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in tables[4].collect()}
    assert all(0 < r.words <= size[r.doc_id] for r in last)
    assert sum(r.words for r in last) == pytest.approx(1.5 * sum(size.values()), abs=30)


def test_run_is_the_chain_of_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and set(queries.table(spark, SF, "documents").columns) <= set(out.columns)
    assert mixing.mix(queries.table(spark, SF, "documents").limit(0)).count() == 0


def test_empty_documents(spark):
    docs = queries.table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_entry_works_without_the_package(tmp_path):
    root = Path(corpus_pipeline.__file__).resolve().parent
    for name in ("__spark_entry__.py", "suite", "paperlake"):
        target = tmp_path / name
        if (root / name).is_dir():
            target.mkdir()
            for path in (root / name).iterdir():
                if path.name not in ("llm", "__pycache__"):
                    (target / path.name).symlink_to(path)
        else:
            target.write_text((root / name).read_text())
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries())[:3], [q for q in e.queries() if q[:2] == 'op' or q == 'pipeline'])"],
        cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)},
    )
    assert said.returncode == 0 and said.stdout.strip().endswith("[]"), said.stderr[-500:]
    for name in [f"op{n}_" for n in range(1, 11)]:
        assert any(q.startswith(name) for q in queries.QUERIES)
