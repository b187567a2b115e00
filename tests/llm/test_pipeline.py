import shutil
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF0001
from tests.llm.conftest import prose
from tests.llm.test_nearjoin import brute


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    languages = corpus_pipeline.identify_language(spark, docs, SF0001)
    assert languages.columns == docs.columns
    kept = languages.collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(kept) >= 0.99 * len(lang) and sum(lang[r.doc_id] == r.lang for r in kept) > 0.97 * len(kept)

    stay = corpus_pipeline.drop_near_copies(spark, docs, SF0001)
    assert stay.columns == docs.columns
    classes = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(r.doc_id for r in stay.collect()) == sorted({c for _, c, _ in classes})

    mixed = corpus_pipeline.mix_to_targets(spark, docs, SF0001)
    assert mixed.columns == docs.columns and 0 < mixed.count() < docs.count()


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF0001).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    parts, sequences = defaultdict(list), defaultdict(int)
    for r in rows:
        parts[r.doc_id].append(r)
        sequences[r.sequence_id] += r.length
    assert set(parts) <= set(docs) and max(sequences.values()) <= 2048
    for ps in parts.values():
        assert sum(p.length for p in ps) == ps[0].doc_tokens
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries()
    assert [f"op{n}" for n in range(1, 14)] == sorted((q.split("_")[0] for q in entry.queries() if q.startswith("op")), key=lambda x: int(x[2:]))


def test_nasty_documents(spark, nasty):
    docs = nasty.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= 0


def test_one_row_of_each_class_stays(spark, nasty, make_docs):
    docs = nasty.select("doc_id", "text", "lang", "source", "n_chars")
    stay = Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    wordless = [r for r in rows if not any(c.isalnum() for c in r[1] or "")]
    others = {t: min((i is None, i or 0, i) for i, u in rows if u == t)[2] for _, t in rows if any(c.isalnum() for c in t or "")}
    assert stay == Counter(wordless) + Counter((i, t) for t, i in others.items())
    # an id that names another text's class doesn't save a copy, and copies without ids are copies
    a, b = prose(1, 30), prose(2, 30)
    docs = make_docs([(1, a), (2, a), (2, b), (None, b), (None, b), (None, prose(3, 30))]).select("doc_id", "text", "lang", "source", "n_chars")
    stay = {(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert stay == {(1, a), (2, b), (None, prose(3, 30))}


def test_stages_on_an_empty_table(spark, empty):
    docs = empty.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


def test_mixing_keeps_its_rate_beside_a_tiny_source(spark, make_docs):
    docs = make_docs([(i, "a b c d") for i in range(2000)]).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.withColumn("source", F.when(F.col("doc_id") < 1999, "s").otherwise("tiny"))
    mixed = corpus_pipeline.mix_to_targets(spark, docs, "").count()
    assert abs(mixed - corpus_pipeline.MIX_RATE * 2000) < 100


def test_rest_works_without_this_package(tmp_path):
    """A copy without llm, its tests and the pipeline still registers the other queries."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    copy = tmp_path / "repo"
    shutil.copytree(repo, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, len(e.oracle_sql()))"], cwd=copy, capture_output=True, text=True, check=True)
    assert said.stdout.split()[1] == "False" and int(said.stdout.split()[0]) >= 80
