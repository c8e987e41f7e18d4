import importlib
import os
import subprocess
import sys

import pytest

import corpus_pipeline
from shelfprice.llm import decontam, mixing, quality, simhash_dedup, surrogates
from shelfprice.plans.staging import stage

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage returns, over the test table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, apply in corpus_pipeline.STAGES:
        out.append(stage(apply(spark, out[-1], sf_dir), "tested"))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_names_and_order():
    words = ["quality", "dedup", "decontamination", "personal", "mixing"]
    assert len(corpus_pipeline.STAGES) == 5
    for (name, _), word in zip(corpus_pipeline.STAGES, words, strict=True):
        assert word in name


def test_all_but_the_last_return_the_columns_of_documents(stages):
    for out in stages[:-1]:
        assert out.schema.simpleString() == stages[0].schema.simpleString()


def test_decisions_take_effect(stages, table):
    docs, good, unlike, clean, private, mixed = stages
    verdicts = quality.quality_verdicts(docs, table("labels")).collect()
    assert ids(good) == {v.doc_id for v in verdicts if v.kept} < ids(docs)
    groups = simhash_dedup.near_duplicates(good).collect()
    assert ids(unlike) == {g.component_id for g in groups} < ids(good)
    dirty = ids(decontam.contaminated(unlike, table("benchmark")))
    assert dirty and ids(clean) == ids(unlike) - dirty
    assert ids(private) == ids(clean) == ids(mixed)
    before = {r.doc_id: r.text for r in clean.collect()}
    changed = 0
    for r in private.collect():
        found = surrogates.entities(before[r.doc_id])
        assert (r.text != before[r.doc_id]) == bool(found) and r.n_chars == len(r.text)
        changed += bool(found)
    assert changed
    want = {(r.doc_id, r.copies) for r in mixing.mix(private).collect()}
    assert {(r.doc_id, r.copies) for r in mixed.collect()} == want


def test_run_is_all_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].collect()))


def test_stages_with_odd_and_no_rows(spark, sf_dir):
    good = " ".join(f"word{i}" for i in range(40))
    data = [(None, good, None, None, None), (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, good + " x@y.example.com", "en", "a", 1)]
    data += [(3, good + " x@y.example.com", "en", "a", 1), (4, good.upper(), "en", None, 5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        out = table
        for _, apply in corpus_pipeline.STAGES:
            out = stage(apply(spark, out, sf_dir), "tested")
        assert out.count() == (0 if table is not docs else out.select("doc_id").distinct().count())


def test_entry_without_the_operators(tmp_path):
    """The other queries stand without this package and the pipeline."""
    for name in os.listdir(ROOT):
        if name not in ("corpus_pipeline.py", "shelfprice", ".git"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "shelfprice")
    for name in os.listdir(f"{ROOT}/shelfprice"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/shelfprice/{name}", tmp_path / "shelfprice" / name)
    # A copy, as the entry adds the folder it really lies in to the path.
    os.unlink(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(f"{ROOT}/__spark_entry__.py").read())
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q))"
    env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True).stdout
    n, extra = map(int, out.split())
    assert n > 50 and extra == 0


def test_registered_names():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


TWINS = ["op2_quality_rules", "op5_chat_format", "op6_line_repeats", "op11_filter_audit", "op12_fill_in_middle", "op13_exact_groups"]


@pytest.mark.parametrize("name", TWINS)
def test_sql_twins(spark, sf_dir, name, monkeypatch):
    from checks import compare
    from shelfprice.llm import queries

    monkeypatch.setattr(compare, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(compare, "ORACLES", queries.ORACLES)
    assert compare.difference(spark, compare.connect(sf_dir), name, sf_dir) is None


@pytest.mark.parametrize("missing", ["regex", "xxhash", "shelfprice.plans.joins"])
def test_a_missing_dependency_is_a_fault(missing):
    """Only the package itself may be left out; what it needs may not."""
    code = f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules[{missing!r}] = None; import __spark_entry__"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode and missing in done.stderr
