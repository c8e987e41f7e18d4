"""Operators that send Python to the executors, in a session whose workers cannot import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()

def importable(batches):
    import importlib.util
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_pydict({"found": [importlib.util.find_spec("shelfprice") is not None]})

assert not any(r.found for r in spark.range(4).mapInArrow(importable, "found boolean").collect())
from shelfprice.llm import exact_dedup, filter_audit, fim, html_text, line_dedup, simhash_dedup, surrogates
words = " ".join(f"w{i}" for i in range(60))
docs = spark.createDataFrame([(1, "Mrs Anna Weber a@b.example.com", "s"), (2, words, "s"), (3, "x " + words, "t")], "doc_id long, text string, source string")
labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
pages = spark.createDataFrame([(1, "u", "<p>Text.</p>")], "page_id long, url string, html string")
print(surrogates.rewrite(docs, b"k").count(), fim.restore(fim.fill_in_middle(docs)).count(), line_dedup.remove_repeats(docs).where(F.size("removed") > 0).count(),
      exact_dedup.exact_groups(docs).count(), filter_audit.audit_documents(docs, labels).count(), html_text.extract_main_text(pages).count(),
      simhash_dedup.near_duplicates(docs).count())
"""


def test_workers_without_the_package(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(CODE)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.split()[-7:] == ["3", "3", "1", "3", "1200", "1", "3"]
