"""Workers that cannot import the package get it from the session."""

import os
import subprocess
import sys

RUN = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from millrace.llm.html_text import extract_text
rows = spark.createDataFrame([(1, "u", "<p>there</p>")], "page_id long, url string, html string")
print("text:", extract_text(rows).first().text)
"""


def test_a_run_in_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", RUN.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120
    )
    assert "text: there" in done.stdout, done.stderr[-2000:]
