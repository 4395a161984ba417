"""Counting words: like plain Python, and in memory that follows the text instead of the number of its words."""

import os
import re
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from adtally.llm.common import count_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Eight million words in 16 MB. As objects they alone fill this heap.
LONG = """
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from adtally.llm import mixing

spark = SparkSession.builder.master("local[1]").getOrCreate()
text = F.repeat(F.concat(F.col("id").cast("string"), F.lit(" ")), F.lit(8_000_000))
docs = spark.range(2).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.when(F.col("id") > 0, text).alias("text"))
print(sorted((r.doc_id, r["size"]) for r in mixing.plan(docs).select("doc_id", "size").collect()))
"""


def test_like_plain_python(spark):
    texts = [
        None, "", " ", "  a", "a  ", " \t\n\x0b\x0c\r", " \ta\x0bb\x0cc\r\nd ", "\x85a\xa0b c", "a\x1cb \x1f c",
        "日本 語\U0001f642 é", "$1 \\ . x", ". . .", "word " * 5000 + " " * 5000, " " * 100_000,
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.n for r in rows.select("id", count_words(F.col("text")).alias("n")).collect()}
    assert got == {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}


def test_long_text_in_a_small_heap(tmp_path):
    conf = [
        "spark.driver.memory=480m", "spark.ui.enabled=false", "spark.ui.showConsoleProgress=false",
        "spark.sql.shuffle.partitions=2", f"spark.checkpoint.dir={tmp_path}/shared", f"spark.sql.warehouse.dir={tmp_path}/warehouse",
    ]
    env = os.environ | {
        "PYTHONPATH": str(Path(__file__).parents[2]),
        "PYSPARK_PYTHON": sys.executable,
        "PYSPARK_SUBMIT_ARGS": " ".join(f"--conf {c}" for c in conf) + " pyspark-shell",
    }
    run = subprocess.run([sys.executable, "-c", LONG], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0 and run.stdout.split("\n")[-2] == "[(0, 0), (1, 8000000)]", run.stderr[-2000:]
