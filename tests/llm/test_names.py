"""Other columns, whatever they are called, come through the operators that return the columns of docs."""

import pathlib
import subprocess
import sys

import pytest
from llm_words import words

from adtally.llm import linedup, mixing, ngram_join

HOSTILE = [
    "__doc", "__spans", "__hash", "__copy", "__id", "__id2", "__version", "__rank2", "__source2", "__place", "__text_hash",
    "__gone", "_given0", "n lines", "matched", "print", "size", "place",
]


@pytest.fixture(scope="module")
def docs(spark):
    passage = words(1, 60)
    texts = [passage + "\n" + words(2, 20), words(3, 80), words(3, 80), None, "", passage + "\n" + words(4, 30)]
    rows = [(n, text, "ab"[n % 2], *[f"{name}{n}" for name in HOSTILE]) for n, text in enumerate(texts)]
    columns = ", ".join(f"`{name}` string" for name in HOSTILE)
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, {columns}")


@pytest.mark.parametrize(
    "run", [lambda d: linedup.dedup(d, counts=False), ngram_join.one_of_each, mixing.mix], ids=["lines", "near", "mix"]
)
def test_hostile_names_come_through(docs, run):
    out = run(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert got
    for row in got:
        for name in HOSTILE:
            assert row[name] == f"{name}{row.doc_id}"


def test_counts_take_the_place_of_columns_of_their_names(docs):
    wide = docs.withColumnRenamed("size", "n_lines")
    out = linedup.dedup(wide)
    assert out.columns == [c for c in wide.columns if c != "n_lines"] + ["n_lines", "n_deleted"]
    assert {r.doc_id: r.n_lines for r in out.collect()}[0] == 2


def test_entry_without_the_tokenizer_files():
    """A library that only these operators need is missing: the other queries are still there."""
    code = (
        "import sys, warnings; sys.modules['public_tokenizers'] = None; warnings.simplefilter('ignore')\n"
        "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') and n[2].isdigit() for n in q))"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=pathlib.Path(__file__).parents[2])
    count, some = out.stdout.split()
    assert int(count) >= 84 and some == "False", out.stderr


def test_roots_of_records_are_those_of_spark(spark):
    from adtally.llm.binary import qualified

    assert qualified(spark, "/tmp/a b") == "file:///tmp/a b"
    assert qualified(spark, "file:///tmp/x") == qualified(spark, "file:/tmp/x") == "file:///tmp/x"
