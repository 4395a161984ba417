"""The pipeline's stages over nulls, repeated rows, very long texts, extra columns and an empty table."""

import hashlib

from llm_fixtures import edge, edge_rows, nothing, small  # noqa: F401

from adtally.llm.common import working_table
from corpus_pipeline import STAGES


def through(spark, docs, sf_dir):
    """The docs after each stage."""
    out = []
    for name, stage in STAGES:
        docs = working_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        out.append(docs)
    return out


def test_edge_rows_pass_all_stages(spark, edge, edge_rows, small):
    quality, lines, near, mixed, encoded = through(spark, edge, small)
    for docs in (quality, lines, near, mixed):
        assert docs.columns == edge.columns
        assert [f.dataType for f in docs.schema] == [f.dataType for f in edge.schema]
    given = {r[8]: r for r in edge_rows}  # __row tells rows apart
    kept = quality.collect()
    assert kept and all(len(r.text.split()) >= 50 for r in kept)
    for r in kept:
        assert tuple(r) == given[r["__row"]]
    assert {r["__row"] for r in near.collect()} <= {r["__row"] for r in lines.collect()} <= {r["__row"] for r in kept}
    # the row that stands twice is one document from the third stage on
    assert sum(r.doc_id == 1 for r in near.collect()) <= 1
    texts = [(r.doc_id, r.text) for r in mixed.collect()]
    assert {t for _, t in texts} <= {r.text for r in near.collect()}
    got = sorted((r.doc_id or 0, r.decoded_sha256) for r in encoded.collect())
    assert got == sorted((d or 0, hashlib.sha256(t.encode()).hexdigest()) for d, t in texts)


def test_an_empty_table_stays_empty(spark, nothing, small):
    stages = through(spark, nothing, small)
    assert all(docs.count() == 0 for docs in stages)
    assert all(docs.columns == nothing.columns for docs in stages[:-1])
