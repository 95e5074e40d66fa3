"""The registered queries over the whole test tables."""

import zlib

import duckdb
import pytest

import corpus_pipeline
from fleetpulse.llm.queries import ORACLES, QUERIES
from tests.compare import database, difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), database(sf_dir), ORACLES[name]) is None


def test_quality_on_held_out_labels(spark, sf_dir):
    found = QUERIES["op8_factorisation_quality"](spark, sf_dir).toPandas()  # noqa: F841 - read by name
    labelled = duckdb.sql(f"SELECT f.*, quality FROM found f JOIN '{sf_dir}/labels.parquet' USING (doc_id)").df()
    out = labelled[labelled.held_out]
    assert (out.predicted == out.quality).mean() > 0.95
    assert out[out.quality == 1].predicted.mean() > 0.97


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, corpus_pipeline.written(stage(spark, kept, sf_dir), "stage")
        assert kept.columns == columns, name
        assert 0 < kept.select("doc_id").distinct().count() <= before.select("doc_id").distinct().count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert pieces.filter("start = 0").count() == kept.count()


def test_sharding_keeps_its_law(spark, sf_dir):
    """Every row once with its own size, groups whole, slots gapless, bytes near equal."""
    found = QUERIES["op10_best_fit_sharding"](spark, sf_dir).toPandas()
    texts = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf_dir}/documents.parquet'").fetchall())
    assert sorted(found.doc_id) == sorted(texts)
    homes, groups = {}, {}
    for r in found.itertuples():
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "bytes")
        assert homes.setdefault(raw, r.shard) == r.shard
        groups[raw] = groups.get(raw, 0) + r.size
    loads = found.groupby("shard")["size"].sum()
    assert sorted(loads.index) == list(range(40)) and found.grown_shard.isna().all()
    alone = {homes[g] for g, n in groups.items() if n * 40 > sum(groups.values())}
    even = loads.drop(list(alone))
    assert even.max() - even.min() <= even.mean() / 500
    for _, s in found.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))
