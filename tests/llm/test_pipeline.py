"""The pipeline: stages take effect, keep the columns, and equal brute-force decisions."""

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.test_operators import brute_fp


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        counts.append(out.count())
        if name != "sharding":
            assert out.columns == columns
            docs = out
        if name == "simhash_near_dedup":
            fps = [brute_fp(r.text) for r in docs.collect()]
            assert all((a ^ b).bit_count() > 2 for i, a in enumerate(fps) for b in fps[i + 1:])
    assert counts[0] >= counts[1] > counts[2] > counts[3] > 0 and counts[4] == counts[5]


def test_registered_with_the_entry_point(spark):
    q = entry.queries()
    assert "pipeline" in q and all(any(k.startswith(f"op{n}_") for k in q) for n in range(1, 11))
