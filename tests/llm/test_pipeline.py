"""Each stage of the pipeline against a plain version, on all that the stage before it kept."""

import corpus_pipeline as pipeline
from sparkloom.llm import common

from . import plain
from .test_near import groups


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        made = common.land(stage(spark, docs, sf))
        after = {r.doc_id: r for r in made.collect()}
        assert made.count() == len(after) and after.keys() <= before.keys()
        if name != "byte_bpe":
            assert made.columns == columns
        if name == "quality_rules":
            failed = {i: plain.metrics(r.text)[2] for i, r in before.items()}
            bad = plain.rejected_hosts([(r.source, failed[i]) for i, r in before.items()])
            assert after.keys() == {i for i, r in before.items() if not failed[i] and r.source not in bad}
        elif name == "line_dedup":
            want = plain.kept_lines([(i, r.text) for i, r in before.items()])
            assert {i: r.text for i, r in after.items()} == {i: w[2] for i, w in want.items()}
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "simhash_near_dedup":
            assert after.keys() == set(groups({i: r.text for i, r in before.items()}).values())
        elif name == "benchmark_decontamination":
            told = [set(x.split()) for x in items]
            likely = {i: [t for t, w in zip(items, told, strict=True) if len(w & set(r.text.split())) >= 4] for i, r in before.items()}
            bad = {i for i, r in before.items() if any(plain.overlaps(r.text, t) for t in likely[i])}
            assert bad and after.keys() == before.keys() - bad
        else:
            assert after.keys() == before.keys()
            assert all(r.decoded_sha256 == plain.sha(before[i].text) and r.n_tokens * 4 == len(r.ids) for i, r in after.items())
        docs = made
    assert sorted(r.doc_id for r in pipeline.run(spark, sf).collect()) == sorted(after)
