"""Tables whose columns have the names that the operators make or use inside: values must be as without these columns."""

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import audit, bpe, decontamination, fingerprints, licenses, line_dedup, lm, negatives, quality, secrets, sharding, simhash, toxicity

NAMES = (
    "_id _th _t _w _n _k _h _s _m _l _a _b _c _fp _key _keys _pos _line _salt _range _first _keep _gone _lines _kept _n_lines _n_dropped _full _chars _symbols _dup _repeat"
    " _host host_docs host_failed host_rate host_rejected _failed _base _spans _k1 _k2 _size _shard _slice _start _row _crc size text_crc32 law shard slot grown_shard"
    " _item _bw _bh _seed _seeds _shift start matched window item_id digest license notices line _name ids n_tokens decoded_sha256 decoded component_id _own _best _node _root"
    " Text DOC_ID Source _held held_out score base_score train_tokens n_known c0 c1 c2 given host failed word keep"
).split()
LONG = "the end of " * 20000
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen"
TEXTS = [None, "", "one", LONG, "same line of text\nother line here", "Same Line of text \nmine alone now", f"so {ITEM} it goes", "password=hunter22 q7Gz0PxLr4Tn9BvKc2WmY8sD", " ".join(f"w{k}" for k in range(80))]
ROWS = [(k, t, "s") for k, t in enumerate(TEXTS)] + [(2, "one", "s"), (None, "no id", None), (None, None, None), (8, "tied id", "s")]


@pytest.fixture(scope="module")
def bare(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string")


@pytest.fixture(scope="module")
def crowded(bare):
    # Some of these differ from the table's own names in case alone.
    return bare.select("*", *[F.lit("x").alias(n) for n in NAMES])


def rows(df, *names):
    at = [df.columns.index(n) for n in names]
    return sorted(str([r[k] for k in at]) for r in df.collect())


BENCH = [(1, ITEM), (1, "other words"), (None, ITEM), (1, ITEM)]
JUDGED = lambda df: quality.judged(quality.rule_metrics(df).withColumn("bad", F.col("_m.base_failed")), failed="bad")
CASES = {
    "rule_metrics": (quality.rule_metrics, ["doc_id", "_m"]),
    "judged": (JUDGED, ["doc_id", "_kept", "host_rate"]),
    "licenses": (licenses.scan_licenses, ["doc_id", "digest", "license", "notices"]),
    "secrets": (secrets.find_secrets, ["doc_id", "_base", "_spans"]),
    "simhash": (simhash.drop_near_copies, ["doc_id", "text"]),
    "lines": (line_dedup.drop_lines, ["doc_id", "_n_lines", "_n_dropped", "_kept"]),
    "sharding": (lambda df: sharding.shard_by_bytes(df, shards=3), ["doc_id", "size", "text_crc32", "shard"]),
    "bpe": (lambda df: bpe.decode(bpe.encode(df)), ["doc_id", "n_tokens", "ids", "decoded", "decoded_sha256"]),
    "lm": (lm.score_texts, ["_id", "n_tokens", "n_known", "base_score"]),
    "fingerprints": (simhash.group_by_simhash, ["_id", "_fp", "component_id"]),
    "overlaps": (lambda df: decontamination.find_overlaps(df, df.sparkSession.createDataFrame(BENCH, "item_id long, text string")), ["_id", "item_id", "start", "matched", "window"]),
    "overlaps_dropped": (lambda df: decontamination.drop_overlaps(df, df.sparkSession.createDataFrame(BENCH, "item_id long, text string")), ["doc_id", "text"]),
    "labelled": (lambda df: toxicity.labelled_sample(df, df.sparkSession.createDataFrame([(3, 1, "x"), (2, 0, "x"), (None, 1, "x"), (4, None, "x")], "doc_id long, toxic int, Toxic string")), ["doc_id", "text", "toxic"]),
    "hard_negatives": (lambda df: negatives.mine(d := df.withColumn("v", F.array(F.lit(1.0), F.lit(2.0))), d, vec_id="doc_id", vector="v", label="doc_id", positives=2), ["anchor_id"]),
    "paragraphs": (fingerprints.fingerprints, ["_id", "_lanes"]),
    "edits": (fingerprints.edits, ["_id", "n_chars", "_edited_lanes"]),
    "audit": (lambda df: audit.audit_filters(df, df.sparkSession.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int")), ["part", "filter_order", "step", "removed", "good_lost"]),
    "toxicity": (lambda df: toxicity.score(df, toxicity.Model(-1.0, 1.0, 0.0, *[toxicity.np.zeros(0, int)] * 2)), ["_id", "score"]),
}


@pytest.mark.parametrize("name", CASES)
def test_names_and_values(bare, crowded, name):
    work, names = CASES[name]
    assert rows(work(crowded), *names) == rows(work(bare), *names)
    assert work(crowded.where("false")).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages(spark, sf, bare, crowded, name):
    stage, known = dict(pipeline.STAGES)[name], ["doc_id", "text", "source"] if name != "byte_bpe" else ["doc_id", "n_tokens", "ids"]
    made = stage(spark, crowded, sf)
    assert name == "byte_bpe" or made.columns == crowded.columns
    assert rows(made, *known) == rows(stage(spark, bare, sf), *known)
    assert stage(spark, crowded.where("false"), sf).count() == 0


def test_values_of_odd_rows(spark, sf, bare):
    def of(name, column):
        return {(r.doc_id, r[column]) for r in dict(pipeline.STAGES)[name](spark, bare, sf).collect()}

    assert of("quality_rules", "text") == set()  # ten of the host's eleven documents fail, so the host is rejected
    more = bare.unionByName(spark.createDataFrame([(100 + k, TEXTS[8], "good") for k in range(40)], bare.schema))
    assert {r.doc_id for r in pipeline.quality_rules(spark, more, sf).collect()} == set(range(100, 140))
    kept = of("line_dedup", "text")
    assert (5, "mine alone now") in kept and (0, "") in kept and (3, LONG) in kept and (None, "no id") in kept and len(kept) == 12
    ids = sorted(str(r.doc_id) for r in pipeline.near_copies(spark, bare, sf).collect())
    assert ids == ["0", "2", "3", "4", "5", "6", "7", "8", "None", "None"]
    left = decontamination.drop_overlaps(bare, spark.createDataFrame(BENCH, "item_id long, text string"))
    assert {r.doc_id for r in left.collect()} == {0, 1, 2, 3, 4, 5, 7, 8, None} and left.count() == len(ROWS) - 1
