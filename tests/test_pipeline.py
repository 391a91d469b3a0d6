from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from kinweave import cli, pipeline
from kinweave.operators import learning
from kinweave.operators.blocking import BlockingConfig
from kinweave.operators.nearest import TrigramEmbedder
from kinweave.sources import records
from tests.test_blocking import RECORD


def tables(spark):
    """Sixty businesses, each with a worn copy in the other tables and a wrong neighbour."""
    name = lambda i: f"{'abcdefghij'[i % 10]}lpha{'klmnopqrst'[i // 10]}on {'uvwxyzabcd'[i % 7]}erto Ltd"
    s1 = [(f"S1-{i:03d}", name(i), f"{i + 1} High St, Town {10000 + i}", "US") for i in range(60)]
    s2 = [(f"S2-{i:03d}", name(i).replace("Ltd", "Limited"), f"{i + 1} High Street, Town {10000 + i}", "US") for i in range(0, 60, 2)] + [(f"S2-9{i:02d}", name(i)[::-1], f"{i} Low Rd", "US") for i in range(20)]
    s3 = [(f"S3-{i:03d}", name(i)[:-4], f"{i + 1} High St Town", "US") for i in range(0, 60, 3)]
    labels = [(f"S1-{i:03d}", ",".join([f"S2-{i:03d}"] * (i % 2 == 0) + [f"S3-{i:03d}"] * (i % 3 == 0))) for i in range(60)]
    src = {k: spark.createDataFrame(v, RECORD) for k, v in (("S1", s1), ("S2", s2), ("S3", s3))}
    return src, spark.createDataFrame(labels, "source1_entity_id string, matched_entity_ids string")


def test_train_and_infer(spark, tmp_path):
    src, labels = tables(spark)
    config = BlockingConfig(top_k=5, window=5)
    result = pipeline.train(src, labels, str(tmp_path / "art"), config, learning.TreeConfig(rounds=4, folds=2, min_leaf=2))
    assert result["candidate_recall"] == 1.0 and result["oof_macro_f_beta"] > 0.8 and result["same_country_only"]
    assert records.read_config(str(tmp_path / "art/config.json"))["window"] == 5
    assert records.read_pairs(spark, str(tmp_path / "art/oof.parquet")).columns == ["source1_entity_id", "candidate_entity_id", "label", "prob"]
    scored = pipeline.infer(src, str(tmp_path / "art"), str(tmp_path / "out"))
    lines = {n: [x for f in sorted(Path(tmp_path / f"out/{n}.tsv").glob("part-*")) for x in f.read_text().split("\n") if x] for n in ("candidates", "matches")}
    assert lines["matches"][0] == "source1_entity_id\tmatched_entity_ids"
    ids = [x.split("\t")[0] for x in lines["matches"][1:]]
    assert ids == [r["entity_id"] for r in src["S1"].collect()]  # input order, all records
    cand = {x.split("\t")[0]: set(x.split("\t")[1].split(",")) for x in lines["candidates"][1:]}
    assert all(set(x.split("\t")[1].split(",")) <= cand[x.split("\t")[0]] | {""} for x in lines["matches"][1:])
    assert scored.count() > 0


def test_sweep_diagnose_embed(spark, tmp_path):
    src, labels = tables(spark)
    out = pipeline.sweep(src, labels, pipeline.parse_combos("1:100:2,5:100:5"), sample=None).collect()
    assert [r["top_k"] for r in out][0] == 5 and out[0]["recall"] >= out[1]["recall"]
    d = pipeline.diagnose(src, labels, BlockingConfig(top_k=5, window=5))
    assert d["recall"].first()["candidate_recall"] == 1.0
    assert d["by_signal"].count() == 7 and d["cap_victims"].count() == 3
    pairs = str(tmp_path / "p.parquet")
    report = pipeline.embed(src, labels, pairs, TrigramEmbedder(), k=3)
    again = pipeline.embed(src, labels, str(tmp_path / "q.parquet"), TrigramEmbedder(), k=3, existing=pairs, merged_output=str(tmp_path / "m.parquet"))
    assert report["embedding"]["candidate_recall"] > 0.9 and again["merged"]["candidate_recall"] >= again["existing"]["candidate_recall"]


def test_sampling(spark):
    src, labels = tables(spark)
    s = records.sample_records(src["S1"], 10)
    assert s.count() == 10 and records.sample_records(src["S1"], None).count() == 60 and records.sample_records(src["S1"], 999).count() == 60
    assert records.sample_truth(labels, s).count() == 10
    assert {r[0] for r in s.select("entity_id").collect()} == {r[0] for r in records.sample_records(src["S1"].orderBy(F.desc("entity_id")), 10).select("entity_id").collect()}


def test_tsv_round_trip(spark, tmp_path):
    (tmp_path / "train_source1.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tNA\t"a ""b"""\tUS\nS1-2\t\tx\t\n')
    for i in (2, 3):
        (tmp_path / f"train_source{i}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n")
    (tmp_path / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\n")
    plain, compat = (records.read_sources(spark, str(tmp_path), null_texts=n)["S1"].orderBy("entity_id").collect() for n in (False, True))
    assert plain[0]["business_name"] == "NA" and compat[0]["business_name"] is None and plain[0]["business_address"] == 'a "b"'
    assert records.read_labels(spark, str(tmp_path)).first()["matched_entity_ids"] == "S2-1,S3-1"


def test_command_line_parses():
    a = cli.parser().parse_args(["train", "--data-dir", "x", "--top-k", "7"])
    assert (a.top_k, a.n_folds, a.rounds) == (7, 5, 500)
    assert cli.parser().parse_args(["diagnose", "--data-dir", "x"]).top_k == 75


def test_one_group_gives_no_model(spark):
    cols = ", ".join(f"{f} double" for f in learning.FEATURE_NAMES)
    df = spark.createDataFrame([("a", "b", *[0.0] * 19, 1)], f"source1_entity_id string, candidate_entity_id string, {cols}, label int")
    scored, n = learning.out_of_fold(df, learning.TreeConfig(rounds=1, folds=2))
    assert scored.count() == 0 and n == 0
