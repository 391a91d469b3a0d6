"""Training, inference, embedding, diagnosis and parameter sweep as functions of tables."""

from __future__ import annotations

import time
from dataclasses import asdict
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.functions.text import prepare
from kinweave.operators import learning, metrics
from kinweave.operators.blocking import BlockingConfig, generate_candidates, prepared_tables
from kinweave.operators.features import FEATURE_NAMES, pair_features, with_labels
from kinweave.operators.nearest import Embedder, embedding_candidates
from kinweave.operators.topk import merge_candidates
from kinweave.session import cut
from kinweave.sources import records
from kinweave.sources.cache import EmbeddingCache

RECALL_GOAL = 0.95
FULL_SCALE = 2_206_821  # left records that a sweep extrapolates to by default


def train(sources: dict[str, DataFrame], labels: DataFrame, out_dir: str, config: BlockingConfig = BlockingConfig(top_k=20), trees: learning.TreeConfig = learning.TreeConfig(), sample: int | None = None) -> dict[str, Any]:
    """Blocks, makes features, scores out of fold, tunes the threshold, refits, and writes model, config.json and oof.parquet to out_dir."""
    s1 = records.sample_records(sources["S1"], sample)
    labels = records.sample_truth(labels, s1) if sample is not None else labels
    others = {k: v for k, v in sources.items() if k != "S1"}
    everyone = others["S2"].unionByName(others["S3"], allowMissingColumns=True)
    spine, truth = metrics.truth_tables(labels)
    spine, truth = cut(spine), cut(truth)
    cross = metrics.cross_country_matches(s1, everyone, truth).first()["n"]
    config = BlockingConfig(**{**asdict(config), "same_country_only": config.same_country_only and cross == 0})
    left, ref = prepared_tables(s1, others, prepare)
    pairs = cut(generate_candidates(left, ref, config))
    recall = metrics.blocking_recall(truth, pairs).first().asDict()
    if recall["candidate_recall"] < RECALL_GOAL:
        print(f"warning: candidate recall {recall['candidate_recall']:.4f} is below {RECALL_GOAL}")
    data = cut(with_labels(pair_features(pairs, left, ref), truth))
    oof, rounds = learning.out_of_fold(data, trees)
    oof = cut(oof)
    # truth within reach: ids of these tables only, and all left records, also those without a label
    known = truth.join(left.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi").join(ref.select(F.col("entity_id").alias("cand_id")), "cand_id", "left_semi")
    threshold, best = metrics.best_threshold(metrics.threshold_sweep(left.select(F.col("entity_id").alias("s1_id")), known, oof))
    model = learning.final_fit(data, rounds, trees)
    result = {"threshold": threshold, "oof_macro_f_beta": best, "feature_names": FEATURE_NAMES, "candidate_recall": recall["candidate_recall"], **asdict(config)}
    records.write_model(model, f"{out_dir}/model")
    records.write_config(result, f"{out_dir}/config.json")
    records.write_pairs(oof, f"{out_dir}/oof.parquet")
    return result


def infer(sources: dict[str, DataFrame], artifacts: str, out_dir: str, top_k: int | None = None, threshold: float | None = None) -> DataFrame:
    """Scores the candidates of new tables, writes candidates.tsv and matches.tsv (matches are a part of the candidates), and gives the scored pairs."""
    saved = records.read_config(f"{artifacts}/config.json")
    config = BlockingConfig(**{k: saved[k] for k in asdict(BlockingConfig())} | ({"top_k": top_k} if top_k else {}))
    threshold = saved["threshold"] if threshold is None else threshold
    left, ref = prepared_tables(sources["S1"], {k: v for k, v in sources.items() if k != "S1"}, prepare)
    pairs = generate_candidates(left, ref, config)
    scored = cut(learning.score(records.read_model(f"{artifacts}/model"), pair_features(pairs, left, ref)).select("source1_entity_id", "candidate_entity_id", "prob"))
    records.write_lists(scored, sources["S1"], f"{out_dir}/candidates.tsv", "candidate_entity_ids")
    records.write_lists(scored.where(F.col("prob") >= threshold), sources["S1"], f"{out_dir}/matches.tsv", "matched_entity_ids")
    return scored


def embed(sources: dict[str, DataFrame], labels: DataFrame | None, output: str, embedder: Embedder, model_name: str = "trigrams", fields: tuple[str, ...] = ("name",), k: int = 30, kind: str = "auto", cache_dir: str | None = None, existing: str | None = None, merged_output: str | None = None) -> dict[str, Any]:
    """Writes embedding candidates, and their union with existing candidates where given; reports recalls where labels are given."""
    others = {s: df for s, df in sources.items() if s != "S1"}
    cache = EmbeddingCache(cache_dir, embedder, model_name) if cache_dir else None
    pairs = cut(embedding_candidates(sources["S1"], others, embedder, model_name, fields, k, kind=kind, embed=cache))
    records.write_pairs(pairs, output)
    report: dict[str, Any] = {"candidates": pairs.count()}
    truth = metrics.truth_tables(labels)[1] if labels is not None else None
    if truth is not None:
        report["embedding"] = metrics.blocking_recall(truth, pairs).first().asDict()
    if existing:
        old = records.read_pairs(pairs.sparkSession, existing)
        merged = merge_candidates(old, pairs, k=k)
        records.write_pairs(merged, merged_output or f"{output}.merged")
        if truth is not None:
            report["existing"] = metrics.blocking_recall(truth, old).first().asDict()
            report["merged"] = metrics.blocking_recall(truth, merged).first().asDict()
    return report


def diagnose(sources: dict[str, DataFrame], labels: DataFrame, config: BlockingConfig = BlockingConfig(top_k=75), sample: int | None = None) -> dict[str, DataFrame]:
    """The four reports on missed matches: recall, by country, by signal, victims of the group cap."""
    s1 = records.sample_records(sources["S1"], sample)
    labels = records.sample_truth(labels, s1) if sample is not None else labels
    truth = cut(metrics.truth_tables(labels)[1])
    left, ref = prepared_tables(s1, {k: v for k, v in sources.items() if k != "S1"}, prepare)
    pairs = cut(generate_candidates(left, ref, config))
    return {
        "recall": metrics.blocking_recall(truth, pairs),
        "by_country": metrics.recall_by_country(s1, truth, pairs),
        "by_signal": metrics.per_signal_recall(left, ref, truth, config),
        "cap_victims": metrics.cap_victims(left, ref, truth, config),
    }


# Fixed values: (top_k, max_group_size, window), the usual setting, each changed by itself, and two together.
DEFAULT_COMBOS = ((75, 2000, 40), (150, 2000, 40), (75, 10000, 40), (75, 2000, 80), (150, 10000, 80), (250, 10000, 80))


def parse_combos(text: str) -> tuple[tuple[int, int, int], ...]:
    """'top_k:group_size:window,...'"""
    return tuple(tuple(int(x) for x in c.split(":")) for c in text.split(",") if c.strip())  # type: ignore[misc]


def sweep(sources: dict[str, DataFrame], labels: DataFrame, combos: tuple[tuple[int, int, int], ...] = DEFAULT_COMBOS, sample: int | None = 20_000, full_scale: int = FULL_SCALE) -> DataFrame:
    """One row for each (top_k, max_group_size, window), best recall first. Records are prepared once for all; full_scale left records are what the estimate extrapolates to."""
    spark: SparkSession = labels.sparkSession
    s1 = records.sample_records(sources["S1"], sample)
    truth = cut(metrics.truth_tables(records.sample_truth(labels, s1))[1])
    left, ref = prepared_tables(s1, {k: v for k, v in sources.items() if k != "S1"}, prepare)
    n = left.select("entity_id").distinct().count()
    rows = []
    for k, size, window in combos:
        began = time.time()
        pairs = cut(generate_candidates(left, ref, BlockingConfig(top_k=k, max_group_size=size, window=window)))
        recall = metrics.blocking_recall(truth, pairs).first()["candidate_recall"]
        made = pairs.count()
        rows.append((k, size, window, float(recall), made, int(made * full_scale / max(n, 1)), time.time() - began))
    schema = "top_k int, max_group_size int, window int, recall double, n_candidates_sample long, est_full_scale_candidates long, seconds double"
    return spark.createDataFrame(rows, schema).orderBy(F.desc("recall"), "n_candidates_sample")


def exists(path: str) -> bool:
    return Path(path).exists()
