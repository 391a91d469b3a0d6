"""Reading record tables and labels, writing results and artifacts."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators.topk import joined_lists

RECORD = "entity_id string, business_name string, business_address string, country string"
LABELS = "source1_entity_id string, matched_entity_ids string"
# Texts that a common dataframe reader takes for missing.
NULL_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_tsv(spark: SparkSession, path: str, schema: str, null_texts: bool = False) -> DataFrame:
    """A tab-separated file with a header; all columns are strings. null_texts also reads NULL_TEXTS as null."""
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    if not null_texts:
        return df
    return df.select(*[F.when(F.col(c).isin(NULL_TEXTS), None).otherwise(F.col(c)).alias(c) for c in df.columns])


def read_any(spark: SparkSession, path: str, schema: str = RECORD, null_texts: bool = False) -> DataFrame:
    """By ending: .parquet, .orc, .json, else TSV."""
    for end in ("parquet", "orc", "json"):
        if path.rstrip("/").endswith("." + end):
            return spark.read.format(end).load(path)
    return read_tsv(spark, path, schema, null_texts)


def read_sources(spark: SparkSession, data_dir: str, kind: str = "train", null_texts: bool = False) -> dict[str, DataFrame]:
    """{S1, S2, S3} from {kind}_source{1,2,3}.tsv, or .parquet where that is there."""
    out = {}
    for i in (1, 2, 3):
        parquet = Path(data_dir) / f"{kind}_source{i}.parquet"
        out[f"S{i}"] = spark.read.parquet(str(parquet)) if parquet.exists() else read_tsv(spark, f"{data_dir}/{kind}_source{i}.tsv", RECORD, null_texts)
    return out


def read_labels(spark: SparkSession, data_dir: str) -> DataFrame:
    for name in ("train_ground_truth.parquet", "train_labels.parquet"):
        if (Path(data_dir) / name).exists():
            return spark.read.parquet(f"{data_dir}/{name}")
    return read_tsv(spark, f"{data_dir}/train_ground_truth.tsv", LABELS)


def sample_records(s1: DataFrame, n: int | None, seed: int = 0) -> DataFrame:
    """n distinct records by hash order, or all if n is None or not smaller. A sampling operator: the cap is its purpose."""
    if n is None:
        return s1
    ids = s1.select("entity_id").distinct().orderBy(F.xxhash64("entity_id", F.lit(seed)), "entity_id").limit(n)
    return s1.join(ids, "entity_id", "left_semi")


def sample_truth(labels: DataFrame, s1: DataFrame) -> DataFrame:
    return labels.join(s1.select(F.col("entity_id").alias("source1_entity_id")).distinct(), "source1_entity_id", "left_semi")


def write_lists(pairs: DataFrame, s1: DataFrame, path: str, column: str) -> None:
    """A TSV with a header and one line for each record of s1 in its input order, with its sorted ids joined by commas."""
    spine = s1.select(F.col("entity_id").alias("source1_entity_id"), F.monotonically_increasing_id().alias("_at")).groupBy("source1_entity_id").agg(F.min("_at").alias("_at"))
    lists = joined_lists(pairs, spine, column).join(spine, "source1_entity_id")
    lists.repartitionByRange(1, "_at").sortWithinPartitions("_at").select("source1_entity_id", column).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def write_pairs(pairs: DataFrame, path: str) -> None:
    pairs.write.mode("overwrite").parquet(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_config(config: dict[str, Any], path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(config, indent=2, sort_keys=True))


def read_config(path: str) -> dict[str, Any]:
    return json.loads(Path(path).read_text())


def write_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def read_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
