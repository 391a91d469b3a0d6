"""A Parquet cache of embeddings, one row for each text."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators.nearest import Embedder, embed_texts


class EmbeddingCache:
    """Vectors keyed by model, prefix and text. Texts that are not in the cache are embedded and appended; nothing else is computed again."""

    def __init__(self, path: str, embedder: Embedder, model: str):
        self.path, self.embedder, self.model = path, embedder, model

    def _stored(self, df: DataFrame, prefix: str) -> DataFrame | None:
        if not (Path(self.path) / "_SUCCESS").exists():
            return None
        return df.sparkSession.read.parquet(self.path).where((F.col("model") == self.model) & (F.col("prefix") == prefix)).select("text", "vec").dropDuplicates(["text"])

    def __call__(self, df: DataFrame, prefix: str = "") -> DataFrame:
        stored = self._stored(df, prefix)
        texts = df.select("text").where("text IS NOT NULL").distinct()
        missing = texts if stored is None else texts.join(stored.select("text"), "text", "left_anti")
        fresh = embed_texts(missing, self.embedder, prefix).withColumns({"model": F.lit(self.model), "prefix": F.lit(prefix)})
        fresh.write.mode("append").partitionBy("model").parquet(self.path)
        return df.join(self._stored(df, prefix), "text")
