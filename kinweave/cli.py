"""python -m kinweave.cli {train,infer,embed,diagnose,sweep} ..."""

from __future__ import annotations

import argparse
import json

from kinweave import pipeline
from kinweave.operators.blocking import BlockingConfig
from kinweave.operators.learning import TreeConfig
from kinweave.operators.nearest import TrigramEmbedder
from kinweave.session import get_spark
from kinweave.sources import records


def embedder_of(model_name: str, device: str | None):
    """The offline trigram embedder, or a sentence model where its library is installed."""
    if model_name == "trigrams":
        return TrigramEmbedder()
    try:
        from sentence_transformers import SentenceTransformer
    except ImportError as e:
        raise SystemExit(f"{model_name} needs sentence-transformers; use --model-name trigrams") from e
    held: dict[str, object] = {}

    def embed(texts: list[str]):
        if "model" not in held:
            held["model"] = SentenceTransformer(model_name, device=device)
        return held["model"].encode(texts, normalize_embeddings=True)

    return embed


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kinweave")
    sub = p.add_subparsers(dest="command", required=True)
    make = lambda name: (c := sub.add_parser(name), c.add_argument("--data-dir", required=True), c.add_argument("--null-texts", action="store_true"))[0]
    c = make("train")
    c.add_argument("--top-k", type=int, default=20)
    c.add_argument("--window", type=int, default=40)
    c.add_argument("--max-group-size", type=int, default=2000)
    c.add_argument("--out-dir", default="artifacts")
    c.add_argument("--n-folds", type=int, default=5)
    c.add_argument("--rounds", type=int, default=500)
    c.add_argument("--sample-n", type=int)
    c = make("infer")
    c.add_argument("--artifacts-dir", default="artifacts")
    c.add_argument("--out-dir", default="output")
    c.add_argument("--top-k", type=int)
    c.add_argument("--threshold", type=float)
    c = make("embed")
    c.add_argument("--model-name", default="trigrams")
    c.add_argument("--fields", nargs="+", default=["name"], choices=["name", "address", "name_address"])
    c.add_argument("--top-k", type=int, default=30)
    c.add_argument("--device")
    c.add_argument("--index-type", default="auto", choices=["auto", "flat", "ivfflat", "ivfpq"])
    c.add_argument("--cache-dir")
    c.add_argument("--sample-n", type=int)
    c.add_argument("--existing-candidates")
    c.add_argument("--output", default="candidates_embedding.parquet")
    c.add_argument("--merged-output", default="candidates_merged.parquet")
    c = make("diagnose")
    c.add_argument("--sample-n", type=int)
    c.add_argument("--top-k", type=int, default=75)
    c.add_argument("--max-group-size", type=int, default=2000)
    c.add_argument("--window", type=int, default=40)
    c = make("sweep")
    c.add_argument("--sample-n", type=int, default=20_000)
    c.add_argument("--combos")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = get_spark()
    sources = records.read_sources(spark, a.data_dir, "test" if a.command == "infer" else "train", a.null_texts)
    if a.command == "infer":
        pipeline.infer(sources, a.artifacts_dir, a.out_dir, a.top_k, a.threshold)
        return
    labels = records.read_labels(spark, a.data_dir)
    if a.command == "train":
        blocking = BlockingConfig(top_k=a.top_k, window=a.window, max_group_size=a.max_group_size)
        print(json.dumps(pipeline.train(sources, labels, a.out_dir, blocking, TreeConfig(rounds=a.rounds, folds=a.n_folds), a.sample_n)))
    elif a.command == "embed":
        s1 = records.sample_records(sources["S1"], a.sample_n)
        print(json.dumps(pipeline.embed(sources | {"S1": s1}, records.sample_truth(labels, s1), a.output, embedder_of(a.model_name, a.device), a.model_name, tuple(a.fields), a.top_k, a.index_type, a.cache_dir, a.existing_candidates, a.merged_output)))
    elif a.command == "diagnose":
        for name, df in pipeline.diagnose(sources, labels, BlockingConfig(top_k=a.top_k, window=a.window, max_group_size=a.max_group_size), a.sample_n).items():
            print(name)
            df.show(200, truncate=False)
    else:
        pipeline.sweep(sources, labels, pipeline.parse_combos(a.combos) if a.combos else pipeline.DEFAULT_COMBOS, a.sample_n).show(200, truncate=False)


if __name__ == "__main__":
    main()
