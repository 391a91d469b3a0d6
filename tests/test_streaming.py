from __future__ import annotations

from kinweave.functions.text import prepare
from kinweave.streaming.blocking import capped_batches, match_stream, reference_keys
from tests.test_blocking import RECORD, S1, S2, S3


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    ref = prepare(spark.createDataFrame(S2, RECORD)).selectExpr("*", "'S2' AS src").unionByName(prepare(spark.createDataFrame(S3, RECORD)).selectExpr("*", "'S3' AS src"))
    keys = reference_keys(ref)
    batch = match_stream(spark.createDataFrame(S1, RECORD), keys)
    spark.createDataFrame(S1, RECORD).repartition(2).write.parquet(str(tmp_path / "in"))
    got = []
    stream = match_stream(spark.readStream.schema(RECORD).parquet(str(tmp_path / "in")), keys)
    q = stream.writeStream.option("checkpointLocation", str(tmp_path / "state")).foreachBatch(capped_batches(lambda df, _: got.extend(df.collect()), 5)).start()
    q.processAllAvailable()
    q.stop()
    assert {(r["source1_entity_id"], r["candidate_entity_id"]) for r in got} == {(r["source1_entity_id"], r["candidate_entity_id"]) for r in batch.collect()}
    assert ("S1-001", "S2-001") in {(r["source1_entity_id"], r["candidate_entity_id"]) for r in got}
