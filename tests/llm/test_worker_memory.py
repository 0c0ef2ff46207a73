"""What Python workers still hold when a later stage runs in them."""

from editpulse.llm import bpe
from editpulse.llm import text as X
from editpulse.llm.queries import vocabulary_path


def test_encoders_go_with_their_stage(spark):
    def left(batch):
        import gc

        import pyarrow as pa
        names = [type(x).__name__ for x in gc.get_objects()]
        return pa.RecordBatch.from_arrays([pa.array([names.count(kind)], pa.int64()) for kind in ("Encoder", "Vocabulary")], names=["encoders", "vocabularies"])
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('word', id, ' tail') AS text").repartition(8)
    assert bpe.encode(docs, vocabulary_path()).filter("n_tokens > 0").count() == 400
    rows = X.map_batches(spark.range(80).repartition(8), left, "encoders bigint, vocabularies bigint").collect()
    assert rows and {tuple(r) for r in rows} == {(0, 0)}
