import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from quarry.operators.cluster import kmeans_assign
from quarry.operators.text import fingerprint_clusters
from quarry.plans import inputs
from quarry.streaming import assign_stream, fingerprint_counts


def _docs_stream(spark):
    schema = spark.read.parquet(f"{SF001}/documents*.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{SF001}/documents*.parquet")


def test_streaming_fingerprint_counts_match_batch(spark):
    lines = _docs_stream(spark).select(F.explode(F.split("text", "\n")).alias("value"))
    ckpt = tempfile.mkdtemp(prefix="quarry-stream-")
    q = (fingerprint_counts(lines).writeStream.outputMode("complete").format("memory")
         .queryName("fp_counts").option("checkpointLocation", ckpt).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    rows = [(r.fingerprint, r.value, r["count"]) for r in spark.table("fp_counts").collect()]
    n_values = {}
    for fp, _, _ in rows:
        n_values[fp] = n_values.get(fp, 0) + 1
    got = sorted(r for r in rows if n_values[r[0]] >= 2)
    batch = fingerprint_clusters(inputs.document_lines(spark, SF001))
    want = sorted((r.fingerprint, r.value, r["count"]) for r in batch.collect())
    assert got == want and len(want) > 0


def test_streaming_assignment_matches_batch(spark):
    schema = spark.read.parquet(f"{SF001}/embeddings.parquet").schema
    stream = (spark.readStream.schema(schema).parquet(f"{SF001}/embeddings*.parquet")
              .select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec")))
    centres = [[0.0] * 64, [0.05] * 64]
    ckpt = tempfile.mkdtemp(prefix="quarry-stream-")
    q = (assign_stream(stream, centres).writeStream.format("memory").queryName("assigned")
         .option("checkpointLocation", ckpt).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.id, r.cid) for r in spark.table("assigned").collect())
    want = sorted((r.id, r.cid) for r in kmeans_assign(inputs.embedding_vectors(spark, SF001), centres).collect())
    assert got == want
