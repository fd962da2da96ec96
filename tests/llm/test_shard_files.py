"""Written shards hold each row once, whatever its key."""

from collections import Counter

from barlake.llm import sharding


def test_null_repeated_and_hot_keys_are_written(spark, tmp_path):
    docs = spark.range(300).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE id END AS doc_id", "concat('text ', id % 250, repeat('.', 40)) AS text"
    )
    sharding.write_shards(docs, str(tmp_path / "out"), 1_000)
    # Folder names are read as text: a shard is a row of bits, not a number.
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    again = spark.read.parquet(str(tmp_path / "out")).collect()
    spark.conf.unset("spark.sql.sources.partitionColumnTypeInference.enabled")
    assert Counter((r["doc_id"], r["text"]) for r in again) == Counter((r["doc_id"], r["text"]) for r in docs.collect())
    sizes = Counter()
    for r in again:
        sizes[r["shard"]] += len(r["text"])
    assert max(sizes.values()) <= 1_000
