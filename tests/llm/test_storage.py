"""Tables in the shared folder."""

from millrace.llm import storage


def test_stored_and_released(spark):
    kept = storage.stored(spark.range(5).toDF("k"))
    other = storage.stored(spark.range(3).toDF("k").limit(0))
    assert kept.count() == 5 and other.count() == 0 and other.columns == ["k"]
    storage.drop_stored(kept)
    again = storage.stored(spark.range(2).toDF("k"))
    assert again.count() == 2
    path = again.inputFiles()[0]
    storage.release(spark)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def test_blocks_by_characters(spark):
    docs = spark.createDataFrame([("x" * 100,), (None,), ("é" * 51,)], "text string")
    assert storage.block_count(docs, chars_per_block=50) == 4 and storage.block_count(docs.limit(0)) == 1
