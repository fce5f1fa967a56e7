from __future__ import annotations

import os

import pytest

import tokenframe as tf
from registry.inputs import ADDRESS
from registry.queries import QUERIES

from .texts import TEXTS


@pytest.fixture
def source(spark, tmp_path):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, address string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    return df


@pytest.mark.parametrize("operator", ["tokenize", "extract", "extract_first"])
def test_a_stream_gives_what_a_batch_gives(spark, source, model, table_model, operator, tmp_path):
    def apply(df):
        if operator == "tokenize":
            return tf.tokenize(df, "address", table_model, class_ids=True)
        if operator == "extract":
            return tf.extract(df, "address", model, ADDRESS, "any")
        return tf.extract_first(df, "address", model, [("a", ADDRESS), ("n", "<<N#>>", "any")])

    stream = (
        spark.readStream.schema(source.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "in"))
    )
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        tf.write_stream(apply(stream), out, checkpoint, available_now=True).awaitTermination()
    found, expected = spark.read.parquet(out), apply(source)
    assert found.count() == expected.count()
    assert found.exceptAll(expected).count() == 0


def test_a_batch_is_refused(source, tmp_path):
    with pytest.raises(ValueError, match="streaming DataFrame"):
        tf.write_stream(source, str(tmp_path / "o"), str(tmp_path / "c"))


def _stream(spark, source, folder):
    files = spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1)
    return files.parquet(str(folder / "in"))


@pytest.mark.parametrize("operator", ["tokenize", "extract", "profile"])
def test_batches_of_a_stream_look_words_up_by_join(spark, source, join_model, operator, tmp_path):
    def apply(df):
        if operator == "tokenize":
            return tf.tokenize(df, "address", join_model, class_ids=True)
        if operator == "extract":
            return tf.extract(df, "address", join_model, ADDRESS, "any")
        return tf.tokens_long(df, "id", "address", join_model)

    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        query = tf.write_batches(_stream(spark, source, tmp_path), apply, out, checkpoint, available_now=True)
        query.awaitTermination()
    found, expected = spark.read.parquet(out), apply(source)
    assert found.select("batch_id").distinct().count() == 3
    found = found.drop("batch_id")
    assert found.count() == expected.count()
    assert found.exceptAll(expected).count() == 0


def test_a_repeated_batch_replaces_what_it_wrote(spark, source, model, tmp_path):
    out, calls = str(tmp_path / "out"), []

    def fails_once(batch):
        calls.append(batch.count())
        if len(calls) == 2:
            # Written, and then the job ends before the batch is marked as done.
            batch.write.mode("overwrite").parquet(f"{out}/batch_id=1")
            raise RuntimeError("lost")
        return batch

    checkpoint = str(tmp_path / "checkpoint")
    with pytest.raises(Exception, match="lost"):
        tf.write_batches(
            _stream(spark, source, tmp_path), fails_once, out, checkpoint, available_now=True
        ).awaitTermination()
    tf.write_batches(
        _stream(spark, source, tmp_path), fails_once, out, checkpoint, available_now=True
    ).awaitTermination()
    found = spark.read.parquet(out).drop("batch_id")
    assert found.count() == source.count() and found.exceptAll(source).count() == 0


def test_what_cannot_be_done_is_refused_at_build(spark, source, join_model, tmp_path):
    stream = _stream(spark, source, tmp_path)
    with pytest.raises(ValueError, match="needs a batch"):
        tf.tokenize(stream, "address", join_model)
    with pytest.raises(ValueError, match="cannot replace a batch"):
        tf.write_batches(stream, lambda df: df, "o", "c", fmt="kafka")
    with pytest.raises(ValueError, match="streaming DataFrame"):
        tf.write_batches(source, lambda df: df, "o", "c")


@pytest.mark.parametrize("name", ["stream_tokenize_join", "stream_extract", "stream_tokenize"])
def test_a_table_may_be_a_folder_of_files(spark, name, tmp_path):
    tables = "/root/testdata/sf0.001"
    if not os.path.isdir(tables):
        pytest.skip("no test tables")
    turns = spark.read.parquet(f"{tables}/conversations.parquet")
    turns.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    os.symlink(f"{tables}/benchmark.parquet", tmp_path / "benchmark.parquet")
    found, expected = QUERIES[name](spark, str(tmp_path)), QUERIES[name](spark, tables)
    assert found.count() == turns.count()
    assert found.exceptAll(expected).count() == 0
