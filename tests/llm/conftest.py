import pytest


@pytest.fixture
def frame(spark):
    """A DataFrame from rows, in several partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make


@pytest.fixture
def stored(frame, tmp_path):
    """A table on disk, for operators that tell rows by their place in the input."""

    def make(rows, schema, parts=3):
        df = frame(rows, schema, parts)
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return make
