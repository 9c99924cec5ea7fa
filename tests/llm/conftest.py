import pytest


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables for a query: {name: (rows, schema)} -> folder."""
    def write(**named):
        for name, (rows, schema) in named.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
