import pytest


@pytest.fixture(scope="session")
def docs(spark, root):
    return spark.read.parquet(f"{root}/documents.parquet")


@pytest.fixture(scope="session")
def pdocs(docs):
    return docs.toPandas()
