import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """The folder that a cluster would name in spark.checkpoint.dir."""
    context = spark.sparkContext
    if context.getConf().get("spark.checkpoint.dir") is None and context.getCheckpointDir() is None:
        context.setCheckpointDir(f"file://{tmp_path_factory.mktemp('shared')}")
