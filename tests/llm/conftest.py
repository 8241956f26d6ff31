from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_fixtures import documents, odd_texts  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, odd_texts()).cache()


@pytest.fixture(autouse=True)
def shared_folder(spark, tmp_path_factory):
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
