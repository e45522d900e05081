from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from corpus import stored  # noqa: E402


@pytest.fixture(scope="session")
def corpus(spark, tmp_path_factory):
    return stored(spark, tmp_path_factory.mktemp("corpus"))


@pytest.fixture(scope="session")
def no_rows(spark, tmp_path_factory):
    return stored(spark, tmp_path_factory.mktemp("none"), rows=[], files=1)


@pytest.fixture(scope="session")
def tokenizer_path():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return str(public_tokenizers.path("byte_bpe_50k.json"))
