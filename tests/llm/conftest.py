import pytest


@pytest.fixture(scope="session")
def model():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("piece_bpe_32k.model")
