import pytest

from objsync.llm.common import bounded_batches
from objsync.session import tune

# Names that operators use for results or in between, as extra columns of their inputs.
CLASHES = ("row", "node", "score", "shard", "slot", "spans", "base", "words", "n_words", "tokens", "rank", "key", "bucket", "label",
           "lang_pred", "host", "rule", "verdict", "length", "start", "offset", "digest", "payload", "predicted", "__rank", "sig")


@pytest.fixture(scope="session")
def llm(spark):
    return bounded_batches(tune(spark))


@pytest.fixture
def make(llm):
    """A table from rows and a schema, on request with extra columns of clashing names."""
    def build(rows, schema, clash=False):
        df = llm.createDataFrame(rows, schema)
        extra = [c for c in CLASHES if c not in df.columns] if clash else []
        return df.selectExpr("*", *[f"'extra' AS `{c}`" for c in extra])

    return build
