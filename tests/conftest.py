import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from sftprep.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[8]", "tests", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def edge_rows(spark):
    """Instruction rows at the edges of the layouts."""
    rows = [
        (1, "Say hi", None, "Hi"),
        (2, "Say hi", "", "Hi"),
        (3, "Say hi", "  ", "Hi"),
        (4, "Sum it", "1 2", "3"),
        (5, "Say hi", None, None),
        (6, 'Echo {response} %s \\ "q"', "{input}", "$1 {x}"),
        (7, "肺がんの特徴を２つ教えてください。", None, "はい　そうでござる。"),
        (8, "emoji 😀", None, ""),
        (9, "a " * 600, None, "b"),
    ]
    return spark.createDataFrame(rows, "rec_id long, instruction string, input string, output string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="session")
def vocab(documents):
    from sftprep.operators.tokens import build_vocab

    return build_vocab(documents, 500)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
