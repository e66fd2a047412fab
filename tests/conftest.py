import pytest

from tidemark.session import session


@pytest.fixture(scope="session")
def spark():
    made = session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g",
                                "spark.ui.showConsoleProgress": "false"}
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
