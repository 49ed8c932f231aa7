import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from codeloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, "codeloom-tests", "4g", spark__checkpoint__dir=shared)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mapping(spark):
    """Ten coded products, two of them alike but for the case of a flag."""
    schema = (
        "product_id long, c1 int, c2 int, c3 int, dedup int, league string, team string, brand string, "
        "color string, product_name string, price_band string, is_hot_market string, "
        "launch_age_bucket string, code_id string"
    )
    members = {
        (1, 4, 2): [0, 1], (1, 4, 7): [2], (1, 6, 3): [3], (11, 4, 2): [4], (8, 0, 5): [5, 6], (6, 2, 2): [7, 8, 9], (0, 0, 9): [999],
    }
    rows = []
    for codes, ids in members.items():
        for slot, number in enumerate(ids):
            brand, flag = ("Alpha" if number < 2 else "Beta"), {0: "true", 1: "True"}.get(number, "false")
            named = ("inland", "harbour", brand, "teal", f"product {number}", "tier 2", flag, "31-90d")
            rows.append((number, *codes, slot, *named, "-".join(map(str, (*codes, slot)))))
    return spark.createDataFrame(rows, schema)
