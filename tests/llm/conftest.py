import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Folders of small tables: edge cases, and none at all."""
    import cases

    some = cases.write_tables(spark, tmp_path_factory.mktemp("some"))
    none = cases.write_tables(spark, tmp_path_factory.mktemp("none"), cases.empty(spark), spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([], "page_id long, url string, html string"))
    return some, none
