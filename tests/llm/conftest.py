import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from cohortry.llm.common import prepared


@pytest.fixture
def work(spark):
    return prepared(spark)
