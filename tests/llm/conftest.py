from __future__ import annotations

import pytest

from airlake.llm import suffix_tree


@pytest.fixture(scope="session", autouse=True)
def few_buckets():
    """Small tables need no 64 tasks per step; the number of buckets changes no result."""
    suffix_tree.LEAST_BUCKETS = 6
