"""Registered queries against their SQL over the whole tables."""

import zlib

import pytest

from bourse.llm.oracle import ORACLE, _crc32
from bourse.llm.queries import QUERIES
from tests.conftest import SF001
from tools.check_oracle import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF001).toPandas(), duck(SF001).sql(ORACLE[name]).df()) == "OK"


def test_crc32_in_sql():
    for s in ("0", "7", "20", "19999", "-3", "123456789012"):
        assert duck(SF001).sql(f"SELECT {_crc32(repr(s))}").fetchall() == [(zlib.crc32(s.encode()),)]
