"""The corpus queries are registered, one for each operator, and the pipeline."""

import re

import __spark_entry__ as spark_entry


def test_one_query_for_each_operator():
    names = spark_entry.queries()
    numbers = sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n)))
    assert numbers == list(range(1, 14)) and "pipeline" in names


def test_sql_is_claimed_for_these():
    corpus = {n for n in spark_entry.oracle_sql() if re.match(r"op\d+_", n) or n == "pipeline"}
    assert corpus == {"op7_setsketch_near_dedup", "op12_redirect_equivalence", "op13_galloping_filter_audit"}
