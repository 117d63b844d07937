"""The driver contract: entry() on the smallest fixture, queries() and oracle_sql()."""

import __spark_entry__ as E

LLM = E.LLM_QUERIES


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "rank", "item_id", "cf", "genre_score", "pop", "final", "pct", "genre_only"]
    assert df.count() > 100


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(set(q) - set(LLM)) == 62 and len(set(o) - set(LLM)) == 57
    assert all(callable(f) for f in q.values())
