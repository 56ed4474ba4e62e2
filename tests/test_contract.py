import __spark_entry__ as E


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["icustay_id", "subject_id", "chart_time"]


def test_registry_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60 and len(o) >= 55
    for sql in o.values():
        assert sql.strip().upper().startswith(("WITH", "SELECT"))
