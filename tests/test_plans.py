import re

import __spark_entry__ as E
from pluvio.plans.catalog import QUERIES

SF1 = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contract_keys(spark):
    qs, sql = E.queries(), E.oracle_sql()
    assert len(qs) >= 60
    assert set(sql) <= set(qs)
    df = E.entry(spark)
    assert df.count() > 0 and "date" in df.columns


def test_every_query_matches_oracle_on_smallest_tables(spark):
    import duckdb

    from tools.oracle_check import TABLES, canon
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF1}/{t}.parquet')")
    sql = E.oracle_sql()
    bad = {}
    for k, f in ((k, f) for k, f in E.queries().items() if k in sql):
        df = f(spark, SF1)
        if k in QUERIES:  # every plan: no window without a key, no cross join
            p = _plan(df)
            assert not re.search(r"Window \[.*\], \[\], \[", p), k
            assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k
        got = canon(df.columns, [tuple(r) for r in df.collect()])
        res = con.execute(sql[k])
        want = canon([c[0] for c in res.description], res.fetchall())
        if got != want:
            bad[k] = ([r for r in got[1] if r not in want[1]][:2], [r for r in want[1] if r not in got[1]][:2])
    assert not bad, bad


def test_no_unpartitioned_window_and_no_cartesian(spark):
    for k in ("subhourly", "hydro_daily", "frequency_table", "gap_flag", "counter_diff", "geo_consistency"):
        p = _plan(E.queries()[k](spark, SF1))
        windows = [ln for ln in p.splitlines() if re.search(r"\bWindow \[", ln)]
        assert windows or k == "geo_consistency" or k == "hydro_daily", k
        for ln in windows:   # Window [functions], [partition spec], [order spec]
            assert not re.search(r"\], \[\], \[", ln), (k, ln)
        assert "CartesianProduct" not in p, k
        assert "BroadcastNestedLoopJoin" not in p, k


def test_scan_prunes_and_pushes(spark):
    p = _plan(E.queries()["cutoff_by_other"](spark, SF1))
    assert "PushedFilters: [IsNotNull(l_shipdate)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in p


def test_series_windows_partitioned_by_device_and_day(spark):
    p = _plan(E.queries()["counter_diff"](spark, SF1))
    lag_windows = [ln for ln in p.splitlines() if re.search(r"\bWindow \[lag", ln)]
    assert lag_windows
    # the per-reading lag runs in (device, day) partitions; the only device-level
    # window runs on the per-(device, day) summary
    assert any("_lag_day" in ln.split("], [")[1] for ln in lag_windows)


def test_stored_slots_reach_the_rolling_sum_without_an_exchange(spark):
    from pyspark.sql import functions as F

    from pluvio.plans import fixtures as fx
    from pluvio.plans import pipelines as pl
    inp = fx.inputs(spark, SF1, with_stations=False, with_incidents=False, with_satellite=False)
    r = pl.rolled(pl.gridded(inp), inp.rules, inp.last_day())
    slots = re.compile(r"Exchange (?!SinglePartition)")
    for p in (_plan(r), _plan(r.filter(F.col("date") == F.lit("2024-01-08").cast("date")))):
        assert p.count("Bucketed: true") >= 2 and p.count("Window [") >= 3
        # what is exchanged are summaries: a row a device or a day
        for at in slots.finditer(p):
            below = p[at.start():].split("FileScan")[0]
            assert "max_by" in below or "explode(" in below or "HashAggregate(keys=[device" in below, below[:600]
        assert "Union" not in p
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(date,2024-01-08\)", p)


def test_spatial_join_is_an_equi_join_on_cells(spark):
    p = _plan(E.queries()["geo_join"](spark, SF1))
    assert re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[[^\n]*_pc#\d+\)*, _prow#\d+L?, _pcol", p), p[:2000]
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_given_schemas_are_those_of_the_files(spark):
    from pluvio.plans import fixtures as fx
    for name, schema in fx.SCHEMAS.items():
        found = spark.read.parquet(f"{SF1}/{name}.parquet")
        assert found.dtypes == spark.read.schema(schema).parquet(f"{SF1}/{name}.parquet").dtypes, name


def test_flagship_is_built_in_few_jobs(spark):
    sc = spark.sparkContext
    sc.setJobGroup("build-flagship", "")
    try:
        E.queries()["hydro_daily"](spark, SF1)
        jobs = sc.statusTracker().getJobIdsForGroup("build-flagship")
    finally:
        sc._jsc.clearJobGroup()
    assert 0 < len(jobs) < 8
