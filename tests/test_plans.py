"""Plan-shape checks: the as-of operators combine before the shuffle, and
filters reach the Parquet scan."""

import datetime as dt

from pyspark.sql import functions as F

from kalulu.operators.latest import latest_per_key, nth_latest, rows_at_extreme


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed(spark):
    # one key holds most rows
    return spark.range(0, 5000).select(
        F.when(F.col("id") < 4000, F.lit(1)).otherwise(F.col("id") % 7).alias("k"),
        F.col("id").alias("o"), (F.col("id") * 3).alias("v"))


def test_as_of_operators_combine_before_the_shuffle(spark):
    df = _skewed(spark)
    for out in (latest_per_key(df, ["k"], ["o"]), rows_at_extreme(df, ["k"], "o")):
        plan = _plan(out)
        assert "Window" not in plan
        assert "partial_max" in plan or "partial_min" in plan
    # the ranked rows are limited per key in each task before the exchange, at any offset with one scan
    for n in (0, 1, 2):
        plan = _plan(nth_latest(df, ["k"], ["o"], n))
        assert plan.count("Range (") == 1 and plan.count("Exchange") == 1
        before = plan[plan.index("Exchange"):]
        assert "WindowGroupLimit" in before and "Partial" in before
    keys = {}
    for i in range(5000):
        keys.setdefault(1 if i < 4000 else i % 7, []).append(i)
    want = {k: sorted(v, reverse=True)[2] for k, v in keys.items() if len(v) > 2}
    assert {r.k: r.o for r in nth_latest(df, ["k"], ["o"], 2).collect()} == want


def test_report_on_stored_tables_pushes_filters(spark, tmp_path):
    import __spark_entry__ as E
    from kalulu.params import ReportParams
    from kalulu.plans.cohort import cohort_rows
    from kalulu.plans.refresh import copy_sources, refresh_warehouse
    from kalulu.sources.fixtures import Warehouse
    from kalulu.sources.warehouse import StoredWarehouse

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    source = Warehouse(spark, E.SF_SMOKE)
    refresh_warehouse(source, str(tmp_path), ["mw_patient", "mw_art_followup", "mw_art_initial"], keep_rejects=False)
    copy_sources(source, str(tmp_path))
    df = cohort_rows(StoredWarehouse(spark, str(tmp_path)), ReportParams(dt.date(2000, 4, 1), dt.date(2000, 6, 30)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    followup = [x for x in scans if "/mw_art_followup" in x]
    assert len(followup) == 2                       # the aggregate and the rows of its dates
    for scan in followup + [x for x in scans if "/mw_art_initial" in x]:
        assert "LessThanOrEqual(visit_date,2000-06-30)" in scan
    assert any("EqualTo(program,HIV program)" in x for x in scans if "/omrs_program_state" in x)
    assert any("EqualTo(type,ARV Number)" in x for x in scans if "/omrs_patient_identifier" in x)
    assert df.count() > 0
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_building_a_query_runs_no_job(spark):
    import __spark_entry__ as E

    tracker = spark.sparkContext.statusTracker()
    # schema inference of the input's footer is the reader's own; a group set here catches any job of the plans
    spark.sparkContext.setJobGroup("building", "plans only")
    before = set(tracker.getJobIdsForGroup("building"))
    frames = [E._QUERIES[n](spark, E.SF_SMOKE) for n in ("moh_tx_mmd", "pepfar_tb_prev", "moh_survival_general", "pipeline_moh_tx_mmd")]
    jobs = set(tracker.getJobIdsForGroup("building")) - before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
    assert all(tracker.getStageInfo(s).numTasks <= 1 for s in stages if tracker.getStageInfo(s)) and len(frames) == 4


def test_changed_data_is_seen(spark, tmp_path):
    import shutil

    from kalulu.sources.fixtures import Warehouse
    from kalulu.sources.normalise import NormalisedWarehouse
    from kalulu.plans.cohort import last_outcome_at_facility

    for t in ("customer", "orders"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    count = lambda: last_outcome_at_facility(
        NormalisedWarehouse(Warehouse(spark, str(tmp_path))), dt.date(2000, 6, 30)).count()
    first = count()
    half = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").toPandas()
    half = half.head(len(half) // 2)
    (tmp_path / "orders.parquet").chmod(0o644)
    half.to_parquet(tmp_path / "orders.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    spark.catalog.refreshByPath(str(tmp_path))
    assert 0 < count() < first


def test_eav_loader_pre_aggregates_observations_per_encounter(spark):
    from kalulu.plans.loaders.art import load_art_initial
    from kalulu.sources.fixtures import Warehouse

    df = load_art_initial(Warehouse(spark, "/root/testdata/sf0.001"))
    plan = _plan(df)
    lines = plan.splitlines()
    # the observation rows are combined per encounter before their first shuffle
    partial = [i for i, line in enumerate(lines) if "key=[encounter_id" in line and "partial_min" in line]
    exch = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(encounter_id" in line]
    assert partial and exch and min(exch) < max(partial)


def test_no_query_plan_has_cross_products_unlimited_windows_or_python(spark):
    import __spark_entry__ as E

    flagged = {}
    for name, fn in E._QUERIES.items():
        plan = _plan(fn(spark, E.SF_SMOKE))
        hits = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython") if w in plan]
        if "Window" in plan and "WindowGroupLimit" not in plan:
            hits.append("Window")
        if hits:
            flagged[name] = hits
    assert flagged == {}


def test_plans_are_built_with_few_calls_to_the_jvm(spark, monkeypatch):
    """Expressions over fixed lists are one text each: the calls do not grow with the lists."""
    from py4j import clientserver

    import __spark_entry__ as E

    calls = []
    send = clientserver.JavaClient.send_command

    def counted(self, command, *args, **kwargs):
        if not command.startswith("m\nd"):            # the release of objects no longer used
            calls.append(command)
        return send(self, command, *args, **kwargs)
    E._QUERIES["moh_tx_mmd"](spark, E.SF_SMOKE)
    monkeypatch.setattr(clientserver.JavaClient, "send_command", counted)
    most = {"pepfar_tx_mmd": 3_000, "moh_regimen_by_weight": 2_500, "load_art_initial": 1_000, "fn_parent_health_facility": 300}
    for name, limit in most.items():
        calls.clear()
        E._QUERIES[name](spark, E.SF_SMOKE)
        assert len(calls) <= limit, (name, len(calls))


def _scans(plan, of=""):
    return sum("FileScan" in x and of in x for x in plan.splitlines())


def test_a_report_builds_its_cohort_once(spark, tmp_path):
    """Detail and group rows are counted in one pass: no report reads the stored tables twice for them."""
    import __spark_entry__ as E
    from kalulu.plans.refresh import copy_sources, refresh_warehouse
    from kalulu.plans.reports.cohort_disaggregated import cohort_disaggregated
    from kalulu.plans.reports.mmd import tx_mmd
    from kalulu.plans.reports.screening import tx_hiv_htn, tx_tb
    from kalulu.plans.reports.tpt import tpt_initiation
    from kalulu.plans.reports.tx_ml import tx_ml
    from kalulu.sources.fixtures import Warehouse
    from kalulu.sources.warehouse import StoredWarehouse

    source = Warehouse(spark, E.SF_SMOKE)
    refresh_warehouse(source, str(tmp_path), ["mw_patient", "mw_art_followup", "mw_art_initial"], keep_rejects=False)
    copy_sources(source, str(tmp_path))
    wh = StoredWarehouse(spark, str(tmp_path))
    start, end = dt.date(2000, 4, 1), dt.date(2000, 6, 30)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    reports = {
        # report: scans of the follow-ups (a cohort has two: the dates, the rows of those dates), of the patients, of the states
        "cohort": (cohort_disaggregated(wh, start, end), 2), "mmd": (tx_mmd(wh, end), 4), "tpt": (tpt_initiation(wh, start, end), 2),
        "tb": (tx_tb(wh, end), 2), "htn": (tx_hiv_htn(wh, end), 2), "ml": (tx_ml(wh, start, end), 2)}
    for name, (report, followups) in reports.items():
        plan = _plan(report)
        assert (_scans(plan, "/mw_art_followup"), _scans(plan, "/mw_patient"), _scans(plan, "/omrs_program_state")) == (followups, 1, 1), name
        assert _scans(plan) <= 15, (name, _scans(plan))
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_range_existence_is_a_search_per_row_not_a_join_with_every_date(spark):
    import random

    from kalulu.operators.ranges import any_date_between, dates_up_to, sorted_dates

    rng = random.Random(5)
    day = lambda: dt.date(2000, 1, 1) + dt.timedelta(rng.randrange(60))
    dates = [(k, day()) for k in range(8) for _ in range(k * k)] + [(9, None), (3, dt.date(2000, 1, 5)), (3, dt.date(2000, 1, 5))]
    probes = [(k, a, a + dt.timedelta(rng.randrange(0, 9))) for k in range(11) for a in [day() for _ in range(12)]] + [(4, None, day()), (4, day(), None)]
    lists = sorted_dates(spark.createDataFrame(dates, "k int, d date"), "k", "d", "ds")
    out = spark.createDataFrame(probes, "k int, low date, high date").join(lists, "k", "left").select(
        "k", "low", "high", any_date_between("ds", "low", "high").alias("hit"), F.expr(dates_up_to("ds", "high")).alias("n"))
    plan = _plan(out)
    assert "BroadcastNestedLoop" not in plan and plan.count("Join") == 1
    own = {}
    for k, d in dates:
        own.setdefault(k, set()).update([d] if d else [])
    rows = out.collect()
    assert len(rows) == len(probes)
    for r in rows:
        if r.k not in own or r.low is None or r.high is None:
            assert r.hit is None
        else:
            assert r.hit == any(r.low <= d <= r.high for d in own[r.k])
            assert r.n == sum(d <= r.high for d in own[r.k])
