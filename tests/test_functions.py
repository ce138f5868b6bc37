"""Golden edge cases for the column helpers and operators (hand-made rows)."""

import datetime as dt

from pyspark.sql import functions as F

from kalulu.functions.dates import months_between_completed
from kalulu.sources.normalise import one_spelling
from kalulu.functions.text import format_identifier, parent_facility, regimen_code, regimen_name
from kalulu.operators.bands import age_band, weight_band
from kalulu.operators.latest import latest_per_key, nth_latest, rows_at_extreme
from kalulu.params import period_start

D = dt.date


def test_period_start():
    assert period_start(D(2000, 6, 30), days=90) == D(2000, 4, 3)
    assert period_start(D(2000, 6, 30), months=6) == D(2000, 1, 1)
    assert period_start(D(2000, 6, 30), months=12) == D(1999, 7, 2)
    assert period_start(D(2000, 6, 15), days=90) == D(2000, 6, 15)  # other days: end itself


def test_age_bands(spark):
    df = spark.createDataFrame([(11, "F"), (12, "M"), (1079, "F"), (1080, "M"), (-3, "F"), (40, "X")],
                               "age int, g string")
    got = [r[0] for r in df.select(age_band("age", "g")).collect()]
    assert got == ["<1 year", "1-4 years", "85-89 years", "90 plus years", "<1 year", None]


def test_weight_bands(spark):
    df = spark.createDataFrame([("2.4",), ("2.5",), ("3.49",), ("3.5",), ("49.5",), (None,)], "w string")
    got = [r[0] for r in df.select(F.col("w").cast("decimal(10,2)").alias("w")).select(weight_band("w")).collect()]
    assert got == [None, "3 - 3.9 Kg", "3 - 3.9 Kg", "4 - 4.9 Kg", "50 Kg +", "Unknown"]


def test_completed_months(spark):
    df = spark.createDataFrame([(D(2000, 1, 31), D(2000, 2, 28)), (D(2000, 1, 15), D(2000, 4, 15)),
                                (D(2000, 5, 15), D(2000, 4, 20))], "a date, b date")
    got = [r[0] for r in df.select(months_between_completed(F.col("a"), F.col("b"))).collect()]
    assert got == [0, 3, 0]


def test_text_helpers(spark):
    df = spark.createDataFrame([("NNO 12", "Kasamba Outreach Clinic", "5A: TDF / 3TC / EFV", "ARV number"),
                                ("NNO 12345 2", "Chifunga HC", "Non standard", "ARV Number ")],
                               "i string, loc string, reg string, t string")
    rows = df.select(format_identifier("i"), parent_facility("loc"), regimen_code("reg"), regimen_name("reg"),
                     F.expr(one_spelling("t", ("ARV Number",)))).collect()
    assert rows[0][0] == "NNO-0012" and rows[1][0] == "NNO-12345-0002"
    assert rows[0][1] == "Midzemba HC" and rows[1][1] == "Chifunga HC"
    assert rows[0][2] == "5A" and rows[0][3] == " TDF / 3TC / EFV"
    assert rows[1][2] == "Non standard" and rows[1][3] == "Non standard"
    assert rows[0][4] == rows[1][4] == "ARV Number"


def test_latest_operators(spark):
    df = spark.createDataFrame([(1, D(2000, 1, 1), 1, "a"), (1, D(2000, 2, 1), 2, "b"), (1, D(2000, 2, 1), 3, "c"),
                                (2, D(2000, 1, 1), 4, "d")], "p int, d date, id int, v string")
    one = {r.p: r.v for r in latest_per_key(df, ["p"], ["d", "id"]).collect()}
    assert one == {1: "c", 2: "d"}  # higher id wins the tie
    ties = sorted(r.v for r in rows_at_extreme(df, ["p"], "d").collect())
    assert ties == ["b", "c", "d"]  # ties at the max date are all kept
    second = {r.p: r.v for r in nth_latest(df, ["p"], ["d", "id"], 1).collect()}
    assert second == {1: "b"}
    third = {r.p: r.v for r in nth_latest(df, ["p"], ["d", "id"], 2).collect()}
    assert third == {1: "a"}


def test_nth_latest_duplicates_and_nulls(spark):
    # OFFSET counts identical rows separately; undated rows rank last
    df = spark.createDataFrame([(1, D(2000, 1, 1), "x"), (1, D(2000, 1, 1), "x"), (1, None, "y"),
                                (2, None, "z"), (2, D(1999, 1, 1), "w")], "p int, d date, v string")
    second = {r.p: r.v for r in nth_latest(df, ["p"], ["d"], 1).collect()}
    assert second == {1: "x", 2: "z"}
    third = {r.p: r.v for r in nth_latest(df, ["p"], ["d"], 2).collect()}
    assert third == {1: "y"}


def test_period_start_column_matches_python(spark):
    from kalulu.params import period_start_col

    ends = [D(2000, 6, 28), D(2000, 2, 29), D(2000, 6, 30), D(2000, 8, 31), D(2000, 6, 15), D(2001, 3, 31)]
    df = spark.createDataFrame([(e,) for e in ends], "e date")
    for kw in ({"days": 90}, {"months": 6}, {"months": 12}, {"months": 13}):
        got = [r[0] for r in df.select(period_start_col(F.col("e"), **kw)).collect()]
        assert got == [period_start(e, **kw) for e in ends], kw


def test_joined_texts_are_bounded(spark):
    import random

    from kalulu.operators.concat import joined_texts

    rng = random.Random(3)
    words = ["", "a", "b'", "NNO 1", "x" * 7, "y" * 30]
    rows = [(k, rng.choice(words)) for k in range(6) for _ in range(k * 6)] + [(9, None), (7, ""), (8, ""), (8, ""), (None, "n")]
    rows += [(10, f"{n:05d}") for n in range(3000)] + [(11, "same")] * 5000 + [(12, "z" * 5000)]
    df = spark.createDataFrame(rows, "k int, v string")
    own = {}
    for k, v in rows:
        if v is not None:
            own.setdefault(k, []).append(v)
    for limit, sep in ((1024, ","), (20, ","), (7, "; "), (1, ",")):
        out = joined_texts(df, ["k"], "v", "t", sep, limit)
        assert {r.k: r.t for r in out.collect()} == {k: sep.join(sorted(v))[:limit] for k, v in own.items()}, limit
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "partial_count" in plan
    assert joined_texts(df.where("false"), ["k"], "v", "t").collect() == []


def test_a_cluster_without_a_shared_checkpoint_folder_is_an_error(monkeypatch):
    import types

    import pytest

    from kalulu import session

    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    def fake(master, **more):
        conf = Conf({"spark.master": master, **more})
        context = types.SimpleNamespace(getConf=lambda: conf, setCheckpointDir=lambda d: None)
        return types.SimpleNamespace(conf=conf, sparkContext=context)

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://host"):
        with pytest.raises(ValueError):
            session.ensure_checkpoint_dir(fake(master))
        assert session.ensure_checkpoint_dir(fake(master, **{"spark.checkpoint.dir": "hdfs://x/c"})) == "hdfs://x/c"
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda **kw: "/tmp/of-its-own")
    assert session.ensure_checkpoint_dir(fake("local[4]")) == session.ensure_checkpoint_dir(fake("local")) == "/tmp/of-its-own"
