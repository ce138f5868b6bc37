"""Operator 7 against its SQL and its rates."""

import duckdb
import pytest
from pyspark.sql import functions as F

from kalulu.llm.mixing import mix, mix_sql, repetition_rates

COLS = "doc_id bigint, text string, source string, copy string"


def table(n):
    rows = [(i, f"t{i}", "hot" if i % 3 == 0 else f"s{i % 7}" if i % 11 else None, "x") for i in range(n)]
    return rows + [(n, None, "rare", "x"), (n + 1, "", "rare", "x"), (5, "t5", "s5", "x"), (5, "t5", "s5", "x"), (None, "a", "s1", "x")]


def test_against_sql(spark):
    rows = table(3000)
    got = [tuple(r) for r in mix(spark.createDataFrame(rows, COLS)).collect()]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [r[:3] for r in rows])
    want = con.execute(mix_sql(columns="d.doc_id, d.text, d.source")).fetchall()
    assert sorted(got, key=str) == sorted(want, key=str)


def test_rates_and_shuffle(spark):
    df = spark.createDataFrame(table(6000), COLS)
    weights = {"hot": 1, "s1": 3, "rare": 1}
    rates = {r.source: (r.n_docs, r.rate) for r in repetition_rates(df, weights).collect()}
    n = sum(x for x, _ in rates.values())
    assert rates["s2"][1] == 0 and rates[None][1] == 0
    assert rates["hot"][1] == pytest.approx(n / 5 / rates["hot"][0])
    out = mix(df, weights).collect()
    share = {s: sum(r.source == s for r in out) / n for s in ("hot", "s1", "rare")}
    assert share["hot"] == pytest.approx(0.2, rel=.1) and share["s1"] == pytest.approx(0.6, rel=.1)
    assert share["rare"] == pytest.approx(0.2, rel=.15)       # two documents, some 600 copies each: several draws
    assert len({(r.doc_id, r.copy) for r in out if r.doc_id == 6000}) == sum(r.doc_id == 6000 for r in out)
    ids = [r.doc_id for r in out if r.doc_id is not None]
    assert sum(a < b for a, b in zip(ids, ids[1:])) < 0.7 * len(ids)
    assert mix(df.where("false")).collect() == [] and mix(df, {}).collect() == []


def test_rows_of_one_id_are_spread(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df = spark.createDataFrame([(None, f"text {i}", "a") for i in range(400)], "doc_id bigint, text string, source string")
        out = mix(df, size=4.0)
        rows = out.select("shuffle_key", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set(key, old)
    assert out.columns == [*df.columns, "copy", "shuffle_key"] and len(rows) >= 400
    one = rows[0].shuffle_key
    assert len({r.p for r in rows if r.shuffle_key == one}) > 1
