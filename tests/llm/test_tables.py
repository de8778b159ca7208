from affinis.llm.tables import may_hold


def test_filter_keeps_all_partners(spark):
    ids = spark.range(0, 3000, 7).toDF("id").unionByName(spark.createDataFrame([(None,)], "id bigint"))
    rows = spark.range(20_000).toDF("id").unionByName(spark.createDataFrame([(None,)], "id bigint"))
    kept = [r.id for r in rows.filter(may_hold(ids, "id")).collect()]
    assert set(range(0, 3000, 7)) <= set(kept) and len(kept) < 1000
    assert rows.filter(may_hold(ids.limit(0), "id")).count() == 0
    assert rows.filter(~may_hold(ids, "id")).count() == rows.count() - len(kept)
