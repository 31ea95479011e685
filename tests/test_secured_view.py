"""Views that ask who reads them, and the membership table, when they are read."""

import uuid

from pyspark.sql import functions as F

from quarry.operators import protect as P


def names(spark):
    return [f"t_{k}_{uuid.uuid4().hex[:8]}" for k in ("base", "members", "view")]


def test_a_change_of_members_changes_the_next_read(spark):
    base, members, view = names(spark)
    rows = [(1, "123456", "ann"), (2, "7", None), (40, None, "eve"), (None, "99", "x")]
    spark.createDataFrame(rows, "id int, mrn string, name string").write.saveAsTable(base)
    me = spark.sql("SELECT current_user()").first()[0]
    P.members_table(spark, [("someone", "it's us"), (me, "other")], members)
    P.secured_view(spark, view, base, members, "it's us", redact_cols=["name"], mask_cols=["mrn"], predicate="id < 30", temporary=False)
    read = lambda: sorted((tuple(r) for r in spark.table(view).collect()), key=repr)
    assert read() == sorted(rows, key=repr)
    P.members_frame(spark, [(me, "it's us")]).write.insertInto(members)
    assert read() == sorted([(1, "****56", "REDACTED"), (2, "7", "REDACTED")], key=repr)
    kept = spark.createDataFrame([("someone", "it's us")], "user string, group string")
    kept.write.insertInto(members, overwrite=True)
    assert read() == sorted(rows, key=repr)
    for kind, name in (("VIEW", view), ("TABLE", base), ("TABLE", members)):
        spark.sql(f"DROP {kind} {name}")


def test_membership_is_one_subquery_and_no_join(spark):
    base, members, view = names(spark)
    spark.range(50).select(F.col("id"), F.col("id").cast("string").alias("mrn")).createOrReplaceTempView(base)
    P.members_table(spark, [], members)
    P.secured_view(spark, view, base, members, "g", mask_cols=["mrn"], predicate="id < 30")
    plan = spark.table(view)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "ubquery" in plan
    assert spark.table(view).count() == 50
    spark.sql(f"DROP TABLE {members}")
