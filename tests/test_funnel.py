"""Abandoned-cart steps on a small frame where some users never buy."""

from quarry.jobs import composite


def test_abandoned_items_counts(spark, monkeypatch):
    users = spark.createDataFrame([("1", "a@x.com"), ("2", "b@x.com"), ("3", None)], "user_id string, email string")
    sales = spark.createDataFrame([("a@x.com",)], "email string")
    events = spark.createDataFrame(
        [("1", ["i1"]), ("2", ["i1", "i2"]), ("2", ["i2"]), ("3", ["i9"])], "user_id string, ids array<string>")
    from pyspark.sql import functions as F
    events = events.select("user_id", F.transform("ids", lambda x: F.struct(x.alias("item_id"))).alias("items"))
    monkeypatch.setattr(composite.fx, "users", lambda s, d: users)
    monkeypatch.setattr(composite.fx, "sales", lambda s, d: sales)
    monkeypatch.setattr(composite.fx, "events_nested", lambda s, d: events)
    conv = {r["email"]: r["converted"] for r in composite.conversions(spark, "").collect()}
    assert conv == {"a@x.com": True, "b@x.com": False}
    out = {r["items"]: r["count"] for r in composite.job09_abandoned_items(spark, "").collect()}
    assert out == {"i1": 1, "i2": 1}
