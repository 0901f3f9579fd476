"""What the checks' own inputs cost: nothing is written or shuffled that a query does not need."""

from pathlib import Path

from checks import ingest, mapping
from checks.feed_source import LANDED, PROVIDER, SOURCE
from checks.lake import Lake
from galley.sources.feed_pages import flatten, land_pages, pages_glob, read_pages

SF_DIR = "/root/testdata/sf0.001"



def test_a_drop_has_only_the_sources_asked_for_in_compressed_parts(spark, tmp_path, monkeypatch):
    own = Lake(spark, SF_DIR)
    own.store.root = f"file://{tmp_path}/lake"
    monkeypatch.setattr(ingest, "lake", lambda *_: own)
    path = ingest._path(spark, SF_DIR, "order_items")
    drop = tmp_path / "lake" / "drop"
    assert [p.name for p in drop.iterdir()] == ["order_items.json"] and not (tmp_path / "lake" / "typed").exists()
    assert {p.suffix for p in Path(path.removeprefix("file://")).glob("part-*")} == {".gz"}
    assert spark.read.json(path).count() == mapping.table(spark, SF_DIR, "lineitem").count()
    ingest.drop_folder(spark, SF_DIR)
    assert sorted(p.name for p in drop.iterdir()) == sorted(f"{e}.json" for e in ingest.ENTITIES)


def test_landed_pages_are_compressed_and_files_bounded(spark, tmp_path):
    pages = mapping.feed_pages(spark, SF_DIR)
    root = land_pages(pages, f"file://{tmp_path}/pages", PROVIDER, SOURCE, LANDED, pages_per_file=3)
    files = list(tmp_path.glob("pages/*/*/*/*/part-*"))
    assert len(files) >= 4 and {f.suffix for f in files} == {".gz"}
    found = flatten(read_pages(spark, pages_glob(root, PROVIDER)))
    assert found.count() == mapping.table(spark, SF_DIR, "events").count()
    assert found.select("order_id").distinct().count() == found.count()


def test_lines_and_events_are_shuffled_once(spark):
    def shuffles(df):
        return str(df._jdf.queryExecution().executedPlan()).count("hashpartitioning(")

    orders = mapping.orders(spark, SF_DIR)
    plan = str(orders._jdf.queryExecution().executedPlan())
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(order_id" not in plan
    assert shuffles(mapping.feed_pages(spark, SF_DIR)) == shuffles(mapping.feed_pages(spark, SF_DIR, 6)) == 1


def test_a_store_of_one_view_has_only_what_the_view_is_made_from(spark):
    from checks.refreshed import refreshed

    store = refreshed(spark, SF_DIR, "vw_delivery_performance")
    assert store.exists("marts", "delivery_sums") and store.exists("marts", "fact_deliveries")
    for table in ("fact_orders", "fact_order_items", "order_sales", "sales_sums", "product_sums", "customer_sums"):
        assert not store.exists("marts", table)


def test_without_hot_orders_lines_are_shuffled_once(spark, monkeypatch):
    from galley.operators import joins
    from galley.plans import staging

    own = Lake(spark, SF_DIR)
    lines, orders = own.source("order_items"), own.staged("int_orders")
    small = staging.int_order_items(lines, orders, "b").collect()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    plain = staging.int_order_items(lines, orders, "b")
    plan = str(plain._jdf.queryExecution().executedPlan())
    assert plan.count("hashpartitioning(") == 2 and "_salt" not in plan  # lines, orders
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    monkeypatch.setattr(joins, "HOT_ROWS", 1)
    monkeypatch.setattr(joins, "may_have_hot_keys", lambda *_: True)
    salted = staging.int_order_items(lines, orders, "b")
    assert "_salt" in str(salted._jdf.queryExecution().executedPlan())
    assert sorted(map(str, small)) == sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))


def test_hot_keys_are_ruled_out_by_shares(spark):
    from galley.operators.joins import may_have_hot_keys

    rows = spark.range(1000).selectExpr("id AS k", "IF(id < 30, NULL, id) AS n")
    assert not may_have_hot_keys(rows, ["k"], 20) and may_have_hot_keys(rows, ["n"], 20)


def test_lines_are_counted_where_they_lie(spark, monkeypatch):
    """Hot orders are looked for before the lines are shuffled by order."""
    from galley.operators import joins
    from galley.plans import staging

    own, asked = Lake(spark, SF_DIR), []
    lines, orders = own.source("order_items"), own.staged("int_orders", again=False)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "may_have_hot_keys", lambda rows, *_: asked.append(rows))
    staging.int_order_items(lines, orders, "b")
    assert len(asked) == 1 and "Repartition" not in asked[0]._jdf.queryExecution().optimizedPlan().toString()
