"""The streaming jobs end to end over folder topics, with small hand-made records."""

from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradewind.config import TOPICS, Settings
from tradewind.functions.text import register_keyword_split
from tradewind.operators.parse import parse_changes
from tradewind.plans.changes import config_table, feed_as_table
from tradewind.plans.orders import enrich_orders
from tradewind.plans.stats import keyword_stats_sql
from tradewind.sources.dims import DimTable
from tradewind.sources.topics import FolderTopics, declare_table
from tradewind.streaming import jobs
from tradewind.streaming.sinks import finish, run_available

BASE = datetime(2021, 1, 1, tzinfo=timezone.utc)


def ms(seconds: float) -> int:
    return int((BASE + timedelta(seconds=seconds)).timestamp() * 1000)


def when(seconds: float) -> str:
    return (BASE + timedelta(seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def page(mid, at, last=None, page_id="home", is_new="0", displays=(), **more):
    return {
        "common": {"mid": mid, "vc": "v1", "ch": "c1", "ar": "a1", "is_new": is_new},
        "page": {"page_id": page_id, "last_page_id": last, "during_time": 5, **more},
        "displays": list(displays),
        "ts": ms(at),
    }


class Bench:
    def __init__(self, spark, root):
        self.spark = spark
        self.topics = FolderTopics(spark, f"{root}/topics")
        self.w = jobs.Warehouse(
            spark, self.topics, str(root), Settings(business_tz="UTC"), once=True
        )
        self.sent = 0

    def send(self, topic: str, *records):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        rows = self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
        self.sent += 1
        self.topics.write(rows, TOPICS.get(topic, topic), 10_000 + self.sent)

    def got(self, topic: str) -> list:
        rows = self.topics.read(TOPICS.get(topic, topic)).collect()
        return [json.loads(r.value) for r in rows]


@pytest.fixture
def bench(spark, tmp_path):
    return Bench(spark, tmp_path)


def test_log_job_separates_and_repairs_over_batches(bench):
    bench.send(
        "raw_log",
        page("m1", 1, is_new="1", displays=[{"item": "7", "item_type": "sku_id"}]),
        page("m1", 2, is_new="1"),
        "{bad",
        "12",
        {"common": {"mid": "m2", "is_new": "1"}, "start": {"entry": "icon"}, "ts": ms(3)},
    )
    finish(jobs.separate_logs(bench.w))
    bench.send("raw_log", page("m1", 9, is_new="1"), page("m2", 9, is_new="1"),
               page("m3", 9, is_new="1"), page("m3", 9, is_new="1"))
    finish(jobs.separate_logs(bench.w))

    flags = sorted((p["common"]["mid"], p["ts"], p["common"]["is_new"])
                   for p in bench.got("page_log"))
    assert flags == [
        ("m1", ms(1), "1"), ("m1", ms(2), "0"), ("m1", ms(9), "0"), ("m2", ms(9), "0"),
        ("m3", ms(9), "0"), ("m3", ms(9), "1"),
    ]
    assert [s["common"]["mid"] for s in bench.got("start_log")] == ["m2"]
    assert bench.got("display_log") == [
        {"item": "7", "item_type": "sku_id", "page_id": "home"}
    ]
    dirty = {r.value for r in bench.topics.read("dirty").collect()}
    assert dirty == {"{bad", "12"}


def test_visit_bounce_and_visitor_stats_jobs(bench):
    bench.send(
        "page_log",
        page("m1", 1), page("m1", 3), page("m2", 2), page("m2", 4, last="home"),
        page("m1", 40),
    )
    # Closes every window above; belongs to no checked window itself.
    bench.send("page_log", page("z", 100_000))
    finish(jobs.unique_visits(bench.w))
    finish(jobs.bounces(bench.w))
    visits = sorted((v["common"]["mid"], v["ts"]) for v in bench.got("unique_visit"))
    assert [m for m, _ in visits] == ["m1", "m2", "z"]
    bounced = sorted((b["common"]["mid"], b["ts"], b["reason"]) for b in bench.got("bounce"))
    assert bounced == [
        ("m1", ms(1), "matched"), ("m1", ms(3), "timeout"), ("m1", ms(40), "timeout"),
    ]
    bench.send("bounce", page("z", 100_000))
    finish(jobs.visitor_stats(bench.w))
    rows = bench.spark.read.parquet(bench.w.table("visitor_stats")).collect()
    by_start = {r.stt: r for r in rows}
    first = by_start[when(0)]
    assert (first.pv_ct, first.sv_ct, first.uj_ct, first.dur_sum) == (4, 3, 2, 20)
    assert first.edt == when(10)
    assert by_start[when(40)].pv_ct == 1
    assert first.ts > ms(0)

    query, refined = jobs.visitor_stats_refined(bench.w)
    finish(query)
    assert {r.stt: r.pv_ct for r in refined.read().collect()}[when(0)] == 4


def test_change_routing_job(bench, tmp_path):
    def config(source, op, sink, table, columns, pk=None, ts=0):
        return {
            "database": "cfg", "table": "table_process", "type": "insert", "ts": ts,
            "after": {
                "sourceTable": source, "operateType": op, "sinkType": sink,
                "sinkTable": table, "sinkColumns": columns, "sinkPk": pk,
            },
        }

    bench.send(
        "config",
        config("order_info", "insert", "kafka", "dwd_order_info", "id,total_amount"),
        config("user_info", "insert", "hbase", "dim_user_info", "id,name,phone"),
        config("user_info", "update", "hbase", "dim_user_info", "id,name"),
        config("coupon", "insert", "clickhouse", "nowhere", "id"),
    )
    routes = lambda: config_table(parse_changes(bench.topics.read("config")))
    dims = f"{tmp_path}/dims"

    def change(table, op, ts, after, **more):
        return {"database": "shop", "table": table, "operation": op, "ts": ts,
                "after": after, **more}

    bench.send(
        "raw_changes",
        change("order_info", "create", 1, {"id": 5, "total_amount": 12.5, "secret": "x"}),
        change("order_info", "delete", 2, None, before={"id": 5}),
        change("user_info", "read", 3, {"id": 1, "name": "ann", "phone": "1"}),
        change("coupon", "insert", 4, {"id": 1}),
        {"database": "shop", "table": "user_info", "type": "insert", "ts": 5,
         "data": {"id": 2, "name": "bob", "phone": "2"}},
    )
    finish(jobs.route_changes(bench.w, routes, dims))
    # Two updates in one millisecond: the later line stands.
    bench.send("raw_changes",
               change("user_info", "update", 6, {"id": 1, "name": "eva", "phone": "9"}),
               change("user_info", "update", 6, {"id": 1, "name": "eve", "phone": "9"}))
    finish(jobs.route_changes(bench.w, routes, dims))

    assert bench.got("dwd_order_info") == [{"id": 5, "total_amount": 12.5}]
    assert [u["table"] for u in bench.got("unrouted")] == ["coupon"]
    table = DimTable(bench.spark, dims, "dim_user_info", ["id", "name", "phone"])
    users = {r.id: (r.name, r.phone) for r in table.read().collect()}
    assert users == {"1": ("eve", "1"), "2": ("bob", "2")}
    fresh = table.copy(f"{tmp_path}/dims2")
    assert {r.id: (r.name, r.phone) for r in fresh.read().collect()} == users


def _dims(spark):
    make = spark.createDataFrame
    return {
        "user": make([("1", "F", "1990-01-01")], "ID string, GENDER string, BIRTHDAY string"),
        "province": make(
            [("3", "north", "03", "N", "X-N")],
            "ID string, NAME string, AREA_CODE string, ISO_CODE string, ISO_3166_2 string",
        ),
        "sku": make(
            [("9", "phone", "99.90", "5", "6", "7")],
            "ID string, SKU_NAME string, PRICE string, CATEGORY3_ID string, "
            "SPU_ID string, TM_ID string",
        ),
        "spu": make([("6", "spu six")], "ID string, SPU_NAME string"),
        "trademark": make([("7", "tm seven")], "ID string, TM_NAME string"),
        "category3": make([("5", "cat five")], "ID string, NAME string"),
    }


def test_order_to_product_and_province_stats_jobs(bench):
    dims = _dims(bench.spark)
    order = {"id": 1, "province_id": 3, "order_status": "1001", "user_id": 1,
             "total_amount": 30.0}
    detail = {"sku_id": 9, "order_price": 10.0, "sku_num": "2", "split_total_amount": 20.0}
    bench.send("order_info", {**order, "create_time": when(0)},
               {**order, "id": 2, "user_id": 8, "province_id": 4, "create_time": when(1)})
    bench.send(
        "order_detail",
        {**detail, "id": 11, "order_id": 1, "create_time": when(5)},
        {**detail, "id": 12, "order_id": 1, "create_time": when(2)},
        {**detail, "id": 13, "order_id": 1, "create_time": when(6)},
        {**detail, "id": 14, "order_id": 2, "sku_id": 77, "create_time": when(1)},
    )
    finish(jobs.order_wide(bench.w, lambda: dims))
    wide = {r["detail_id"]: r for r in bench.got("order_wide")}
    assert sorted(wide) == [11, 12, 14]
    assert wide[11]["sku_num"] == 2 and wide[11]["tm_name"] == "tm seven"
    assert wide[11]["province_3166_2_code"] == "X-N" and wide[11]["user_gender"] == "F"
    assert wide[11]["create_date"] == "2021-01-01" and wide[11]["create_hour"] == "00"
    assert "sku_name" not in wide[14] and "user_gender" not in wide[14]

    bench.send("payment_info", {"id": 50, "order_id": 1, "user_id": 1, "total_amount": 30.0,
                                "payment_type": "1101", "create_time": when(600)},
               {"id": 51, "order_id": 2, "user_id": 8, "create_time": when(902)})
    finish(jobs.payment_wide(bench.w))
    paid = bench.got("payment_wide")
    assert sorted(p["detail_id"] for p in paid) == [11, 12]
    assert {p["order_create_time"] for p in paid} == {when(0)}

    bench.send("page_log", page("m", 3, page_id="good_detail", item="9", item_type="sku_id"),
               page("m", 4, displays=[{"item": "9", "item_type": "sku_id"},
                                      {"item": "9", "item_type": "promo"}]))
    bench.send("cart_info", {"sku_id": 9, "create_time": when(5)})
    bench.send("favor_info", {"sku_id": 9, "create_time": when(5)})
    bench.send("refund_info", {"sku_id": 9, "order_id": 1, "refund_amount": 4.5,
                               "create_time": when(7)})
    bench.send("comment_info", {"sku_id": 9, "appraise": "1201", "create_time": when(8)},
               {"sku_id": 9, "appraise": "1203", "create_time": when(8)})
    bench.send("page_log", page("z", 100_000))
    end = {"sku_id": -1, "create_time": when(100_000), "payment_create_time": when(100_000)}
    for topic in ("cart_info", "favor_info", "refund_info", "comment_info", "order_wide",
                  "payment_wide"):
        bench.send(topic, end)
    finish(jobs.product_stats(bench.w, lambda: dims))
    rows = bench.spark.read.parquet(bench.w.table("product_stats")).collect()
    r = {(x.stt, x.sku_id): x for x in rows}[(when(0), 9)]
    assert (r.click_ct, r.display_ct, r.cart_ct, r.favor_ct) == (1, 1, 1, 1)
    assert (r.order_ct, r.order_sku_num, float(r.order_amount)) == (1, 4, 40.0)
    assert (r.refund_order_ct, float(r.refund_amount)) == (1, 4.5)
    assert (r.comment_ct, r.good_comment_ct) == (2, 1)
    assert (r.sku_price, r.spu_name, r.category3_name) == ("99.90", "spu six", "cat five")
    later = {(x.stt, x.sku_id): x for x in rows}[(when(600), 9)]
    assert (later.paid_order_ct, float(later.payment_amount)) == (1, 40.0)

    bench.send("order_wide", {"province_id": -1, "order_id": 0, "total_amount": 0,
                              "create_time": when(100_000)})
    finish(jobs.province_stats(bench.w))
    found = bench.spark.read.parquet(bench.w.table("province_stats")).collect()
    by_province = {p.province_id: (p.order_count, float(p.order_amount)) for p in found}
    assert by_province == {3: (1, 60.0), 4: (1, 30.0)}


def test_keyword_job(bench):
    search = {"page_id": "good_list"}
    bench.send("page_log", page("m", 1, item="Apple 手机 256GB", **search),
               page("m", 2, item="apple 双卡双待", **search), page("m", 3, item=None, **search),
               page("m", 4, item="apple"), page("m", 100_000, item="end", **search))
    finish(jobs.keyword_stats(bench.w))
    rows = bench.spark.read.parquet(bench.w.table("keyword_stats")).collect()
    assert {(r.keyword, r.ct, r.stt) for r in rows} == {
        ("apple", 2, when(0)), ("256gb", 1, when(0)),
        *((c, 1 + (c == "双"), when(0)) for c in "手机双卡待"),
    }
    assert {r.source for r in rows} == {"SEARCH"}


def test_feed_to_topic_job(bench):
    schema = "topic string, op string, after map<string,string>"
    path = f"{bench.w.root}/feed"
    bench.spark.createDataFrame(
        [("server.shop.user_info", "CREATE", {"id": "1"}),
         ("server.shop.user_info", "DELETE", None)], schema
    ).write.parquet(path)
    source = bench.spark.readStream.schema(schema).parquet(path)
    finish(jobs.feed_to_topic(bench.w, source, "envelopes"))
    assert sorted(e["operation"] for e in bench.got("envelopes")) == ["create", "delete"]
    assert all(e["database"] == "shop" and e["table"] == "user_info"
               for e in bench.got("envelopes"))
    finish(jobs.print_feed(bench.w, source.select("op")))


def test_every_bounce_lands_in_its_window(bench):
    """Round by round, as a running job sees it: bounces trail the pages they come from."""
    moments = [5, 14, 19, 40]
    for at in moments:
        bench.send("page_log", page("m", at))
        finish(jobs.unique_visits(bench.w))
        finish(jobs.bounces(bench.w))
        finish(jobs.visitor_stats(bench.w))
    bench.send("page_log", page("z", 100_000))
    finish(jobs.bounces(bench.w))
    for topic in ("unique_visit", "bounce"):
        bench.send(topic, page("z", 100_000))
    finish(jobs.visitor_stats(bench.w))
    found = {}
    for r in bench.spark.read.parquet(bench.w.table("visitor_stats")).collect():
        assert r.stt not in found
        found[r.stt] = (r.pv_ct, r.uj_ct)
    want = {}
    for at in moments:
        pages, _ = want.get(when(at // 10 * 10), (0, 0))
        want[when(at // 10 * 10)] = (pages + 1, pages + 1)
    assert found == want


def test_seeded_feed_keeps_its_seed(bench):
    present = bench.spark.createDataFrame([(1, "a")], "id int, name string")
    jobs.seed_feed(bench.w, present, "shop", "user_info")
    path = f"{bench.w.root}/connector"
    schema = "topic string, op string, after map<string,string>"
    bench.spark.createDataFrame(
        [("server.shop.user_info", "CREATE", {"id": "2", "name": "b"})], schema
    ).write.parquet(path)
    source = bench.spark.readStream.schema(schema).parquet(path)
    finish(jobs.feed_to_topic(bench.w, source, TOPICS["raw_changes"]))
    assert len(bench.got("raw_changes")) == 2
    read = run_available(bench.topics.stream(TOPICS["raw_changes"]), "seeded")
    assert read.count() == 2


def test_product_attributes_are_those_of_the_day(bench):
    dims = _dims(bench.spark)
    topics = ("cart_info", "favor_info", "refund_info", "comment_info", "order_wide", "payment_wide")

    def upto(at):
        bench.send("page_log", page("z", at))
        for topic in topics:
            bench.send(topic, {"sku_id": -1, "create_time": when(at), "payment_create_time": when(at)})
        finish(jobs.product_stats(bench.w, lambda: dims))

    bench.send("cart_info", {"sku_id": 9, "create_time": when(5)})
    upto(1000)
    bench.send("cart_info", {"sku_id": 9, "create_time": when(2005)})
    dims = {**dims, "spu": bench.spark.createDataFrame([("6", "new spu")], "ID string, SPU_NAME string")}
    upto(3000)
    rows = bench.spark.read.parquet(bench.w.table("product_stats")).filter("sku_id = 9").collect()
    assert {r.stt: r.spu_name for r in rows} == {when(0): "spu six", when(2000): "new spu"}


def test_feed_opened_by_a_snapshot_then_changes_only(bench):
    present = bench.spark.createDataFrame([(1, "a")], "id int, name string")
    jobs.seed_feed(bench.w, present, "shop", "user_info")
    bench.send("raw_changes", {"database": "shop", "table": "user_info", "type": "update",
                               "ts": 9, "before": {"id": 1}, "after": {"id": 1, "name": "b"}})
    state, retract = feed_as_table(
        bench.topics.read(TOPICS["raw_changes"]), {"id": "int", "name": "string"}, "id"
    )
    assert [tuple(r) for r in state.collect()] == [(1, "b")]
    assert retract.filter("is_add").count() == 2
    from_now = bench.topics.stream(TOPICS["raw_changes"], "latest")
    assert run_available(from_now, "changes-only").count() == 0
    from_then = bench.topics.stream(TOPICS["raw_changes"], "2001-01-01 00:00:00")
    assert run_available(from_then, "changes-since").count() == 2


def test_dimension_read_for_some_keys(spark, tmp_path):
    table = DimTable(spark, str(tmp_path), "dim", ["id", "v"]).create()
    assert table.read().count() == 0
    rows = [({"id": str(i), "v": "x"}, i) for i in range(5)]
    changes = spark.createDataFrame(rows, "after map<string,string>, ts bigint")
    table.upsert(changes, 0, ["ts"])
    table.upsert(changes.limit(0), 1, ["ts"])
    keys = spark.createDataFrame([(3,), (9,)], "id bigint")
    assert [r.id for r in table.read(only=keys).collect()] == ["3"]
    with pytest.raises(ValueError, match="primary key"):
        DimTable(spark, str(tmp_path), "dim", ["v"])


def test_keyword_job_with_a_vocabulary_table(bench):
    words = bench.spark.createDataFrame([("手机",), ("双卡",), ("双卡双待",)], "word string")
    search = {"page_id": "good_list"}
    bench.send("page_log", page("m", 1, item="Apple 手机双卡双待吗 256GB", **search),
               page("m", 2, item="手机双卡双待吗", **search),
               page("m", 3, item="双卡手机", **search), page("m", 100_000, item="x", **search))
    finish(jobs.keyword_stats_by_vocabulary(bench.w, lambda: words))
    rows = bench.spark.read.parquet(bench.w.table("keyword_stats_by_vocabulary")).collect()
    assert {(r.keyword, r.ct) for r in rows} == {
        ("apple", 1), ("256gb", 1), ("手机", 3), ("双卡双待", 2), ("双卡", 1), ("吗", 2),
    }
    assert {r.stt for r in rows} == {when(0)}


def rerun_last_batch(w, job):
    """Forget that the last batch was finished, as a crash before the commit would."""
    commits = Path(w.checkpoint(job)) / "commits"
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    (commits / str(last)).unlink()
    (commits / f".{last}.crc").unlink(missing_ok=True)


def test_a_batch_run_again_changes_nothing(bench, tmp_path):
    bench.send("raw_log", page("m1", 1, is_new="1"), page("m1", 2, is_new="1"), "{bad")
    bench.send("raw_changes",
               {"database": "shop", "table": "u", "type": "insert", "ts": 1,
                "after": {"id": 1, "n": "a"}},
               {"database": "shop", "table": "o", "type": "insert", "ts": 2, "after": {"id": 5}})
    names = ["sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns", "sinkPk",
             "sinkExtend"]
    routes = bench.spark.createDataFrame(
        [("u", "insert", "hbase", "dim_u", "id,n", None, None),
         ("o", "insert", "kafka", "facts", "id", None, None)],
        ", ".join(f"{n} string" for n in names),
    )
    dims = f"{tmp_path}/dims"
    logs_job = lambda: finish(jobs.separate_logs(bench.w))
    routes_job = lambda: finish(jobs.route_changes(bench.w, lambda: routes, dims))
    table = DimTable(bench.spark, dims, "dim_u", ["id", "n"])

    def outcome():
        return (
            sorted((p["ts"], p["common"]["is_new"]) for p in bench.got("page_log")),
            sorted(r.value for r in bench.topics.read("dirty").collect()),
            bench.got("facts"),
            [tuple(r) for r in table.read().collect()],
        )

    logs_job()
    routes_job()
    first = outcome()
    assert first == ([(ms(1), "1"), (ms(2), "0")], ["{bad"], [{"id": 5}], [("1", "a")])
    rerun_last_batch(bench.w, "separate_logs")
    rerun_last_batch(bench.w, "route_changes")
    logs_job()
    routes_job()
    assert outcome() == first


def test_keyword_sql_over_a_declared_stream(bench):
    register_keyword_split(bench.spark, bench.w.settings.keyword_pattern)
    bench.send("page_log", page("m", 1, page_id="good_list", item="Red phone"),
               page("m", 2, page_id="good_list", item="phone"),
               page("m", 100_000, page_id="good_list", item="end"))
    declare_table(
        bench.topics.stream(TOPICS["page_log"]), "page_view_stream",
        "common map<string,string>, page map<string,string>, ts bigint",
        "timestamp_seconds(ts div 1000)", "2 seconds",
    )
    found = run_available(
        keyword_stats_sql(bench.spark, "page_view_stream", "10 seconds", "UTC"), "keyword-sql"
    )
    assert {(r.keyword, r.ct, r.stt) for r in found.collect()} == {
        ("red", 1, when(0)), ("phone", 2, when(0)),
    }


def test_stored_dimensions_enrich_orders(bench, tmp_path):
    """Dimension tables filled by the routing job serve the lookups as they are."""
    dims = dict(_dims(bench.spark))
    user = DimTable(bench.spark, str(tmp_path), "dim_user", ["id", "gender", "birthday"])
    user.create()
    feed = bench.spark.createDataFrame(
        [({"id": "1", "gender": "F", "birthday": "2000-01-01"}, 1),
         ({"id": "1", "gender": "M"}, 2)],
        "after map<string,string>, ts bigint",
    )
    user.upsert(feed, 0, ["ts"])
    dims["user"] = user.read()
    facts = bench.spark.createDataFrame(
        [(1, 3, 9, None), (2, 3, 9, None)],
        "user_id bigint, province_id bigint, sku_id bigint, sku_name string",
    )
    at = F.lit("2020-12-31 00:00:00").cast("timestamp")
    rows = enrich_orders(facts, dims, bench.w.settings, at).collect()
    got = {r.user_id: (r.user_gender, r.user_age, r.spu_name) for r in rows}
    assert got == {1: ("M", 21, "spu six"), 2: (None, None, "spu six")}
