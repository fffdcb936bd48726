"""Silent sources, heartbeats, and the table of late rows."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

import pytest
from test_jobs import Bench, ms, page, when

from tradewind.streaming import jobs
from tradewind.streaming.heartbeats import LateRows
from tradewind.streaming.sinks import finish

NO_DIMS = {
    "sku": "ID string, SKU_NAME string, PRICE string, SPU_ID string, TM_ID string, CATEGORY3_ID string",
    "spu": "ID string, SPU_NAME string",
    "trademark": "ID string, TM_NAME string",
    "category3": "ID string, NAME string",
}


@pytest.fixture
def bench(spark, tmp_path):
    return Bench(spark, tmp_path)


def product_rows(bench):
    dims = {k: bench.spark.createDataFrame([], v) for k, v in NO_DIMS.items()}
    finish(jobs.product_stats(bench.w, lambda: dims))
    rows = bench.spark.read.parquet(bench.w.table("product_stats")).collect()
    return sorted((r.stt, r.sku_id, r.click_ct, r.cart_ct) for r in rows)


def detail(mid, at, sku):
    return page(mid, at, page_id="good_detail", item=str(sku), item_type="sku_id")


def test_a_source_without_records_holds_windows_until_heartbeats_pass_it(bench):
    bench.send("page_log", detail("m", 1, 9), detail("m", 2, 9), detail("m", 300, 9))
    bench.send("cart_info", {"sku_id": 9, "create_time": when(3)}, {"sku_id": 8, "create_time": when(150)})
    bench.w.heartbeats = True
    assert product_rows(bench) == []  # no heartbeat has come yet
    sources = jobs.product_sources(bench.w)
    finish(jobs.heartbeats(bench.w, {k: sources[k] for k in ("page", "cart")}))
    assert [b["ts"] for b in bench.got("heartbeat")] == [ms(240)]  # the newest time less the allowance
    assert product_rows(bench) == [(when(0), 9, 2, 1), (when(150), 8, 0, 1)]


def test_heartbeats_of_one_source_leave_the_others_waiting(bench):
    bench.w.heartbeats = True
    bench.w.settings = replace(bench.w.settings, heartbeat_allowance=timedelta(0))
    bench.send("page_log", page("a", 1), page("a", 100))
    bench.send("heartbeat", {"source": "bounce", "ts": ms(100)})
    finish(jobs.visitor_stats(bench.w))
    read = lambda: bench.spark.read.parquet(bench.w.table("visitor_stats"))
    assert read().count() == 0
    # A query started again knows no source's time until a record or a heartbeat comes.
    beats = {"bounce": 100, "unique_visit": 50, "page_log": 200}
    bench.send("heartbeat", *({"source": k, "ts": ms(at)} for k, at in beats.items()), "{no json")
    finish(jobs.visitor_stats(bench.w))
    assert [(r.stt, r.pv_ct) for r in read().collect()] == [(when(0), 1)]  # 50 s: the slowest


def test_late_rows_are_counted_in_a_table(bench):
    late = LateRows(bench.spark, bench.w.table("late_rows"))
    bench.spark.streams.addListener(late)
    try:
        search = {"page_id": "good_list", "item": "word"}
        bench.send("page_log", page("m", 1, **search), page("m", 100, **search))
        finish(jobs.keyword_stats(bench.w))
        bench.send("page_log", page("m", 2, **search), page("m", 3, **search), page("m", 200, **search))
        finish(jobs.keyword_stats(bench.w))
        late.settled()
    finally:
        bench.spark.streams.removeListener(late)
    rows = late.read().collect()
    assert [(r.query, r.dropped) for r in rows] == [("keyword_stats", 1)]  # one group of both late rows
    assert rows[0].watermark and rows[0].operator == "stateStoreSave"
