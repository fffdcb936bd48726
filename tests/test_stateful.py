"""Keyed state of devices across batches and restarts."""

from __future__ import annotations

import pytest
from test_jobs import Bench, ms, page, rerun_last_batch

from tradewind.streaming import jobs
from tradewind.streaming.sinks import finish


@pytest.fixture
def bench(spark, tmp_path):
    return Bench(spark, tmp_path)


def flags(bench):
    return sorted((p["common"]["mid"], p["ts"], p["common"]["is_new"]) for p in bench.got("page_log"))


def test_seen_devices_move_to_another_root(bench, tmp_path):
    bench.send("raw_log", page("a", 5, is_new="1"), page("a", 2, is_new="1"), page("b", 1))
    finish(jobs.separate_logs(bench.w))
    assert flags(bench) == [("a", ms(2), "1"), ("a", ms(5), "0"), ("b", ms(1), "0")]
    assert [r.mid for r in jobs.seen_visitors(bench.w).collect()] == ["a"]

    fresh = Bench(bench.spark, tmp_path / "other")
    fresh.send("raw_log", page("a", 7, is_new="1"), page("b", 8, is_new="1"), page("b", 9, is_new="1"))
    known = bench.spark.createDataFrame([("a",), ("a",), (None,), ("never again",)], "mid string")
    finish(jobs.separate_logs(fresh.w, known))
    assert flags(fresh) == [("a", ms(7), "0"), ("b", ms(8), "1"), ("b", ms(9), "0")]
    assert sorted(r.mid for r in jobs.seen_visitors(fresh.w).collect()) == ["a", "b", "never again"]


def test_a_batch_looks_up_its_own_devices_only(bench):
    for at in range(3):
        mids = [f"d{i}" for i in range(30 if at == 0 else 2)]
        bench.send("raw_log", *(page(m, at, is_new="1") for m in mids))
        query = jobs.separate_logs(bench.w)
        finish(query)
    state = query.recentProgress[-1].stateOperators[0]
    assert state.numRowsTotal == 30
    assert [f for f in flags(bench) if f[2] == "1"] == sorted((f"d{i}", ms(0), "1") for i in range(30))


def test_a_reader_past_a_batch_does_not_meet_it_again(bench):
    bench.send("raw_log", *(page(f"m{i}", i) for i in range(20)), "{bad")
    job = lambda: finish(jobs.separate_logs(bench.w))
    job()
    finish(jobs.unique_visits(bench.w))  # a reader, now past the first batch
    assert len(bench.got("unique_visit")) == 20
    for _ in range(2):
        rerun_last_batch(bench.w, "separate_logs")
        job()
        bench.send("page_log", page("late", 1))
        finish(jobs.unique_visits(bench.w))
        assert sorted(v["ts"] for v in bench.got("unique_visit")) == sorted([*(ms(i) for i in range(20)), ms(1)])
        assert len(bench.got("page_log")) >= 21


def test_a_batch_that_died_while_its_files_moved_goes_on(bench, monkeypatch):
    topics = bench.topics
    rows = bench.spark.createDataFrame([(str(i),) for i in range(12)], "value string").repartition(4)
    publish = topics._publish

    def dies(lines):
        publish(lines[:2])
        raise OSError("the driver died")

    monkeypatch.setattr(topics, "_publish", dies)
    with pytest.raises(OSError):
        topics.write(rows, "t", 7, "job")
    half = {r.value for r in topics.read("t").collect()}
    assert 0 < len(half) < 12
    monkeypatch.undo()
    other = bench.spark.createDataFrame([("not the first write",)], "value string")
    for _ in range(2):
        topics.write(other, "t", 7, "job")
        assert sorted(int(r.value) for r in topics.read("t").collect()) == list(range(12))
    topics.write(other, "t", 8, "job")
    topics.write(other, "t", job="job")
    topics.write(other, "t", job="job")
    assert topics.read("t").count() == 15


def test_a_job_without_its_checkpoint_is_not_taken_for_a_rerun(bench):
    raw = bench.topics.stream("in")
    bench.send("in", {"a": 1})
    finish(bench.w.text_to_topic(raw, "out", "copy"))
    bench.w.root += "/moved"
    finish(bench.w.text_to_topic(raw, "out", "copy"))
    assert bench.topics.read("out").count() == 2
