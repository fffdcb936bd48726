from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.config import Settings
from tradewind.functions import text, times
from tradewind.operators.changes import current_state, retract_stream, upserted
from tradewind.operators.parse import (
    mark_json,
    normalise_changes,
    parse_changes,
    parse_records,
    split_lines,
    with_create_times,
)
from tradewind.operators.route import (
    drop_deletes,
    explode_displays,
    fact_topic_rows,
    keep_columns,
    latest_config,
    route_changes,
)
from tradewind.plans.changes import feed_as_table, feed_to_topic
from tradewind.plans.logs import separate_logs
from tradewind.sources.topics import FolderTopics, KafkaTopics, declare_table


def lines(spark, *values):
    rows = [(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values]
    return spark.createDataFrame(rows, "value string")


@pytest.mark.parametrize(
    ("value", "valid"),
    [
        ("{bad", False), ("12", False), ('""', False), ("[]", False), ("[{}]", False),
        ("", False), (None, False), ("null", False), ('{"a":1} x', False),
        ('{"a":1},{"b":2}', False), ('{"a":1}{"b":2}', False), ('{"a":1},null', False),
        ("{}", True), ('{"start":{}}', True), ('  {"a": [1, {"b": null}]}  ', True),
        ('{"a":"} {"}', True), ('{"a":\n1}', True), ("{'a':1}", False),
    ],
)
def test_only_one_whole_json_object_is_valid(spark, value, valid):
    assert mark_json(lines(spark, value)).first().is_valid is valid


def test_log_separation(spark):
    common = {"mid": "m", "is_new": "0"}
    raw = lines(
        spark,
        "{bad", "12",
        {"common": common, "start": {}, "ts": 1},
        {"common": common, "start": "", "page": {"page_id": "p1"}, "ts": 2},
        {"common": common, "page": {"page_id": "p2"}, "displays": [], "ts": 3},
        {"common": common, "page": {"page_id": "p3"}, "ts": 4,
         "displays": [{"item": "1", "item_type": "sku_id"}, {"item": "2"}]},
        {"common": common, "start": None, "ts": 5},
    ).withColumn("n", F.monotonically_increasing_id())
    parts = separate_logs(raw, tiebreak=["n"])
    assert sorted(r.value for r in parts["dirty"].collect()) == ["12", "{bad"]
    assert [(r.ts, r.start) for r in parts["start"].collect()] == [(1, "{}")]
    assert sorted(r.ts for r in parts["page"].collect()) == [2, 3, 4, 5]
    shown = [(r.page_id, r.item, r.item_type) for r in parts["display"].collect()]
    assert sorted(shown) == [("p3", "1", "sku_id"), ("p3", "2", None)]
    seen = spark.createDataFrame([("m",)], "mid string")
    assert separate_logs(raw, tiebreak=["n"], seen=seen)["page"].count() == 4


def test_displays_of_nothing(spark):
    pages = parse_records(lines(spark, {"ts": 1}, {"displays": []}), schemas.PAGE_LOG)
    assert explode_displays(pages).collect() == []


def test_records_take_numbers_bare_or_quoted(spark):
    raw = lines(spark, {"id": "7", "order_id": 8, "sku_num": "x", "order_price": 1.256}, "{bad")
    rows = parse_records(raw, schemas.ORDER_DETAIL).collect()
    assert (rows[0].id, rows[0].order_id, rows[0].sku_num) == (7, 8, None)
    assert str(rows[0].order_price) == "1.26"
    assert rows[1].id is None


def test_create_times(spark):
    df = spark.createDataFrame(
        [("2021-01-01 08:30:00",), ("nonsense",)], "create_time string"
    )
    a, b = with_create_times(df, Settings()).collect()
    assert (a.create_date, a.create_hour, a.create_ts) == (
        "2021-01-01", "08", 1609430400000 + 8 * 3600_000 + 1800_000,
    )
    assert b.create_ts is None and b.rowtime is None


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2021-01-01 00:00:00",)], "t string")
    instant = times.parse_time(F.col("t"), "+08:00")
    for zone in ("UTC", "America/New_York", "Asia/Shanghai"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            r = df.select(
                times.time_to_millis(F.col("t"), "+08:00").alias("ms"),
                times.format_time(instant, "+08:00").alias("back"),
                times.local_day(instant, "UTC").cast("string").alias("day"),
                F.unix_millis(times.millis_to_time(F.lit(1609430400999))).alias("cut"),
            ).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert tuple(r) == (1609430400000, "2021-01-01 00:00:00", "2020-12-31", 1609430400000)


def test_age(spark):
    born = F.lit("2000-01-01")
    at = F.lit("2001-01-01 00:00:00").cast("timestamp")  # 366 days: 2000 is a leap year
    df = spark.range(1)
    assert df.select(times.age_years(born, at, "UTC")).first()[0] == 1
    before = F.lit("2000-12-30 23:59:59").cast("timestamp")
    assert df.select(times.age_years(born, before, "UTC")).first()[0] == 0


def test_text_lines(spark):
    raw = lines(spark, "1,ann,100", "2,bob", "3,cy,x")
    cols = {"id": "string", "name": "string", "ts": "bigint"}
    assert [tuple(r) for r in split_lines(raw, cols).collect()] == [
        ("1", "ann", 100), ("2", "bob", None), ("3", "cy", None),
    ]


def test_envelope_aliases(spark):
    raw = lines(
        spark,
        {"table": "t", "operation": "create", "after": {"a": 1}},
        {"table": "t", "type": "update", "data": {"a": 2}, "ts": 5},
        {"table": "t", "op": "r", "after": {"a": 3}},
        {"table": "t", "op": "READ", "after": {"a": 3}},
        {"table": "t", "type": "delete", "before": {"a": 4}, "after": None},
        {"table": "t", "after": {"a": 5}},
    )
    rows = parse_changes(raw).select(
        "type", F.col("after").isNull().alias("gone"), F.to_json("after").alias("after"), "ts"
    ).collect()
    assert [r.type for r in rows] == ["insert", "update", "insert", "insert", "delete", None]
    assert [r.gone for r in rows] == [False] * 4 + [True, False]
    assert rows[1].after == '{"a":2}' and rows[1].ts == 5


def test_envelope_from_connector(spark):
    records = spark.createDataFrame(
        [("srv.shop.t", "CREATE", None, {"a": "1"}), ("srv.shop.t", "DELETE", {"a": "1"}, None)],
        "topic string, op string, before map<string,string>, after map<string,string>",
    )
    full = normalise_changes(records).collect()
    assert [(r.operation, r.database, r.table) for r in full] == [
        ("insert", "shop", "t"), ("delete", "shop", "t"),
    ]
    assert full[1].before == {"a": "1"} and full[1].after is None
    text_form = sorted(r.value for r in feed_to_topic(records).collect())
    assert text_form[0] == '{"operation":"create","data":{"a":"1"},"database":"shop","table":"t"}'
    with pytest.raises(ValueError, match="variant"):
        normalise_changes(records, variant="other")


CHANGE = "table string, type string, after map<string,string>"
CONFIG = (
    "type string, sourceTable string, operateType string, sinkType string, "
    "sinkTable string, sinkColumns string, sinkPk string, sinkExtend string, ts bigint"
)


def test_routing(spark):
    config = latest_config(spark.createDataFrame(
        [
            ("insert", "o", "insert", "kafka", "old", "x", None, None, 1),
            ("update", "o", "insert", "kafka", "new", "id,a ,b", None, None, 2),
            ("insert", "u", "insert", "hbase", "dim_u", "id", "uid", None, 3),
            ("insert", "c", "insert", "clickhouse", "c", "id", None, None, 4),
            ("insert", "g", "insert", "kafka", "gone", "id", None, None, 5),
            ("delete", "g", "insert", "kafka", "gone", "id", None, None, 6),
            ("insert", None, None, "kafka", "null-null", "id", None, None, 7),
        ],
        CONFIG,
    ))
    image = {"id": "1", "a": "2", "b": "3", "z": "4"}
    changes = spark.createDataFrame(
        [(t, op, image) for t, op in (
            ("o", "insert"), ("u", "insert"), ("c", "insert"), ("g", "insert"),
            ("o", "update"), ("o", "delete"), ("o", None),
        )],
        CHANGE,
    )
    routed = route_changes(drop_deletes(changes), config)
    got = {(r.table, r.type): (r.route, r.sink_table, r.sink_pk, r.after)
           for r in routed.collect()}
    assert got[("o", "insert")] == ("fact", "new", "id", {"id": "1", "b": "3"})
    assert got[("u", "insert")] == ("dim", "dim_u", "uid", {"id": "1"})
    assert got[("c", "insert")][0] == "ignored"
    assert got[("g", "insert")][:2] == ("unmatched", None)
    assert got[("o", "update")][0] == got[("o", None)][0] == "unmatched"
    assert ("o", "delete") not in got
    sent = [(r.topic, json.loads(r.value)) for r in fact_topic_rows(routed).collect()]
    assert sent == [("new", {"id": "1", "b": "3"})]


def test_column_names_match_exactly(spark):
    df = spark.createDataFrame([({"a": "1", "ab": "2"}, "ab, a")], "m map<string,string>, c string")
    assert df.select(keep_columns(F.col("m"), F.col("c"))).first()[0] == {"ab": "2"}


FEED = "type string, before map<string,string>, after map<string,string>, ts bigint"


def test_current_state_and_retractions(spark):
    feed = spark.createDataFrame(
        [
            ("insert", None, {"id": "1", "n": "a"}, 1),
            ("update", {"id": "1", "n": "a"}, {"id": "1", "n": "b"}, 2),
            ("insert", None, {"id": "2", "n": "c"}, 3),
            ("delete", {"id": "2", "n": "c"}, None, 4),
        ],
        FEED,
    )
    cols = {"id": "int", "n": "string"}
    assert [tuple(r) for r in current_state(feed, "id", cols).collect()] == [(1, "b")]
    got = sorted(tuple(r) for r in retract_stream(feed, cols).collect())
    assert got == [
        (1, True, 1, "a"), (2, False, 1, "a"), (2, True, 1, "b"), (3, True, 2, "c"),
        (4, False, 2, "c"),
    ]


def test_feed_as_table_from_text(spark):
    raw = lines(
        spark,
        {"table": "u", "type": "insert", "after": {"id": 1, "name": "a", "phone_num": "1"}, "ts": 1},
        {"table": "u", "type": "update", "before": {"id": 1}, "after": {"id": 1, "name": "b"}, "ts": 2},
    )
    state, retract = feed_as_table(
        raw, {"id": "int", "name": "string", "phone_num": "string"}, "id"
    )
    assert [tuple(r) for r in state.collect()] == [(1, "b", None)]
    assert retract.filter("is_add").count() == 2


def test_upsert_is_per_column_and_in_order(spark):
    feed = spark.createDataFrame(
        [
            ({"id": "1", "a": "x", "b": "y"}, 1),
            ({"id": "1", "a": "z"}, 3),
            ({"id": "1", "a": "late"}, 2),
            ({"id": "1", "b": None}, 4),
            ({"a": "no key"}, 5),
            ({"id": "2", "c": "only c"}, 6),
        ],
        "after map<string,string>, ts bigint",
    )
    got = {r.id: (r.a, r.b, r.c) for r in upserted(feed, "id", ["id", "a", "b", "c"]).collect()}
    assert got == {"1": ("z", None, None), "2": (None, None, "only c")}


TITLE = "Apple iPhoneXSMax (A2104) 256GB 深空灰色 移动联通电信 4G 手机双卡双待"


def test_keywords(spark):
    df = spark.createDataFrame([(TITLE,), ("",), (None,)], "t string")
    pattern = Settings().keyword_pattern
    words = [
        r[0] for r in df.select(text.keyword_tokens(F.col("t"), pattern)).collect()
    ]
    assert words[0][:4] == ["apple", "iphonexsmax", "a2104", "256gb"]
    assert words[0][4:8] == list("深空灰色") and words[1] == [] and words[2] is None
    mixed = spark.createDataFrame([("Apple über Café КАША 手机x ñandú かな e\u0301t",)], "t string")
    assert mixed.select(text.keyword_tokens(F.col("t"), pattern)).first()[0] == [
        "apple", "über", "café", "каша", "手", "机", "x", "ñandú", "かな", "e\u0301t"
    ]


def test_keyword_table_function_in_sql(spark):
    text.register_keyword_split(spark, Settings().keyword_pattern)
    rows = spark.sql("""
        SELECT id, word FROM (SELECT 1 AS id, 'IT''s 手机 4G' AS t UNION ALL SELECT 2, ''),
        LATERAL keyword_split(t) AS k(word)
    """).collect()
    assert [(r.id, r.word) for r in rows] == [
        (1, "it"), (1, "s"), (1, "手"), (1, "机"), (1, "4g")
    ]
    same = spark.sql("SELECT * FROM ik_analyze('a b')").collect()
    assert [r[0] for r in same] == ["a", "b"]


@pytest.mark.parametrize(
    ("value", "blank"), [(None, True), ("", True), (" \t\n", True), ("x", False), (" x ", False)]
)
def test_blank(spark, value, blank):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(text.is_blank(F.col("v"))).first()[0] is blank


def test_declared_table(spark):
    raw = lines(spark, {"page": {"page_id": "good_list", "item": "x"}, "ts": 1609430400999})
    declare_table(
        raw, "declared_pages", "page map<string,string>, ts bigint",
        "timestamp_seconds(ts div 1000)", "2 seconds",
    )
    row = spark.sql("SELECT page['item'] AS item, unix_millis(rowtime) AS ms FROM declared_pages").first()
    assert tuple(row) == ("x", 1609430400000)


@pytest.mark.parametrize(("value", "valid"), [
    ('\n\t{"a": 1}\r\n', True), ('{"a": 1, "a": 2}', True), ("{}", True), ('{"a": {"b": [1, {}]}}', True),
    ('{"a": 1} x', False), ('{"a": 1},{"b": 2}', False), ("{}],[{}", False), ('{},"w":{}', False),
    ("{'a': 1}", False), ('{"a": NaN}', False), ('{"a": {"b": [1,}}', False), ("[{}]", False), (None, False),
])
def test_json_objects_of_odd_shape(spark, value, valid):
    from tradewind.functions.json import is_json_object

    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(is_json_object(F.col("v"))).first()[0] is valid


def test_changes_without_a_key_make_no_row(spark):
    from tradewind.operators.changes import current_state

    feed = spark.createDataFrame(
        [("insert", {"id": "1"}, 1), ("insert", {"name": "x"}, 2), ("insert", None, 3)],
        "type string, after map<string,string>, ts bigint",
    ).withColumn("before", F.lit(None).cast("map<string,string>"))
    assert [r.id for r in current_state(feed, "id", {"id": "int"}).collect()] == [1]


def test_folder_topics_by_row_and_replay(spark, tmp_path):
    topics = FolderTopics(spark, str(tmp_path))
    rows = spark.createDataFrame(
        [("a", "1"), ("b", "2"), ("a", "3")], "topic string, value string"
    )
    topics.write(rows, batch_id=4)
    topics.write(rows, batch_id=4)  # run again
    topics.write(rows.filter("value = '1'"), batch_id=5)
    assert sorted(r.value for r in topics.read("a").collect()) == ["1", "1", "3"]
    assert [r.value for r in topics.read("b").collect()] == ["2"]


def test_kafka_options():
    topics = KafkaTopics(None, "h1:9092,h2:9092", **{"kafka.security.protocol": "SSL"})
    assert topics.read_options("t", "latest") == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092", "kafka.security.protocol": "SSL",
        "subscribe": "t", "startingOffsets": "latest",
    }
    assert "topic" not in topics.write_options()
    assert topics.write_options("t")["topic"] == "t"


def test_cutting_pieces_takes_the_longest_word_first(spark):
    import random
    import re

    from tradewind.operators.keywords import cut_pieces

    rnd = random.Random(5)
    words = {"".join(rnd.choices("abc", k=rnd.randint(2, 4))) for _ in range(25)}
    pieces = {"".join(rnd.choices("abcd", k=rnd.randint(1, 30))) for _ in range(80)}
    df = spark.createDataFrame([(p,) for p in pieces], "piece string")
    vocabulary = spark.createDataFrame([(w,) for w in words], "word string")
    cut = {r.piece: r.words for r in cut_pieces(df, vocabulary).collect()}
    pattern = "|".join([*sorted(words, key=len, reverse=True), "[a-z]"])
    assert cut == {p: re.findall(pattern, p) for p in pieces}
    long = spark.createDataFrame([("手机壳手机",)], "piece string")
    known = spark.createDataFrame([("手机",), ("手机壳",), ("",)], "word string")
    assert cut_pieces(long, known).first().words == ["手机壳", "手机"]
    assert cut_pieces(long, known.filter("false")).first().words == list("手机壳手机")


def test_cutting_a_piece_takes_time_in_proportion_to_its_length(spark):
    import random
    import re
    import time

    from tradewind.operators.keywords import cut_pieces

    rnd = random.Random(6)
    words = sorted({"".join(rnd.choices("ab漢😀", k=rnd.randint(2, 90))) for _ in range(60)} | {"ab", "漢😀a"})
    vocabulary = spark.createDataFrame([(w,) for w in words], "word string")

    def run(n):
        text = "".join(rnd.choices([*words, "a", "b", "漢", "😀"], k=n))[:n]
        df = spark.createDataFrame([(text,)], "piece string")
        begin = time.time()
        got = cut_pieces(df, vocabulary).first().words
        spent = time.time() - begin
        pattern = "|".join([*sorted(words, key=len, reverse=True), "."])
        assert got == re.findall(pattern, text)
        return spent

    run(1000)
    assert run(64_000) < 12 * run(8_000) + 5
