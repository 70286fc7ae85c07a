import json

import pytest

from opsledger.functions.text import topic_regex
from opsledger.operators import events as ev
from opsledger.sinks.tables import publish_events, store_deliveries
from opsledger.sources.messages import dead_letters, decode_messages, encode_events, good_messages
from opsledger.sources.rules import NOTIFICATION_RULES, default_channels, load_rules, rules_table

# The sample rules: one type with two channels, one with one, and the default.
SAMPLE_RULES = {
    "handlers": {
        "order.created": [
            {"type": "email", "template": "order_confirmation", "retry": 3},
            {"type": "push", "template": "order_created_push", "retry": 1},
        ],
        "order.shipped": [{"type": "sms", "template": "order_shipped_sms", "retry": 2}],
        "order.muted": [],
        "order.bare": [{}],
    },
    "default": [{"type": "log", "level": "warning"}],
}


def _decode(spark, *bodies):
    frame = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    return {r.i: r for r in decode_messages(frame).collect()}


def test_envelope_defaults(spark):
    rows = _decode(
        spark,
        '{"event_type":"a","payload":{"x":1,"y":"z"}}',
        "{}",
        '{"event_type":null,"payload":{}}',
        '{"event_type":"a"}',
        ' {"event_type":"a","payload":null} ',
    )
    assert all(r.decoded for r in rows.values())
    assert [rows[i].event_type for i in range(5)] == ["a", "unknown", "unknown", "a", "a"]
    assert rows[0].payload == {"x": "1", "y": "z"}
    assert all(rows[i].payload == {} for i in range(1, 5))


@pytest.mark.parametrize(
    "body",
    ["not json {", "[1]", '[{"event_type":"a"}]', '"s"', "5", "null", "", None, '{"a":1} more',
     '{"event_type":"a"},{"event_type":"b"}'],
)
def test_anything_but_one_object_is_a_dead_letter(spark, body):
    frame = spark.createDataFrame([(body,)], "body string")
    decoded = decode_messages(frame)
    assert good_messages(decoded).count() == 0
    assert dead_letters(decoded).count() == 1


def test_payload_must_be_an_object(spark):
    rows = _decode(
        spark,
        '\t{"event_type":"a","payload":{"payload":"{x"}}\r\n',
        '{"event_type":"a","payload":null}',
        "{'event_type':'a'}",
        '{"event_type":"a","payload":[1]}',
        '{"event_type":"a","payload":"{}"}',
        '{"event_type":"a","payload":3}',
        '\u00a0{"event_type":"a"}',
    )
    assert [rows[i].decoded for i in range(7)] == [True, True, False, False, False, False, False]
    assert rows[0].payload == {"payload": "{x"} and rows[1].payload == {}


def test_first_deliveries_of_decoded_events(spark):
    rows = [(1, 2, '{"event_type":"late"}'), (1, 1, '{"event_type":"early","payload":{"k":"v"}}')]
    decoded = good_messages(decode_messages(spark.createDataFrame(rows, "event_id int, ts int, body string")))
    (row,) = ev.first_deliveries(decoded).collect()
    assert (row.event_type, row.payload) == ("early", {"k": "v"})


def test_unused_default_is_listed(spark):
    events = spark.createDataFrame([("order.created",)], "event_type string")
    usage = ev.rule_usage(events, rules_table(spark, SAMPLE_RULES), default_channels(SAMPLE_RULES))
    assert [r.n_events for r in usage.where("rule = 'default'").collect()] == [0]


def test_dead_letter_keeps_the_first_200(spark):
    frame = spark.createDataFrame([("x" * 500,)], "body string")
    row = dead_letters(decode_messages(frame)).first()
    assert row.body_head == "x" * 200 and row.body == "x" * 500


def test_encode_then_decode(spark):
    events = spark.createDataFrame(
        [("order.created", {"order_id": "1", "customer_id": None})],
        "event_type string, payload map<string,string>",
    )
    row = encode_events(events).first()
    assert row.routing_key == "order.created"
    assert json.loads(row.body) == {
        "event_type": "order.created", "payload": {"order_id": "1", "customer_id": None}}


def _route(spark, config, *types, **join):
    events = spark.createDataFrame([(t,) for t in types], "event_type string")
    routed = ev.route_events(events, rules_table(spark, config), default_channels(config))
    return [tuple(r) for r in routed.orderBy("event_type", "pos").collect()]


def test_routing(spark):
    assert _route(spark, SAMPLE_RULES, "order.created") == [
        ("order.created", 0, "email", "order_confirmation", 3, None),
        ("order.created", 1, "push", "order_created_push", 1, None),
    ]
    assert _route(spark, SAMPLE_RULES, "order.no_such_event") == [
        ("order.no_such_event", 0, "log", "", None, "warning")]
    assert _route(spark, SAMPLE_RULES, "order.muted") == []
    assert _route(spark, SAMPLE_RULES, "order.bare") == [("order.bare", 0, "log", "", None, None)]


def test_default_list_without_entry_and_empty_default(spark):
    assert _route(spark, {"handlers": {}}, "x") == [("x", 0, "log", "", None, "warning")]
    assert _route(spark, {"handlers": {}, "default": []}, "x") == []


def test_rules_files(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(SAMPLE_RULES))
    assert load_rules(str(path)) == SAMPLE_RULES
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "rules.yaml"
    path.write_text(yaml.safe_dump(NOTIFICATION_RULES))
    assert load_rules(str(path)) == NOTIFICATION_RULES


def test_rule_usage_counts_unused_rules_too(spark):
    events = spark.createDataFrame([("order.created",)] * 3 + [("a",), ("b",)], "event_type string")
    usage = ev.rule_usage(events, rules_table(spark, SAMPLE_RULES), default_channels(SAMPLE_RULES))
    assert {(r.rule, r.pos): r.n_events for r in usage.collect()} == {
        ("order.created", 0): 3, ("order.created", 1): 3, ("order.shipped", 0): 0,
        ("order.bare", 0): 0, ("default", 0): 2}


@pytest.mark.parametrize(
    "pattern, yes, no",
    [
        ("#", ["a", "a.b", ""], []),
        ("order.*", ["order.created"], ["order", "order.a.b", "xorder.a"]),
        ("order.#", ["order", "order.a", "order.a.b"], ["orders.a"]),
        ("#.created", ["created", "a.created", "a.b.created"], ["a.createdx"]),
        ("a.#.b", ["a.b", "a.x.b", "a.x.y.b"], ["ab", "a.bx"]),
        ("*.*", ["a.b"], ["a", "a.b.c"]),
        ("a.b", ["a.b"], ["axb"]),
    ],
)
def test_topic_patterns(spark, pattern, yes, no):
    frame = spark.createDataFrame([(k,) for k in yes + no], "event_type string")
    assert sorted(r[0] for r in ev.subscribe(frame, pattern).collect()) == sorted(yes)
    assert topic_regex(pattern).startswith("^")


def test_attempts(spark):
    frame = spark.createDataFrame(
        [(1, 3), (4, 3), (5, 3), (1, None), (2, None)], "attempts_needed int, retry int")
    rows = ev.delivery_attempts(frame).collect()
    assert [(r.attempts_made, r.delivered, r.dead_letter) for r in rows] == [
        (1, True, False), (4, True, False), (4, False, True), (1, True, False), (1, False, True)]


def test_first_deliveries_do_not_depend_on_order(spark):
    rows = [(1, "b"), (1, "a"), (2, "c"), (2, "c")]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "event_id int, body string")
        assert sorted(map(tuple, ev.first_deliveries(frame).collect())) == [(1, "a"), (2, "c")]


def test_reconcile(spark):
    orders = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "id string")
    events = spark.createDataFrame([("2",), ("3",), ("3",), (None,)], "order_id string")
    found = {(r.order_id, r.reason): (r.n_orders, r.n_events) for r in ev.reconcile(orders, events).collect()}
    assert found == {
        ("1", "order without event"): (1, 0),
        (None, "order without event"): (1, 0),
        ("3", "event without order"): (0, 2),
        (None, "event without order"): (0, 1),
    }


def test_publish_writes_a_folder_per_routing_key(spark, tmp_path):
    events = spark.createDataFrame(
        [("order.created", {"a": "1"}), ("order.shipped", {"a": "2"})],
        "event_type string, payload map<string,string>")
    publish_events(events, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("routing_key=*")) == [
        "routing_key=order.created", "routing_key=order.shipped"]


def test_deliveries_split_into_two_tables(spark, tmp_path):
    frame = spark.createDataFrame([(1, 0), (2, 0), (5, 3)], "attempts_needed int, retry int")
    for _ in range(2):  # a repeated run replaces what it stored
        store_deliveries(ev.delivery_attempts(frame), str(tmp_path / "ok"), str(tmp_path / "dead"), "1")
    assert spark.read.parquet(str(tmp_path / "ok")).count() == 1
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 2
