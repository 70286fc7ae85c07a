"""Many topic patterns at once, against one regex per pattern."""

import random
import re

from opsledger.functions.text import topic_regex
from opsledger.operators import topics

WORDS = ["order", "created", "shipped", "eu", "us", "a", "b"]


def _plain(keys, patterns):
    compiled = {p: re.compile(topic_regex(p)) for p in set(patterns) if p is not None}
    return {(k, p) for k in set(keys) if k is not None for p, r in compiled.items() if r.match(k)}


def _frames(spark, keys, patterns):
    return (
        spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, topic string"),
        spark.createDataFrame([(f"q{i}", p) for i, p in enumerate(patterns)], "queue string, pattern string"),
    )


def test_ten_thousand_patterns_equal_their_regexes(spark, capsys):
    rng = random.Random(1)
    words = WORDS + [f"w{i}" for i in range(40)]
    patterns = [
        ".".join(rng.choices([*words, "*", "*", "#"], [1] * len(words) + [4, 4, 6], k=rng.randint(1, 6))) for _ in range(10_000)
    ]
    keys = [".".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(150)]
    found = topics.matching_patterns(*[f.drop("id", "queue") for f in _frames(spark, keys, patterns)])
    rows = [(r.topic, r.pattern) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == _plain(keys, patterns)
    found.explain()
    plan = capsys.readouterr().out
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_edges_of_the_grammar(spark):
    patterns = ["#", "#.#", "#.#.#", "", "*", "*.*", "a", "a.#", "#.a", "a.#.b", "a.#.#.b", "#.*", "*.#", "a..b", ".", "a.", "#.a.#", None, "a.*.#.b.#"]
    keys = ["", "a", "b", "a.b", "a.a", "a.x.b", "a.x.y.b.z", "a..b", ".", "a.", ".a", "a.a.a", None, "A", "ab", "*", "x.*"]
    found = topics.matching_patterns(*[f.drop("id", "queue") for f in _frames(spark, keys, patterns)])
    assert {(r.topic, r.pattern) for r in found.collect()} == _plain(keys, patterns)


def test_messages_and_bindings_repeat(spark):
    messages, bindings = _frames(spark, ["a.b", "a.b", "c", None], ["a.*", "a.*", "#", "d"])
    found = topics.subscribed(messages, bindings)
    assert sorted((r.id, r.queue) for r in found.collect()) == [
        (0, "q0"), (0, "q1"), (0, "q2"), (1, "q0"), (1, "q1"), (1, "q2"), (2, "q2")]
    assert topics.subscribed(messages.limit(0), bindings).count() == 0
    assert topics.subscribed(messages, bindings.limit(0)).count() == 0
