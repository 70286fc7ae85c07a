"""Log search over fewer files: same lines as a full scan."""

import random

import pytest
from pyspark.sql import functions as F

from opsledger.operators import skip_index

WORDS = ["timeout", "Refused", "order", "CREATED", "health", "über", "käse", "a.b", "[x]", "id=7"]
PATTERNS = [
    "timeout", "time.ut", "(?i)TIMEOUT", "refused|Refused", "(order|health) cre", "(?:or)?der", "a\\.b", "\\[x\\]",
    "x{2,}", "(abc)+d", "(abc)*order", "id=[0-9]", "^only9$", "only[0-9] *$", "über", "(?!order)he", "(?=timeout)t",
    "(?x) order # note", "\\Qa.b\\E", "[a[b]]", "o(r|x(y|z))der", "health(?:y|s)?", "",
]


@pytest.fixture()
def logs(tmp_path):
    rng = random.Random(4)
    for i in range(12):
        lines = [" ".join(rng.choices(WORDS[i % 5 :: 5], k=4)) for _ in range(30)]
        (tmp_path / f"pod {i}").mkdir()
        (tmp_path / f"pod {i}" / "0.log").write_text("\n".join([*lines, f"only{i}"]) + "\n", encoding="utf-8")
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "0.log").write_text("")
    return str(tmp_path / "*" / "*.log")


def _full(spark, glob, condition):
    return sorted(r.value for r in spark.read.text(glob).where(condition).collect())


def test_searches_equal_full_scans(spark, logs):
    index = skip_index.build_index(spark, logs).cache()
    for pattern in PATTERNS:
        try:
            expected = _full(spark, logs, F.col("value").rlike(pattern))
        except Exception:
            continue
        assert sorted(r.line for r in skip_index.search(spark, logs, index, regex=pattern).collect()) == expected, pattern
    for text in [*WORDS, "only3", "no such text", "a", ""]:
        expected = _full(spark, logs, F.contains("value", F.lit(text)))
        assert sorted(r.line for r in skip_index.search(spark, logs, index, text=text).collect()) == expected
    index.unpersist()


def test_few_files_are_read(spark, logs):
    index = skip_index.build_index(spark, logs)
    files = lambda needed: skip_index.matching_files(spark, logs, index, needed).count()
    assert files(skip_index.needed_of_text("only7")) == 1
    assert files(skip_index.needed_of_regex("(only7|zzzz).*|[0-9]+nowhere")) == 1
    assert files(skip_index.needed_of_text("nowhere at all")) == 0
    assert files(skip_index.needed_of_regex("ti*ou*t")) == 12
    assert len(skip_index.search(spark, logs, index, text="only7").inputFiles()) == 1


def test_bitmaps_are_built_from_each_bit_once(spark, tmp_path):
    (tmp_path / "0.log").write_text("abcdef Abc\n" * 3000)
    index = skip_index.build_index(spark, str(tmp_path / "*.log"))
    index.collect()
    plan = index._jdf.queryExecution().executedPlan()
    aggregates = plan.toString().split("== Initial Plan ==")[0]
    lower = aggregates[aggregates.index("partial_bitmap_construct_agg") :]
    assert "HashAggregate(keys=[path" in lower.split("Generate explode")[0]
    bits = index.where("part >= 0").select(F.sum(F.bitmap_count("bits"))).first()[0]
    assert bits == len({"abcdef abc"[i : i + 3] for i in range(8)})


def test_changed_and_new_files_are_read(spark, logs, tmp_path):
    path = str(tmp_path / "index")
    skip_index.build_index(spark, logs).write.parquet(path)
    (tmp_path / "pod 0" / "0.log").write_text("a new thing\n")
    (tmp_path / "pod 99").mkdir()
    (tmp_path / "pod 99" / "0.log").write_text("a new thing too\n")
    for _ in range(2):
        found = skip_index.search(spark, logs, spark.read.parquet(path), text="new thing")
        assert sorted(r.line for r in found.collect()) == ["a new thing", "a new thing too"]
        skip_index.update_index(spark, logs, path)
    assert len(found.inputFiles()) == 2
    assert spark.read.parquet(path).where("part = -1").count() == 14


@pytest.mark.parametrize("pattern, needed", [
    ("abcd", ("all", ["abc", "bcd"])), ("ab", None), ("ABC|de", None),
    ("x(Abc|def)y", ("any", ["abc", "def"])),
    ("(abc)?", None), ("(abc){2}", "abc"), ("[a]bcd", ("all", ["abc", "bcd"])), ("(", None), ("\\p{L}abc", None),
])
def test_what_a_pattern_needs(pattern, needed):
    assert skip_index.needed_of_regex(pattern) == needed
