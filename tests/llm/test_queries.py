"""The subpackage's queries against their SQL, and against brute force where SQL cannot."""

import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd
import pytest
import sentencepiece

import __spark_entry__ as contract
from opsledger.llm import pieces, queries, secret_scan
from tests.conftest import SF

ORACLES = queries.oracle_sql()


def run(name, spark, sf=SF):
    return contract.queries()[name](spark, sf)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, duck):
    found = run(name, spark)
    columns = sorted(found.columns)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = Counter(tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in found.collect()) == expected


def test_secrets_match_plain_rules(spark, documents):
    rules = {
        "assign": re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
        ),
        "access": re.compile("AKIA[A-Z0-9]+"),
        "hex": re.compile("[0-9a-f]+"),
    }
    least = {"assign": 6, "access": 20, "hex": 24}
    rows = {r["doc_id"]: r for r in run("op1_secrets", spark).collect()}
    assert rows.keys() == set(documents.index)
    for doc_id, text in documents.text.items():
        spans = []
        for order, (kind, rule) in enumerate(rules.items()):
            for m in rule.finditer(text or ""):
                if len(m[2] if kind == "assign" else m[0]) >= least[kind]:
                    spans.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
        joined = ",".join(s[2] for s in sorted(spans))
        row = rows[doc_id]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        base = [s for s in row["spans"].split(",") if s and not s.startswith("network")]
        assert ",".join(base) == joined


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = pd.read_parquet(f"{sf}/labels.parquet").set_index("doc_id").quality
    rows = run("op3_quality", spark, sf).toPandas().set_index("doc_id")
    assert len(rows) == 1000 and rows.score.between(0, 1).all()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.index]).all()
    assert (rows.predicted == (rows.score >= 0.7)).all()
    unseen = rows[rows.held_out].join(labels, how="inner")
    assert len(unseen) > 60
    assert (unseen.predicted == unseen.quality).mean() > 0.95


def test_html_gives_the_article(spark):
    pages = pd.read_parquet(f"{SF}/pages.parquet").set_index("page_id")
    rows = {r["page_id"]: r for r in run("op6_html", spark).collect()}
    assert rows.keys() == set(pages.index)
    import html

    for page_id, page in pages.html.items():
        article = re.search("<article>(.*)</article>", page, re.S)[1]
        blocks = [html.unescape(re.sub("<[^>]*>", "", b)).split() for b in re.split("</?(?:p|h1)>", article)]
        text = "\n".join(" ".join(b) for b in blocks if b)
        assert rows[page_id]["text"] == text and rows[page_id]["n_chars"] == len(text)


def test_ids_equal_the_library(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    rows = {r["doc_id"]: r for r in run("op10_sentencepiece", spark).collect()}
    assert rows.keys() == set(documents.index)
    for doc_id, text in documents.text.items():
        ids = model.encode(text or "")
        row = rows[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_pipeline_keeps_its_promises(spark, documents):
    """Each stage on its own input, against plain Python."""
    import corpus_pipeline as pipeline
    from opsledger.functions.workspace import stored
    from opsledger.llm import quality

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    outputs = [docs]
    for name, stage in pipeline.STAGES:
        outputs.append(stored(stage(spark, outputs[-1], sf), f"test-{name}"))
    for out in outputs[1:-1]:
        assert out.columns == columns
    raw, good, one, clean, mixed, tokens = (o.toPandas() for o in outputs)
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scores = model.scores(raw.text.tolist())
    assert set(good.doc_id) == set(raw.doc_id[scores >= 0.7])
    # near-duplicates by brute force
    sets = {i: _shingles(t) for i, t in zip(good.doc_id, good.text)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= 75 * (len(x) + len(y) - shared):
                    a_root, b_root = sorted((find(a), find(b)))
                    root[b_root] = a_root
    assert sorted(one.doc_id) == sorted(i for i in sets if find(i) == i)
    # secrets
    before = dict(zip(one.doc_id, one.text))
    assert sorted(clean.doc_id) == sorted(one.doc_id)
    for i, text, size in zip(clean.doc_id, clean.text, clean.n_chars):
        assert not secret_scan.rule_spans(text)
        if not secret_scan.rule_spans(before[i]) and text != before[i]:
            assert secret_scan.MASK in text
        assert size == len(text)
    # mixing: whole documents, near the targets, never beyond three times
    taken = mixed.doc_id.value_counts()
    assert taken.max() <= 3
    assert set(mixed.text) <= set(clean.text)
    assert abs(mixed.text.str.split().str.len().sum() / clean.text.str.split().str.len().sum() - 1) < 0.1
    # tokens
    assert len(tokens) == len(mixed) and tokens.round_trip.all()
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    by_id = dict(zip(mixed.doc_id, mixed.text))
    for i, found in zip(tokens.doc_id, tokens.ids):
        assert list(found) == library.encode(by_id[i])


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
