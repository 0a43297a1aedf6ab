"""Defined results of every operator for nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import (
    bpe,
    decontamination,
    language_id,
    line_dedup,
    minhash,
    pii,
    quality,
    sharding,
    toxicity,
    url_filters,
)

LONG = " ".join(f"word{i % 5000}" for i in range(60_000))
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, kept boolean, hits int, n_lines int, ids int"
)


def row(i, text, lang="en"):
    return (i, text, lang, "s", len(text or ""), 9.0, False, 1, 2, 3)


ROWS = [
    row(1, "one two three four five six seven eight nine ten"),
    row(1, "one two three four five six seven eight nine ten"),
    row(2, None),
    row(3, "", None),
    row(None, "a text without an id, in no group at all"),
    (4, None, None, None, None, None, None, None, None, None),
    row(5, LONG),
    row(6, "\n\n \t\n"),
]


@pytest.fixture
def docs(rows):
    return rows(ROWS, SCHEMA)


@pytest.fixture
def empty(rows):
    return rows([], SCHEMA)


def labelled(docs):
    return docs.withColumn("toxic", F.when(F.col("doc_id") == 1, 1).when(F.col("doc_id") > 2, 0))


def items(rows):
    return rows([(7, "three four five six seven"), (7, None), (None, "x"), (8, "")], "item_id long, text string")


def operators(rows):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return {
        "bpe": lambda d: bpe.round_trip(d, vocabulary),
        "ids": lambda d: bpe.decode(bpe.encode(d, vocabulary), vocabulary),
        "quality": lambda d: quality.apply(d, quality.fit(d)),
        "language": lambda d: language_id.predict(
            d, language_id.fit(d.filter(language_id.known_language()))
        ),
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(labelled(d))),
        "pii": lambda d: pii.pseudonymise(d, "k"),
        "lines": line_dedup.line_dedup,
        "decontamination": lambda d: decontamination.mark(d, items(rows)),
        "near": minhash.near_duplicates,
        "shards": lambda d: sharding.shard_documents(d, shards=3),
    }


NAMES = (
    "bpe ids quality language toxicity pii lines decontamination near shards".split()
)


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_a_result(docs, empty, rows, name):
    run = operators(rows)[name]
    found = run(docs)
    assert len(set(map(str.lower, found.columns))) == len(found.columns)
    assert found.count() == len(ROWS)
    assert run(empty).count() == 0


def by_id(frame, *columns):
    return {(r.doc_id, r.text): tuple(r[c] for c in columns) for r in frame.collect()}


def test_null_and_empty_texts(docs, rows):
    found = operators(rows)
    counts = by_id(found["bpe"](docs), "n_tokens")
    assert counts[2, None] == counts[3, ""] == (0,)
    judged = by_id(found["quality"](docs), "n_words", "kept")
    assert judged[2, None] == judged[3, ""] == (0, False)
    assert judged[5, LONG][0] == 60_000
    langs = by_id(found["language"](docs), "lang_pred", "score")
    assert langs[2, None] == langs[6, "\n\n \t\n"] == ("und", 0.0)
    assert langs[5, LONG][0] == "en"
    lines = by_id(found["lines"](docs), "n_lines", "n_deleted")
    assert lines[2, None] == (0, 0)
    assert lines[6, "\n\n \t\n"] == (4, 0)
    hits = by_id(found["decontamination"](docs), "hits")
    assert [h.item_id for h in hits[1, ROWS[0][1]][0]] == [7]
    assert hits[2, None] == ([],)
    assert by_id(found["pii"](docs), "n_replaced")[2, None] == (0,)


def test_near_duplicates_of_odd_rows(docs):
    found = [tuple(r) for r in minhash.near_duplicates(docs).collect()]
    assert sorted(f for f in found if f[0] == 1) == [(1, 6, 1, True)] * 2
    assert (2, 0, 2, True) in found and (3, 0, 3, True) in found
    assert (None, 6, None, True) in found
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(ROWS) - 1


def test_shards_of_odd_rows(docs):
    found = sharding.shard_documents(docs, shards=3).collect()
    assert {r["size"] for r in found if r.doc_id in (2, 3)} == {1}
    for shard in {r.shard for r in found}:
        own = sorted(r.slot for r in found if r.shard == shard)
        assert own == list(range(len(own)))


def test_urls_of_odd_rows(rows):
    pages = rows(
        [
            (1, None, "x"),
            (2, "no scheme", "x"),
            (2, "no scheme", "x"),
            (None, "HTTP://Sub.Example.NET/en/1?x#y", "x"),
            (4, "ftp://example.com?q=/de/", "x"),
            (5, "a://b://c/d" + "/9" * 30, "x"),
        ],
        "page_id long, url string, host string",
    )
    labels = rows([(1, 1), (1, 0), (None, 1), (2, None)], "page_id long, bad int")
    rules = [url_filters.Rule("net/", "block"), url_filters.Rule("example.net/en/", "allow")]
    found = {r.page_id: r for r in url_filters.judge_urls(pages, labels, rules).collect()}
    assert (found[1].host, found[1].path, found[1].rule) == ("", "", None)
    assert (found[None].host, found[None].path) == ("sub.example.net", "/en/1")
    assert (found[None].rule, found[None].verdict) == ("example.net/en/", "allow")
    assert (found[4].host, found[4].path) == ("example.com", "")
    assert found[5].host == "b:" and found[5].template.count("/") == 8
    assert url_filters.judge_urls(pages.limit(0), labels.limit(0), rules).count() == 0


def test_one_bad_section_among_hundreds(rows):
    """Branches are decided by their labels, not by their share of the host."""
    names = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(300)]
    own = [(20 * k + i, f"http://a.com/{s}/p{i}", int(s == "ca")) for k, s in enumerate(names) for i in range(20)]
    pages = rows(own, "page_id long, url string, bad int")
    judged = url_filters.judge_urls(pages, pages.select("page_id", "bad"), [])
    blocked = judged.filter("verdict = 'block'").collect()
    assert len(blocked) == 20 and all(r.path.startswith("/ca/") for r in blocked)


def test_pipeline_stages_keep_the_columns(spark, rows, tmp_path):
    documents = rows([r[:5] for r in ROWS], ", ".join(SCHEMA.split(", ")[:5]))
    items(rows).write.parquet(str(tmp_path / "benchmark.parquet"))
    for source in (documents, documents.limit(0)):
        docs = source
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.dtypes == documents.dtypes
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert "ids_sha256" in last.columns
        assert last.count() <= source.count()
