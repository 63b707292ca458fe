"""NULLs, empty and long texts, ties, repeats, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

import corpus_pipeline
from staylens.llm import (
    decontamination,
    extraction,
    fingerprints,
    language,
    near_dedup,
    packing,
    quality,
    sharding,
    toxicity,
    warc,
)
from staylens.llm.rows import small_batches

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
TEXTS = [None, "", "   \n", "!!! ???", "one", "two words", LONG, "same same same", "same same same", "é ü ß 東京", "<p>a & b</p>\x00"]
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, node string, shard int, row string, language string, text_key string"
LABELS = "doc_id bigint, quality int, toxic int"
VOCABULARY = path("byte_bpe_50k.json")


def table(spark, texts=TEXTS):
    rows = [(i, t, "en" if i % 2 else None, None, None, 0.1, "n", 7, "r", "l", "k") for i, t in enumerate(texts)]
    rows += [(None, "no id", None, "s", 1, None, None, None, None, None, None)] * 2  # rows that repeat, without an id
    rows += [(1, "", "en", None, None, 0.1, "n", 7, "r", "l", "k")]  # an id that repeats
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, n=11):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(n)] + [(3, None, None), (None, 1, 1), (4, 1, 1)], LABELS)


def test_toxicity(spark, docs, none):
    out = toxicity.predictions(docs, labels(spark)).collect()
    assert len(out) == 14 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.score == 0 and r.worst_start is None for r in out if r.doc_id in (0, 2, 3))
    assert toxicity.predictions(none, labels(spark)).count() == 0
    untaught = toxicity.predictions(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(untaught) == 14 and all(r.predicted == 0 for r in untaught)
    replaced = toxicity.scored(docs.withColumn("toxicity", F.lit(1)), toxicity.Model(0.0, {}))
    assert len(replaced.columns) == len(docs.columns) + 1


def test_quality(spark, docs, none):
    out = quality.predictions(docs, labels(spark)).collect()
    assert len(out) == 14 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    same = {r.score for r in out if r.doc_id in (7, 8)}
    assert len(same) == 1
    assert quality.predictions(none, labels(spark)).count() == 0
    assert quality.predictions(docs, spark.createDataFrame([], LABELS)).count() == 14
    kept = quality.accepted(docs, quality.fit(quality.np.zeros((0, 20)), []))
    assert kept.columns == docs.columns and kept.count() == 14


def test_language(spark, docs, none):
    out = language.predictions(docs).collect()
    assert len(out) == 14
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in out if r.doc_id in (0, 2, 3))
    assert all(r.lang_pred == "en" and r.score > 0 for r in out if r.doc_id in (4, 5, 6, 9))
    assert language.predictions(none).count() == 0
    unlabelled = language.predictions(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
    kept = language.accepted(docs, language.train(docs))
    assert kept.columns == docs.columns and kept.where("doc_id = 3").count() == 0


def test_all_languages_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 900)
    letters = [chr(0x4E00 + 7 * k) for k in range(300)]
    rows = [(i, f"l{i % 300}", letters[i % 300] * 9) for i in range(6_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").withColumn("a.b", F.lit(1))
    model = language.train(docs)
    assert len(model.languages) == 300  # of about three documents each
    kept = language.accepted(docs, model, 0.0)
    assert kept.columns == docs.columns and kept.count() == 6_000


def test_near_duplicates(spark, docs, none):
    classes, links = near_dedup.near_duplicates(docs)
    out = classes.collect()
    assert len(out) == 14 and links.count() == 0
    ids = {(r.doc_id, r.class_id) for r in out}
    assert ids == {(0, 0), (1, 0), (None, None), *((i, i) for i in (2, 3, 4, 5, 6, 9, 10)), (7, 7), (8, 7)}
    assert near_dedup.near_duplicates(none)[0].count() == 0
    kept = near_dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        *((False, i) for i in (0, 2, 3, 4, 5, 6, 7, 9, 10)), (True, 0),
    ]


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "same same"), (3, "same same"), (4, "東京"), (None, "one")], "item_id bigint, text string")
    out = decontamination.contamination(decontamination.build_index(docs), items).collect()
    assert len(out) == 14
    assert {r.doc_id: r.n_items for r in out if r.n_hit} == {7: 1, 8: 1, 9: 1, 4: 1}  # items without an id count
    hit = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in out if r.n_hit}
    assert hit == {7: (3, 3, ["3"]), 8: (3, 3, ["3"]), 9: (4, 1, ["4"]), 4: (1, 1, [])}
    assert {r.n_words for r in out if r.doc_id in (0, 2, 3)} == {0} and not any(r.contaminated for r in out if not r.n_hit)
    assert decontamination.contamination(decontamination.build_index(none), items).count() == 0
    nothing = items.where("false")
    assert decontamination.contamination(decontamination.build_index(docs), nothing).where("n_hit > 0").count() == 0
    kept = decontamination.without_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == 10


def test_clean_texts_are_not_shuffled_to_drop_contaminated_ones(spark):
    passage = "a passage of the benchmark that stands word for word in some of the training texts"
    rows = [(i, f"clean text number {i}", i) for i in range(200)]
    rows += [(7, passage, 1), (7, passage, 2), (None, passage, 3), (None, "clean", 4), (8, None, 5), (7, "clean text number 7", 6)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, `a.marked` int")
    kept = decontamination.without_contaminated(docs, spark.createDataFrame([(1, passage)], "item_id bigint, text string"))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in rows if r[1] != passage), key=str)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.index("Union") < plan.index("LeftAnti")  # clean rows take a way without the join


def test_texts_go_to_workers_in_small_batches(spark):
    session, name = spark.newSession(), "spark.sql.execution.arrow.maxBytesPerBatch"
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    docs = session.range(8000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 100).alias("text")).coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    nothing = language.Model([], np.zeros(0), np.zeros((0, 0)))
    for step in (
        lambda: language.accepted(docs, nothing),
        lambda: quality.accepted(docs, quality.fit(np.zeros((0, 0)), [])),
        lambda: decontamination.build_index(docs),
    ):
        session.conf.set(name, "64m")
        step()
        assert max(r.n for r in docs.mapInArrow(sizes, "n bigint").collect()) < 4 << 20
    for lower in ("1m", "2097152b"):
        session.conf.set(name, lower)
        small_batches(session)
        assert session.conf.get(name) == lower


def test_packing(spark, docs, none):
    out = packing.pack(docs, VOCABULARY).collect()
    total = sum(r.length for r in out)
    first = {(r.doc_id, r.start): r for r in out}
    assert first[(0, 0)].doc_tokens == 1 and first[(0, 0)].ids_crc32 == zlib.crc32(b"\x01\0\0\0")
    by_sequence: dict = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
    expected = docs.count() + sum(len(packing.tokenizer(VOCABULARY).ids(r.text or "")) for r in docs.collect())
    assert total == expected
    assert packing.pack(none, VOCABULARY).count() == 0


def test_fingerprints(spark, docs, none):
    out = fingerprints.fingerprint_edits(docs).collect()
    assert len(out) == 14 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert len({r.fingerprint for r in out if r.doc_id in (7, 8)}) == 1
    assert {r.near_next for r in out if r.doc_id in (0, 2, 7)} == {1.0}  # empty beside empty, copy beside copy
    assert fingerprints.fingerprint_edits(none).count() == 0
    (only,) = fingerprints.fingerprint_edits(docs.where("doc_id = 6")).collect()
    assert only.near_next == 1.0  # an only document follows itself
    groups = fingerprints.merged(docs, "source").collect()
    assert len(groups) == 2


def test_sharding(spark, docs, none):
    sized = sharding.sized(docs)
    out = sharding.interleave(sized, ties=("text_crc32", "size")).collect()
    assert len(out) == 14 and all(r.slot == 0 for r in out) and len({r.shard for r in out}) == 14
    assert {(r["size"], r.text_crc32) for r in out if r.doc_id in (0,)} == {(16, 0)}
    assert sharding.interleave(sharding.sized(none)).count() == 0
    whole = sharding.interleave(docs, shards=3)
    assert set(whole.columns) == set(docs.columns) | {"slot"}  # its own column "shard" is replaced
    sizes = [r["count"] for r in whole.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


PAGES = "page_id bigint, url string, html string, text string, host string, path string"


def pages(spark):
    same = "<body><article><p>" + "repeated payload " * 80 + "</p></article></body>"
    rows = [
        (1, "http://h.example/1", same), (2, "http://h.example/2", same), (5, None, same), (5, None, same), (None, "http://h.example/n", same),
        (3, "not a url\r\nX: y", None), (4, "", ""), (6, "http://h.example/6", "short"), (7, "http://h.example/7", "short"),
        (8, "http://h.example/8", f"<article><p>{LONG}</p></article>"),
    ]
    return spark.createDataFrame([(*r, "t", "h", "p") for r in rows], PAGES)


def test_extraction(spark):
    out = extraction.extract(pages(spark)).collect()
    assert len(out) == 10
    texts = {r.page_id: r.text for r in out}
    assert texts[3] == texts[4] == "" and texts[6] == "short" and texts[8] == LONG
    assert texts[1] == texts[5] == ("repeated payload " * 80).strip()
    assert all(r.n_chars == len(r.text) for r in out)
    assert extraction.extract(pages(spark).where("false")).count() == 0


def test_warc(spark):
    given = pages(spark)
    manifest, folder = warc.write_archives(given)
    assert sum(r.records for r in manifest.collect()) == 10
    out = warc.read_archives(manifest, folder).collect()
    got = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in out)
    assert got == [
        (0, "revisit", 5), (1, "revisit", 5), (2, "revisit", 5), (3, "response", 0), (4, "response", 0), (5, "response", 0),
        (5, "response", 0), (6, "response", 0), (7, "response", 0), (8, "response", 0),
    ]
    full = {r.page_id: (r.html or "").encode() for r in given.collect()}
    assert all(r.payload_bytes == len(full[r.page_id]) for r in out)
    assert all(r.payload_digest == hashlib.sha1(full[r.page_id]).hexdigest() for r in out)
    assert all(r.payload == full[r.page_id] for r in out if r.record_type == "response")
    manifest, folder = warc.write_archives(given.where("false"))
    assert manifest.count() == 0 and warc.read_archives(manifest, folder).count() == 0


def test_pipeline_on_an_empty_table_and_odd_rows(spark, docs, none, tmp_path):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    items = spark.createDataFrame([(1, "same same")], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (docs, none):
        now = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            before, now = now, stage(spark, now, str(tmp_path)).cache()
            assert now.columns == given.columns and now.count() <= before.count()
        assert corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count() >= now.count()
