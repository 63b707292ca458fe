"""What grows over runs and batches: links seen before, and means."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from staylens.operators import reviews as V
from staylens.operators import seen
from staylens.plans.reviews import traveler_means
from staylens.streaming import means

LINKS = "dest_seq int, scroll_no int, pos int, href string"
CARDS = "property_id string, list_kind string, review_ts timestamp, review_id bigint, score_text string, stay_date string, traveler_type string"


def links_of(spark, hrefs):
    return spark.createDataFrame([(0, 0, i, h) for i, h in enumerate(hrefs)], LINKS)


def test_runs_against_a_set(spark, tmp_path):
    rng, store, known = random.Random(1), str(tmp_path / "store"), set()
    for run in range(4):
        hrefs = [f"/hotel/{rng.randrange(900)}?r={run}" for _ in range(400)] + [None]
        new = seen.add_run(store, links_of(spark, hrefs), run, bucket_keys=60)
        wanted = {}
        for h in hrefs[:-1]:
            wanted.setdefault(h.partition("?")[0], h)
        want = {k: h for k, h in wanted.items() if k not in known}
        assert {r.canonical: r.href for r in new.collect()} == want
        known |= wanted.keys()
    runs = seen.finished_runs(spark, store)
    assert [r.run for r in runs] == [0, 1, 2, 3] and runs[0].buckets > 3 and sum(r.n_keys for r in runs) == len(known)
    # compacted, the store knows the same keys
    other = str(tmp_path / "compacted")
    assert seen.compact(spark, store, other, bucket_keys=100) == len(known)
    fresh = [f"/hotel/{i}" for i in range(1000)]
    for at in (store, other):
        assert {r.canonical for r in seen.add_run(at, links_of(spark, fresh), 9).collect()} == set(fresh) - known


def test_a_run_that_is_run_again_gives_the_same(spark, tmp_path):
    store = str(tmp_path / "store")
    first = [f"/a{i}" for i in range(50)]
    seen.add_run(store, links_of(spark, first), 1)
    for _ in range(2):
        again = seen.add_run(store, links_of(spark, [*first[:10], "/new"]), 2)
        assert [r.canonical for r in again.collect()] == ["/new"]
    assert [r.n_keys for r in seen.finished_runs(spark, store)] == [50, 1]
    assert seen.add_run(store, links_of(spark, [None]), 3).count() == 0
    assert seen.add_run(store, links_of(spark, first), 4).count() == 0  # an empty run before it does no harm


def test_unseen_links_read_no_stored_keys(spark, tmp_path, monkeypatch):
    store, reads = str(tmp_path / "store"), []
    real = seen.stored_keys
    monkeypatch.setattr(seen, "stored_keys", lambda spark, store, buckets: reads.append(buckets) or real(spark, store, buckets))
    seen.add_run(store, links_of(spark, [f"/old/{i}" for i in range(3000)]), 0, bucket_keys=100)
    assert seen.finished_runs(spark, store)[0].buckets == 30
    assert seen.add_run(store, links_of(spark, ["/other/1"]), 1).count() == 1 and not reads
    assert seen.add_run(store, links_of(spark, ["/old/7", "/other/2"]), 2).count() == 1
    assert len(reads) == 1 and 1 <= len(reads[0]) <= 2  # the bucket of the one known link, and perhaps a false hit


def test_filters_hold_all_keys_and_few_others(spark, tmp_path):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("canonical"))
    words = 1700 * seen.BITS_PER_KEY // 64
    filters = seen.bloom_filters(keys, "canonical", 3, words)
    assert [len(r.words) for r in filters.collect()] == [words] * 3
    asked = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("canonical"), F.lit(words).alias("n_words"))
    asked = asked.withColumn("b", seen._bucket("canonical", F.lit(3)))
    held = seen._may_hold(F.col("filter"), seen._places("canonical", F.col("n_words")))
    hits = asked.join(filters.toDF("bucket", "filter"), (F.col("b") == F.col("bucket")) & held)
    ids = {int(r.canonical[1:]) for r in hits.select("canonical").collect()}
    assert ids >= set(range(5000)) and len(ids) < 5000 + 150


def some_cards(spark, n, seed):
    rng = random.Random(seed)
    kinds = ["Couple", "Couples", "Family", "Families", "Solo traveler", None, " ", "Digital-nomad"]
    rows = [
        (
            f"p{rng.randrange(6)}",
            rng.choice([V.R.ALL_LIST, V.R.BUSINESS_LIST]),
            f"2024-01-{rng.randrange(1, 29):02} 10:00:00",
            i,
            rng.choice(["Scored 8.1", "Scored 7.25", "Scored 0.1", "Scored x", f"Scored {rng.randrange(100) / 7:.3f}"]),
            rng.choice([None, "May 2024", "May 2025", "in 2025"]),
            rng.choice(kinds),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, CARDS.replace("timestamp", "string")).withColumn("review_ts", F.col("review_ts").cast("timestamp"))


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_batches_in_any_order_give_the_same_bits(spark, tmp_path, order):
    cards, store = some_cards(spark, 600, 4), str(tmp_path / "state")
    want = sorted(map(tuple, traveler_means(cards, 2025).collect()))
    for number, part in enumerate(order):
        means.add_batch(store, cards.where(F.col("review_id") % 4 == part), number, 2025)
        if number == 2:
            means.add_batch(store, cards.where(F.col("review_id") % 4 == part), number, 2025)  # again
            means.compact(spark, store, 1)
    assert sorted(map(tuple, V.traveler_record(means.state(spark, store)).collect())) == want
    means.compact(spark, store, 3)
    means.compact(spark, store, 2)  # nothing left to do
    assert sorted(map(tuple, V.traveler_record(means.state(spark, store)).collect())) == want
    means.add_batch(store, cards, 2, 2025)  # a late repeat of a batch that the base holds
    assert sorted(map(tuple, V.traveler_record(means.state(spark, store)).collect())) == want


def test_no_batch_yet(spark, tmp_path):
    with pytest.raises(ValueError, match="no batch"):
        means.state(spark, str(tmp_path / "none"))
