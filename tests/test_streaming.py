from __future__ import annotations

from pyspark.sql import functions as F

from staylens import schemas
from staylens.operators.attributes import page_attributes
from staylens.operators.links import first_seen
from staylens.plans import queries
from staylens.sources import tables
from staylens.streaming import incremental as I


def write(spark, path, rows, schema, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}")


def run(query):
    query.awaitTermination()
    return query


LINKS = [
    [(0, 1, 0, "h/a?1"), (0, 1, 1, "h/b?1"), (0, 1, 2, "h/a?2")],
    [(0, 2, 0, "h/b?3"), (0, 2, 1, "h/c?3")],
    [(1, 1, 0, "h/a?9"), (1, 1, 1, "h/d?9")],
]


def stream_links(spark, folder):
    return tables.stream(spark, f"{folder}/in/*", schemas.LINKS, files_per_batch=1)


def test_first_seen_stream_equals_batch_and_restarts(spark, tmp_path):
    start = lambda: run(
        I.write_batches(I.first_seen_stream(stream_links(spark, tmp_path)), f"{tmp_path}/out", f"{tmp_path}/cp", "update")
    )
    read = lambda: {(r.canonical, r.href) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    write(spark, f"{tmp_path}/in", LINKS[0], schemas.LINKS, "f0")
    start()
    write(spark, f"{tmp_path}/in", LINKS[1], schemas.LINKS, "f1")
    start()
    write(spark, f"{tmp_path}/in", LINKS[2], schemas.LINKS, "f2")
    start()
    batch = first_seen(spark.createDataFrame(sum(LINKS, []), schemas.LINKS))
    assert read() == {(r.canonical, r.href) for r in batch.collect()}
    rows = spark.read.parquet(f"{tmp_path}/out").count()
    start()  # nothing new: the checkpoint remembers
    assert spark.read.parquet(f"{tmp_path}/out").count() == rows == 4


def test_first_seen_within_a_delay(spark, tmp_path):
    rows = [("h/a?1", "2025-01-01 00:00:00"), ("h/a?2", "2025-01-01 00:05:00"), ("h/b", "2025-01-01 00:06:00")]
    df = spark.createDataFrame(rows, "href string, at string").select("href", F.col("at").cast("timestamp"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in/f0")
    stream = tables.stream(spark, f"{tmp_path}/in/*", "href STRING, at TIMESTAMP")
    run(I.write_batches(I.first_seen_within(stream, "at", "1 hour"), f"{tmp_path}/out", f"{tmp_path}/cp"))
    assert {r.canonical for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {"h/a", "h/b"}
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_records_are_flushed_per_batch(spark, tmp_path):
    for n in range(3):
        write(spark, f"{tmp_path}/in", [(n, f"/hotel/{n}", f"€ {n}50")], schemas.PAGES, f"f{n}")
    stream = tables.stream(spark, f"{tmp_path}/in/*", schemas.PAGES, files_per_batch=2)
    run(I.run_incremental(stream, page_attributes, f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.select("batch_id").distinct().count() == 2
    batch = page_attributes(spark.read.schema(schemas.PAGES).parquet(f"{tmp_path}/in/*"))
    assert got.drop("batch_id").exceptAll(batch).count() == 0 and got.count() == 3


def test_repeated_batch_replaces_itself(spark, tmp_path):
    sink = I._write_batch(str(tmp_path / "t"))
    df = spark.range(5)
    sink(df, 0)
    sink(df, 1)
    sink(df, 1)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_records_of_four_files_batch_by_batch(spark, tmp_path):
    page = '<span data-testid="breadcrumb-current"><span>Fes (Hotel {0})</span></span><div>Free • {0} Mbps</div>'
    rows = [(i, f"/hotel/{i}", page.format(i) if i % 5 else None) for i in range(20)]
    given = spark.createDataFrame(rows, schemas.PAGES)
    for part in range(4):
        given.where(F.col("page_id") % 4 == part).coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")
    arriving = tables.stream(spark, f"{tmp_path}/in/*", given.schema, files_per_batch=1)
    out = f"{tmp_path}/out"
    I.run_incremental(
        arriving, lambda batch: page_attributes(batch, built_in=True), out, f"{tmp_path}/checkpoint", per_batch=True
    ).awaitTermination()
    found = spark.read.parquet(out)
    assert sorted(r[0] for r in found.select("batch_id").distinct().collect()) == [0, 1, 2, 3]
    assert sorted(map(tuple, found.drop("batch_id").collect()), key=str) == sorted(map(tuple, page_attributes(given).collect()), key=str)


def test_all_tasks_write_an_arriving_part(spark, tmp_path):
    """A part is no single file that one task writes, and yet one batch."""
    rows = spark.range(0, 800, 1, 8).withColumnRenamed("id", "page_id")
    out = str(tmp_path)

    def run():
        arriving = tables.stream(spark, f"{out}/arrivals/*", rows.schema)
        return I.write_batches(arriving, f"{out}/rows", f"{out}/checkpoint")

    queries._in_parts(rows, "page_id", out, run)
    assert len(list((tmp_path / "arrivals" / "part=0").glob("*.parquet"))) == 8
    told = spark.read.parquet(f"{out}/rows").groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [(r["batch_id"], r["count"]) for r in told] == [(k, 200) for k in range(queries.BATCHES)]
    assert {r.page_id % 4 for r in spark.read.parquet(f"{out}/rows").where("batch_id = 1").collect()} == {1}
