"""Streams that forget, that number on from their state, and that read only what a batch asks for."""

import json
import os

from pyspark.sql import functions as F

from postlake.sinks.tables import save_by_tag_range
from postlake.streaming import ingest, missing_tags, requests, tag_stats
from tests.conftest import plan_of


def finish(stream):
    stream.awaitTermination()
    assert stream.exception() is None


def write(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as file:
        file.write("".join(json.dumps(row) + "\n" for row in rows))


def test_an_id_that_comes_back_after_the_delay_is_admitted_again(spark, folder):
    def run():
        lines = spark.readStream.schema("id BIGINT, n INT, at TIMESTAMP").option("maxFilesPerTrigger", 1).json(f"{folder}/in")
        finish(ingest.ingest_dedup_bounded(lines, f"{folder}/out", f"{folder}/cp", "90 minutes", 2, "at"))
        return sorted((row["id"], row["n"]) for row in spark.read.parquet(f"{folder}/out").collect())

    at = "2024-01-01T{:02}:00:00Z".format
    write(f"{folder}/in", "a", [{"id": 1, "n": 0, "at": at(0)}, {"id": 1, "n": 1, "at": at(0)}, {"id": None, "n": 2, "at": at(0)}])
    assert [i for i, _ in run()] == [1]
    write(f"{folder}/in", "b", [{"id": 1, "n": 3, "at": at(1)}, {"id": 2, "n": 4, "at": at(1)}])
    assert [i for i, _ in run()] == [1, 2]
    for hour in (3, 5, 7):
        write(f"{folder}/in", f"c{hour}", [{"id": 100 + hour, "n": 0, "at": at(hour)}])
        run()
    write(f"{folder}/in", "d", [{"id": 1, "n": 9, "at": at(8)}, {"id": 2, "n": 9, "at": None}, {"id": 103, "n": 9, "at": at(1)}])
    assert [pair for pair in run() if pair[0] < 100] == [(1, 0), (1, 9), (2, 4), (2, 9)]  # 103 was late


def test_the_queue_is_never_read_again(spark, folder, monkeypatch):
    known = spark.createDataFrame([("k", 1, "k", 1, 0, 0)], "key string, id bigint, name string, count bigint, type int, ambiguous int")
    monkeypatch.setattr(missing_tags, "read_batches", lambda *a, **b: 1 / 0)

    def run():
        posts = spark.readStream.schema("id BIGINT, tags STRING").option("maxFilesPerTrigger", 1).json(f"{folder}/in")
        finish(missing_tags.queue_missing_tags(posts, ["w"], known, f"{folder}/out", f"{folder}/cp", partitions=3))
        rows = spark.read.schema(missing_tags.QUEUE).parquet(f"{folder}/out").collect()
        return {row["position"]: row["name"] for row in rows}

    write(f"{folder}/in", "1", [{"id": 1, "tags": "w b a k"}, {"id": 2, "tags": "z"}])
    assert run() == {0: "a", 1: "b", 2: "w"}
    write(f"{folder}/in", "2", [{"id": 3, "tags": "w a b"}])
    write(f"{folder}/in", "3", [{"id": 4, "tags": None}, {"id": 5, "tags": "w zz a c"}])
    assert run() == {0: "a", 1: "b", 2: "w", 3: "c", 4: "zz"}
    assert run() == {0: "a", 1: "b", 2: "w", 3: "c", 4: "zz"}


def test_requests_read_the_ranges_they_name(spark, table_name):
    tag = spark.range(8000).select(F.col("id").alias("tag_id"), F.concat(F.lit("t"), "id").alias("name"), F.lit("general").alias("kind"))
    related = spark.range(40_000).select((F.col("id") * 3).alias("post_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 8000).alias("tag_id"))
    save_by_tag_range(related, 100, table_name)
    saved = spark.table(table_name)
    pairs = {(row["tag_id"], row["post_id"]) for row in related.collect()}
    assert {(row["tag_id"], row["post_id"]) for row in saved.collect()} == pairs
    for n, step in ((10, 13), (5000, 1)):
        wanted = [i * step for i in range(n)]
        asked = spark.createDataFrame([(f"t{i}",) for i in wanted] + [("unknown",)], "request STRING")
        answer = requests.answer(asked, tag, saved, 100)
        got = {(row["request"], row["post_id"]) for row in answer.collect()}
        chosen = set(wanted)
        assert got == {(f"t{tag_id}", post_id) for tag_id, post_id in pairs if tag_id in chosen}
        assert "dynamicpruning" in plan_of(answer)
    none = requests.answer(spark.createDataFrame([("unknown",)], "request STRING"), tag, saved, 100)
    assert none.collect() == []


def test_snapshots_keep_what_is_read_small_over_restarts(spark, folder):
    every, want = 3, {}
    for at in range(10 * every + 1):
        write(f"{folder}/in", f"{at:02}", [{"id": at, "created_at": "2024-01-01T00:00:00Z", "tag_string_general": f"a t{at % 4}"}])
        want["a"] = want.get("a", 0) + 1
        want[f"t{at % 4}"] = want.get(f"t{at % 4}", 0) + 1
        if at % 7 and at != 10 * every:  # several files wait for some runs
            continue
        posts = spark.readStream.schema("id BIGINT, created_at STRING, tag_string_general STRING").option("maxFilesPerTrigger", 1).json(f"{folder}/in")
        finish(tag_stats.refresh_tag_snapshots(posts, f"{folder}/out", f"{folder}/cp", {"general": "tag_string_general"}, every))
        current = tag_stats.current_tag_snapshot(spark, f"{folder}/out")
        assert {row["name"]: row["post_count"] for row in current.collect()} == want
        assert len({os.path.dirname(path) for path in current.inputFiles()}) <= every + 2
    assert tag_stats._pointed(spark, f"{folder}/out") == 10
    assert len(os.listdir(f"{folder}/out/_current")) == 2
