"""Streams equal the batch result, go on where they stopped, and survive a batch that runs again."""

import json
import os

import pytest

from postlake import fixtures as fx
from postlake.operators import stats
from postlake.session import shared_dir
from postlake.streaming import batches, ingest, missing_tags, requests, tag_stats
from tests.conftest import values


def finish(stream):
    stream.awaitTermination()
    assert stream.exception() is None


def write(folder, name, *records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as file:
        file.write("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records))


def post(i, tags="a b", **more):
    return {"id": i, "created_at": "2024-01-01T00:00:00Z", "tag_string_general": tags, "score": 1, **more}


@pytest.mark.parametrize("bounded", [False, True])
def test_ingest_once_per_id_over_restarts(spark, folder, bounded):
    source, out, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/cp"

    def run():
        posts = ingest.arriving_posts(spark, source, low=2, high=50, files_per_batch=1)
        if bounded:
            finish(ingest.ingest_dedup_bounded(posts, out, checkpoint, "1 hour"))
        else:
            finish(ingest.ingest_dedup(posts, out, checkpoint))
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    write(source, "0_9.jsonl", post(1), post(2), post(2), post(3), "{cut", post(None))
    assert run() == [2, 3]
    write(source, "10_19.jsonl", {"post": [post(3), post(4)]}, post(51))
    assert run() == [2, 3, 4]
    assert run() == [2, 3, 4]


def test_posts_without_id_are_all_kept(spark, folder):
    write(f"{folder}/in", "a.jsonl", post(None), post(None), post(1))
    posts = ingest.arriving_posts(spark, f"{folder}/in")
    finish(ingest.ingest_without_id(posts, f"{folder}/out", f"{folder}/cp"))
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_statistics_follow_the_posts(spark, folder):
    source, out = f"{folder}/in", f"{folder}/out"

    def run(target=out):
        posts = ingest.arriving_posts(spark, source, files_per_batch=1)
        finish(tag_stats.refresh_tag_stats(posts, target, f"{folder}/cp"))
        return {r["name"]: r["post_count"] for r in tag_stats.current_tag_stats(spark, target).collect()}

    write(source, "a.jsonl", post(1, "x y"), post(2, "x x"))
    assert run() == {"x": 3, "y": 1}
    write(source, "b.jsonl", post(3, "y z"))
    assert run() == {"x": 3, "y": 2, "z": 1}
    tag_stats.compact_tag_stats(spark, out, f"{folder}/out2")
    write(source, "c.jsonl", post(4, "z"))
    assert run(f"{folder}/out2") == {"x": 3, "y": 2, "z": 2}


def test_a_batch_that_runs_again_counts_once(spark, sf_dir, folder):
    flat = fx.flat_posts(spark, sf_dir)
    batches.prepare(spark, folder + "/o", tag_stats.DELTA)
    for _ in range(2):
        batches.write_batch(stats.tag_stats_by_name(flat), f"{folder}/o", 0)
    current = tag_stats.current_tag_stats(spark, f"{folder}/o")
    assert values(current) == values(stats.tag_stats_by_name(flat))


def test_requests_are_answered_once(spark, folder):
    tag = spark.createDataFrame([(0, "long_hair", "general"), (1, "x", "general"), (2, "x", "artist")], "tag_id bigint, name string, kind string")
    related = spark.createDataFrame([(7, 0), (7, 0), (8, 1), (8, 2), (9, 2)], "post_id bigint, tag_id bigint")

    def run():
        asked = requests.arriving_requests(spark, f"{folder}/in", files_per_batch=1)
        finish(requests.answer_requests(asked, tag, related, f"{folder}/out", f"{folder}/cp"))
        return values(requests.answers(spark, f"{folder}/out"), "request", "post_id")

    write(f"{folder}/in", "a", " long hair ", "unknown", "")
    assert run() == [("long_hair", 7)]
    write(f"{folder}/in", "b", "long_hair", "x")
    assert run() == [("long_hair", 7), ("x", 8), ("x", 9)]


def test_missing_tags_fill_batches(spark, folder):
    known = spark.createDataFrame([("k", 1, "k", 1, 0, 0)], "key string, id bigint, name string, count bigint, type int, ambiguous int")

    def run():
        posts = ingest.arriving_posts(spark, f"{folder}/in", files_per_batch=1)
        finish(missing_tags.queue_missing_tags(
            posts, ["w"], known, f"{folder}/out", f"{folder}/cp", tags="tag_string_general"
        ))

    look = lambda done: {
        r["lookup"]: r["names"].split(" ") for r in missing_tags.lookup_batches(spark, f"{folder}/out", 3, done).collect()
    }
    write(f"{folder}/in", "a.jsonl", post(1, "w a k b"), post(2, "skipped"))
    run()
    assert look(False) == {0: ["a", "b", "w"]}
    write(f"{folder}/in", "b.jsonl", post(3, "w c a d"))
    run()
    assert look(False) == {0: ["a", "b", "w"]}
    assert look(True) == {0: ["a", "b", "w"], 1: ["c", "d"]}


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_dir(spark).startswith(named)
    assert spark.sparkContext.applicationId in shared_dir(spark)
