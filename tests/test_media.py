"""Variants, manifests, audits and sharded outputs."""

import os

import pytest

from pyspark.sql import functions as F

from postlake.operators import manifest
from postlake.sinks import files
from postlake.sources import media as media_source
from postlake.sources.media import list_artifacts
from tests.conftest import plan_of, values

VARIANT = "struct<type:string,url:string,width:bigint,height:bigint,file_ext:string>"


def post(i, variants, large="http://x/l.jpg", url="http://x/o.png", ext="png"):
    return (i, ext, url, large, variants)


def posts_of(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        f"id bigint, file_ext string, file_url string, large_file_url string, variants array<{VARIANT}>",
    )


def test_variants(spark):
    sample = ("sample", "http://x/l.jpg", 850, 600, "jpg")
    original = lambda w, h: ("original", "http://x/orig.webp", w, h, "webp")
    posts = posts_of(
        spark,
        post(1, None), post(2, []), post(3, [sample]), post(4, [sample, original(900, 700)]),
        post(5, [sample, original(900, 599)]), post(6, [original(1, 1)]),
        post(7, None, None, None, "zip"), post(8, [original(1, 1), original(2, 2)], "http://x/v.mp4"),
        post(9, None, "http://x/v.mp4"),
    )
    rows = {r["id"]: r for r in manifest.media_manifest(posts, originals_only=True).collect()}
    assert {i: r["skip_reason"] for i, r in rows.items()} == {
        1: None, 2: None, 3: "no_original", 4: None, 5: "original_smaller", 6: None, 7: "video", 8: None,
        9: "video",
    }
    assert (rows[4]["target"], rows[4]["ext"], rows[4]["path"]) == ("http://x/orig.webp", "webp", "4/4.webp")
    assert (rows[1]["target"], rows[1]["ext"], rows[1]["path"]) == ("http://x/l.jpg", "jpg", "1/1.png")


def test_first_rule_wins(spark):
    rows = [
        (1, "a 3dcg", "mirror", None, "http://x/v.mp4", 9), (2, "a", "mirror", 1, "http://x/v.mp4", 9),
        (3, "keep", "mirror", 7, "http://x/v.mp4", 9), (4, "a", "u", 7, "http://x/i.png", 9),
        (5, "a", "u", None, None, 9), (6, "a", "u", None, "http://x/i.png", 9), (7, "keep", "u", 7, "http://x/i.png", 9),
        (8, "a", "u", None, "http://x/i.png", 3), (9, None, None, None, "http://x/i.zip", None),
    ]
    posts = spark.createDataFrame(
        rows, "id bigint, tags string, owner string, creator_id bigint, file_url string, size bigint"
    ).withColumn("large_file_url", F.lit(None).cast("string")).withColumn("file_ext", F.lit("png"))
    made = manifest.media_manifest(
        posts, archives=False, banned_words=["3d"], uploader=("mirror", 7), exempt=["keep"], max_size=5, tags="tags"
    )
    got = {r["id"]: r["skip_reason"] for r in made.collect()}
    assert got == {
        1: "banned_tag", 2: "uploader", 3: "video", 4: "uploader", 5: "no_target", 6: "too_large", 7: None, 8: None,
        9: None,
    }
    assert "Exchange" not in plan_of(made)
    counts = {r["skip_reason"]: r["n_posts"] for r in manifest.manifest_counts(made).collect()}
    assert counts == {"banned_tag": 1, "uploader": 2, "video": 1, "no_target": 1, "too_large": 1, "fetch": 3}


def test_audit_of_stored_files(spark, folder):
    for path, size in (("1/1.png", 5), ("2/2.png", 0), ("3/3.png", 4), ("x/9.png", 1), ("top.png", 2)):
        os.makedirs(os.path.dirname(f"{folder}/media/{path}"), exist_ok=True)
        with open(f"{folder}/media/{path}", "wb") as file:
            file.write(b"x" * size)
    expected = spark.createDataFrame(
        [(i, f"{i}/{i}.png", 5) for i in (1, 2, 3, 4)], "id bigint, path string, size bigint"
    )
    listing = list_artifacts(spark, f"{folder}/media")
    assert ("2/2.png", 0) in values(listing)
    assert values(manifest.audit_artifacts(expected, listing)) == sorted([
        ("1/1.png", 1, "ok"), ("2/2.png", 2, "empty"), ("3/3.png", 3, "size_mismatch"), ("4/4.png", 4, "missing"),
        ("x/9.png", None, "unexpected"), ("top.png", None, "unexpected"),
    ], key=str)


@pytest.mark.parametrize("min_folders", [1, 2, 3, 50])
def test_listing_is_dealt_out_by_folders(spark, folder, min_folders):
    rows = [(f"{i % 3}/{i % 7}/{i}.bin", bytes(i % 5)) for i in range(300)] + [("top.bin", b"x"), ("0/up.bin", None), ("1/2/3/4/deep.bin", b"yy"), (None, b"z")]
    stored = spark.createDataFrame(rows, "path STRING, content BINARY")
    assert files.write_media(stored, f"{folder}/media") == 303
    assert files.write_media(stored.where("path = 'top.bin'"), f"file://{folder}/media") == 1
    listing = list_artifacts(spark, f"{folder}/media", min_folders)
    assert sorted(map(tuple, listing.collect())) == sorted((path, len(content or b"")) for path, content in rows if path)
    os.makedirs(f"{folder}/none")
    assert list_artifacts(spark, f"{folder}/none", min_folders).collect() == []


def test_listings_hand_rows_on_in_batches(folder):
    os.makedirs(f"{folder}/a/b")
    for i in range(25):
        open(f"{folder}/a/{'b/' * (i % 2)}{i}", "w").close()
    reader = media_source._Reader(folder, 1)
    batches = [batch for part in reader.partitions() for batch in reader.read(part)]
    assert sum(batch.num_rows for batch in batches) == 25
    media_source.BATCH_ROWS, kept = 4, media_source.BATCH_ROWS
    batches = [batch for part in reader.partitions() for batch in reader.read(part)]
    media_source.BATCH_ROWS = kept
    assert max(batch.num_rows for batch in batches) == 4


def test_sharded_output_skips_what_is_written(spark, folder):
    records = spark.range(500).select("id", (F.col("id") * 2).alias("v"))
    files.write_sharded_metadata(records.where("id < 300"), f"{folder}/m")
    first = spark.read.parquet(f"{folder}/m")
    files.write_sharded_metadata(records, f"{folder}/m", existing=first)
    rows = spark.read.parquet(f"{folder}/m")
    assert rows.count() == 500 and rows.where("shard = id % 100").count() == 500


def test_captions_and_json(spark, folder):
    posts = spark.createDataFrame([(1, "é x", None), (2, None, 60)], "id bigint, tag_string_general string, score bigint")
    files.write_captions(posts, f"{folder}/c")
    assert values(spark.read.parquet(f"{folder}/c"), "id", "caption") == [(1, "é, x"), (2, "score:best quality")]
    files.write_jsonl(posts, f"{folder}/j")
    lines = sorted(r[0] for r in spark.read.text(f"{folder}/j").collect())
    assert lines[0] == '{"id":1,"tag_string_general":"é x","score":null}'
