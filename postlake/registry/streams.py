"""Streaming jobs, run over what the test tables derive and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake import fixtures as fx
from postlake.registry import inputs
from postlake.registry.base import CLOCK, clock, fresh_folder, query, same_result
from postlake.registry.dictionary import WORDS
from postlake.sources.dictionary import load_tag_dictionary
from postlake.session import cut_lineage
from postlake.streaming import ingest, missing_tags, requests, tag_stats


def _finish(stream) -> None:
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


# A batch has a cost of its own, whatever it holds: files arrive in about as many batches at any size.
BATCHES = 8


def _per_batch(spark, path, least, pattern="*.parquet"):
    """Files of a batch: ``least``, or more where that would make more than ``BATCHES`` batches."""
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).format("binaryFile").load(path)
    return max(least, -(-len(found.inputFiles()) // BATCHES))


_CLIPPED = "SELECT id, score, rating, tag_string FROM post_src WHERE id >= 50"


def _read_posts(spark, path):
    return spark.read.parquet(path).select("id", "score", "rating", "tag_string")


@query("stream_ingest_dedup", _CLIPPED, "post_src")
def stream_ingest_dedup(spark, sf_dir):
    run = fresh_folder(spark, sf_dir, "ingest")
    tree = inputs.line_tree(spark, sf_dir)
    few = _per_batch(spark, tree, 1, inputs.TREE_FILES)
    posts = ingest.arriving_posts(spark, tree, low=50, files_per_batch=few, pattern=inputs.TREE_FILES)
    parts = fx.parts(spark, sf_dir)
    _finish(ingest.ingest_dedup(posts, f"{run}/out", f"{run}/checkpoint", parts))
    return _read_posts(spark, f"{run}/out")


@query(
    "stream_ingest_without_id",
    "SELECT s.score, s.rating, s.tag_string FROM recs r JOIN post_src s ON s.id = r.src WHERE r.id IS NULL",
    ("recs", "post_src"),
)
def stream_ingest_without_id(spark, sf_dir):
    run = fresh_folder(spark, sf_dir, "unkeyed")
    posts = ingest.arriving_posts(spark, inputs.line_tree(spark, sf_dir), pattern=inputs.TREE_FILES)
    _finish(ingest.ingest_without_id(posts, f"{run}/out", f"{run}/checkpoint"))
    return _read_posts(spark, f"{run}/out").drop("id")


def _fetched(spark, sf_dir, folder):
    """Posts as lines of one file an hour: each id in one of six hours, a third of them again an hour
    later and a fifth seven hours later, with other scores."""
    first = F.col("id") % 6

    def seen(after, more):
        return F.struct("id", (F.col("score") + more).alias("score"), (first + after).alias("hour"))

    times = F.array(seen(0, 0), F.when(F.col("id") % 3 == 0, seen(1, 1000)), F.when(F.col("id") % 5 == 0, seen(7, 2000)))
    posts = fx.flat_posts(spark, sf_dir).select(F.explode(F.array_compact(times)).alias("p")).select("p.*")
    clock = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.col("hour") * 3600), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lines = posts.select("hour", F.to_json(F.struct("id", "score", clock.alias("fetched_at"))).alias("line"))
    kept = cut_lineage(lines)
    for hour in range(13):  # files are read in the order in which they were written
        of_hour = kept.where(F.col("hour") == hour).select("line")
        of_hour.coalesce(1).write.mode("append").text(f"{folder}/in")


@query(
    "stream_dedup_bounded",
    """SELECT id, score FROM post_src UNION ALL SELECT id, score + 2000 FROM post_src WHERE id % 5 = 0""",
    "post_src",
)
def stream_dedup_bounded(spark, sf_dir):
    """Ids that come back within the delay are left out; those that come back after it are admitted again."""
    run = fresh_folder(spark, sf_dir, "bounded")
    _fetched(spark, sf_dir, run)
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{run}/in")
    fields = F.from_json("value", "id BIGINT, score BIGINT, fetched_at TIMESTAMP")
    posts = lines.select(fields.alias("p")).select("p.*")
    _finish(ingest.ingest_dedup_bounded(
        posts, f"{run}/out", f"{run}/checkpoint", "90 minutes", fx.parts(spark, sf_dir), "fetched_at"
    ))
    return spark.read.parquet(f"{run}/out").select("id", "score")


@query(
    "stream_search_requests",
    """SELECT request, request AS folder, post_id FROM (
  SELECT DISTINCT t.name AS request, post_id FROM tag t JOIN post_tag USING (tag_id)
  WHERE t.name IN (SELECT 'supp_' || s_suppkey FROM supplier) OR t.name IN ('red', 'new'))""",
    ("tag", "post_tag"),
)
def stream_search_requests(spark, sf_dir):
    run = fresh_folder(spark, sf_dir, "requests")
    typed = fx.table(spark, sf_dir, "supplier").select(
        F.explode(F.array(
            F.concat(F.lit(" supp "), "s_suppkey"), F.concat(F.lit("supp_"), "s_suppkey"),
            F.lit("red "), F.lit("new"),
        )).alias("value")
    )
    typed.repartition(3).write.text(f"{run}/in")
    arriving = requests.arriving_requests(spark, f"{run}/in", files_per_batch=1)
    related, width = fx.post_tags_by_range(spark, sf_dir)
    _finish(requests.answer_requests(
        arriving, fx.tags(spark, sf_dir), related, f"{run}/out", f"{run}/checkpoint", fx.parts(spark, sf_dir), width,
    ))
    return requests.answers(spark, f"{run}/out")


@query(
    "stream_tag_stats",
    f"SELECT kind, tag_name AS name, {CLOCK.format('first_seen')} AS first_seen, post_count FROM stats",
    "stats",
)
def stream_tag_stats(spark, sf_dir):
    run = fresh_folder(spark, sf_dir, "tag_stats")
    fx.flat_posts(spark, sf_dir)
    flat = fx.folder(spark, sf_dir, "flat")
    arriving = ingest.arriving_parquet(spark, flat, files_per_batch=_per_batch(spark, flat, 3))
    _finish(tag_stats.refresh_tag_stats(arriving, f"{run}/out", f"{run}/checkpoint"))
    current = tag_stats.current_tag_stats(spark, f"{run}/out")
    return current.withColumn("first_seen", clock("first_seen"))


@same_result("stream_tag_snapshots", "stream_tag_stats")
def stream_tag_snapshots(spark, sf_dir):
    """Folded by the stream every second batch."""
    run = fresh_folder(spark, sf_dir, "tag_snapshots")
    fx.flat_posts(spark, sf_dir)
    flat = fx.folder(spark, sf_dir, "flat")
    arriving = ingest.arriving_parquet(spark, flat, files_per_batch=_per_batch(spark, flat, 2))
    _finish(tag_stats.refresh_tag_snapshots(arriving, f"{run}/out", f"{run}/checkpoint", fold_every=2))
    return tag_stats.current_tag_snapshot(spark, f"{run}/out").withColumn("first_seen", clock("first_seen"))


@query(
    "stream_missing_tags",
    """SELECT token AS name FROM (SELECT DISTINCT token FROM plain_tok WHERE id IN (SELECT id FROM plain
  WHERE contains(tags, 'red') OR contains(tags, 'gizmo')) AND token NOT IN (SELECT token FROM by_alias))""",
    ("plain", "plain_tok", "by_alias"),
)
def stream_missing_tags(spark, sf_dir):
    run = fresh_folder(spark, sf_dir, "missing")
    plain = inputs.plain_posts(spark, sf_dir)
    source = fx.folder(spark, sf_dir, "plain")
    arriving = spark.readStream.schema(plain.schema).option("maxFilesPerTrigger", _per_batch(spark, source, 3)).parquet(source)
    dictionary = load_tag_dictionary(spark, inputs.dictionary_folder(spark, sf_dir))
    _finish(missing_tags.queue_missing_tags(
        arriving, WORDS, dictionary, f"{run}/out", f"{run}/checkpoint", partitions=fx.parts(spark, sf_dir)
    ))
    batches = missing_tags.lookup_batches(spark, f"{run}/out", finished=True)
    return batches.select(F.explode(F.split("names", " ")).alias("name"))
