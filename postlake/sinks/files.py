"""Files written in parallel. No writer gathers its rows in one task."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions.labels import caption
from postlake.functions.media import shard_of
from postlake.operators.manifest import not_yet_written
from postlake.operators.stats import collect_names
from postlake.sources.dictionary import newest_tags
from postlake.sources.media import open_store

# The section of each kind in the exported document, in document order.
SECTIONS = {"character": "characters", "general": "general", "artist": "artist"}


def write_parquet_zstd(
    df: DataFrame, path: str, mode: str = "errorifexists", source: DataFrame | None = None
) -> bool:
    """Write zstd Parquet; no rows, no output. Row groups are sized by ``parquet.block.size``.

    ``source`` is a cheaper frame that has rows whenever ``df`` has, such as its input before a
    shuffle; only its first row is looked for.
    """
    if (df if source is None else source).isEmpty():
        return False
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return True


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row, NULL fields kept, text unescaped."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def tag_list_lines(ranked: DataFrame) -> DataFrame:
    """(section, position, line): the lines of one JSON document with a name list per kind.

    Read in (section, position) order the lines are the document
    ``{"characters":[...],"general":[...],"artist":[...]}``, so it needs no single row or task.
    """
    names = collect_names(ranked)
    place = F.lit(None).cast("int")
    for at, kind in enumerate(SECTIONS):
        place = F.when(F.col("kind") == kind, at).otherwise(place)
    comma = F.when(F.col("position") == 0, "").otherwise(",")
    quoted = F.to_json(F.array("tag_name"))
    bare = F.substr(quoted, F.lit(2), F.length(quoted) - 2)
    body = names.withColumn("section", place).where("section IS NOT NULL").select(
        "section", "position", F.concat(comma, bare).alias("line")
    )
    last = len(SECTIONS) - 1
    frame = []
    for at, title in enumerate(SECTIONS.values()):
        frame.append((at, -1, ("{" if at == 0 else "") + f'"{title}":['))
        frame.append((at, (1 << 62), "]" + ("}" if at == last else ",")))
    edges = ranked.sparkSession.createDataFrame(frame, "section INT, position BIGINT, line STRING")
    return body.unionByName(edges)


def export_tag_lists(ranked: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The document as text files; read in name order they join to one JSON document."""
    lines = tag_list_lines(ranked).orderBy("section", "position")
    lines.select("line").write.mode(mode).text(path)


def write_sharded(df: DataFrame, path: str, mode: str = "append") -> None:
    """Partition by ``id % 100``. The rebalance splits a shard over as many files as its size
    needs and joins small ones, so no task writes a whole shard."""
    sharded = df.withColumn("shard", shard_of(F.col("id")))
    sharded.hint("rebalance", "shard").write.mode(mode).partitionBy("shard").option(
        "compression", "zstd"
    ).parquet(path)


def write_sharded_metadata(
    records: DataFrame, path: str, existing: DataFrame | None = None
) -> None:
    """Append records to the sharded output, but for those it already holds."""
    new = records if existing is None else not_yet_written(records, existing)
    write_sharded(new, path)


def caption_rows(posts: DataFrame) -> DataFrame:
    return posts.select("id", caption(posts.columns).alias("caption"))


def write_captions(posts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_sharded(caption_rows(posts), path, mode)


def compact_dictionary(spark: SparkSession, path: str, new_path: str) -> DataFrame:
    """A new version of the dictionary with one line per name and no broken lines."""
    newest_tags(spark, path).write.mode("errorifexists").option(
        "ignoreNullFields", "false"
    ).json(new_path)
    return spark.read.json(new_path)


def append_dictionary(tags: DataFrame, path: str) -> None:
    tags.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_media(files: DataFrame, root: str) -> int:
    """Write the bytes of (path, content) rows below ``root``, each row a file of its own, and say how
    many there are. A file appears whole: it is written beside its place and moved there, so a task that
    runs again or twice at once leaves the same file. NULL content is an empty file."""

    def run(batches):
        system, base = open_store(root)
        folders = set()
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                folder = f"{base}/{path}".rpartition("/")[0]
                if folder not in folders:
                    system.create_dir(folder, recursive=True)
                    folders.add(folder)
                part = f"{base}/{path}.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(content or b"")
                system.move(part, f"{base}/{path}")
            yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    written = files.where("path IS NOT NULL").select("path", "content").mapInArrow(run, "n BIGINT")
    return written.agg(F.sum("n")).first()[0] or 0
