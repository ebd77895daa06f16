"""Token ids as binary files: encode texts, write Simple-8b shards in document order, read them back.

Documents are range partitioned and sorted by id; a task encodes its documents one after another and
closes a shard at the first document end beyond ``shard_ids`` ids. A file carries a name of its own
attempt, and only the manifest rows of tasks that succeeded count, so a task run again, or twice at
once, never leaves half a shard in the result. Positions over all files come from one sum per shard.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.pieces import encoded_rows, small_batches, word_pieces
from postlake.llm.simple8b import Shard, pack_shard
from postlake.llm.tokenizers_files import library_table
from postlake.session import cut_lineage, shuffle_partitions

MANIFEST = "part INT, shard INT, path STRING, n_docs BIGINT, n_ids BIGINT, first_doc BIGINT, last_doc BIGINT"


def _open(folder: str):
    """(file system, folder in it); any store pyarrow knows: file, hdfs, s3, gs."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    return fs.FileSystem.from_uri(folder)


def write_shards(
    docs: DataFrame, folder: str, path: str, end_id: int, shard_ids: int = 4_000_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write the ids of every text, each with ``end_id`` behind it, and return the manifest: one row
    for each shard of ``folder``, saved beside them.

    ``path``: a lower-casing vocabulary of the tokenizers library that drops white space. A null or
    empty text is ``end_id`` alone. Null ids come first; rows that share an id follow one another in
    the order of their texts. Other columns are not read. An empty table gives an empty manifest.
    """

    def run(batches):
        table = library_table(path, lower=True)
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        part, attempt, shard = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        ids, lengths, values, held = [], [], [], 0

        def close():
            nonlocal ids, lengths, values, held, shard
            name = f"part-{part:06d}-{shard:05d}-{attempt}.s8b"
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(pack_shard(ids, np.concatenate(lengths), np.concatenate(values)))
            row = pa.record_batch({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "path": pa.array([name]), "n_docs": pa.array([len(ids)], pa.int64()),
                "n_ids": pa.array([held], pa.int64()), "first_doc": pa.array(ids[:1], pa.int64()),
                "last_doc": pa.array(ids[-1:], pa.int64()),
            })
            ids, lengths, values, held, shard = [], [], [], 0, shard + 1
            return row

        for batch in small_batches(batches, "text", 4 << 20):
            texts = batch.column("text").to_pylist()
            found = list(encoded_rows(texts, table, word_pieces))
            rows = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.int64)
            flat = np.concatenate([i for _, i in found]) if found else np.zeros(0, np.int32)
            counts = np.bincount(rows, minlength=len(texts))
            flat = np.insert(flat, np.cumsum(counts), end_id)  # behind each document
            ids += batch.column("id").to_pylist()
            lengths.append(counts + 1)
            values.append(flat)
            held += len(flat)
            if held >= shard_ids:
                yield close()
        if ids:
            yield close()

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_documents(manifest: DataFrame, folder: str, with_ids: bool = False, id_col: str = "doc_id") -> DataFrame:
    """Decode the shards of ``manifest``: (id, start, n_tokens, ids_crc32) per document, and ``ids`` if
    asked for. ``start`` counts the ids of all documents before, over all files."""
    in_part = Window.partitionBy("part").orderBy("shard")
    before = F.coalesce(F.sum("n_ids").over(in_part.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per writing task meets in one place: the partitions of one shuffle.
    totals = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("_before"))
    placed = manifest.withColumn("_in_part", before).join(F.broadcast(parts), "part")
    placed = placed.select("path", (F.col("_before") + F.col("_in_part")).alias("start"))

    def run(batches):
        system, root = _open(folder)
        for batch in batches:
            for name, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with system.open_input_stream(f"{root}/{name}") as source:
                    shard = Shard(source.read())
                rows, size = [], 0
                for at, (doc, values) in enumerate(shard.documents()):
                    ids = values.astype("<u4")
                    rows.append((doc, start + int(shard.doc_offsets[at]), len(ids), zlib.crc32(ids.tobytes()), ids))
                    size += len(ids)
                    if size >= 1 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        columns = {
            id_col: pa.array([r[0] for r in rows], pa.int64()), "start": pa.array([r[1] for r in rows], pa.int64()),
            "n_tokens": pa.array([r[2] for r in rows], pa.int64()),
            "ids_crc32": pa.array([r[3] for r in rows], pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array([r[4].astype(np.int32) for r in rows], pa.list_(pa.int32()))
        return pa.record_batch(columns)

    schema = f"{id_col} BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT"
    placed = cut_lineage(placed)
    # A number given is kept: a shard is work enough for a task, however few bytes its row has.
    tasks = max(1, min(placed.count(), 4 * shuffle_partitions(placed.sparkSession)))
    return placed.repartition(tasks, "path").mapInArrow(run, schema + (", ids ARRAY<INT>" if with_ids else ""))
