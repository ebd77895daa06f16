"""Token counts: lengths only, from an Arrow function.

A task takes its texts in steps of even size in characters; texts above a step are cut at safe
boundaries and their parts counted apart, so that memory does not follow the longest text. Within a
step each distinct piece is encoded once by the library and its length added up per text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postlake.llm.pieces import byte_level_pieces, counted_rows, small_batches
from postlake.llm.tokenizers_files import library_table


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row of ``docs``, in the library's counting.

    ``path``: a byte-level vocabulary of the tokenizers library. A null or empty text has no bytes and
    no tokens. Null and repeated ids keep a row each. Other columns are not carried, so that none
    clashes. An empty table gives no rows. A text without a safe boundary is encoded whole.
    """

    def run(batches):
        table = library_table(path)
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            sizes = np.array([len((text or "").encode()) for text in texts], np.int64)
            counts = counted_rows(texts, table, byte_level_pieces)
            yield pa.record_batch({
                id_col: batch.column("id"), "n_bytes": pa.array(sizes), "n_tokens": pa.array(counts),
                "over_limit": pa.array(counts > limit),
            })

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"{id_col} BIGINT, n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN")
