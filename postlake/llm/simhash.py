"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

The trie is walked as pairs of nodes of one depth. A pair carries the bits its two prefixes differ in;
it falls as soon as they exceed the budget, else it opens into the pairs of its children. Over the
cluster, pairs open two bits a round while a node holds more fingerprints than a task should; each
remaining pair becomes one task's work, which goes on bit by bit over sorted arrays. Equal
fingerprints meet before the walk, so copies never meet as pairs, and a task returns a spanning forest
of its links, so that a dense group of near copies leaves no more rows than it has fingerprints.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from postlake.llm.components import components, forest
from postlake.llm.pieces import small_batches
from postlake.session import cut_lineage

SEED = 42
#: Fingerprints below one node from which a pair of nodes is opened over the cluster.
NODE_LIMIT = 8192
_STEP = 2  # bits a round
_CHUNK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """64 bits: bit i is set if it is set in over half the hashes of the word shingles of ``text``.

    Words are runs without ASCII white space, A-Z in lower case; fewer words than a shingle are one
    shingle; no word gives 0. Long texts are counted in chunks.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(gram) for gram in zip(*(words[i:] for i in range(shingle)))]
    counts = np.zeros(64, np.int64)
    for start in range(0, len(grams), _CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(gram, SEED) for gram in grams[start:start + _CHUNK]], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(grams)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp BIGINT) for each row. A null or empty text has fingerprint 0."""

    def run(batches):
        for batch in small_batches(batches, "text", 2 << 20):
            found = np.array([fingerprint_of(text) for text in batch.column("text").to_pylist()], np.uint64)
            yield pa.record_batch({id_col: batch.column("id"), "fp": pa.array(found.view(np.int64))})

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"{id_col} BIGINT, fp BIGINT")


def near_pairs(left: np.ndarray, right: np.ndarray | None, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of fingerprints that differ in at most ``budget`` bits, of two sorted arrays, or of
    one with itself (``right`` None, i < j), by walking both tries together from the root."""
    same_tree = right is None
    right = left if same_tree else right
    found_a, found_b = [], []
    if not len(left) or not len(right):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # One row per pair of nodes: the ranges of both, the bits that differ, and whether they are one node.
    al, ah, bl, bh = (np.array([x]) for x in (0, len(left), 0, len(right)))
    bits, same = np.zeros(1, np.int64), np.array([same_tree])
    for bit in range(63, -1, -1):
        if not len(al):
            break
        ones_a = np.concatenate([[0], np.cumsum((left >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)])
        ones_b = ones_a if same_tree else np.concatenate(
            [[0], np.cumsum((right >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)]
        )
        am, bm = ah - (ones_a[ah] - ones_a[al]), bh - (ones_b[bh] - ones_b[bl])
        children = (
            (al, am, bl, bm, bits, same), (am, ah, bm, bh, bits, same),
            (al, am, bm, bh, bits + 1, np.zeros_like(same)),
            (am, np.where(same, am, ah), bl, bm, bits + 1, np.zeros_like(same)),
        )
        al, ah, bl, bh, bits, same = (np.concatenate(column) for column in zip(*children))
        keep = (ah > al) & (bh > bl) & (bits <= budget) & ~(same & (ah - al == 1))
        al, ah, bl, bh, bits, same = (column[keep] for column in (al, ah, bl, bh, bits, same))
        single = (ah - al == 1) & (bh - bl == 1)  # what is left of both is known at once
        if single.any():
            i, j = al[single], bl[single]
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            found_a.append(i[near])
            found_b.append(j[near])
            al, ah, bl, bh, bits, same = (column[~single] for column in (al, ah, bl, bh, bits, same))
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _prefix(depth: int):
    return F.shiftrightunsigned("fp", 64 - depth)


def _open_pairs(classes: DataFrame, budget: int, limit: int) -> list[tuple[int, DataFrame]]:
    """(depth, pairs (a, b, na, nb) of node prefixes) whose nodes hold at most ``limit`` fingerprints."""
    spark = classes.sparkSession
    pairs = spark.createDataFrame([(0, 0, 0)], "a BIGINT, b BIGINT, bits INT")
    members, leaves = classes, []
    for depth in range(_STEP, 65, _STEP):
        # Equal prefixes are combined before the shuffle; a node's children are at most four rows.
        nodes = members.groupBy(_prefix(depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))
        nodes = nodes.withColumn("parent", F.shiftright("node", _STEP)) if depth > _STEP else nodes.withColumn("parent", F.lit(0).cast("long"))
        nodes = cut_lineage(nodes)
        left = nodes.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("parent").alias("a"))
        right = nodes.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("parent").alias("b"))
        opened = pairs.join(left, "a").join(right, "b").select(
            F.col("x").alias("a"), F.col("y").alias("b"), "nx", "ny",
            (F.col("bits") + F.bit_count(F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(F.lit((1 << _STEP) - 1)))).cast("int").alias("bits"),
        ).where((F.col("bits") <= budget) & (F.col("a") <= F.col("b")))
        opened = cut_lineage(opened)
        large = (F.greatest("nx", "ny") > limit) & F.lit(depth < 64)
        leaves.append((depth, opened.where(~large)))
        pairs = opened.where(large).select("a", "b", "bits")
        if pairs.isEmpty():
            break
        wide = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        members = cut_lineage(members.join(wide, _prefix(depth) == F.col("node"), "left_semi"))
    return leaves


def near_links(classes: DataFrame, budget: int = 2, limit: int = NODE_LIMIT) -> DataFrame:
    """Links (a, b) between fingerprints ``fp`` (distinct) that differ in at most ``budget`` bits: a
    spanning forest of those that each pair of subtries holds, which keeps every component whole."""
    seats = None
    for depth, leaves in _open_pairs(classes, budget, limit):
        pair = F.xxhash64(F.lit(depth), "a", "b")
        seat = leaves.select(
            pair.alias("pair"),
            F.explode(F.when(F.col("a") == F.col("b"), F.array("a")).otherwise(F.array("a", "b"))).alias("node"),
            "a",
        ).select("pair", "node", (F.col("node") != F.col("a")).alias("second"))
        seat = classes.select("fp", _prefix(depth).alias("node")).join(seat, "node").select("pair", "second", "fp")
        seats = seat if seats is None else seats.unionByName(seat)

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fp"].to_numpy().view(np.uint64)
        second = rows["second"].to_numpy()
        left, right = np.sort(values[~second]), np.sort(values[second])
        i, j = near_pairs(left, right if len(right) else None, budget)
        every = np.concatenate([left, right])
        label = forest(len(every), i, j + len(left) if len(right) else j)
        moved = np.flatnonzero(label != np.arange(len(every)))
        return pd.DataFrame({"a": every[moved].view(np.int64), "b": every[label[moved]].view(np.int64)})

    return seats.groupBy("pair").applyInPandas(walk, "a BIGINT, b BIGINT")


def near_duplicates(docs: DataFrame, budget: int = 2, limit: int = NODE_LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint of 16 hex digits, component_id, component) for each row of ``docs``.

    Rows are linked if their fingerprints differ in at most ``budget`` bits; ``component_id`` is the
    smallest id reachable, the row's own included; ``component`` names the component also where no row
    has an id. A null id keeps its row and is never the smallest
    unless its component has no other. Null and empty texts have fingerprint 0 and link like any
    other. Repeated rows keep a row each. Other columns are not carried; an empty table gives none.
    """
    prints = cut_lineage(fingerprints(docs, id_col, text_col).withColumnRenamed(id_col, "_id"))
    classes = cut_lineage(prints.groupBy("fp").agg(F.min("_id").alias("_first")))
    linked = cut_lineage(components(near_links(classes, budget, limit)))
    known = classes.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "_first", F.coalesce("component", "fp").alias("component")
    )
    smallest = known.groupBy("component").agg(F.min("_first").alias("component_id"))
    of_class = known.select("fp", "component").join(smallest, "component")
    return prints.join(of_class, "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id", "component",
    )


@F.pandas_udf(LongType())
def _fingerprint_column(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint_of(text) for text in texts], np.uint64).view(np.int64))


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component of ``found`` (from ``near_duplicates``) the
    row of its smallest id; of several rows under that id in the component the one of the smallest text;
    where no row of a component has an id, the one of the smallest text. An id that is the smallest of
    several components keeps a row in each.

    Ids are counted apart from the texts, and only rows under a repeated id or none are ranked.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.struct(*map(F.col, docs.columns)).alias("row"))
    order = F.struct(*(F.col("row")[c] for c in [text_col, *(c for c in docs.columns if c != text_col)]))
    own = F.col(id_col) == F.col("component_id")
    first = found.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.count(F.lit(1)).alias("n"), F.max(own).alias("own")
    ).where("own").select("id", "n")
    # As many ids as documents: a shuffle join at every size, never a broadcast while they happen to be few.
    kept = rows.join(cut_lineage(first).hint("merge"), "id")
    once = kept.where("n = 1").select("row.*")
    smallest = F.min_by("row", order).alias("row")
    fp = F.conv("fingerprint", 16, -10).cast("long").alias("fp")
    # Other rows of a repeated id may be in components of smaller ids.
    there = found.where(own).select(F.col(id_col).alias("id"), fp, "component").distinct()
    again = kept.where("n > 1").withColumn("fp", _fingerprint_column(F.col("row")[text_col])).join(there, ["id", "fp"])
    again = again.groupBy("id", "component").agg(smallest).select("row.*")
    nameless = found.where("component_id IS NULL").select(fp, "component").distinct()
    lost = rows.where("id IS NULL").withColumn("fp", _fingerprint_column(F.col("row")[text_col])).join(nameless, "fp")
    return once.unionByName(again).unionByName(lost.groupBy("component").agg(smallest).select("row.*"))
