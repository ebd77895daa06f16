"""Language identification by Bayesian fusion of what is known of a document.

Four kinds of evidence meet: the likelihood of the text under byte-trigram models, the language its
markup declares, the suffix of its address, and the host's habit. The trigram counts, the confusion of
declared with found languages and the host counts are grouped aggregations over all documents; a host's
prior is smoothed towards its domain's, that towards its suffix's, and that towards the whole corpus.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.pieces import small_batches
from postlake.session import cut_lineage

LANGUAGES = ("de", "en", "es", "fr")
BUCKETS = 1 << 13
#: Trigrams from which on more text adds no evidence: neighbours in a text are not independent.
SATURATION = 100
#: Documents' worth of its parent's prior that a host, domain or suffix starts with.
STRENGTH = 20.0
LEAST_POSTERIOR = 0.5
#: Bytes of text whose trigrams a worker holds at once, in some fifty times their memory.
BATCH_BYTES = 1 << 20

_SPACE = 32
_FOLD = np.full(256, _SPACE, np.uint8)
_FOLD[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row of each trigram, bucket): trigrams of letters and spaces, no two spaces side by side; all
    else counts as a space."""
    data = [f" {text} ".encode() if text else b"" for text in texts]
    folded = _FOLD[np.frombuffer(b"".join(data), np.uint8)]
    rows = np.repeat(np.arange(len(texts)), [len(one) for one in data])
    if len(folded) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = folded == _SPACE
    keep = np.append(True, ~(space[1:] & space[:-1] & (rows[1:] == rows[:-1])))
    folded, rows = folded[keep].astype(np.uint32), rows[keep]
    code = (folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]) * np.uint32(2654435761)
    whole = rows[:-2] == rows[2:]
    return rows[:-2][whole], (code >> np.uint32(32 - 13)).astype(np.int64)[whole]


def trigram_counts(docs: DataFrame, declared: str, languages: tuple[str, ...], text_col: str = "text") -> DataFrame:
    """(language, bucket, n): trigram counts of all documents by the language each declares. A task
    sends one row per language and bucket at most."""

    def run(batches):
        totals = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in small_batches(batches, "text", BATCH_BYTES):
            rows, buckets = trigrams(batch.column("text").to_pylist())
            place = pd.Index(languages).get_indexer(pd.Index(batch.column("declared").to_pylist(), dtype=object))
            which = place[rows]
            known = which >= 0
            totals += np.bincount(which[known] * BUCKETS + buckets[known], minlength=totals.size).reshape(totals.shape)
        at, bucket = np.nonzero(totals)
        yield pa.record_batch({
            "language": pa.array(at, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "n": pa.array(totals[at, bucket]),
        })

    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(declared).cast("string").alias("declared"))
    counts = rows.mapInArrow(run, "language INT, bucket INT, n BIGINT")
    return counts.groupBy("language", "bucket").agg(F.sum("n").alias("n"))


def text_model(counts: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """log P(bucket | language), buckets by languages: a table of fixed size, whatever the corpus."""
    totals = np.full((BUCKETS, len(languages)), 0.5)
    for row in counts.collect():  # at most BUCKETS rows per language
        totals[row["bucket"], row["language"]] += row["n"]
    return np.log(totals / totals.sum(axis=0)).astype(np.float32)


def text_scores(docs: DataFrame, model: np.ndarray, keep: dict[str, str], text_col: str = "text") -> DataFrame:
    """The columns of ``keep`` (new name to column) with ``n_trigrams``, ``text_hash`` and ``scores``:
    the log likelihood of the text under each language, saturated."""
    columns = list(keep)

    def run(batches):
        for batch in small_batches(batches, "_text", BATCH_BYTES):
            rows, buckets = trigrams(batch.column("_text").to_pylist())
            n = batch.num_rows
            counts = np.bincount(rows, minlength=n)
            sums = np.zeros((n, model.shape[1]))
            for at in range(model.shape[1]):
                sums[:, at] = np.bincount(rows, weights=model[buckets, at], minlength=n)
            sums *= np.minimum(1.0, SATURATION / np.maximum(counts, 1))[:, None]
            sums -= sums.max(axis=1, keepdims=True)
            yield pa.record_batch(
                [batch.column(c) for c in [*columns, "text_hash"]] + [
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1) * model.shape[1], pa.int32()), pa.array(sums.ravel(), pa.float64())
                    ),
                ], names=[*columns, "text_hash", "n_trigrams", "scores"],
            )

    rows = docs.select(
        *(F.col(old).alias(new) for new, old in keep.items()), F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).cast("string").alias("_text"),
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_text")
    return rows.mapInArrow(run, f"{schema}, n_trigrams BIGINT, scores ARRAY<DOUBLE>")


def page_evidence(pages: DataFrame) -> DataFrame:
    """(doc_id, markup, host) of the pages that show a document: the number in the path is its id. Of
    several pages of one document the first that declares a language gives ``markup``, the first with
    a host ``host``."""
    path = F.regexp_extract("url", r"(?i)^[a-z]+://[^/]*/(?:[a-z]+/)?(\d+)", 1)
    found = pages.select(
        path.alias("_n"), "page_id",
        F.lower(F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([A-Za-z]{2})", 1)).alias("markup"),
        F.lower(F.regexp_extract("url", r"(?i)^[a-z]+://([^/:?#]+)", 1)).alias("host"),
    ).where("_n != ''").select(F.col("_n").try_cast("bigint").alias("doc_id"), "page_id", "markup", "host")

    def first(name):
        place = F.struct(F.col("page_id").isNull().alias("last"), "page_id", name)
        return F.min(F.when(F.col(name) != "", place))[name].alias(name)

    return found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(first("markup"), first("host"))


def _levels(host):
    """Domain and suffix of a host: its last two labels and its last; a bare name is its own domain."""
    return {
        "domain": F.substring_index(host, ".", -2),
        "suffix": F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1)).otherwise(F.lit("")),
        "corpus": F.lit(0),
    }


def _smoothed(counts: DataFrame, key: str, parent: str, above: DataFrame, k: int) -> DataFrame:
    """(key, prior array) of every value of ``key``, shrunk towards its parent's prior."""
    names = [f"n{i}" for i in range(k)]
    total = sum((F.col(n) for n in names), F.lit(0.0))
    sums = counts.groupBy(key, parent).agg(*(F.sum(n).alias(n) for n in names))
    sums = sums.join(above.withColumnRenamed("prior", "_above"), parent)
    prior = F.array(*(
        (F.col(n) + F.col("_above")[i] * STRENGTH) / (total + STRENGTH) for i, n in enumerate(names)
    ))
    return sums.select(key, prior.alias("prior"))


def identify(
    docs: DataFrame, evidence: DataFrame | None = None, languages: tuple[str, ...] = LANGUAGES, least: float = LEAST_POSTERIOR,
    id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang", host_col: str = "source",
) -> DataFrame:
    """(id, text_hash, language, posterior, kept) for each row of ``docs``.

    ``evidence`` (doc_id, markup, host) comes before the row's own declared language and host. A row
    is rejected (``kept`` false) if its text has no letters, where ``language`` is null, or if no
    language reaches ``least``. A null or unknown declared language, or a null host, is no evidence.
    Texts that are null are empty. Rows with a null or repeated id are judged each; an empty table gives
    none. Other columns are not carried.
    """
    k = len(languages)
    model = text_model(trigram_counts(docs, declared_col, languages, text_col), languages)
    scored = text_scores(docs, model, {"_id": id_col, "_declared": declared_col, "_host": host_col}, text_col)
    scored = scored.withColumns({"_declared": F.lower(F.col("_declared").cast("string")), "_host": F.col("_host").cast("string")})
    if evidence is not None:
        pages = evidence.select(F.col("doc_id").alias("_page"), "markup", "host")
        scored = scored.join(pages, F.col("_id") == F.col("_page"), "left").withColumns({
            "_declared": F.coalesce("markup", "_declared"), "_host": F.coalesce("host", "_host"),
        }).drop("_page", "markup", "host")
    known = F.array_position(F.array(*map(F.lit, languages)), F.col("_declared")).cast("int")
    scored = scored.withColumns({
        "_best": F.when(F.col("n_trigrams") > 0, F.array_position("scores", F.array_max("scores")).cast("int")),
        "_said": F.when(known > 0, known), "_host": F.coalesce("_host", F.lit("")),
    })
    scored = cut_lineage(scored)

    # What texts say of hosts and of declared languages, over all documents.
    sure = scored.where("_best IS NOT NULL")
    by_host = sure.groupBy("_host").agg(*(F.sum((F.col("_best") == i + 1).cast("double")).alias(f"n{i}") for i in range(k)))
    by_host = cut_lineage(by_host.withColumns(_levels(F.col("_host"))))
    whole = by_host.agg(*(F.sum(f"n{i}") for i in range(k))).first()
    counts = np.array([value or 0.0 for value in whole]) + 1.0
    corpus = docs.sparkSession.createDataFrame([(0, (counts / counts.sum()).tolist())], "corpus INT, prior ARRAY<DOUBLE>")
    suffix = _smoothed(by_host, "suffix", "corpus", corpus, k)
    domain = _smoothed(by_host, "domain", "suffix", suffix, k)
    host = _smoothed(by_host, "_host", "domain", domain, k).withColumnRenamed("_host", "_known").withColumnRenamed("prior", "_prior")
    host = cut_lineage(host)
    said = np.ones((k, k))
    for row in sure.where("_said IS NOT NULL").groupBy("_best", "_said").count().collect():  # languages squared
        said[row["_best"] - 1, row["_said"] - 1] += row["count"]
    said = np.log(said / said.sum(axis=1, keepdims=True))

    def of_said(i: int):
        out = F.lit(0.0)
        for j in range(k):
            out = F.when(F.col("_said") == j + 1, float(said[i, j])).otherwise(out)
        return out

    fused = scored.join(host, F.col("_host") == F.col("_known"), "left")
    flat = F.array(*(F.lit(float(p)) for p in counts / counts.sum()))
    prior = F.coalesce("_prior", flat)
    fused = fused.withColumn("_log", F.array(*(F.col("scores")[i] + of_said(i) + F.log(prior[i]) for i in range(k))))
    top = F.array_max("_log")
    fused = fused.withColumn("_top", top).withColumn(
        "posterior", 1.0 / F.aggregate("_log", F.lit(0.0), lambda so_far, one: so_far + F.exp(one - F.col("_top")))
    )
    named = F.element_at(F.array(*map(F.lit, languages)), F.array_position("_log", F.col("_top")).cast("int"))
    found = F.col("n_trigrams") > 0
    return fused.select(
        F.col("_id").alias(id_col), "text_hash", F.when(found, named).alias("language"),
        F.when(found, F.col("posterior")).otherwise(0.0).alias("posterior"),
        (found & (F.col("posterior") >= least)).alias("kept"),
    )
