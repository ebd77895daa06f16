"""Phrases that hold together, by dynamic itemset counting.

Texts become blocks of word numbers, dealt to a few shards that are scanned in turn, over and over.
Words are counted from the first scan on; a phrase is counted from the scan after both phrases of one
word less inside it (all but its last word, all but its first) reached the threshold, whatever their
own counting still has to see, and until it has met every shard once. So lengths interleave, and
only phrases that can still be frequent are counted. A phrase that ends its cycle below is forgotten.

A block is a bounded number of words; its places are files of the shared folder that its tasks read.
What is known of its words and phrases comes to it by joins of its distinct ones, never as a whole.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlake.llm.pieces import small_batches
from postlake.llm.token_files import _open
from postlake.operators.skew import join_even
from postlake.session import cut_lineage, shared_dir, shuffle_partitions

#: Shards of a cycle, and words of a block (a batch of texts of 4 MB may come on top).
SHARDS = 2
BLOCK_WORDS = 1 << 21
LONGEST = 4
#: Phrases of a block that are listed in one row: at most 65,536.
LIST_BITS = 16
_BREAKS = b".,;:!?\x0b\x0c\r"
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _BREAKS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(_BREAKS)
)
#: A task holds the rows of few buckets: it keeps a file of each open and need not sort its rows by bucket.
_WRITERS = 8
_ROW_BITS = (1 << 33) - 1
_PAIR = "block BIGINT, local INT, x BIGINT, y BIGINT, n BIGINT, active INT"


class _Codes(dict):
    """Numbers from 1 for the words of one language in the block; 0 is a break, -1 nothing."""

    def __init__(self, lang: str, names: list[tuple[str, bytes]]):
        super().__init__({b"": -1, b"\n": 0})
        self._lang, self._names = lang, names

    def __missing__(self, word: bytes) -> int:
        self._names.append((self._lang, word))
        self[word] = code = len(self._names)
        return code


def _save(folder: str, name: str, values: np.ndarray) -> None:
    system, root = _open(folder)
    with system.open_output_stream(f"{root}/{name}") as out:
        out.write(len(values).to_bytes(8, "little"))
        out.write(pa.compress(values.astype("<i4").tobytes(), "zstd", asbytes=True))


def _load(folder: str, name: str) -> np.ndarray:
    system, root = _open(folder)
    with system.open_input_stream(f"{root}/{name}") as source:
        size = int.from_bytes(source.read(8), "little")
        return np.frombuffer(pa.decompress(source.read(), 4 * size, "zstd", asbytes=True), "<i4")


def word_blocks(docs: DataFrame, folder: str, shards: int, block_words: int, lang_col: str, text_col: str) -> DataFrame:
    """(shard, block, local, lang, word, n): the distinct words of each block; its words in order
    lie in ``folder``. A block has a number of its own attempt, so that a task run again, or twice at
    once, leaves files that no row names."""

    def run(batches):
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        part, closed = TaskContext.get().partitionId(), 0
        names, languages, held, size = [], {}, [], 0

        def close():
            nonlocal names, languages, held, size, closed
            block, places = uuid.uuid4().int >> 65, np.concatenate(held)
            _save(folder, f"{block}-1-0", places)
            counts = np.bincount(places, minlength=len(names) + 1)[1:]
            for start in range(0, len(names), 1 << 16):
                chosen = names[start:start + (1 << 16)]
                yield pa.record_batch({
                    "shard": pa.array(np.full(len(chosen), (part + closed) % shards), pa.int32()),
                    "block": pa.array(np.full(len(chosen), block)),
                    "local": pa.array(np.arange(start + 1, start + 1 + len(chosen)), pa.int32()),
                    "lang": pa.array([lang for lang, _ in chosen], pa.string()),
                    "word": pa.array([word for _, word in chosen], pa.string()),
                    "n": pa.array(counts[start:start + len(chosen)]),
                })
            names, languages, held, size, closed = [], {}, [], 0, closed + 1

        for batch in small_batches(batches, "text", 4 << 20):
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, some in texts.items():
                if lang not in languages:
                    languages[lang] = _Codes(lang, names)
                words = b"\n".join([*some, b""]).translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
                codes = np.fromiter(map(languages[lang].__getitem__, words), np.int32, len(words))
                held.append(codes[codes >= 0])
                size += len(held[-1])
            if size >= block_words:
                yield from close()
        if names:
            yield from close()

    rows = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    ).where("text <> ''")
    return rows.mapInArrow(run, "shard INT, block BIGINT, local INT, lang STRING, word STRING, n BIGINT")


def _pairs(known: DataFrame, folder: str, length: int, before: int, step: int) -> DataFrame:
    """The distinct phrases of ``length`` words in the blocks of ``known`` (block, local, id, reached:
    lists of the phrases of one word less that reached the threshold), with their counts and the step from
    which they count. Their places lie in ``folder``, those of the shorter ones since step ``before``."""

    def run(key, table):
        block = key[0].as_py()
        places = _load(folder, f"{block}-{length - 1}-{before}")
        most = int(places.max()) + 1
        ids, reached = np.full(most, -1, np.int64), np.zeros(most, np.int32)
        local = np.array(pc.list_flatten(table.column("local")))
        ids[local], reached[local] = np.array(pc.list_flatten(table.column("id"))), np.array(pc.list_flatten(table.column("reached")))
        known_here = ids[places] >= 0
        starts = np.flatnonzero(known_here[:-1] & known_here[1:])
        both = places[starts].astype(np.int64) << 32 | places[starts + 1]
        both, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
        found = np.zeros(len(places), np.int32)
        found[starts] = inverse + 1
        _save(folder, f"{block}-{length}-{step}", found)
        x, y = both >> 32, both & 0xFFFFFFFF
        return pa.table({
            "block": pa.array(np.full(len(both), block)), "local": pa.array(np.arange(1, len(both) + 1), pa.int32()),
            "x": pa.array(ids[x]), "y": pa.array(ids[y]), "n": pa.array(counts),
            "active": pa.array(np.maximum(reached[x], reached[y]) + 1, pa.int32()),
        })

    return known.groupBy("block").applyInArrow(run, _PAIR)


class _Tables:
    """Rows of blocks saved as tables bucketed on the block, so that what is looked up for a block stays
    where the block is."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder, self._names = spark, folder, f"phrases_{uuid.uuid4().hex}"

    def save(self, rows: DataFrame, name: str, partition: list[str]) -> DataFrame:
        table, setting = f"{self._names}_{name}", "spark.sql.maxConcurrentOutputFileWriters"
        before = self._spark.conf.get(setting)
        self._spark.conf.set(setting, str(_WRITERS))
        writer = rows.write.format("parquet").option("path", f"{self._folder}/{name}").bucketBy(shuffle_partitions(self._spark), "block")
        try:
            (writer.partitionBy(*partition) if partition else writer).saveAsTable(table)
        finally:
            self._spark.conf.set(setting, before)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self._spark.table(f"{self._names}_{name}")

    def drop(self, name: str, files: bool = True) -> None:
        self._spark.sql(f"DROP TABLE IF EXISTS {self._names}_{name}")
        if files:
            _remove(f"{self._folder}/{name}")


def _remove(path: str) -> None:
    system, root = _open(path)
    system.delete_dir(root)


def _added(
    state: DataFrame | None, fresh: DataFrame, keys: list[str], step: int, cycle: int, least: int, first_id: int
) -> DataFrame:
    """Counts of ``state`` and this scan's together. Phrases that reach the threshold get an id from
    ``first_id`` on; those that ended their cycle below it go."""
    both = fresh.where(F.col("active") + cycle > step).select(*keys, "n", "active")
    if state is not None:
        both = both.unionByName(state, allowMissingColumns=True)
        sums = [F.max("id").alias("id"), F.max("reached").alias("reached")]
    else:
        sums = [F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("int").alias("reached")]
    total = both.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("active").alias("active"), *sums)
    new = F.col("id").isNull() & (F.col("n") >= least)
    # Small numbers shuffle in fewer bytes: the row in its partition, then the partition.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    number = row * shuffle_partitions(fresh.sparkSession) + F.spark_partition_id()
    counted = total.withColumns({
        "id": F.when(new, number + F.lit(first_id)).otherwise(F.col("id")),
        "reached": F.when(new, F.lit(step)).otherwise(F.col("reached")),
    })
    return counted.where(F.col("id").isNotNull() | (F.col("active") + cycle > step + 1))


class _Counting:
    """The counts of all lengths while shards are scanned: ``state[k]`` holds phrases of k words.

    Where all shorter phrases have completed their cycles, the distinct phrases of a shard stay what
    they are, and a later scan of it starts from them.
    """

    def __init__(self, blocks: DataFrame, folder: str, tables: _Tables, longest: int, least: int):
        self.blocks, self.folder, self.tables, self.longest, self.least = blocks, folder, tables, longest, least
        self.shards = sorted(row["shard"] for row in blocks.select("shard").distinct().collect())
        self.state: dict[int, DataFrame] = {}
        self.reached: dict[int, int | None] = {}  # the last step at which a phrase of k words reached it
        self._next_id: dict[int, int] = {}
        self._paths: dict[int, str] = {}
        self._settled: dict[int, tuple[int, int]] = {}  # shard: (length, step) of phrases that stay

    def _open(self, length: int, step: int) -> bool:
        """Whether phrases of ``length`` words may be counted at ``step``."""
        if length == 1:
            return step < len(self.shards)
        last = self.reached.get(length - 1)
        return last is not None and last < step <= last + len(self.shards)

    def _closed(self, length: int, step: int) -> bool:
        """Whether no phrase of ``length`` words or less is counted from ``step`` on."""
        return not any(self._open(k, step) for k in range(1, length + 1))

    def _keep(self, length: int, frame: DataFrame, step: int) -> None:
        spark, old = frame.sparkSession, self._paths.get(length)
        path = f"{self.folder}/state-{length}-{step}"
        frame.write.parquet(path)
        self.state[length] = spark.read.schema(frame.schema).parquet(path)
        self._paths[length] = path
        self.reached[length], highest = self.state[length].agg(F.max("reached"), F.max("id")).first()
        self._next_id[length] = (highest or 0) + 1
        if old:
            _remove(old)

    def _known(self, length: int, rows: DataFrame) -> DataFrame:
        """The distinct words or phrases of blocks that reached the threshold, with their ids: lists of
        bounded length, so that few rows are sorted by block. Most words are rare and go in the join;
        phrases of known words stay in their place, and the lists leave out those without an id."""
        keys, how = (["lang", "word"], "inner") if length == 1 else (["x", "y"], "left")
        reached = self.state[length].where("id IS NOT NULL").select(*keys, "id", "reached")
        known = join_even(rows.select("block", "local", *keys), reached, keys, F.xxhash64("block", "local"), how=how)
        lists = [F.collect_list(F.when(F.col("id").isNotNull(), F.col(name))).alias(name) for name in ("local", "id", "reached")]
        return known.groupBy("block", F.shiftright("local", LIST_BITS).alias("_list")).agg(*lists)

    def scan(self, step: int) -> None:
        """Count one shard."""
        cycle = len(self.shards)
        shard = self.shards[step % cycle]
        deepest = max((k for k in range(1, self.longest + 1) if self._open(k, step)), default=0)
        start, before = self._settled.get(shard, (1, 0))
        rows = self.blocks.where(F.col("shard") == shard).withColumn("active", F.lit(0))
        if start > 1:
            rows = self.tables.read(f"scan_{start}_{before}")
        fresh: dict[int, DataFrame] = {start: rows} if self._open(start, step) else {}
        done = []
        for length in range(start + 1, deepest + 1):
            known = self._known(length - 1, rows)
            found = _pairs(known, f"{self.folder}/places", length, before if length == start + 1 else step, step)
            rows = self.tables.save(found, f"scan_{length}_{step}", [])
            if self._open(length, step):
                fresh[length] = rows
            if self._closed(length - 1, step):
                old_length, old_step = self._settled.get(shard, (1, 0))
                done += [f"scan_{old_length}_{old_step}"] if old_length > 1 else []
                self._settled[shard] = (length, step)
            else:
                done.append(f"scan_{length}_{step}")
        for length, some in fresh.items():
            keys = ["lang", "word"] if length == 1 else ["x", "y"]
            added = _added(self.state.get(length), some, keys, step, cycle, self.least, self._next_id.get(length, 0))
            self._keep(length, added, step)
        for name in done:
            self.tables.drop(name)

    def run(self) -> dict[int, DataFrame]:
        """Scan shards in turn until every phrase has completed a cycle."""
        step = 0
        while not self._closed(self.longest, step):
            self.scan(step)
            step += 1
        for length, at in self._settled.values():
            self.tables.drop(f"scan_{length}_{at}")
        if self.shards:
            _remove(f"{self.folder}/places")
        return self.state


def frequent_phrases(
    docs: DataFrame, least: int = 30, longest: int = LONGEST, shards: int = SHARDS, block_words: int = BLOCK_WORDS,
    lang_col: str = "lang", text_col: str = "text",
) -> tuple[dict[int, DataFrame], DataFrame]:
    """({k: phrases of k words}, sizes): the phrases of 1 to ``longest`` words met ``least`` times or
    more in a language, with exact counts, and (lang, total): all words of each language.

    Phrases of one word are (id, n, lang, word), longer ones (id, n, x, y): the ids of the phrases of
    one word less at their beginning and end. A-Z become lower case, marks and line ends split texts
    into pieces, blanks pieces into words; no phrase crosses a piece. A null text is empty, a null
    language ``und``; repeated rows count each time. No words give no phrases.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/phrases/{uuid.uuid4().hex}"
    tables = _Tables(spark, folder)
    blocks = tables.save(word_blocks(docs, f"{folder}/places", shards, block_words, lang_col, text_col), "blocks", ["shard"])
    state = _Counting(blocks, folder, tables, longest, least).run()
    reached = {k: frame.where("id IS NOT NULL") for k, frame in state.items()}
    sizes = cut_lineage(blocks.groupBy("lang").agg(F.sum("n").alias("total")))
    tables.drop("blocks")
    return reached, sizes


def _spelled(phrases: dict[int, DataFrame]) -> dict[int, DataFrame]:
    """Phrases of 2 words and more as (id, n, x, y, lang, phrase, heads, tails): counts of the phrases
    they begin with (1 word, 2 words, ...) and of those they end with."""
    none = F.array().cast("array<bigint>")
    spelled = {}
    part = phrases[1].select("id", "n", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), none.alias("heads"), none.alias("tails"))
    for length in sorted(phrases)[1:]:
        head = part.select(F.col("id").alias("x"), "lang", F.col("phrase").alias("_head"), F.concat("heads", F.array("n")).alias("heads"))
        tail = part.select(F.col("id").alias("y"), "last", F.concat("tails", F.array("n")).alias("tails"))
        joined = phrases[length].select("id", "n", "x", "y").join(head, "x").join(tail, "y")
        phrase = F.concat_ws(" ", "_head", "last").alias("phrase")
        part = cut_lineage(joined.select("id", "n", "x", "y", "lang", phrase, "last", "heads", "tails"))
        spelled[length] = part
    return spelled


def collocations(
    docs: DataFrame, least: int = 30, longest: int = LONGEST, share: int = 80, top: int = 2000, shards: int = SHARDS,
    block_words: int = BLOCK_WORDS, lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``longest`` words of each
    language by their weakest cut.

    Cutting a phrase met ``a`` times after its first words gives ``l``, ``r``, the counts of its two
    parts, and floor(2000000 a / (l + r)); the lowest counts, of equal ones that of the shortest first
    part. A phrase goes where a longer one holds it and has ``share`` percent of its count or more.
    Ties in score go by ``a``, falling, then by the phrase. ``n``: all words of the language. See
    ``frequent_phrases`` for nulls, repeats and empty tables; other columns are not read.
    """
    phrases, sizes = frequent_phrases(docs, least, longest, shards, block_words, lang_col, text_col)
    shape = "lang STRING, rank BIGINT, phrase STRING, a BIGINT, l BIGINT, r BIGINT, n BIGINT, score BIGINT"
    spelled = _spelled(phrases) if phrases else {}
    if not spelled:
        return docs.sparkSession.createDataFrame([], shape)
    scored = None
    for length, some in spelled.items():
        if length + 1 in spelled:
            # A longer phrase that holds it is at most as frequent as one of a word more inside that.
            longer = spelled[length + 1]
            around = longer.select(F.col("x").alias("id"), "n").unionByName(longer.select(F.col("y").alias("id"), "n"))
            held = around.groupBy("id").agg(F.max("n").alias("_longer"))
            some = some.join(held, "id", "left").where(F.coalesce(F.lit(100) * F.col("_longer") < F.lit(share) * F.col("n"), F.lit(True)))
        cuts = [
            F.struct(
                F.expr(f"CAST(n AS DECIMAL(19, 0)) * 2000000 div CAST(heads[{k - 1}] + tails[{length - k - 1}] AS DECIMAL(19, 0))").alias("score"),
                F.lit(k).alias("k"), F.col("heads")[k - 1].alias("l"), F.col("tails")[length - k - 1].alias("r"),
            )
            for k in range(1, length)
        ]
        weakest = F.least(*cuts) if len(cuts) > 1 else cuts[0]
        rows = some.select("lang", "phrase", F.col("n").alias("a"), weakest.alias("_cut"))
        scored = rows if scored is None else scored.unionByName(rows)
    scored = scored.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    # The first of every slice of a language, then the first of those: no task orders a whole language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slices = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs.sparkSession)))).orderBy(*order)
    first = scored.withColumn("_at", F.row_number().over(slices)).where(F.col("_at") <= top).drop("_at")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
