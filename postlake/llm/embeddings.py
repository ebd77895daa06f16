"""Embedding near-duplicates by sorted projection passes.

Each pass gives a vector the signs of random projections, of its own, as one key of 64 bits. Sorted by
that key, vectors of a small angle tend to stand close together; each is compared with the ``window``
before it in its pass, and pairs that reach the cosine are united across passes. A projection is cut
where a vector of a sample lies on it, so that a crowded topic, where most of the sample is, is cut most
often.

Passes go on until the links of the sample, found by comparing it with all vectors, are met; as many
again follow, at every size of the input. Links are united to components and then counted exactly inside
each, block by block.

On request every pair is compared instead: distinct vectors are written in files of even size, and tasks
compare each file with every other as matrix products. The same is done where the sample still misses
links after ``MOST_PASSES``.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.llm.components import components, forest
from postlake.session import cut_lineage, shared_dir, shuffle_partitions

#: Vectors of a file that a task compares with every other, and how many of the other a product takes.
FILE_ROWS = 4096
_TILE = 1024
WINDOW = 1024
BITS = 64
#: Passes between two looks at what the sample still misses, and vectors in that sample.
ROUND = 4
SAMPLE = 2048
#: Passes where no vector of the sample has a neighbour to be met.
UNSEEN = 8
#: Passes after which a sample that still misses links asks for all pairs.
MOST_PASSES = 256
#: Share of the sample's links to be met before the passes are doubled.
RECALL = 0.999
#: New rows that a task compares at a time with the window before them.
_CHUNK = 4096
#: Vectors of a component that one task compares with as many others.
BLOCK = 1024
_SPREAD = 20_000


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(len(column), -1)


def _usable(vector: Column) -> Column:
    """Whether a vector can link: not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _projection(seed: int, at: int, width: int) -> np.ndarray:
    return np.random.default_rng([seed, at, width]).standard_normal((width, BITS))


def _cuts(sample: dict[int, np.ndarray], directions: np.ndarray, seed: int, at: int, size: int) -> np.ndarray:
    """Where each direction is cut: at a vector of the sample; at zero without one of that width."""
    units = sample.get(size)
    if units is None:
        return np.zeros(BITS)
    chosen = np.random.default_rng([seed, at, size, 1]).integers(0, len(units), BITS)
    return (units[chosen] * directions.T).sum(axis=1)


def pass_keys(classes: DataFrame, passes: range, seed: int, sample: dict[int, np.ndarray]) -> DataFrame:
    """(pass, size, key, node, vector): each vector once per pass, ``key`` the sides of its cuts."""

    def run(batches):
        planes = {}
        for batch in batches:
            sizes = np.array(batch.column("size"))
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                chosen = batch.take(pa.array(rows))
                units = _unit(_matrix(chosen.column("vector")))
                for at in passes:
                    if (at, size) not in planes:
                        directions = _projection(seed, at, size)
                        planes[at, size] = directions, _cuts(sample, directions, seed, at, size)
                    directions, cuts = planes[at, size]
                    signs = np.packbits(units @ directions > cuts, axis=1)
                    keys = signs.view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)  # sorts as signed
                    yield pa.record_batch({
                        "pass": pa.array(np.full(len(rows), at), pa.int32()), "size": chosen.column("size"),
                        "key": pa.array(keys.view(np.int64)), "node": chosen.column("node"), "vector": chosen.column("vector"),
                    })

    return classes.mapInArrow(run, f"pass INT, size INT, key BIGINT, node BIGINT, vector {_type(classes)}")


def _type(classes: DataFrame) -> str:
    return classes.schema["vector"].dataType.simpleString()


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    values = np.asarray(values, np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values ** 2).sum(axis=1, keepdims=True))


def _window_links(units: np.ndarray, nodes: np.ndarray, groups: np.ndarray, window: int, least: float, fresh: int = 0):
    """Links that unite all pairs reaching ``least`` of a row from ``fresh`` on and one at most ``window``
    places before it, in one group."""
    found_a, found_b = [nodes[:0]], [nodes[:0]]
    for start in range(fresh, len(nodes), _TILE // 2):
        end, low = min(len(nodes), start + _TILE // 2), max(0, start - window)
        at, before = np.arange(start, end)[:, None], np.arange(low, end)
        near = units[start:end] @ units[low:end].T >= least
        near &= (before < at) & (before >= at - window) & (groups[start:end, None] == groups[low:end])
        rows, columns = np.nonzero(near)
        label = forest(end - low, rows + start - low, columns)
        moved = np.flatnonzero(label != np.arange(end - low))
        found_a.append(nodes[low + moved])
        found_b.append(nodes[low + label[moved]])
    return np.concatenate(found_a), np.concatenate(found_b)


def window_links(keyed: DataFrame, window: int, least: float, rows: int) -> DataFrame:
    """Links (a, b) between neighbours of each pass; ``rows`` tells how many rows ``keyed`` has.

    Rows are range partitioned and sorted by (pass, size, key), into partitions of several windows. A
    task compares chunk by chunk, each with the ``window`` rows before it, and hands on its first and
    last ``window`` rows; these meet the neighbouring partitions' in a second, small step.
    """
    kind = _type(keyed)

    def run(batches):
        part = TaskContext.get().partitionId()
        tail, first, seen, held = None, [], 0, []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            if seen < window:
                first.append(table.slice(0, window - seen))
            seen += batch.num_rows
            held.append(table)
            if sum(map(len, held)) >= _CHUNK:
                found, tail = _chunk(tail, held)
                held = []
                yield found
        if held:
            found, tail = _chunk(tail, held)
            yield found
        if tail is not None:
            yield _edge(pa.concat_tables(first), 2 * part)
            yield _edge(tail, 2 * part + 1)

    def _chunk(tail: pa.Table | None, held: list[pa.Table]):
        joined = pa.concat_tables(([] if tail is None else [tail]) + held)
        a, b = _links(joined, window, least, 0 if tail is None else tail.num_rows)
        none = pa.nulls(len(a), pa.int64())
        found = pa.RecordBatch.from_arrays([
            pa.array(a, pa.int64()), pa.array(b, pa.int64()), none, none, pa.nulls(len(a), pa.int32()),
            pa.nulls(len(a), pa.int32()), none, pa.nulls(len(a), joined.schema.field("vector").type),
        ], names=[*_HEAD, *_ROW])
        return found, joined.slice(max(0, joined.num_rows - window))

    def _edge(table: pa.Table, place: int):
        n = table.num_rows
        table = table.combine_chunks()
        return pa.RecordBatch.from_arrays([
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.full(n, place), pa.int64()),
            pa.array(np.arange(n), pa.int64()), *(table.column(c).combine_chunks() for c in _ROW),
        ], names=[*_HEAD, *_ROW])

    schema = f"a BIGINT, b BIGINT, edge BIGINT, place BIGINT, pass INT, size INT, node BIGINT, vector {kind}"
    wide = shuffle_partitions(keyed.sparkSession)
    parts = max(1, min(wide, rows // (4 * window)), rows // (64 * window))
    ordered = keyed.repartitionByRange(parts, "pass", "size", "key", "node").sortWithinPartitions("pass", "size", "key", "node")
    done = cut_lineage(ordered.drop("key").select(*_ROW).mapInArrow(run, schema))

    # Partitions that hold rows, in order: the end of one meets the start of the next.
    edges = done.where("edge IS NOT NULL")
    held = sorted(row[0] for row in edges.where("edge % 2 = 0").select(F.expr("edge div 2")).distinct().collect())
    follows = {p: q for p, q in zip(held, held[1:])}
    if not follows:
        return done.where("a IS NOT NULL").select("a", "b")
    seams = edges.sparkSession.createDataFrame(
        [(2 * p + 1, p, 0) for p in follows] + [(2 * q, p, 1) for p, q in follows.items()], "edge BIGINT, seam BIGINT, side INT",
    )

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "place"])
        a, b = [], []
        for _, same in rows.groupby(["pass", "size"], sort=False):
            units = _unit(np.stack(same["vector"].to_numpy()))
            before = int((same["side"] == 0).sum())
            x, y = _window_links(units, same["node"].to_numpy(), np.zeros(len(same)), window, least, before)
            a.append(x)
            b.append(y)
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    at_seams = edges.join(F.broadcast(seams), "edge").groupBy("seam").applyInPandas(meet, "a BIGINT, b BIGINT")
    return done.where("a IS NOT NULL").select("a", "b").unionByName(at_seams)


_HEAD = ("a", "b", "edge", "place")
_ROW = ("pass", "size", "node", "vector")


def _links(table: pa.Table, window: int, least: float, fresh: int):
    passes, sizes = np.array(table.column("pass")), np.array(table.column("size"))
    nodes, vectors = np.array(table.column("node")), table.column("vector").combine_chunks()
    found = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        units = _unit(_matrix(vectors.take(pa.array(rows))))
        found.append(_window_links(units, nodes[rows], passes[rows], window, least, int((rows < fresh).sum())))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def sampled(classes: DataFrame, rows: int = SAMPLE) -> list[tuple[int, int, list[float]]]:
    """(node, size, vector) of the ``rows`` vectors whose hashes are smallest."""
    chosen = classes.orderBy(F.xxhash64("vector"), "node").limit(rows).select("node", "size", "vector")
    return [tuple(row) for row in chosen.collect()]


def _by_size(sample: list[tuple[int, int, list[float]]]) -> dict[int, np.ndarray]:
    sizes = sorted({size for _, size, _ in sample})
    return {size: _unit(np.array([v for _, s, v in sample if s == size], np.float64)) for size in sizes}


def met_share(classes: DataFrame, linked: DataFrame, sample: list[tuple[int, int, list[float]]], least: float) -> float | None:
    """How much of its neighbours a vector of ``sample`` has in its own component of ``linked`` (node,
    component), on average over those that have any among all ``classes``; None if none has.

    The sample goes to every task; each task adds up its counts, a row per vector of the sample."""
    names = [node for node, _, _ in sample]
    own = {row[0]: row[1] for row in linked.join(
        F.broadcast(classes.sparkSession.createDataFrame([(node,) for node in names], "node BIGINT")), "node"
    ).select("node", "component").collect()}
    units = _by_size(sample)
    places = {size: np.array([at for at, (_, s, _) in enumerate(sample) if s == size]) for size in units}
    nodes = np.array(names, np.int64)
    group = np.array([own.get(node, -1) for node in names], np.int64)

    def run(batches):
        total, met = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        for batch in batches:
            sizes = np.array(batch.column("size"))
            for size in np.unique(sizes).tolist():
                if size not in units:
                    continue
                rows, at = np.flatnonzero(sizes == size), places[size]
                chosen = batch.take(pa.array(rows))
                near = _unit(_matrix(chosen.column("vector"))) @ units[size].T >= least
                near &= np.array(chosen.column("node"))[:, None] != nodes[at]
                total[at] += near.sum(axis=0)
                met[at] += (near & (np.array(chosen.column("component"))[:, None] == group[at])).sum(axis=0)
        some = np.flatnonzero(total)
        yield pa.record_batch({"at": pa.array(some, pa.int32()), "total": pa.array(total[some]), "met": pa.array(met[some])})

    # -2 is no component: vectors without a link are in none.
    rows = classes.join(linked, "node", "left").select("node", "size", "vector", F.coalesce("component", F.lit(-2).cast("long")).alias("component"))
    counts = rows.mapInArrow(run, "at INT, total BIGINT, met BIGINT").groupBy("at").agg(F.sum("total").alias("total"), F.sum("met").alias("met"))
    return counts.agg(F.avg(F.col("met") / F.col("total"))).first()[0]


def linked_components(
    classes: DataFrame, least: float, passes: int | None = None, window: int = WINDOW, seed: int = 7, recall: float = RECALL,
) -> DataFrame:
    """(node, component) of the ``classes`` (node, size, vector) that have a link.

    ``passes`` makes just that many. Otherwise rounds of ``ROUND`` passes follow one another until the
    sample has met ``recall`` of its neighbours, and then as many passes again; where the sample has none,
    ``UNSEEN`` passes are made. The number of vectors decides nothing. A sample that has not met its
    neighbours after ``MOST_PASSES`` shows links that passes do not find, and all pairs are compared.
    """
    n, sample, made, enough, linked = classes.count(), sampled(classes), 0, passes, None
    units = _by_size(sample)
    while enough is None or made < enough:
        count = ROUND if enough is None else enough - made
        if enough is None and made >= MOST_PASSES:
            return cut_lineage(components(all_links(classes, least)))
        links = window_links(pass_keys(classes, range(made, made + count), seed, units), window, least, n * count)
        made += count
        if linked is not None:
            links = links.unionByName(linked.select(F.col("node").alias("a"), F.col("component").alias("b")))
        linked = cut_lineage(components(links))
        if enough is None:
            share = met_share(classes, linked, sample, least)
            if share is None:
                enough = max(made, UNSEEN)
            elif share >= recall:
                enough = 2 * made
    return linked


def _tile_links(a: np.ndarray, b: np.ndarray, nodes_a: np.ndarray, nodes_b: np.ndarray, least: float):
    """A spanning forest of the pairs of two sets of units that reach ``least``."""
    near = a @ b.T >= least
    if nodes_a[0] <= nodes_b[-1] and nodes_b[0] <= nodes_a[-1]:
        near &= nodes_a[:, None] != nodes_b
    if not near.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    near = near[np.ix_(rows, columns)]
    names, place = np.unique(np.concatenate([nodes_a[rows], nodes_b[columns]]), return_inverse=True)
    left, right = place[:len(rows)], place[len(rows):]
    label, found_a, found_b = np.arange(len(names)), [], []
    while near.any():
        # A link of each column; the next round takes those whose ends are still apart.
        one = near.argmax(axis=0)
        linked = np.flatnonzero(near[one, np.arange(len(columns))])
        found_a.append(left[one[linked]])
        found_b.append(right[linked])
        label = forest(len(names), np.concatenate(found_a), np.concatenate(found_b))
        near &= label[left][:, None] != label[right]
    moved = np.flatnonzero(label != np.arange(len(names)))
    return names[moved], names[label[moved]]


def all_links(classes: DataFrame, least: float, file_rows: int = FILE_ROWS) -> DataFrame:
    """Links (a, b) that unite all pairs of ``classes`` (node, size, vector) that reach ``least``.

    Vectors are written in files of about ``file_rows``. A task reads one file and, one by one, itself and
    the half of the others that follow it in a circle, so each two files meet once; rows are shuffled
    once, to the files, and only links come out.
    """
    from pyarrow import fs
    from pyarrow import parquet

    spark = classes.sparkSession
    path = f"{shared_dir(spark)}/cuts/{uuid.uuid4().hex}"
    rows = classes.select("node", "size", "vector")
    rows.repartition(max(1, -(-rows.count() // file_rows))).sortWithinPartitions("node").write.parquet(path)
    files = sorted(spark.read.schema(rows.schema).parquet(path).inputFiles())
    n = len(files)

    def load(at: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        system, name = fs.FileSystem.from_uri(files[at])
        with system.open_input_file(name) as source:
            table = parquet.ParquetFile(source).read().combine_chunks()
        sizes, nodes, vectors = np.array(table["size"]), np.array(table["node"]), table["vector"].combine_chunks()
        chosen = {int(size): np.flatnonzero(sizes == size) for size in np.unique(sizes)}
        return {size: (_unit(_matrix(vectors.take(pa.array(at)))), nodes[at]) for size, at in chosen.items()}

    def run(batches):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                left = load(i)
                for step in range(n // 2 + 1):
                    j = (i + step) % n
                    if 2 * step == n and i > j:
                        continue  # opposite in the circle: the other one's
                    right = load(j) if step else left
                    for size in left.keys() & right.keys():
                        (units, nodes), (others, names) = left[size], right[size]
                        for start in range(0, len(names), _TILE):
                            end = start + _TILE
                            a, b = _tile_links(units, others[start:end], nodes, names[start:end], least)
                            if len(a):
                                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return spark.range(0, n, 1, max(1, n)).mapInArrow(run, "a BIGINT, b BIGINT")


def _block_counts(left: pd.DataFrame, right: pd.DataFrame | None, least: float) -> tuple[np.ndarray, np.ndarray | None]:
    """Copies linked to each row of ``left`` among ``right`` and the reverse; within ``left`` if that is
    None, the row's own class left out."""
    a = _unit(np.stack(left["vector"].to_numpy()))
    if right is None:
        near = a @ a.T >= least
        np.fill_diagonal(near, False)
        return near @ left["copies"].to_numpy(), None
    near = a @ _unit(np.stack(right["vector"].to_numpy())).T >= least
    return near @ right["copies"].to_numpy(), left["copies"].to_numpy() @ near


def exact_links(members: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """(node, n): copies of other classes linked to each of ``members`` (component, node, copies, vector).

    Components up to ``block`` members share tasks by the hash of their name; larger ones are cut into
    blocks, and each pair of blocks is a task's work. Only counts come out, never pairs.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("_size"))
    sized = cut_lineage(members.join(sizes, "component"))
    spark = members.sparkSession
    parts = shuffle_partitions(spark)

    def small(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, one in rows.groupby("component", sort=False):
            counts, _ = _block_counts(one, None, least)
            out.append(pd.DataFrame({"node": one["node"].to_numpy(), "n": counts}))
        return pd.concat(out)

    few = sized.where(F.col("_size") <= block)
    total = few.count()
    groups = max(parts, total // _SPREAD)
    counted = few.withColumn("_g", F.pmod(F.xxhash64("component"), F.lit(groups))).groupBy("_g").applyInPandas(
        small, "node BIGINT, n BIGINT"
    )

    many = sized.where(F.col("_size") > block)
    blocks = F.ceil(F.col("_size") / block).cast("int")
    many = many.withColumn("_blocks", blocks).withColumn("_block", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    # A block meets every block of its component, itself included: one row per meeting.
    meetings = many.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "component", "node", "copies", "vector", F.least("_block", "_other").alias("_i"),
        F.greatest("_block", "_other").alias("_j"), "_block",
    )

    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(rows["_i"].iloc[0]), int(rows["_j"].iloc[0])
        left, right = rows[rows["_block"] == i], rows[rows["_block"] == j]
        if i == j:
            counts, _ = _block_counts(left, None, least)
            return pd.DataFrame({"node": left["node"], "n": counts})
        if left.empty or right.empty:
            return pd.DataFrame({"node": rows["node"], "n": 0})
        a, b = _block_counts(left, right, least)
        return pd.DataFrame({"node": np.concatenate([left["node"], right["node"]]), "n": np.concatenate([a, b])})

    met = meetings.groupBy("component", "_i", "_j").applyInPandas(pair, "node BIGINT, n BIGINT")
    return counted.unionByName(met).groupBy("node").agg(F.sum("n").alias("n"))


def near_duplicates(
    vectors: DataFrame, least: float = 0.9, passes: int | None = None, window: int = WINDOW, seed: int = 7,
    id_col: str = "vec_id", vector_col: str = "embedding", exact: bool = False,
) -> DataFrame:
    """(id, n_links, component_id, kept) for each row of ``vectors``.

    ``n_links`` counts the other rows of its component whose cosine with it, in double precision, is
    ``least`` or more; ``component_id`` is the smallest id of the component, ``kept`` whether that is
    the row's own. A vector that is null, zero, or holds a null or non-finite component links with
    nothing; vectors of different lengths do not link. Rows that repeat an id are rows of their own;
    a null id keeps its row and is the smallest only where no other row of the component has an id,
    and then nothing of it is kept. An empty table gives no rows; other columns are not carried.

    Pairs come from sorted projection passes (``linked_components``), whose work grows with the vectors;
    a pair is missed if no pass brings it within the ``window`` and no chain of found pairs joins it.
    ``exact`` compares every pair, which grows with the square of the distinct vectors.
    """
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    every = vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast(kind).alias("vector"))
    fine = every.where(_usable(F.col("vector")))
    # Copies of one vector are one class; minus zero equals zero.
    plain = F.transform("vector", lambda x: x + F.lit(0.0)).cast(kind)
    classes = fine.select("_id", plain.alias("vector")).groupBy("vector").agg(
        F.min("_id").alias("first"), F.count(F.lit(1)).alias("copies")
    ).withColumn("size", F.size("vector"))
    classes = cut_lineage(classes.withColumn("node", F.monotonically_increasing_id()))  # written: it stays
    rows = classes.select("node", "size", "vector")
    linked = cut_lineage(components(all_links(rows, least))) if exact else linked_components(rows, least, passes, window, seed)
    members = classes.join(linked, "node").select("component", "node", "copies", "vector")
    counted = cut_lineage(exact_links(members, least))
    known = cut_lineage(classes.select("node", "vector", "first", "copies").join(linked, "node", "left").join(counted, "node", "left").select(
        "vector", "first", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component"),
    ))
    smallest = known.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = known.join(smallest, "component").select("vector", "n_links", "component_id")
    rows = fine.select("_id", plain.alias("vector")).join(of_class, "vector").select("_id", "n_links", "component_id")
    odd = every.where(~_usable(F.col("vector"))).select(
        "_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id")
    )
    return rows.unionByName(odd).select(
        F.col("_id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
