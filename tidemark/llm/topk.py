"""Exact top-k inner products: a forest of M-trees searched best first.

Equal vectors are one entry with their smallest ids. Entries are banded by length (a factor of
two), as the longest vector of a band sets how blunt its bounds are; a band's entries are dealt
to the cells of at most `MAX_CELLS` routing vectors, and large cells cut by hash, so a tree
has about `TREE_ROWS` entries however the vectors lie. A query first searches one tree near
it in the band of the longest vectors; what it finds bounds its k-th score, and only
cells that the triangle inequality leaves are searched after that. A tree meets the queries
that open it in blocks of `QUERY_BLOCK`, so it is copied as often as its own queries fill
a block, and not at all if none opens it.

Defined results: vectors that are null or hold null or non-finite components, and null
ids, take no part; vectors meet those of as many components only; a query's own row is
left out, other rows with its id or vector are not; a repeated query row is answered
as often as it stands; fewer than k candidates give fewer rows; ties go to smaller ids; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.mtree import MTree, lifted_distance
from tidemark.session import stage

MAX_CELLS = 256
TREE_ROWS = 4096
QUERY_BLOCK = 4096
BANDS = 40  # of lengths, for each number of components
TREE = ["grp", "cell", "part"]


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and integer components `v`, of valid vectors only."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.int64()))
    n = len(column)
    return np.asarray(column.flatten(), np.int64).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _by_size(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the lists of each length."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.list_value_length(column))
    return [(at, _matrix(column.take(pa.array(at)))) for n in np.unique(sizes) if len(at := np.flatnonzero(sizes == n))]


def _band(v: str = "v") -> Column:
    """Number of a vector's group: its components' number and the binary digits of its length."""
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    digits = F.floor(F.log2(square + 1) / 2).cast("int")
    return F.size(v) * BANDS + F.least(digits, F.lit(BANDS - 1))


def _placed(rows: DataFrame, routing: dict[int, np.ndarray], tops: dict[int, float]) -> DataFrame:
    """Add `cell`, the nearest routing vector of the row's group `grp`, and `away`, its distance."""
    shared = rows.sparkSession.sparkContext.broadcast((routing, tops))  # at most MAX_CELLS vectors of each group

    def run(batches):
        pivots, top = shared.value
        for batch in batches:
            cell, away = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            groups = np.asarray(batch.column("grp"), np.int64)
            for g in np.unique(groups).tolist():
                at = np.flatnonzero(groups == g)
                apart = lifted_distance(_matrix(batch.column("v").take(pa.array(at))), pivots[g], top[g])
                cell[at], away[at] = apart.argmin(axis=1), apart.min(axis=1)
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(cell), pa.array(away)], names=[*batch.schema.names, "cell", "away"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, cell int, away double")


def _searched(trees: DataFrame, queries: DataFrame, keys: list[str], k: int, tops: dict[int, float]) -> DataFrame:
    """rep, score, vec_id, same: up to k best rows of each tree for each query dealt to it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if left.num_rows and right.num_rows:
            ids = left.column("ids").to_pylist()
            tree = MTree(_matrix(left.column("v")), tops[left.column("grp")[0].as_py()])
            wanted = _matrix(right.column("v"))
            for q, rep, least in zip(wanted, right.column("rep").to_pylist(), right.column("least").to_pylist(), strict=True):
                best = [(-score, i, row) for score, row in tree.search(q, k, least) for i in ids[row]]
                best.sort()
                for minus, i, row in best[:k]:
                    out[0].append(rep)
                    out[1].append(-minus)
                    out[2].append(i)
                    out[3].append(bool((tree.vectors[row] == q).all()))
        return pa.table([pa.array(o, t) for o, t in zip(out, [pa.int64()] * 3 + [pa.bool_()], strict=True)],
                        names=["rep", "score", "vec_id", "same"])

    return trees.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(
        run, "rep long, score long, vec_id long, same boolean"
    )


def _meetings(trees: DataFrame, dealt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trees and the queries that open them, with `block`: a tree is copied once per block of its own queries."""
    blocks = dealt.groupBy(*TREE).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    blocks = stage(blocks, "topk-blocks")
    queries = dealt.join(blocks, TREE).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    copies = trees.join(blocks, TREE).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return copies.drop("blocks"), queries.drop("blocks")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of `vectors` for each row of `queries` (both vec_id, v).

    Every query is a row of `vectors`, too; that row is left out.
    """
    spark = vectors.sparkSession
    # Of equal vectors only the k + 1 smallest ids can be in a result.
    few = vectors.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    entries = stage(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "topk-entries")
    entries = entries.withColumn("grp", _band())
    facts = entries.groupBy("grp").agg(
        F.count("*").alias("n"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("top"),
    ).collect()  # at most BANDS rows a number of components
    tops = {r.grp: float(r.top) for r in facts}
    cells = max(1, min(MAX_CELLS, -(-sum(r.n for r in facts) // TREE_ROWS)))
    first = entries.select("v", "grp").withColumn(
        "nth", F.row_number().over(Window.partitionBy("grp").orderBy(F.xxhash64("v"), "v"))
    ).where(F.col("nth") <= cells)
    routing: dict[int, list] = {}
    for r in first.select("v", "grp").collect():  # at most MAX_CELLS of each group
        routing.setdefault(r.grp, []).append(r.v)
    pivots = {g: np.array(v, np.int64).reshape(len(v), g // BANDS) for g, v in routing.items()}

    placed = stage(_placed(entries, pivots, tops), "topk-cells")
    shape = {(r.grp, r.cell): (r.n, r.radius) for r in
             placed.groupBy("grp", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()}
    parts = {key: max(1, -(-n // TREE_ROWS)) for key, (n, _) in shape.items()}
    cut = spark.createDataFrame([(g, c, p) for (g, c), p in parts.items()] or [(-1, -1, 1)], "grp int, cell int, parts int")

    asked = stage(queries.select(F.col("vec_id").alias("query_id"), "v"), "topk-queries")
    alike = stage(asked.select("v").distinct().withColumn("rep", F.monotonically_increasing_id()), "topk-asked")
    trees = stage(placed.join(cut, ["grp", "cell"]).select(
        "v", "ids", "grp", "cell", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part")
    ), "topk-trees")

    # One tree near each query, in the band of the longest vectors, for a bound of its k-th score.
    longest = {g // BANDS: max(x for x in tops if x // BANDS == g // BANDS) for g in tops}
    home = F.create_map(*[F.lit(x) for pair in longest.items() for x in pair]) if longest else F.create_map().cast("map<int,int>")
    homed = _placed(alike.withColumn("grp", home[F.size("v")]).where("grp IS NOT NULL"), pivots, tops).select(
        "v", "rep", "grp", "cell", F.lit(0).alias("part"), F.lit(None).cast("long").alias("least")
    )
    near = _searched(*_meetings(trees.where("part = 0"), stage(homed, "topk-homes")), [*TREE, "block"], k + 1, tops)
    bound = near.groupBy("rep").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bounded = alike.join(bound.where(F.col("n") > k).select("rep", "least"), "rep", "left")

    def open_cells(batches):
        """Every tree that may still hold one of the k best, for each query."""
        for batch in batches:
            out: list[list] = [[], [], [], []]
            least = np.array([-np.inf if x is None else x for x in batch.column("least").to_pylist()], dtype=np.float64)
            for at, q in _by_size(batch.column("v")):
                qq = (q.astype(np.float64) ** 2).sum(axis=1)
                for group in (g for g in tops if g // BANDS == q.shape[1]):
                    top, own = tops[group], sorted(c for g, c in shape if g == group)
                    base = pivots[group][own].astype(np.float64)
                    away = np.sqrt(np.maximum(qq[:, None] + top - 2 * (q.astype(np.float64) @ base.T), 0))
                    low = away - np.array([shape[group, c][1] for c in own])[None, :]
                    most = np.sqrt(np.maximum(qq + top - 2 * least[at], 0)) * (1 + 1e-6) + 1e-6
                    # No vector of the band can have a larger product than both lengths allow.
                    hopeless = np.sqrt(qq * top) * (1 + 1e-9) < least[at]
                    row, col = np.nonzero((low <= most[:, None]) & ~hopeless[:, None])
                    for r, c in zip(at[row].tolist(), col.tolist(), strict=True):
                        for part in range(parts[group, own[c]]):
                            for o, value in zip(out, (r, group, own[c], part), strict=True):
                                o.append(value)
            index = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).take(index) for n in ("v", "rep", "least")] + [pa.array(o, pa.int32()) for o in out[1:]],
                names=["v", "rep", "least", "grp", "cell", "part"],
            )

    dealt = stage(bounded.select("v", "rep", "least").mapInArrow(
        open_cells, "v array<long>, rep long, least long, grp int, cell int, part int"
    ), "topk-dealt")
    found = _searched(*_meetings(trees, dealt), [*TREE, "block"], k + 1, tops)
    best = _best(found, ["rep"], k + 1).select("rep", "score", "vec_id", "same")

    # Back to every query row: without its own row, once for each time it stands there.
    rows = asked.groupBy("v", "query_id").agg(F.count("*").alias("copies")).join(alike, "v").select("rep", "query_id", "copies")
    lists = rows.join(best, "rep").withColumn(
        "nth", F.row_number().over(Window.partitionBy("rep", "query_id", "same", "vec_id").orderBy("score"))
    ).where(~(F.col("same") & (F.col("vec_id") == F.col("query_id")) & (F.col("nth") == 1)))
    ranked = _best(lists, ["rep", "query_id"], k)
    return ranked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
