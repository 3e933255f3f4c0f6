"""Near-duplicate classes by order MinHash and banded alignment.

A text is the sequence of its runs of `SHINGLE` words, each labelled with how often it
has occurred before. A sketch has `VECTORS` entries: for each, the `SAMPLED` labelled
shingles of least hash, hashed in the order in which they stand, so a match needs the
same shingles in the same order. Texts that share an entry are candidates.

Equal texts are one node. In each bucket every node is aligned with the least one. What
is not similar to it is aligned with all others of the bucket if they are few (`FEW`).
The nodes of larger buckets with such a rest are searched exactly, by a prefix join: a pair
of similarity s shares s / (1 + s) of both texts' shingles, so if each text's shingles stand
from rare to common, the shorter one's first ninth and the longer one's first fifth (at 0.8)
must share one. A passage or template that many texts have in common stands
at the end of that order, so it brings no pairs. Texts that share a shingle there meet in a
bucket of its own: all are aligned with each other if few; else all with those that have it
in their first ninth, if these are few; else all with the least one of these, and what is
unlike that with its neighbours in a random order, on both sides. Such a crowd has eight
ninths of its shingles that are no rarer, so nearly all of it is linked by then. Where
a crowd is still in several components, the nodes outside its largest one are compared
with all others of another component, in tiles of bounded size, so no link between
components is lost: by common shingles first, those with enough of them by alignment. Classes are the components of the links.
The components are known after each of these steps, and the next one aligns only nodes of
different ones: of a large group of near copies nearly all meet in the first step.

Two texts are similar if the longest common subsequence of their labelled shingles,
within the band that the limit allows, is at least `SIMILARITY` of the union.

Defined results: texts shorter than a shingle are alike only if equal; null and
wordless texts are classes of their own; repeated rows are in one class; an empty
table gives an empty table. Words are compared in lower case (A-Z).
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.textarrays import Words, chunks, gram_starts, mix, signed, span_hash
from tidemark.session import stage

SHINGLE = 5
SIMILARITY = 0.8
VECTORS = 12
SAMPLED = 2
FEW = 8  # nodes of a bucket that are all aligned with each other
FEW_OF_SHINGLE = 16  # the same, for nodes that share a rare shingle
NEIGHBOURS = 3
BLOCK = 64  # nodes of a bucket that are put in order together
TILE_WORDS = 100_000  # about so many words on each side of a tile of pairs
LEAST_WORDS = 100  # a shorter text counts as so many, so a side has about a thousand texts
COMMON_STEP = 4096  # shingles counted at a time

_SEEDS = mix(np.arange(1, VECTORS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def labelled_shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle with its occurrence number, and the text it is in."""
    starts, owner = gram_starts(words.first, SHINGLE)
    gram = span_hash(words.prefix(), starts, starts + SHINGLE)
    by = np.argsort(mix(gram ^ mix(owner.astype(np.uint64))), kind="stable")
    same = np.zeros(len(by), dtype=bool)
    same[1:] = (gram[by][1:] == gram[by][:-1]) & (owner[by][1:] == owner[by][:-1])
    index = np.arange(len(by))
    begin = np.maximum.accumulate(np.where(same, 0, index))
    times = np.empty(len(by), dtype=np.uint64)
    times[by] = (index - begin).astype(np.uint64)
    return mix(gram + times * np.uint64(0xD1B54A32D192ED03)), owner


def sketches(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the texts that have shingles, and their sketch entries, one row a text."""
    shingle, owner = labelled_shingles(words)
    texts = np.unique(owner)
    begin = np.searchsorted(owner, texts)
    where = np.searchsorted(texts, owner)
    index = np.arange(len(owner))
    out = np.zeros((len(texts), VECTORS), dtype=np.uint64)
    if not len(texts):
        return texts, out
    for v, seed in enumerate(_SEEDS):
        rank = mix(shingle ^ seed)
        chosen = []
        for _ in range(SAMPLED):
            least = np.minimum.reduceat(rank, begin)
            at = np.minimum.reduceat(np.where(rank == least[where], index, len(index)), begin)
            chosen.append(np.where(least == _MOST, chosen[0] if chosen else at, at))
            rank[at] = _MOST
        key = np.full(len(texts), seed)
        for at in np.sort(np.stack(chosen), axis=0):
            key = mix(key * np.uint64(31) + shingle[at])
        out[:, v] = key
    return texts, out


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned share of two sequences of labelled shingles; 0 if their lengths rule out `least`."""
    if not len(a) or not len(b) or min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    band = int((1 - least) / least * min(len(a), len(b))) + SHINGLE
    order = np.argsort(b)
    slot = np.searchsorted(b[order], a)
    slot[slot == len(b)] = 0
    place = order[slot]
    common = (b[place] == a) & (np.abs(place - np.arange(len(a))) <= band)
    at = place[common]
    if len(at) < 2 or (np.diff(at) > 0).all():
        length = len(at)
    else:  # a longest increasing run of places is a longest common subsequence
        tails: list[int] = []
        for x in at.tolist():
            i = bisect_left(tails, x)
            tails[i : i + 1] = [x]
        length = len(tails)
    return length / (len(a) + len(b) - length)


def _sketched(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = Words(part.column("text"), lower=True)
                texts, keys = sketches(words)
                sizes = np.zeros(part.num_rows + 1, dtype=np.int32)
                sizes[texts + 1] = VECTORS
                entries = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(signed(keys.reshape(-1))))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("h1"), part.column("h2"), pa.array(words.counts()), entries],
                    names=["doc_id", "h1", "h2", "n_words", "entries"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, h1 long, h2 long, n_words long, entries array<long>")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The similar ones of some pairs (a, b) of nodes."""
    sides = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text_a"):
                for side in chunks(part, "text_b"):
                    left, own = labelled_shingles(Words(side.column("text_a"), lower=True))
                    right, other = labelled_shingles(Words(side.column("text_b"), lower=True))
                    rows = np.arange(side.num_rows + 1)
                    x, y = np.searchsorted(own, rows), np.searchsorted(other, rows)
                    good = [similarity(left[x[i] : x[i + 1]], right[y[i] : y[i + 1]]) >= SIMILARITY for i in range(side.num_rows)]
                    keep = pa.array(good, pa.bool_())
                    yield pa.RecordBatch.from_arrays(
                        [side.column("a").filter(keep), side.column("b").filter(keep)], names=["a", "b"]
                    )

    return stage(sides.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), "near-links")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _opened(buckets: DataFrame, similar: DataFrame) -> DataFrame:
    """Add `open`: the node is not its bucket's least one, nor similar to it."""
    linked = similar.select(F.col("a").alias("leader"), F.col("b").alias("node"), F.lit(True).alias("linked"))
    linked = linked.unionByName(similar.select(F.col("b").alias("leader"), F.col("a").alias("node"), F.lit(True).alias("linked")))
    marked = buckets.join(linked, ["leader", "node"], "left")
    return marked.withColumn("open", (F.col("node") != F.col("leader")) & F.col("linked").isNull()).drop("linked")


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Add `root`, the component that each `node` is in so far."""
    return nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _apart(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """The buckets (key, node) whose nodes are in several components so far, with `root`."""
    placed = stage(_rooted(buckets, roots), "near-placed")
    several = placed.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
    return stage(placed.join(stage(several.select("key"), "near-several"), "key", "left_semi"), "near-apart")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) with more links, of which only those between components so far are followed."""
    if links.isEmpty():
        return roots
    for side in ("a", "b"):
        links = links.join(roots.toDF(side, f"root_{side}"), side, "left")
    met = components(links.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    before = roots.join(met.toDF("root", "least"), "root", "left").select("node", F.coalesce("least", "root").alias("root"))
    return stage(before.unionByName(met.join(roots, "node", "left_anti")), "near-roots")


def _in_order(rooted: DataFrame, order: WindowSpec, reach: int) -> DataFrame:
    """Pairs of each node and those of other components among the `reach` nodes on both sides of it."""
    near = F.array(*[f(F.struct("node", "root"), i).over(order) for f in (F.lag, F.lead) for i in range(1, reach + 1)])
    others = rooted.withColumn("near", near).select("node", F.expr("filter(near, x -> x.root <> root)").alias("others"))
    return others.select("node", F.explode("others.node").alias("other")).select(*_pair("node", "other")).distinct()


def _by_rare_shingle(texts: DataFrame) -> DataFrame:
    """key, node, size, index, n, indexed, leader: nodes (node, text) by the shingles that a similar pair must share.

    `size` is the number of the node's shingles, `key` is a shingle among the rarest fifth of each node, `index` whether among its rarest ninth; `indexed` of the
    `n` nodes have it there, of which `leader` is the least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                shingle, owner = labelled_shingles(Words(part.column("text"), lower=True))
                edges = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(signed(shingle)))
                yield pa.RecordBatch.from_arrays([part.column("node"), lists], names=["node", "shingles"])

    held = texts.select("node", "text").mapInArrow(run, "node long, shingles array<long>")
    each = stage(held.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("key")), "near-shingles")
    common = stage(each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "near-frequencies")
    known = each.join(common, "key", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("n", "key"))
    probe = F.col("size") - F.ceil(F.col("size") * SIMILARITY - 1e-9) + 1
    index = F.col("size") - F.ceil(F.col("size") * (2 * SIMILARITY / (1 + SIMILARITY)) - 1e-9) + 1
    prefix = known.withColumn("rank", rank).where((F.col("rank") <= probe) & (F.col("n") > 1))
    prefix = stage(prefix.select("key", "node", "size", (F.col("rank") <= index).alias("index")), "near-prefixes")
    buckets = prefix.groupBy("key").agg(
        F.count("*").alias("n"), F.count_if("index").alias("indexed"), F.min(F.when(F.col("index"), F.col("node"))).alias("leader")
    )
    return prefix.join(stage(buckets.where("n > 1 AND indexed > 0"), "near-prefix-buckets"), "key")


def common_shingles(x: np.ndarray, own: np.ndarray, n: int, y: np.ndarray, other: np.ndarray, m: int) -> np.ndarray:
    """How many labelled shingles each of `n` texts (shingles `x`, owners `own`) shares with each of `m` others."""
    ids = np.intersect1d(x, y)
    out = np.zeros((n, m), dtype=np.float32)
    sides = []
    for shingle, owner in ((x, own), (y, other)):
        held = np.isin(shingle, ids)
        sides.append((np.searchsorted(ids, shingle[held]), owner[held]))
    for a in range(0, len(ids), COMMON_STEP):
        has = []
        for (at, owner), rows in zip(sides, (n, m), strict=True):
            here = (at >= a) & (at < a + COMMON_STEP)
            has.append(np.zeros((rows, min(COMMON_STEP, len(ids) - a)), dtype=np.float32))
            has[-1][owner[here], at[here] - a] = 1
        out += has[0] @ has[1].T
    return out


def _tile_links(left: pa.Table, right: pa.Table) -> pa.Table:
    """A similar pair for each two components that have one in a tile; both sides are node, root, text."""
    sides = []
    for side in (left, right):
        shingle, owner = labelled_shingles(Words(side.column("text"), lower=True))
        edges = np.searchsorted(owner, np.arange(side.num_rows + 1))
        sides.append((shingle, owner, edges, np.asarray(side.column("node")), np.asarray(side.column("root"))))
    (x, own, first, a, root_a), (y, other, begin, b, root_b) = sides
    common = common_shingles(x, own, len(a), y, other, len(b))
    least = SIMILARITY / (1 + SIMILARITY) * (np.diff(first)[:, None] + np.diff(begin)[None, :])
    linked, pairs = set(), []
    for i, j in np.argwhere((common >= least - 1e-3) & (root_a[:, None] != root_b[None, :])).tolist():
        joint = (min(root_a[i], root_b[j]), max(root_a[i], root_b[j]))
        if joint not in linked and similarity(x[first[i] : first[i + 1]], y[begin[j] : begin[j + 1]]) >= SIMILARITY:
            linked.add(joint)
            pairs.append((min(a[i], b[j]), max(a[i], b[j])))
    found = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": found[:, 0], "b": found[:, 1]})


def _across(crowded: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the components (node, root) that the nodes of a crowded bucket are in: all such pairs are compared.

    Of two nodes of different components one at least is outside the bucket's largest. A bucket
    is dealt into tiles, so a large one is spread over tasks; buckets of the same nodes are one.
    """
    placed = crowded.select("key", "node", F.greatest("size", F.lit(LEAST_WORDS)).cast("long").alias("size"))
    placed = stage(_rooted(placed, roots), "near-placed")
    each = placed.groupBy("key", "root").agg(
        F.count("*").alias("n"), F.sum("size").alias("size"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64("node", F.lit(1)) % (1 << 40)).alias("s"),
    )
    buckets = each.groupBy("key").agg(
        F.sum("n").alias("n"), F.count("*").alias("roots"), F.max_by("root", F.struct("size", "root")).alias("main"),
        F.sum("size").alias("size"), F.max("size").alias("of_main"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"),
    ).where("roots > 1")
    buckets = buckets.groupBy("n", "x", "s").agg(F.min_by(F.struct("key", "main", "size", "of_main"), "key").alias("k"))
    parts = buckets.select(
        "k.key", "k.main", F.ceil((F.col("k.size") - F.col("k.of_main")) / TILE_WORDS).alias("lefts"),
        F.ceil(F.col("k.size") / TILE_WORDS).alias("rights"),
    )
    dealt = stage(placed.join(stage(parts, "near-parts"), "key"), "near-dealt")
    spot = F.xxhash64("node", "key")
    left = dealt.where("root <> main").withColumn("i", F.pmod(spot, "lefts"))
    left = left.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rights") - 1)))
    right = dealt.withColumn("j", F.pmod(spot, "rights"))
    right = right.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1)))
    left, right = (side.join(texts, "node").select("key", "i", "j", "node", "root", "text") for side in (left, right))
    right = right.toDF("of_key", "of_i", "of_j", "node", "root", "text")
    tiles = left.groupBy("key", "i", "j").cogroup(right.groupBy("of_key", "of_i", "of_j"))
    return stage(tiles.applyInArrow(_tile_links, "a long, b long").distinct(), "near-links")


def classes(docs: DataFrame, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """uid, doc_id, h1, h2 and `root` for every row: rows of one class have the same root, the uid of one of them.

    h1 and h2 are hashes of the text, with which rows of `docs` can be found again.
    """
    rows = docs.select(F.col(f"`{keep}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.select("doc_id", *text_hashes("text"), "text")
    sketched = stage(_sketched(rows).withColumn("uid", F.monotonically_increasing_id()), "near-sketches")
    # Written first, as Spark splits a hot key of a join only if both sides come straight from a shuffle.
    equal = stage(sketched.where("n_words > 0").groupBy("h1", "h2", "n_words").agg(F.min("uid").alias("node")), "near-equal")
    known = stage(
        sketched.select("uid", "doc_id", "h1", "h2", "n_words").join(equal, ["h1", "h2", "n_words"], "left").withColumn(
            "node", F.coalesce("node", "uid")
        ),
        "near-nodes",
    )

    nodes = known.where("uid = node").select("node", F.col("doc_id").alias("of"), "h1", "h2")
    entries = sketched.select(F.col("uid").alias("node"), "entries").join(nodes.select("node"), "node").select(
        "node", F.explode("entries").alias("key")
    )
    entries = stage(entries, "near-entries")
    buckets = stage(
        entries.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1"), "near-leaders"
    )
    shared = stage(entries.join(buckets, "key"), "near-buckets")
    wanted = nodes.join(shared.select("node").distinct(), "node")
    texts = rows.withColumnRenamed("doc_id", "of").alias("r").join(
        wanted.alias("w"),
        F.col("r.of").eqNullSafe(F.col("w.of")) & (F.col("r.h1") == F.col("w.h1")) & (F.col("r.h2") == F.col("w.h2")),
    ).select("w.node", "r.text").dropDuplicates(["node"])
    texts = stage(texts, "near-texts")

    first = stage(shared.where("node <> leader").select(*_pair("node", "leader")).distinct(), "near-pairs")
    similar = _verified(first, texts)
    roots = stage(components(similar), "near-roots")
    marked = _opened(shared.select("key", "node", "leader", "n"), similar)
    rest = marked.groupBy("key").agg(F.max("open").alias("rest")).where("rest").select("key")
    marked = stage(marked.join(rest, "key"), "near-rest")
    few = _in_order(_rooted(marked.where(F.col("n") <= FEW), roots), Window.partitionBy("key").orderBy("node"), FEW - 1)
    crowd = marked.where(F.col("n") > FEW).select("node").distinct().join(texts, "node")
    sub = _apart(stage(_by_rare_shingle(stage(crowd, "near-crowd")), "near-sub-buckets"), roots)
    close = _in_order(
        sub.where(F.col("n") <= FEW_OF_SHINGLE), Window.partitionBy("key").orderBy("node"), FEW_OF_SHINGLE - 1
    )
    crowded = sub.where(F.col("n") > FEW_OF_SHINGLE)
    heads = crowded.where(F.col("index") & ((F.col("indexed") <= FEW_OF_SHINGLE) | (F.col("node") == F.col("leader"))))
    heads = heads.select("key", F.col("node").alias("head"), F.col("root").alias("of_head"))
    headed = crowded.join(heads, "key").where("root <> of_head").select(*_pair("node", "head"))
    second = few.unionByName(close).unionByName(headed).distinct().join(first, ["a", "b"], "left_anti")
    second = stage(second, "near-pairs")
    roots = _merged(roots, _verified(second, texts))
    # Dealt by block, as a bucket alone may be large.
    crowded = crowded.where(F.col("indexed") > FEW_OF_SHINGLE).drop("root")
    mixed = _rooted(crowded, roots).withColumn("spot", F.xxhash64("node", "key"))
    mixed = mixed.withColumn("block", F.pmod("spot", F.ceil(F.col("n") / BLOCK))).repartition("key", "block")
    third = _in_order(mixed, Window.partitionBy("key", "block").orderBy("spot", "node"), NEIGHBOURS)
    third = third.join(first, ["a", "b"], "left_anti").join(second, ["a", "b"], "left_anti")
    roots = _merged(roots, _verified(stage(third, "near-pairs"), texts))
    roots = _merged(roots, _across(crowded, roots, texts))
    return known.join(roots, "node", "left").select("uid", "doc_id", "h1", "h2", F.coalesce("root", "node").alias("root"))


def text_hashes(text: str) -> list:
    column = F.col(f"`{text}`")
    return [F.xxhash64(column).alias("h1"), F.crc32(column.cast("binary")).alias("h2")]


def representatives(docs: DataFrame, text: str = "text", keep: str = "doc_id") -> DataFrame:
    """The rows of `docs` without all but one of each class."""
    kept = classes(docs, text, keep).where("uid = root").select(F.col("doc_id").alias("of"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), "uid")
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    named = named.select("doc", F.col(f"doc.`{keep}`").alias("id"), F.xxhash64(F.col(f"doc.`{text}`")).alias("h1"),
                         F.crc32(F.col(f"doc.`{text}`").cast("binary")).alias("h2"))
    found = named.join(kept, F.col("id").eqNullSafe(F.col("of")) & F.col("h1").eqNullSafe(F.col("k1")) & F.col("h2").eqNullSafe(F.col("k2")))
    # Rows of the same id and text are copies of the one kept.
    one = Window.partitionBy("uid").orderBy(F.xxhash64("doc"))
    return found.withColumn("nth", F.row_number().over(one)).where("nth = 1").select("doc.*")
