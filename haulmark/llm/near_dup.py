"""MinHash near-duplicates by an inverted join over signature coordinates.

Every distinct shingle set has a signature of k coordinate-value pairs. A set is posted under each of its pairs, and two
sets are compared when enough of their pairs collide: the count of collisions must reach ``match`` of k. Since two sets
that share ``match`` pairs share one among the k - match + 1 rarest of either, only that prefix of each set is merged;
pairs that occur in one set alone drop out of the merge at once. Collision counts reach the threshold for a link of
similarity 0.8 but in about eight of 10^7 cases (k = 48, match = 24). What is retained is confirmed on the full sets.

Groups of copies need no pairs within: equal sets are one node, and first every posting list is compared with one member
of its own. Of what then lies in different components, the pairs that collide often enough are gathered in clusters, for
which a forest of them is enough. Within a cluster the full sets meet in blocks of bounded size, counted by products of 0-1
matrices, and again only a forest of the links leaves a task: no link between components is lost. Rows dealt grow with the
members of lists and clusters up to a chunk; beyond it each member goes to every chunk of its list or cluster, so a family of n
texts that are much alike and yet not linked deals n * n / 2048 and n * n / 128 rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm import shingles
from haulmark.llm.common import components, ship, table

#: Posting lists up to this long are compared in one go.
SHORT = 32
#: Members of a chunk of a longer list, and of a cluster whose full sets meet; a block holds two chunks.
LIST_CHUNK, CLUSTER_CHUNK = 2048, 128
#: Columns of the dense matrices that count shared shingles.
SLAB = 2048
EDGES = "a long, b long"


def _signatures(width: int, k: int):
    a, b = shingles.coefficients(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, tokens, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles.shingle_set(text, width)
                keys.append(shingles.set_key(s))
                sizes.append(len(s))
                low = shingles.signature(s, a, b) if len(s) else None
                tokens.append(shingles.tagged(low) if len(s) else None)
                sketches.append(shingles.sketch(low) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(tokens, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "text_hash", "key", "n_shingles", "tokens", "sketch"])
    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles.shingle_set(text, width) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([shingles.set_key(s) for s in found], pa.binary()),
                                              pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], ["node", "key", "hashes"])
    return run


class _Rows:
    """Members as arrays, those of one list or block next to each other."""

    def __init__(self, group, chunk, node, root, size, sketch, hashes=None):
        self.group, self.chunk, self.node, self.root, self.size, self.sketch, self.hashes = group, chunk, node, root, size, sketch, hashes

    @staticmethod
    def of(batch: pa.RecordBatch, key: str) -> _Rows:
        group = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (key, "one", "two")], axis=1)
        flat = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8)
        hashes = None
        if "hashes" in batch.schema.names:
            hashes = np.empty(batch.num_rows, object)
            for i, x in enumerate(batch.column("hashes")):
                hashes[i] = x.values.to_numpy()
        return _Rows(group, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "node", "root", "n_shingles")),
                     flat.reshape(batch.num_rows, -1), hashes)

    def columns(self):
        return self.group, self.chunk, self.node, self.root, self.size, self.sketch, self.hashes

    def then(self, other: _Rows) -> _Rows:
        return _Rows(*(None if a is None else np.concatenate([a, b]) for a, b in zip(self.columns(), other.columns())))

    def at(self, rows) -> _Rows:
        return _Rows(*(None if c is None else c[rows] for c in self.columns()))

    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.flatnonzero((self.group[1:] != self.group[:-1]).any(axis=1)) + 1])


def _fit(rows: _Rows, i: np.ndarray, j: np.ndarray, match: int, percent: int) -> np.ndarray:
    """Which of the row pairs lie in different components, can be similar by size, and collide often enough."""
    n, m = rows.size[i], rows.size[j]
    ok = (rows.root[i] != rows.root[j]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
    at = np.flatnonzero(ok)
    ok[at] = (rows.sketch[i[at]] == rows.sketch[j[at]]).sum(axis=1) >= match
    return ok


def _stars(rows: _Rows, starts: np.ndarray, match: int, percent: int):
    """Every member with the first of its list."""
    hub = np.repeat(starts, np.diff(np.append(starts, len(rows.node))))
    i = np.flatnonzero(hub != np.arange(len(hub)))
    ok = _fit(rows, hub[i], i, match, percent)
    return hub[i][ok], i[ok]


def _short_lists(rows: _Rows, starts: np.ndarray, match: int, percent: int):
    """All pairs that fit in lists of at most SHORT members: each row with the one ``step`` rows on."""
    lengths = np.diff(np.append(starts, len(rows.node)))
    number = np.repeat(np.arange(len(starts)), lengths)
    left = np.repeat(lengths, lengths) - (np.arange(len(number)) - starts[number])
    left[np.repeat(lengths, lengths) > SHORT] = 0
    out = []
    for step in range(1, SHORT):
        i = np.flatnonzero(left > step)
        if len(i) == 0:
            break
        ok = _fit(rows, i, i + step, match, percent)
        out.append((i[ok], i[ok] + step))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, int), np.empty(0, int))


def _block(rows: _Rows, match: int, percent: int):
    """Row numbers of the two sides of a block, and which of their pairs fit."""
    first = np.flatnonzero(rows.chunk == rows.chunk[0])
    rest = np.flatnonzero(rows.chunk != rows.chunk[0])
    right = rest if len(rest) else first
    hits = np.zeros((len(first), len(right)), np.uint8)
    for c in range(rows.sketch.shape[1]):
        hits += rows.sketch[first, c][:, None] == rows.sketch[right, c][None, :]
    n, m = rows.size[first][:, None], rows.size[right][None, :]
    return first, right, ((hits >= match) & (rows.root[first][:, None] != rows.root[right][None, :])
                          & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))


def _forest(first: np.ndarray, right: np.ndarray, fits: np.ndarray):
    """Edges that connect what ``fits`` connects, at most one per row."""
    at, on = fits.any(axis=1), fits.any(axis=0)
    names = np.unique(np.concatenate([first[at], right[on]]))
    linked = np.zeros((len(names), len(names)), bool)
    linked[np.ix_(np.searchsorted(names, first[at]), np.searchsorted(names, right[on]))] = fits[at][:, on]
    linked |= linked.T
    new = np.ones(len(names), bool)
    a, b = [], []
    for start in range(len(names)):
        if not new[start]:
            continue
        new[start] = False
        todo = [start]
        while todo:
            u = todo.pop()
            found = np.flatnonzero(linked[u] & new)
            if len(found):
                new[found] = False
                a.append(np.full(len(found), u))
                b.append(found)
                todo.extend(found.tolist())
    return (names[np.concatenate(a)], names[np.concatenate(b)]) if a else (np.empty(0, int), np.empty(0, int))


def _joining(i: np.ndarray, j: np.ndarray):
    """Those of the pairs that join what the pairs before them have not joined."""
    above: dict[int, int] = {}

    def top(x):
        while (y := above.get(x, x)) != x:
            above[x] = x = above.get(y, y)
        return x

    keep = []
    for n, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = top(x), top(y)
        if x != y:
            above[x] = y
            keep.append(n)
    return i[keep], j[keep]


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0-1 matrices over the shingles that occur twice."""
    rows = [*left, *right]
    lengths = np.array([len(x) for x in rows])
    known, column, times = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1
    row = np.repeat(np.arange(len(rows)), lengths)
    many = times[column] > 1
    row, column = row[many], number[column[many]]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, SLAB):
        s, e = np.searchsorted(column, [low, low + SLAB])
        dense = np.zeros((len(rows), SLAB), np.float32)
        dense[row[s:e], column[s:e] - low] = 1
        out += dense[:len(left)] @ dense[len(left):].T
    return np.rint(out).astype(np.int64)


def _merge(mode: str, key: str, match: int, percent: int):
    """Edges out of members sorted by ``key`` and block.

    "star": each member of a list with its first. "lists": a forest over the pairs of a list that fit. "links": a forest
    over the pairs of a cluster that fit and whose full sets are similar enough.
    """
    def block_edges(rows: _Rows):
        first, right, fits = _block(rows, match, percent)
        if mode == "links" and fits.any():
            at, on = np.flatnonzero(fits.any(axis=1)), np.flatnonzero(fits.any(axis=0))
            first, right, fits = first[at], right[on], fits[np.ix_(at, on)]
            both = _shared(list(rows.hashes[first]), list(rows.hashes[right]))
            fits &= 100 * both >= percent * (rows.size[first][:, None] + rows.size[right][None, :] - both)
        return _forest(first, right, fits)

    def edges(rows: _Rows, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if mode == "star":
            found = [_stars(rows, starts, match, percent)]
        else:
            ends = np.append(starts[1:], len(rows.node))
            short = SHORT if mode == "lists" else 1
            found = [_joining(*_short_lists(rows, starts, match, percent))] if mode == "lists" else []
            for s, e in zip(starts, ends):
                if e - s > short:
                    i, j = block_edges(rows.at(slice(s, e)))
                    found.append((i + s, j + s))
        i, j = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int))
        if len(i):
            both = np.unique(np.sort(np.stack([rows.node[i], rows.node[j]], axis=1), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = _Rows.of(batch, key) if kept is None else kept.then(_Rows.of(batch, key))
            starts = rows.starts()
            if mode == "star":  # the first member is all that is needed of a list that goes on
                yield from edges(rows, starts)
                kept = rows.at(slice(starts[-1], starts[-1] + 1))
                continue
            if len(starts) > 1:
                yield from edges(rows.at(slice(0, starts[-1])), starts[:-1])
            kept = rows.at(slice(starts[-1], None))
        if kept is not None and mode != "star":
            yield from edges(kept, np.zeros(1, int))
    return run


def _edges(members: DataFrame, mode: str, key: str, match: int, percent: int) -> DataFrame:
    """Distinct edges (a, b) from ``members``, whose ``chunks`` says into how many chunks a list or cluster is cut."""
    rest = ["node", "root", "n_shingles", "sketch", *(["hashes"] if mode == "links" else [])]
    spread = (members.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks").cast("long")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select(key, F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"), "chunk", *rest))
    dealt = spread.repartition(key, "one", "two").sortWithinPartitions(key, "one", "two", "node")
    return table(dealt.mapInArrow(_merge(mode, key, match, percent), EDGES).distinct(), "edges")


def _cut(members: DataFrame, key: str, chunk: int, whole: int) -> DataFrame:
    """``members`` of lists or clusters that hold more than one component, with the number of their chunks."""
    n = F.count("*")
    lists = (members.groupBy(key).agg(F.min("root").alias("r1"), F.max("root").alias("r2"), n.alias("n")).filter(F.col("r1") != F.col("r2"))
             .select(key, F.when(F.col("n") <= whole, 1).otherwise(F.ceil(F.col("n") / chunk)).cast("int").alias("chunks")))
    return members.join(lists, key)


class _Sets:
    """Full sets of the nodes that pairs ask for, computed from the texts once and written."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int):
        self.docs, self.nodes, self.width, self.known = docs.select(F.col("doc_id").alias("node"), "text"), nodes, width, None

    def of(self, asked: DataFrame) -> DataFrame:
        """(node, hashes) at least of the nodes in ``asked``."""
        if self.known is not None:
            asked = asked.join(self.known.select("node"), "node", "left_anti")
        asked = table(asked, "asked")
        texts = self.docs.join(asked.filter(F.col("node") > F.lit(-(2**63))), "node", "left_semi")
        with _bloom(self.docs.sparkSession):
            new = table(texts.mapInArrow(_full_sets(self.width), "node long, key binary, hashes array<long>")
                        .join(self.nodes.select("node", "key"), ["node", "key"], "left_semi").drop("key"), "sets")
        self.known = new if self.known is None else self.known.unionByName(new)
        return self.known


@contextmanager
def _bloom(spark):
    """Let Spark filter the texts by a Bloom filter of the ids asked for, of bounded size, before it shuffles them."""
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _confirmed(pairs: DataFrame, sets: _Sets, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    full = sets.of(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    both = F.size(F.array_intersect("a_hashes", "b_hashes"))
    return (pairs.join(full.select(F.col("node").alias("a"), F.col("hashes").alias("a_hashes")), "a")
            .join(full.select(F.col("node").alias("b"), F.col("hashes").alias("b_hashes")), "b")
            .withColumn("both", both)
            .filter(100 * F.col("both") >= percent * (F.size("a_hashes") + F.size("b_hashes") - F.col("both")))
            .select("a", "b"))


def linked(docs: DataFrame, width: int = 5, percent: int = 80, k: int = 48, match: int = 24) -> DataFrame:
    """``near_duplicates`` with a hash of the text, which tells the rows of one id apart."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prep = table(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _signatures(width, k), "doc_id long, text_hash long, key binary, n_shingles long, tokens array<long>, sketch binary"), "signatures")
    # Equal sets have one key; the smallest id stands for them.
    classes = table(prep.filter(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
                    .groupBy("key").agg(F.min("doc_id").alias("node")), "classes")
    nodes = table(prep.select(F.col("doc_id").alias("node"), "key", "n_shingles", "tokens", "sketch").join(classes, ["node", "key"])
                  .dropDuplicates(["node", "key"]), "nodes")

    posts = nodes.select("node", F.explode("tokens").alias("token")).repartition("token")
    shared = posts.groupBy("token").agg(F.count("*").alias("c")).filter(F.col("c") > 1)
    # Pairs of one set alone come first in its prefix of the k - match + 1 rarest and merge with nothing.
    spare = F.greatest(F.lit(0), F.lit(1 - match) + F.size("list"))
    prefixes = (posts.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("c", "token"))).alias("list"))
                .select("node", F.explode(F.slice("list", F.lit(1), spare)).alias("p")).select("node", F.col("p.token").alias("token")))
    posted = table(prefixes.join(nodes.select("node", "n_shingles", "sketch"), "node"), "posted")

    sets = _Sets(docs, nodes, width)
    alone = posted.withColumn("root", F.col("node")).withColumn("chunks", F.lit(1))
    roots = components(_confirmed(_edges(alone, "star", "token", match, percent), sets, percent))

    # What is left to compare: pairs of different components that collide often enough. Clusters hold all of them.
    placed = posted.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    clusters = components(_edges(_cut(placed, "token", LIST_CHUNK, SHORT), "lists", "token", match, percent))
    members = (clusters.withColumnRenamed("root", "cluster").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
               .join(nodes.select("node", "n_shingles", "sketch"), "node"))
    members = _cut(members, "cluster", CLUSTER_CHUNK, CLUSTER_CHUNK).join(sets.of(clusters.select("node")), "node")
    links = _edges(members, "links", "cluster", match, percent)
    roots = components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    of_key = classes.join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("component_id"))
    return (prep.select("doc_id", "text_hash", "key", "n_shingles").join(of_key, "key", "left")
            .withColumn("component_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", "text_hash", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id").eqNullSafe(F.col("component_id")) | F.col("component_id").isNull(), F.lit(True)).alias("kept")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = 48, match: int = 24) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Texts are linked when 100 * shared shingles >= ``percent`` * shingles of either; components are what links reach.
    Edge cases: a null or wordless text has no shingles, is linked with nothing and is its own component; a text of fewer
    than ``width`` words is one shingle. Repeated rows each get a row; rows of one doc_id with different texts are one
    document, linked by any of them. A null doc_id names no component: such a row joins the component of an equal set, else
    its component is null and it is kept. Other columns are ignored. An empty table gives an empty result.
    """
    return linked(docs, width, percent, k, match).drop("text_hash")


def keep_one(docs: DataFrame, by_text: bool = False, **options) -> DataFrame:
    """One row of ``docs`` per component, all columns as they are: a row of the smallest doc_id.

    Of rows that repeat an id one stays, with ``by_text`` one for each of its texts that is linked with none kept: there a
    document is an id and a text, ordered by the text's hash within an id. Rows without an id stay when no row with an id has
    their shingles, one per text. Among rows that are alike, hashes of text and row choose, so reruns agree.
    """
    own = F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind])
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), own.alias("own"))
    if by_text:
        pairs = marked.select("id", "hash").filter(F.col("id").isNotNull())
        if pairs.groupBy("id").agg(F.min("hash").alias("a"), F.max("hash").alias("b")).filter("a <> b").limit(1).collect():
            # Numbers in the order of id and hash stand for the pairs.
            nodes = table(pairs.distinct().orderBy("id", "hash").withColumn("node", F.monotonically_increasing_id()), "pairs")
            numbered = table(marked.join(nodes, ["id", "hash"], "left")
                             .select(F.col("node").alias("doc_id"), F.col("row.text").alias("text"), "row"), "numbered")
            return keep_one(numbered, **options).select("row.*")
    kept = linked(docs, **options).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    one = marked.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("hash") == F.col("kept_hash")), "left_semi")
    return (one.groupBy("id", F.when(F.col("id").isNull(), F.col("hash")).alias("text_of_none"))
            .agg(F.min_by("row", F.struct("hash", "own")).alias("row")).select("row.*"))


def brute_sql(width: int = 2, percent: int = 80) -> str:
    """DuckDB SQL for ``near_duplicates``: all pairs that share a shingle, and the closure of their links.

    Meant for small tables with unique ids.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    return f"""
with recursive base as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) >= {width} then list_distinct(list_transform(range(1, len(w) - {width - 2}), lambda i: {run}))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from base),
posts as (select doc_id, len(s) as n, unnest(s) as t from sets),
pairs as (select a.doc_id as x, b.doc_id as y, a.n as nx, b.n as ny, count(*) as c from posts a join posts b on a.t = b.t and a.doc_id < b.doc_id group by all),
links as (select x, y from pairs where 100 * c >= {percent} * (nx + ny - c)),
both_ways as (select x, y from links union all select y, x from links),
reach as (select doc_id, doc_id as other from sets union select r.doc_id, b.y from reach r join both_ways b on b.x = r.other),
named as (select doc_id, min(other) as component_id from reach group by 1)
select doc_id, len(s) as n_shingles, component_id, doc_id = component_id as kept from sets join named using (doc_id)
"""
