"""Nearest neighbours by inner product, from balanced posting lists.

Centroids are fitted on a bounded sample of distinct vectors (Settings.sample rows, drawn by hash): k-means, whose large
clusters are split until none holds more than twice its share. Inner product becomes distance by one more component,
sqrt(longest ** 2 - norm ** 2), which is 0 for queries. Every vector is indexed, in its nearest list and, near a boundary,
in the next ones too. Queries search a neighbour graph of the centroids that each task holds in memory, best first, and
take every list not farther than (1 + ratio) times the mean of the nearest Settings.anchor lists, and the nearest; nothing else limits the lists. Lists and the queries that
visit them are dealt in chunks and blocks of bounded size, each pair of which is one matrix product.

How wide a boundary is and how far the ratio reaches depend on the vectors, so both are read off the sample, of which the
centroids are fitted on three quarters: the boundary is the margin that marks the share Settings.replicated of the rows, the
ratio lets in the lists of a share Settings.recall of the nearest neighbours. Fitted rows stand for themselves and the last
quarter for all rows outside the fit, by number, both as queries and as neighbours; of each part a query has as many
neighbours as stand for k in the whole table, one at least, so that recall only rises in larger tables. Where neighbours are
hardly nearer than other vectors (directions without any clusters) a query needs a large share of the lists, whatever the
ratio; scanned() tells how large.

Equal vectors are one class with the few smallest ids that a result can need, found in three salted steps, so that a vector
that a third of all rows hold costs what a single one does.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do those of another
length than most; equal scores go to the smaller id; a query with fewer candidates than k gets all; rows of one id and one
vector count once; an id on several vectors is a row for each of them: as a query each is ranked on its own, told apart by
`query_vector`, and as neighbours each has a rank of its own, also among those of its own id; rows with a null id take no
part; no query or no vector gives an empty result. Extra columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship
from .common import spill


#: Parts of a query's result are merged by so many salts first.
SALTS = 256


@dataclass(frozen=True)
class Settings:
    k: int = 20
    per_list: int = 400
    max_lists: int = 4_096
    sample: int = 16_000
    rounds: int = 10
    copies: int = 2
    replicated: float = 0.1
    recall: float = 0.96
    anchor: int = 8
    judged: int = 1_000
    neighbours: int = 24
    chunk: int = 1_024
    block: int = 256
    seed: int = 3


@dataclass
class Index:
    centroids: object  # lists x (dimensions + 1), float32
    longest: float
    graph: object  # lists x neighbours
    start: int
    how: Settings
    boundary: float = 0.0
    ratio: float = 0.0

    def lifted(self, x, query: bool = False):
        import numpy as np

        x = np.asarray(x, np.float32)
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.longest**2 - (x.astype(np.float64) ** 2).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None].astype(np.float32)], axis=1)

    def lists_of(self, x):
        """(row, list) pairs: the nearest list, and near a boundary the next ones."""
        import numpy as np

        y, c, how = self.lifted(x), self.centroids, self.how
        d = distances(y, c)
        near = np.argsort(d, axis=1, kind="stable")[:, : how.copies]
        dist = np.take_along_axis(d, near, axis=1)
        row, place = np.nonzero(dist <= dist[:, :1] * (1 + self.boundary))
        return row, near[row, place]

    def probe(self, q) -> list[int]:
        """Lists within the ratio of the nearest few, by best-first search of the centroid graph."""
        import bisect
        import heapq

        import numpy as np

        def distance(at):
            return np.sqrt(((self.centroids[at] - q) ** 2).sum(axis=1))

        seen = {self.start}
        heap = [(float(distance([self.start])[0]), self.start)]
        least, found = [heap[0][0]], []  # least: the anchor's distances, ascending
        while heap:
            d, at = heapq.heappop(heap)
            # some slack lets the search pass a ring of slightly farther centroids
            if len(found) >= self.how.anchor and d > sum(least) / len(least) * (1 + max(0.0, self.ratio)) * 1.05:
                break
            found.append((d, at))
            new = [i for i in dict.fromkeys(self.graph[at].tolist()) if i not in seen]
            if new:
                seen.update(new)
                for x, i in zip(distance(new).tolist(), new, strict=True):
                    if len(least) < self.how.anchor or x < least[-1]:
                        bisect.insort(least, x)
                        del least[self.how.anchor:]
                    heapq.heappush(heap, (x, i))
        reach = max(least[0], sum(least) / len(least) * (1 + self.ratio))
        return [at for d, at in found if d <= reach]


def distances(y, c):
    """Rows of y by rows of c."""
    import numpy as np

    return np.sqrt(np.maximum((y * y).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * y @ c.T, 0))


def nearest_of(y, c):
    """The nearest row of c for each row of y, in blocks that bound the memory."""
    import numpy as np

    square = (c * c).sum(axis=1)
    return np.concatenate([np.zeros(0, np.int64), *((2 * y[k : k + 2_048] @ c.T - square).argmax(axis=1) for k in range(0, len(y), 2_048))])


def calibrate(index: Index, fitted, held, total: int) -> None:
    """Set boundary and ratio of index by the rows that its centroids are fitted on, and others, of total vectors."""
    import numpy as np

    how, c = index.how, index.centroids
    rng = np.random.default_rng(how.seed + 1)
    share = min(1.0, len(fitted) / max(total, 1))
    parts = [(np.asarray(x, np.float32), part) for x, part in ((fitted, share), (held, 1 - share)) if len(x) and part]
    asked = [(x[at], at, part) for x, part in parts for at in [rng.permutation(len(x))[: how.judged]]]
    if len(c) > 1:
        d = [np.sort(distances(index.lifted(q), c), axis=1) for q, _, _ in asked]
        index.boundary = max(0.0, weighted_quantile([(x[:, 1] / x[:, 0].clip(1e-12), part / len(x)) for x, (_, _, part) in zip(d, asked, strict=True)], how.replicated) - 1)
    reaches = []
    for i, (x, of_rows) in enumerate(parts):
        lists = np.full((len(x), how.copies), -1, np.int32)
        for start in range(0, len(x), 1_024):
            row, at = index.lists_of(x[start : start + 1_024])
            lists[start + row, np.arange(len(row)) - np.searchsorted(row, row)] = at
        for j, (q, own, of_queries) in enumerate(asked):
            k = min(max(1, round(how.k * len(x) / max(total, 1))), len(x) - 1)
            for start in range(0, len(q) if k > 0 else 0, 128):
                some, mine = q[start : start + 128], own[start : start + 128]
                score = some @ x.T
                if i == j:  # the queries are among these rows
                    score[np.arange(len(some)), mine] = -np.inf
                near = np.argpartition(-score, k - 1, axis=1)[:, :k]
                d = distances(index.lifted(some, query=True), c)
                mean = np.sort(d, axis=1)[:, : min(how.anchor, len(c))].mean(axis=1, keepdims=True).clip(1e-12)
                d = np.concatenate([d, np.full((len(d), 1), np.inf)], axis=1)  # place -1: no list
                reach = np.take_along_axis(d, lists[near].reshape(len(d), -1), axis=1).reshape(len(d), k, how.copies).min(axis=2)
                reaches.append(((reach / mean).ravel(), of_rows * of_queries / (len(q) * k)))
    if reaches:
        index.ratio = weighted_quantile(reaches, how.recall) - 1 + 1e-6


def weighted_quantile(groups: list, share: float) -> float:
    """groups: (values, the weight of each)."""
    import numpy as np

    values, weights = np.concatenate([x for x, _ in groups]), np.concatenate([np.full(len(x), w) for x, w in groups])
    order = np.argsort(values, kind="stable")
    upto = np.cumsum(weights[order])
    return float(values[order][min(len(order) - 1, int(np.searchsorted(upto, share * upto[-1])))])


def scanned(index: Index, q, rows) -> float:
    """How much of the table a query of q reads on average: lengths of the lists it visits, over the number of rows."""
    import numpy as np

    length = np.bincount(index.lists_of(rows)[1], minlength=len(index.centroids))
    return float(np.mean([length[index.probe(x)].sum() for x in index.lifted(q, query=True)]) / len(rows))


def build(sample, total: int, longest: float, how: Settings) -> Index:
    """Centroids and their graph from the sample, for an index of total vectors."""
    import numpy as np

    rng = np.random.default_rng(how.seed)
    index = Index(None, longest, None, 0, how)
    held = sample[::4] if len(sample) >= 64 else sample[:0]
    fitted = np.delete(sample, np.s_[::4], axis=0) if len(held) else sample
    y = index.lifted(fitted)
    lists = max(1, min(how.max_lists, total // how.per_list, len(y) // 4))

    def means(y, c):
        for _ in range(how.rounds):
            at = nearest_of(y, c)
            count = np.bincount(at, minlength=len(c))
            sums = np.zeros_like(c, dtype=np.float64)
            np.add.at(sums, at, y)
            c = np.where(count[:, None] > 0, sums / count.clip(1)[:, None], c).astype(np.float32)
        return c, nearest_of(y, c)

    c, at = means(y, y[rng.permutation(len(y))[:lists]].copy())
    most, out, todo = max(8, 2 * len(y) // len(c)), [], [y[at == k] for k in range(len(c))]
    while todo:
        part = todo.pop()
        if len(part) > most:
            two, side = means(part, part[rng.permutation(len(part))[:2]].copy())
            if 0 < side.sum() < len(side):
                todo += [part[side == 0], part[side == 1]]
                continue
        if len(part):
            out.append(part.mean(axis=0))
    index.centroids = c = np.array(out, np.float32)
    d = (c * c).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * c @ c.T
    near = np.argsort(d, axis=1, kind="stable")[:, : how.neighbours]
    ring = np.stack([(np.arange(len(c)) + 1) % len(c)], axis=1)  # keeps the graph in one piece
    index.graph = np.concatenate([near, ring], axis=1)
    index.start = int(((c - c.mean(axis=0)) ** 2).sum(axis=1).argmin())
    calibrate(index, fitted, held, total)
    return index


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, class): the rows that take part. Vectors keep float or double; class is a digest of 128 bits."""
    wide = vectors.schema[vector_col].dataType.simpleString() == "array<double>"
    v = F.col("v")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>" if wide else "array<float>").alias("v")).where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(good)
    sizes = rows.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size(v) == (sizes["d"] if sizes else 0)).withColumn("class", F.struct(F.xxhash64("v").alias("x"), F.xxhash64(F.lit(1), "v").alias("y")))


def smallest_ids(rows: DataFrame, most: int) -> DataFrame:
    """(class, ids) for classes of more than one id: the smallest ids, at most so many, ascending."""
    # written before it is joined: a join of two plain shuffles may be split at a hot class
    many = spill(rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("class"), "many")
    left = rows.join(many, "class").select("class", "id").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)).cast("int"))
    for salts in (64, 8, 1):
        by = Window.partitionBy("class", "salt").orderBy("id")
        left = left.withColumn("salt", F.col("salt") % salts).withColumn("nth", F.dense_rank().over(by)).where(F.col("nth") <= most).select("class", "id", "salt").distinct()
    return left.groupBy("class").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def search(vectors: DataFrame, is_query, how: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score, query_vector) of the rows whose id satisfies is_query (a function of the id column),
    against all rows. query_vector: a digest of the query's vector, which tells queries of one id apart.
    """
    spark = vectors.sparkSession
    ship(spark)
    most = how.k + 1  # the query itself may be among them
    rows = spill(usable(vectors, id_col, vector_col), "vectors")
    first = spill(rows.groupBy("class").agg(F.min("id").alias("id"), F.first("v").alias("v")), "classes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    total, longest = first.agg(F.count(F.lit(1)), F.max(norm)).first()
    schema = "query_id long, rank int, vec_id long, score double, query_vector string"
    if not total:
        return spark.createDataFrame([], schema)
    import numpy as np

    share = min(1.0, how.sample / total)
    drawn = first.where(F.pmod(F.xxhash64("id", F.lit(how.seed)), F.lit(1 << 40)) < int(share * (1 << 40))).select("id", "v").limit(2 * how.sample).toArrow().sort_by("id")
    if not drawn.num_rows:
        drawn = first.orderBy("id").limit(how.sample).select("id", "v").toArrow()
    sample = drawn.column("v").combine_chunks().flatten().to_numpy().reshape(drawn.num_rows, -1).astype(np.float32)
    index = spark.sparkContext.broadcast(build(sample, total, longest, how))  # at most 2 * max_lists centroids

    def matrix(column):
        flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
        return flat.flatten().to_numpy().reshape(len(column), -1)

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                row, at = index.value.lists_of(matrix(part.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(c.take(pa.array(row)) for c in part.columns)], names=["list", "id", "v", "x", "y"])

    def visit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            q = index.value.lifted(matrix(batch.column(1)), query=True)
            probes = [index.value.probe(x) for x in q]
            row = np.repeat(np.arange(len(q)), [len(p) for p in probes])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*map(np.asarray, probes), []]).astype(np.int32)), *(c.take(pa.array(row)) for c in batch.columns)], names=["list", "id", "v", "x", "y"])

    member = f"list int, id long, v {rows.schema['v'].dataType.simpleString()}, x long, y long"
    posted = spill(first.select("id", "v", "class.x", "class.y").mapInArrow(assign, member), "postings")
    asked = rows.where(is_query(F.col("id"))).select("class", F.col("id").alias("query_id")).distinct()
    asking = spill(first.join(asked.select("class").distinct(), "class", "left_semi").select("id", "v", "class.x", "class.y").mapInArrow(visit, member), "visits")
    chunks = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / how.chunk).cast("int").alias("chunks"))
    blocks = asking.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / how.block).cast("int").alias("blocks"))
    sizes = spill(chunks.join(blocks, "list"), "sizes")  # a row for each list
    sizes = F.broadcast(sizes)
    spread = lambda n: F.pmod("x", F.col(n)).cast("int")
    left = posted.join(sizes, "list").select("list", spread("chunks").alias("chunk"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("asks"), "id", "v", "x", "y")
    right = asking.join(sizes, "list").select("list", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), spread("blocks").alias("block"), F.lit(True).alias("asks"), "id", "v", "x", "y")

    def nearest(table):
        import pyarrow as pa

        asks = table.column("asks").to_numpy()
        keys, v = np.stack([table.column(c).to_numpy() for c in ("id", "x", "y")]), matrix(table.column("v")).astype(np.float64)
        q, asked, p, found = v[asks], keys[:, asks], v[~asks], keys[:, ~asks]
        out = []
        if len(q) and len(p):
            rough = q @ p.T
            n = min(most, len(p))
            # all that may tie at the cut stay until they are ordered by id
            cut = -np.partition(-rough, n - 1, axis=1)[:, n - 1] - 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(p, axis=1).max()
            for i in range(len(q)):
                at = np.flatnonzero(rough[i] >= cut[i])
                exact = (p[at] * q[i]).sum(axis=1)  # the same bits in whatever block
                order = np.lexsort((*found[::-1, at], -exact))[:most]
                out.append((asked[1:, i], found[:, at[order]], exact[order]))
        salt = (int(table.column("list")[0].as_py()) + 31 * int(table.column("chunk")[0].as_py())) % SALTS if table.num_rows else 0
        whole, longs = pa.int64(), pa.list_(pa.int64())
        columns = {"x": pa.array([a[0] for a, _, _ in out], whole), "y": pa.array([a[1] for a, _, _ in out], whole), "salt": pa.array([salt] * len(out), pa.int32())}
        columns |= {name: pa.array([f[k] for _, f, _ in out], longs) for k, name in enumerate(("ids", "xs", "ys"))}
        return pa.table(columns | {"lows": pa.array([-s for _, _, s in out], pa.list_(pa.float64()))})

    parts = left.unionByName(right).groupBy("list", "chunk", "block").applyInArrow(nearest, "x long, y long, salt int, ids array<long>, xs array<long>, ys array<long>, lows array<double>")
    parts = parts.withColumn("asked", F.struct("x", "y"))
    pairs = F.transform(F.arrays_zip("lows", "ids", "xs", "ys"), lambda e: F.struct(e["lows"].alias("low"), e["ids"].alias("id"), e["xs"].alias("x"), e["ys"].alias("y")))
    # a vector is in so many lists at most: what is cut after sorting holds enough distinct ones, and is short
    near = F.slice(F.array_sort(F.flatten(F.collect_list(pairs))), 1, most * how.copies)
    # in two steps, so that no row gathers all parts of a query at once
    some_of = parts.groupBy("asked", "salt").agg(F.slice(F.array_distinct(near), 1, most).alias("best"))
    best = some_of.groupBy("asked").agg(F.slice(F.array_distinct(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, most * how.copies)), 1, most).alias("best"))
    # from classes back to ids: those of the nearest classes, of which each has one at least
    some = smallest_ids(rows.select("class", "id"), most)
    each = best.select("asked", F.explode("best").alias("b")).select("asked", "b.low", F.col("b.id").alias("head"), F.struct("b.x", "b.y").alias("class")).join(some, "class", "left")
    each = each.select("asked", F.transform(F.coalesce("ids", F.array("head")), lambda i: F.struct(F.col("low").alias("low"), i.alias("id"), F.col("class").alias("class"))).alias("x"))
    merged = each.groupBy("asked").agg(F.slice(F.array_sort(F.flatten(F.collect_list("x"))), 1, most).alias("x"))
    result = asked.join(spill(merged, "named").withColumnRenamed("asked", "class"), "class")
    own = lambda s: (s["id"] == F.col("query_id")) & (s["class"] == F.col("class"))
    result = result.select("query_id", "class", F.slice(F.filter("x", lambda s: ~own(s)), 1, how.k).alias("x"))
    digest = F.concat(F.lpad(F.lower(F.hex("class.x")), 16, "0"), F.lpad(F.lower(F.hex("class.y")), 16, "0")).alias("query_vector")
    return result.select("query_id", digest, F.posexplode("x").alias("at", "s")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("s.id").alias("vec_id"), (-F.col("s.low")).alias("score"), "query_vector")
