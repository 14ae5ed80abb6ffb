"""Near-duplicate documents by minhash with tensored banding, verified on whole shingle sets.

1. Every text becomes its set of word shingles; sets of one digest of 128 bits are one class. A class goes by the first half
   of it, a long; where two classes share that, they get new names, so that no two have one.
2. A class has two collections of short minhash tuples, and a table key is a pair of one tuple of each: c * c tables cost
   2 * c tuples. At similarity 0.8 a pair misses all tables with probability 2 * (1 - 0.8 ** width) ** c, 7e-5 here. A
   tuple that no other class has can be in no shared key, so only pairs of shared tuples are formed.
3. Members of a key are checked against the key's smallest class only (a star, no pairs among members); links with enough
   similarity, on whole sets, give components.
4. Keys whose members are still in several components may hide links between others than the star's centre. Their classes
   are joined exactly: two sets similar enough share one of their rarest shingles (prefix filter), so classes that share
   such a shingle with another component are put together, dealt into blocks of a bounded number of sets and shingles, and blocks are compared two at a time by
   matrix products, across components only. One link is returned for each two components in a pair of blocks.
5. Components are closed again and carried to all documents.

Nothing of a class, key or group is collected; hot keys are aggregated partially or joined by sorting, which adaptive
execution splits. Only block pairs grow with the square of a group, and only in groups that the stars leave divided; their
size is bounded by blocks, and they spread over tasks.

Defined results: null texts and texts without a word have an empty set and are linked with nothing; a text of fewer words
than a shingle is one shingle; rows with a null id take part, but a component's id is the smallest id that is not null;
repeated rows each return; very long texts count whole, in memory of one text and its set; equal similarity needs no order,
as all links count; an empty table gives an empty result. Extra columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .common import fresh, settled, small, spill
from .components import components
from .shingles import Sketcher, Tensor

#: Sets are picked from the documents by a broadcast of up to so many ids of 8 bytes; beyond, by a join.
BROADCAST_IDS = 500_000


def mark_of(text_col: str) -> Column:
    """Tells texts of one id apart."""
    return F.xxhash64(F.col(text_col).cast("binary"))


def sketches(docs: DataFrame, how: Tensor, id_col: str, text_col: str) -> DataFrame:
    """(id, mark, n_shingles, half, other, tuples); mark is a digest of the text, half and other that of the set, null if it is empty."""
    ship(docs.sparkSession)

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sketcher = Sketcher(how)
        for batch in small(batches):
            size, node, tuples = [], [], []
            for text in batch.column(2):
                s = sketcher.shingles(text.as_py())
                size.append(len(s))
                node.append(sketcher.name(s) if len(s) else (None, None))
                tuples.append(sketcher.tuples(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), *(pa.array([n[k] for n in node], pa.int64()) for k in range(2)), pa.array(tuples, pa.list_(pa.int64()))], names=["id", "mark", "n_shingles", "half", "other", "tuples"])

    return docs.select(F.col(id_col).cast("long").alias("id"), mark_of(text_col).alias("mark"), F.col(text_col).cast("binary")).mapInArrow(work, "id long, mark long, n_shingles long, half long, other long, tuples array<long>")


def named(classes: DataFrame) -> DataFrame:
    """classes with `node`, a long of its own for each pair of half and other: half, where no other class has it."""
    out, tries = classes.withColumn("node", F.col("half")), 0
    while True:
        twice = spill(out.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("node", F.lit(True).alias("twice")), "twice")
        if twice.isEmpty():
            return out
        tries += 1
        again = F.when(F.col("twice"), F.xxhash64(F.lit(tries), "half", "other")).otherwise(F.col("node"))
        out = spill(out.join(twice, "node", "left").withColumn("node", again).drop("twice"), "named")


def keys_of(classes: DataFrame, how: Tensor) -> DataFrame:
    """(key, node) of the tables' keys; keys of tuples that one class alone has are left out."""
    each = classes.select("node", F.posexplode("tuples").alias("at", "tuple"))
    # here and below, what is joined back by a key is written first: a join of two plain shuffles may be split at a hot key
    shared = spill(each.groupBy("tuple").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("tuple"), "shared")
    some = each.join(shared, "tuple").groupBy("node").agg(
        F.collect_set(F.when(F.col("at") < how.collection, F.col("tuple"))).alias("first"), F.collect_set(F.when(F.col("at") >= how.collection, F.col("tuple"))).alias("second")
    )
    pairs = some.select("node", "second", F.explode("first").alias("x")).select("node", "x", F.explode("second").alias("y"))
    return pairs.select(F.xxhash64("x", "y").alias("key"), "node")


def sets_of(docs: DataFrame, wanted: DataFrame, how: Tensor, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) for wanted (id, half, other, node): one document of each class is read again."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("body"))
    ids = wanted.select("id").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = rows.join(ids, rows["id"].eqNullSafe(ids["id"]), "left_semi")

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sketcher = Sketcher(how)
        for batch in small(batches):
            sets = [sketcher.shingles(t.as_py()) for t in batch.column(1)]
            names = [sketcher.name(s) for s in sets]
            yield pa.RecordBatch.from_arrays([*(pa.array([n[k] for n in names], pa.int64()) for k in range(2)), pa.array([s.view("int64") for s in sets], pa.list_(pa.int64()))], names=["half", "other", "shingles"])

    found = rows.mapInArrow(work, "half long, other long, shingles array<long>")
    # an id may stand for several texts, and a text for several ids
    return found.join(wanted.select("half", "other", "node"), ["half", "other"]).dropDuplicates(["half", "other"]).select("node", "shingles")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"), F.size("shingles").alias("m"))
    sized = pairs.join(two.select("b", "m"), "b").join(one, "a").where((100 * F.size("s") >= percent * F.col("m")) & (100 * F.col("m") >= percent * F.size("s")))
    both = sized.select("a", "b", "s").join(two.select("b", "t"), "b")
    common = F.size(F.array_intersect("s", "t"))
    return both.where(100 * common >= percent * (F.size("s") + F.size("t") - common)).select("a", "b")


def rest(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, block: tuple[int, int]) -> DataFrame:
    """Links (a, b) between components that share a key: step 4."""
    labelled = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    open_keys = spill(labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key"), "keys")
    left = spill(labelled.join(open_keys, "key", "left_semi").select("node", "label").distinct(), "open")
    own = sets.join(left, "node")
    tokens = own.select("node", "label", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    df = spill(tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "rarity")
    # shingles of one class alone come first in order of rarity: they only use up places of the prefix
    shared = tokens.join(df, "shingle").groupBy("node", "label", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("rare"))
    place = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("rare"))
    prefix = spill(shared.where(place > 0).select("node", "label", F.explode(F.slice("rare", 1, place.cast("int"))).alias("x")).select("node", "label", "x.shingle"), "prefix")
    ends = spill(prefix.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("b")).where("low < high").select("shingle", "b"), "ends")
    groups = components(prefix.join(ends, "shingle").select(F.col("node").alias("a"), "b"), "groups").withColumnRenamed("label", "group")
    each = spill(groups.join(left, "node").join(sets, "node"), "contested")
    size = each.groupBy("group").agg(F.ceil(F.greatest(F.count(F.lit(1)) / block[0], F.sum(F.size("shingles")) / block[1])).cast("int").alias("blocks"))
    dealt = each.join(spill(size, "blocks"), "group").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select("group", "node", "label", "own", "shingles", other.alias("other")).select("group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label", "shingles")

    def compare(table):
        import numpy as np
        import pyarrow as pa

        node, label, own = (table.column(c).to_numpy() for c in ("node", "label", "own"))
        out_a, out_b = [], []
        if len(set(label.tolist())) > 1:
            lists = table.column("shingles").combine_chunks()
            flat, size = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
            row = np.repeat(np.arange(len(node)), size)
            keep = count[column] > 1
            row, column = row[keep], np.unique(column[keep], return_inverse=True)[1]
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            common = np.zeros((len(node), len(node)), np.float32)
            step = 8_192
            for k in range(0, int(column[-1]) + 1 if len(column) else 0, step):
                a, b = np.searchsorted(column, [k, k + step])
                x = np.zeros((len(node), min(step, int(column[-1]) + 1 - k)), np.float32)
                x[row[a:b], column[a:b] - k] = 1
                common += x @ x.T
            union = size[:, None] + size[None, :] - common
            first, second = np.nonzero(np.triu(100 * common.astype(np.float64) >= percent * union, 1) & (label[:, None] != label[None, :]))
            seen = set()
            for p, q in zip(first.tolist(), second.tolist(), strict=True):
                pair = (min(label[p], label[q]), max(label[p], label[q]))
                if pair not in seen:
                    seen.add(pair)
                    out_a.append(node[p])
                    out_b.append(node[q])
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return dealt.groupBy("group", "i", "j").applyInArrow(compare, "a long, b long")


def groups_of(docs: DataFrame, how: Tensor = Tensor(), percent: int = 80, block: tuple[int, int] = (256, 60_000), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component, mark, stays) for every row of docs. component: the smallest id linked, over any number of links.

    mark is the digest of the row's text; stays is false where the row's group has an id and the row is not the document,
    an id and a text, that stands for it.
    """
    return settled(lambda: _groups(docs, how, percent, block, id_col, text_col), "groups")


def _groups(docs: DataFrame, how: Tensor, percent: int, block: tuple[int, int], id_col: str, text_col: str) -> DataFrame:
    sigs = spill(sketches(docs, how, id_col, text_col), "sketches")
    classes = spill(sigs.where("half IS NOT NULL").groupBy("half", "other").agg(F.min("id").alias("id"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "mark"))).alias("head"), F.first("tuples").alias("tuples")), "classes")
    classes = named(classes)
    keys = settled(lambda: keys_of(classes, how), "keys")
    leaders = spill(keys.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "leader"), "leaders")
    members = spill(keys.join(leaders, "key"), "members")
    sets = spill(sets_of(docs, classes.join(members.select("node").distinct(), "node", "left_semi").select("id", "half", "other", "node"), how, id_col, text_col), "sets")
    stars = members.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct()
    links = spill(verified(stars, sets, percent), "verified")
    labels = settled(lambda: components(links), "labels")
    more = settled(lambda: rest(members.select("key", "node"), labels, sets, percent, block), "rest")
    if more.isEmpty():
        final = labels
    else:
        final = settled(lambda: components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more), "closed"), "labels")
    labelled = classes.select("half", "other", "node", "head").join(final, "node", "left").select("half", "other", "head", F.coalesce("label", "node").alias("label"))
    lowest = spill(labelled.groupBy("label").agg(F.min("head").alias("head")), "lowest")  # null: no row of the group has an id
    of_class = labelled.drop("head").join(lowest, "label").select("half", "other", "head")
    joined = sigs.select("id", "mark", "n_shingles", "half", "other").join(of_class, ["half", "other"], "left")
    stays = F.col("head").isNull() | (F.col("id").eqNullSafe(F.col("head.id")) & (F.col("mark") == F.col("head.mark")))
    return joined.select("id", "n_shingles", F.coalesce("head.id", "id").alias("component"), "mark", stays.alias("stays"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs, all columns, one document of each group: that with the smallest id, and of its texts one.

    An id may stand for several texts: each is kept or dropped with its own group. Rows of equal id and text stand or fall
    together, and one of them stays. Rows with a null id stay unless their group has an id.
    """
    found = groups_of(docs, id_col=id_col, text_col=text_col, **options)
    gone = found.where("NOT stays").select(F.col("id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    again = found.where("stays AND id IS NOT NULL").groupBy(F.col("id").alias("again_id"), F.col("mark").alias("again_mark")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("again_id", "again_mark")
    gone, again = (F.broadcast(x) if x.count() <= BROADCAST_IDS else x for x in (spill(gone, "gone"), spill(again, "again")))
    (mark,) = fresh(docs, "mark")
    own, marked = [F.col(f"`{c}`") for c in docs.columns], docs.withColumn(mark, mark_of(text_col))
    stay = marked.join(gone, marked[id_col].eqNullSafe(gone["gone_id"]) & (marked[mark] == gone["gone_mark"]), "left_anti")
    if again.isEmpty():
        return stay.select(*own)
    repeated = (stay[id_col] == again["again_id"]) & (stay[mark] == again["again_mark"])
    once = stay.join(again, repeated, "left_semi").dropDuplicates([id_col, mark])
    return stay.join(again, repeated, "left_anti").unionByName(once).select(*own)
