"""Ranked lexical search by a hierarchical max tree over document ranges.

Items are queries: their terms score every document by whole-number sums, and each item gets its best documents. Documents
are taken in ranges of up to `range_docs`. Over a range stands a tree: leaves of `leaf` neighbouring documents, above them
nodes of `fan` children up to one root; for each term it holds the highest score that a document below a node has of the
term. The sum of these over an item's terms bounds every document below the node. The search is best first: it opens the
node with the highest bound, and ends when the best node left is below the worst of the item's documents so far. A node
whose bound equals it is opened, as a document with an equal score and a smaller id may be below. Documents so far are kept
from range to range, so most ranges of a task end at their root.

1. postings: a map over the documents gives each its length and its counts of the items' terms, which is all that later
   steps read; written to shared storage. Numbers of documents and terms and document frequencies are sums over it.
2. A map over the postings builds the trees and searches them; a task returns at most `top` rows an item.
3. The best `top` of these an item, in two steps, so that no window holds more than a part of the tasks' rows.

Items are taken in blocks of about `block_bytes` of text, a pass over the documents each, so what tasks hold of items is
bounded (an item is never divided). Terms are maximal runs of ASCII letters and digits and of anything beyond ASCII, with
only A-Z lower-cased.

Defined results: documents and items without terms, or with a null text, match nothing, and such documents don't count.
Repeated rows of documents are documents each; repeated rows of items are one item; different texts under one item id are
items each, ranked apart. Very long texts count whole. Equal scores go by ascending document id, null last. Empty tables
give an empty result. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..shipping import ship
from .common import slices, spill

#: For bytes.translate: A-Z to lower case; of ASCII everything but letters and digits to a blank.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


@dataclass(frozen=True)
class Ranking:
    top: int = 20
    leaf: int = 32
    fan: int = 8
    range_docs: int = 1 << 14
    #: A range ends before this many postings, too, so that its tree has a bounded size.
    range_postings: int = 1 << 21
    block_bytes: int = 4 << 20


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def weights(df: list[int], n_docs: int) -> list[int]:
    """Of terms by document frequency, in doubles, rounded down."""
    return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df]


class Tree:
    """The max tree of one range of documents, for every term in it."""

    def __init__(self, how: Ranking, weight, lengths: list[int], postings: list[tuple], n_docs: int, n_terms: int):
        """lengths: terms of each document; postings: (term ids, counts) of each, as arrays."""
        import numpy as np

        self.how, self.size = how, len(lengths)
        m = np.array([100 - 25 + 25 * n * n_docs // n_terms for n in lengths], np.int64)
        docs = np.repeat(np.arange(self.size), [len(t) for t, _ in postings])
        terms, tf = (np.concatenate([p[k] for p in postings]).astype(np.int64) for k in range(2))
        score = weight[terms] * (1_000_000_000 * tf // (1000 * tf + 12 * m[docs]))
        order = np.argsort(terms, kind="stable")  # documents ascend within a term
        self.docs, self.score, terms = docs[order], score[order], terms[order]
        self.terms = np.unique(terms)
        row = np.searchsorted(self.terms, terms)
        #: From the leaves up to the root: (where each term's nodes begin, nodes, highest scores). Terms have entries only for nodes that hold them.
        self.levels, self.widths = [], []
        width, node, best = -(-self.size // how.leaf), self.docs // how.leaf, self.score
        while True:
            first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (node[1:] != node[:-1])])) if len(row) else np.empty(0, np.int64)
            if not self.levels:
                self.postings = np.append(first, len(row))  # of each leaf entry
            best = np.maximum.reduceat(best, first) if len(first) else best
            row, node = row[first], node[first]
            self.levels.append((np.searchsorted(row, np.arange(len(self.terms) + 1)), node, best))
            self.widths.append(width)
            if width == 1:
                break
            width, node = -(-width // how.fan), node // how.fan

    def entries(self, level: int, rows, times):
        """(entry indexes, and how often the item has the term of each) of these terms on one level."""
        import numpy as np

        begin, end = self.levels[level][0][rows], self.levels[level][0][rows + 1]
        return runs(begin, end - begin), np.repeat(times, end - begin)

    def bounds(self, level: int, rows, times):
        """The summed bounds of all nodes of a level."""
        import numpy as np

        entries, often = self.entries(level, rows, times)
        _, node, best = self.levels[level]
        out = np.zeros(self.widths[level], np.int64)
        np.add.at(out, node[entries], best[entries] * often)
        return out

    def search(self, terms, times, best: Best, ids: list) -> int:
        """Offer an item's documents of this range, best nodes first; how many nodes and leaves were opened."""
        import numpy as np

        have = np.isin(terms, self.terms, assume_unique=True)
        rows, times = np.searchsorted(self.terms, terms[have]), times[have]
        if not len(rows):
            return 0
        top = len(self.levels) - 1
        sums, opened, leaves = {top: self.bounds(top, rows, times)}, 0, None
        heap = [(-int(sums[top][0]), top, 0)]
        while heap and -heap[0][0] >= best.least:
            _, level, node = heapq.heappop(heap)
            opened += 1
            if level:
                below = level - 1
                if below not in sums:
                    sums[below] = self.bounds(below, rows, times)
                begin = node * self.how.fan
                for k, bound in enumerate(sums[below][begin : begin + self.how.fan].tolist(), begin):
                    if bound and bound >= best.least:
                        heapq.heappush(heap, (-bound, below, k))
                continue
            if leaves is None:
                leaves = self.entries(0, rows, times)
            entries, often = leaves
            here = np.flatnonzero(self.levels[0][1][entries] == node)
            begin, lengths = self.postings[entries[here]], self.postings[entries[here] + 1] - self.postings[entries[here]]
            at, low = runs(begin, lengths), node * self.how.leaf
            scores = np.zeros(self.how.leaf, np.int64)
            np.add.at(scores, self.docs[at] - low, self.score[at] * np.repeat(often[here], lengths))
            good = np.flatnonzero(scores >= max(best.least, 1))
            if len(good):
                best.offer([(-int(scores[k]), ids[low + k]) for k in good])
        return opened


def runs(begin, lengths):
    """begin, begin + 1 and so on, of each length, end to end."""
    import numpy as np

    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + lengths, lengths)


class Best:
    """An item's best documents so far; least: the score below which nothing counts any more."""

    def __init__(self, top: int):
        self.top, self.rows, self.least = top, [], 1

    def offer(self, rows: list[tuple]) -> None:
        self.rows = sorted(self.rows + rows, key=lambda r: (r[0], r[1] is None, r[1]))[: self.top]
        if len(self.rows) == self.top:
            self.least = -self.rows[-1][0]


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, counts) of every document with a term: its length, and the ids and counts of terms of the vocabulary."""
    ship(docs.sparkSession)
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ints = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([picked.schema["id"], T.StructField("n", T.LongType()), T.StructField("terms", ints), T.StructField("counts", ints)])

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        get, kind = vocabulary.get, pa.list_(pa.field("element", pa.int32(), False))
        for part in slices(batches):
            rows = []
            for at, text in enumerate(part.column(1).to_pylist()):
                if found := terms_of(text):
                    counted = [(t, c) for term, c in Counter(found).items() if (t := get(term)) is not None]
                    rows.append((at, len(found), [t for t, _ in counted], [c for _, c in counted]))
            if rows:
                at, n, terms, counts = (list(x) for x in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), pa.array(n, pa.int64()), pa.array(terms, kind), pa.array(counts, kind)], names=schema.names)

    return picked.mapInArrow(work, schema)


def _ranges(how: Ranking, batches: Iterator) -> Iterator[tuple[list, list, list]]:
    """(ids, lengths, (terms, counts) arrays) of one range of documents after the other."""
    import numpy as np

    ids, lengths, found, total = [], [], [], 0
    for batch in batches:
        flat = [batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (2, 3)]
        ends = np.cumsum([0, *(len(x) for x in batch.column(2))]).tolist()
        for k, (id_, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            begin, end = ends[k], ends[k + 1]
            if begin == end:
                continue
            if ids and (len(ids) == how.range_docs or total + end - begin > how.range_postings):
                yield ids, lengths, found
                ids, lengths, found, total = [], [], [], 0
            ids.append(id_)
            lengths.append(n)
            found.append((flat[0][begin:end], flat[1][begin:end]))
            total += end - begin
    if ids:
        yield ids, lengths, found


def _block(docs: DataFrame, items: list[tuple], item_type: T.DataType, how: Ranking, id_col: str, text_col: str) -> DataFrame:
    """(key, item, id, score): the best documents of these items, at most top an item and task."""
    asked = [(item, Counter(terms_of(text))) for item, text in items]
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, c in asked for t in c}))}
    table = spill(postings(docs, vocabulary, id_col, text_col), "postings")
    n_docs, n_terms = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = [0] * len(vocabulary)
    for term, count in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row a term of the items
        df[term] = count
    weight = weights(df, n_docs)
    queries = [(item, [vocabulary[t] for t in c], list(c.values())) for item, c in asked]
    schema = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("item", item_type), table.schema["id"], T.StructField("score", T.LongType())])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        mine = [(np.array(t, np.int64), np.array(c, np.int64), Best(how.top)) for _, t, c in queries]
        weighed = np.array(weight, np.int64)
        for ids, lengths, found in _ranges(how, batches):
            tree = Tree(how, weighed, lengths, found, n_docs, n_terms)
            for terms, times, best in mine:
                tree.search(terms, times, best, ids)
        out = [(k, queries[k][0], id_, -minus) for k, (_, _, best) in enumerate(mine) for minus, id_ in best.rows]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=schema.names)

    return table.mapInArrow(work, schema)


def search(docs: DataFrame, items: DataFrame, how: Ranking | None = None, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(item_col, rank, id_col, score): each item's best documents with a score above 0, rank 1 first."""
    how = how or Ranking()
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").alias("text")).where(F.col("text").isNotNull()).distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // how.block_bytes))
    order = [F.desc("score"), F.asc_nulls_last("id")]

    def best(found: DataFrame, *by: str) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= how.top)

    parts = []
    for k in range(blocks):
        chosen = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else asked
        rows = [tuple(r) for r in chosen.orderBy("item", "text").collect()]  # about block_bytes of text
        found = _block(docs, rows, asked.schema["item"].dataType, how, id_col, text_col)
        parts.append(best(best(found.withColumn("part", F.spark_partition_id() % 64), "key", "part"), "key"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
