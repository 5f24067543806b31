"""Ranked lexical search through per-term geometric blocks.

1. Every document's terms and their counts are written once (the forward
   table); document frequencies, the number of documents and their length come
   from it.
2. Each (document, term) gets its exact integer share of the score. Documents
   are dealt to shards by a hash of their row, about ``SHARD_POSTINGS`` shares
   each, so no term's posting list is ever gathered as a whole: a term that
   stands in every document has a list of its own in every shard.
3. In a shard, each term's posting list is clustered by document similarity
   (nearest of pivot documents of the list, on a random projection of the score
   vectors) and cut into blocks of similar documents. A block's summary is the
   coordinatewise maximum of its documents' score vectors.
4. An item visits the blocks of its terms' lists by falling bound (the sum of
   the summary over its terms, never below the best score inside), scores
   unseen documents exactly, and skips a block only when its bound lies below
   the tenth best score so far. Shards' bests are merged by Spark.

Items go to the tasks in blocks of about ``BLOCK_PAIRS`` (item, term) pairs, a
bound on what is collected and sent at once; more items mean more blocks.

Defined results: null and empty texts have no terms; such documents are in no
result and such items have no rows. Rows with equal item ids are one item with
the terms of all. Equal document rows are documents of their own; of equal
scores the smaller id comes first, a null id last. Empty tables give no rows.
Very long texts are worked on whole. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import WORD_CHARS, Words, arrow_batches, blocks, lower_ascii, stored

SHARD_POSTINGS = 1_000_000
BLOCK_PAIRS = 200_000
BLOCK_DOCS = 64  # documents of a block
DIMENSIONS = 16  # of the projection that similarity is measured on
SEED = 11


def _terms(batches):
    """(row, id, n, terms, counts) of each document; ``row`` numbers the rows of the written table."""
    part = TaskContext.get().partitionId()
    seen = 0
    for batch in batches:
        rows = list(zip(batch.column("id").to_pylist(), map(lower_ascii, batch.column("text").to_pylist())))
        for block in blocks(iter(rows), lambda r: len(r[1])):
            words = Words([r[1] for r in block], WORD_CHARS)
            per_doc = words.text_of()
            order = np.lexsort((words.hash, per_doc))
            h, d = words.hash[order], per_doc[order]
            new = np.ones(len(order), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(order)))
            at = order[first]
            terms = [words.buf[a:b] for a, b in zip(words.start[at].tolist(), words.end[at].tolist())]
            off = np.searchsorted(d[first], np.arange(len(block) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(seen, seen + len(block), dtype=np.int64) + (part << 40)), pa.array([r[0] for r in block], batch.column("id").type),
                 pa.array(words.per.astype(np.int64)), pa.ListArray.from_arrays(pa.array(off), pa.array(terms, pa.binary()).cast(pa.string())),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(count.astype(np.int64)))],
                ["row", "id", "n", "terms", "counts"])
            seen += len(block)


def _forward(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    id_type = df.schema[id_col].dataType.simpleString()
    return df.selectExpr(f"`{id_col}` AS id", f"CAST(`{text_col}` AS STRING) AS text").mapInArrow(
        _terms, f"row long, id {id_type}, n long, terms array<string>, counts array<long>")


class Shard:
    """Posting lists, blocks and summaries over a shard's (document, term, share) triples.

    ``items`` are arrays of term numbers; a list's summary holds the terms that
    items with the list's term ask for, since no other can enter a bound.
    """

    def __init__(self, doc: np.ndarray, term: np.ndarray, share: np.ndarray, n_docs: int, n_terms: int, items: list[np.ndarray]):
        order = np.lexsort((term, doc))
        self.term, self.share = term[order], share[order]
        doc = doc[order]
        self.at = np.searchsorted(doc, np.arange(n_docs + 1))  # of each document's triples
        by_term = np.argsort(self.term, kind="stable")
        self.list_docs = doc[by_term]
        self.list_at = np.searchsorted(self.term[by_term], np.arange(n_terms + 1))
        self.items, self.n_terms = items, n_terms
        self.place = self._projection(doc, n_docs)
        pair_item = np.repeat(np.arange(len(items)), [len(x) for x in items])
        pair_term = np.concatenate(items) if items else np.empty(0, np.int64)
        by = np.argsort(pair_term, kind="stable")
        self.asking = pair_item[by]  # items by term
        self.asking_at = np.searchsorted(pair_term[by], np.arange(n_terms + 1))

    def _projection(self, doc: np.ndarray, n_docs: int) -> np.ndarray:
        signs = np.random.default_rng(SEED).choice(np.array([-1.0, 1.0], np.float32), (self.n_terms, DIMENSIONS))
        out = np.stack([np.bincount(doc, weights=self.share * signs[self.term, j], minlength=n_docs) for j in range(DIMENSIONS)], axis=1)
        norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return (out / np.where(norm > 0, norm, 1)).astype(np.float32)

    def blocked(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents of list ``t`` in the order of its blocks, and where each block begins (and the end)."""
        docs = self.list_docs[self.list_at[t]:self.list_at[t + 1]]
        n = len(docs)
        if n <= BLOCK_DOCS:
            return docs, np.array([0, n])
        pivots = docs[np.linspace(0, n - 1, -(-n // BLOCK_DOCS)).astype(np.int64)]
        where = self.place[pivots].T
        near = np.concatenate([(self.place[docs[i:i + 4096]] @ where).argmax(axis=1) for i in range(0, n, 4096)])
        order = np.argsort(near, kind="stable")
        docs, near = docs[order], near[order]
        run = np.concatenate([[0], np.flatnonzero(np.diff(near)) + 1, [n]])
        cut = [np.arange(a, b, BLOCK_DOCS) for a, b in zip(run[:-1], run[1:])]
        return docs, np.append(np.concatenate(cut), n)

    def _triples(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all triples of ``docs``, and the position in ``docs`` that each belongs to."""
        size = self.at[docs + 1] - self.at[docs]
        ends = np.cumsum(size)
        who = np.repeat(np.arange(len(docs)), size)
        return np.arange(ends[-1] if len(ends) else 0) + (self.at[docs] - (ends - size))[who], who

    def summary(self, t: int, docs: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(terms, maxima): for each block of list ``t`` the coordinatewise maximum over its documents."""
        mine = self.asking[self.asking_at[t]:self.asking_at[t + 1]]
        terms = np.unique(np.concatenate([self.items[i] for i in mine])) if len(mine) else np.empty(0, np.int64)
        col = np.full(self.n_terms, -1, np.int64)
        col[terms] = np.arange(len(terms))
        out = np.zeros((len(start) - 1, len(terms)), np.int64)
        block = np.repeat(np.arange(len(start) - 1), np.diff(start))
        for i in range(0, len(docs), 8192):
            at, who = self._triples(docs[i:i + 8192])
            c = col[self.term[at]]
            use = c >= 0
            np.maximum.at(out, (block[i:i + 8192][who[use]], c[use]), self.share[at[use]])
        return terms, out

    def _bounds(self):
        """By item: (list, block) and bound of every block of its terms' lists."""
        self.docs, self.start = {}, {}
        found: list[list] = [[] for _ in self.items]
        for t in np.flatnonzero(np.diff(self.list_at)):
            mine = self.asking[self.asking_at[t]:self.asking_at[t + 1]]
            if not len(mine):
                continue
            docs, start = self.blocked(t)
            self.docs[t], self.start[t] = docs, start
            terms, most = self.summary(t, docs, start)
            for i in mine:
                found[i].append((t, most[:, np.searchsorted(terms, self.items[i])].sum(axis=1)))
        return found

    def search(self, k: int):
        """By item: (documents, scores) of at least its ``k`` best (ties at the end included), and blocks seen and skipped."""
        wanted = np.zeros(self.n_terms, bool)
        scored = np.zeros(len(self.at) - 1, bool)
        for i, lists in enumerate(self._bounds()):
            if not lists:
                continue
            which = np.concatenate([np.full(len(b), t) for t, b in lists])
            block = np.concatenate([np.arange(len(b)) for _, b in lists])
            bound = np.concatenate([b for _, b in lists])
            order = np.argsort(-bound, kind="stable")
            wanted[self.items[i]] = True
            docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
            least, at, step = 1, 0, 1
            while at < len(order) and bound[order[at]] >= least:
                take = order[at:at + step]
                take = take[bound[take] >= least]
                fresh = np.unique(np.concatenate([self.docs[t][self.start[t][b]:self.start[t][b + 1]] for t, b in zip(which[take], block[take])]))
                fresh = fresh[~scored[fresh]]
                scored[fresh] = True
                place, who = self._triples(fresh)
                use = wanted[self.term[place]]
                score = np.zeros(len(fresh), np.int64)
                np.add.at(score, who[use], self.share[place[use]])
                docs, scores = np.append(docs, fresh), np.append(scores, score)
                if len(scores) >= k:
                    least = max(1, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                at += len(take)
                step = min(step * 2, 64)
            wanted[self.items[i]] = False
            scored[docs] = False
            best = scores >= least
            yield i, docs[best], scores[best], at, len(order) - at


def _dense(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document number, term and share of each triple, and the first triple of each document."""
    row = table.column("row").to_numpy()
    _, first, doc = np.unique(row, return_index=True, return_inverse=True)
    return doc, table.column("t").to_numpy().astype(np.int64), table.column("share").to_numpy(), first


def _prepared(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str):
    """(forward table, item terms, N, L), the tables written."""
    arrow_batches(docs.sparkSession)
    forward = stored(_forward(docs, doc_id, text), "terms")
    asked = stored(_forward(items, item_id, text).select("id", F.explode("terms").alias("term")).distinct(), "asked")
    n, length = forward.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    return forward, asked, n, length


def _item_blocks(asked: DataFrame) -> list[DataFrame]:
    """The item terms in blocks of about ``BLOCK_PAIRS`` pairs, an item's terms together."""
    count = -(-asked.count() // BLOCK_PAIRS)
    return [asked.where(F.pmod(F.xxhash64("id"), F.lit(count)) == b) for b in range(count)]


def _block_of_items(asked: DataFrame) -> tuple[DataFrame, list, list[np.ndarray], int]:
    """(table of term numbers, item ids, term numbers by item, number of terms) of one block of items."""
    rows = sorted(asked.collect(), key=lambda r: (r["id"] is not None, r["id"], r["term"]))  # about BLOCK_PAIRS rows
    number = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
    ids: list = []
    terms: list[list[int]] = []
    for r in rows:
        if not ids or ids[-1] != r["id"]:
            ids.append(r["id"])
            terms.append([])
        terms[-1].append(number[r["term"]])
    numbers = stored(asked.sparkSession.createDataFrame(list(number.items()), "term string, t int").coalesce(1), "numbers")
    return numbers, ids, [np.unique(np.array(x, np.int64)) for x in terms], len(number)


def _shares(forward: DataFrame, numbers: DataFrame, n: int, length: int) -> DataFrame:
    """(shard, row, id, t, share): each document's positive shares of the numbered terms, dealt to shards."""
    each = forward.select("row", "id", "n", F.explode(F.arrays_zip("terms", "counts")).alias("x")) \
        .select("row", "id", "n", F.col("x.terms").alias("term"), F.col("x.counts").alias("tf")).join(numbers, "term")
    df = each.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    weights = stored(df.select("t", "df", F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1))).alias("w")), "weights")
    postings = weights.agg(F.sum("df")).first()[0] or 0
    shards = max(1, -(-postings // SHARD_POSTINGS))
    share = f"w * ((1000000000 * tf) div (1000 * tf + 8 * (10 + ((90 * n * {n}L) div {max(length, 1)}L))))"
    dealt = each.join(weights.select("t", "w").where("w > 0"), "t") \
        .select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), "row", "id", "t", F.expr(share).cast("long").alias("share")) \
        .where("share > 0")
    return dealt.repartition(shards, "shard")  # about a task per shard, however many there are


def _searcher(ids: list, terms: list[np.ndarray], n_terms: int, item_type: pa.DataType, k: int):
    """The function that gives a shard's ``k`` best documents of each item."""

    def search(table):
        doc, term, share, first = _dense(table)
        names = table.column("id")
        out: list[tuple] = []
        for i, d, score, _, _ in Shard(doc, term, share, len(first), n_terms, terms).search(k):
            name = names.take(pa.array(first[d])).to_pylist()
            mine = sorted(zip((-score).tolist(), [x is None for x in name], [0 if x is None else x for x in name], name), key=lambda r: r[:3])[:k]
            out += [(ids[i], r[3], -r[0]) for r in mine]
        cols = list(zip(*out)) if out else [(), (), ()]
        return pa.table([pa.array(cols[0], item_type), pa.array(cols[1], names.type), pa.array(cols[2], pa.int64())], ["item", "doc", "score"])

    return search


def _indexer(names: list[str], terms: list[np.ndarray], n_terms: int):
    """The function that gives a shard's blocks as rows."""

    def index(table):
        doc, term, share, first = _dense(table)
        shard, ids = Shard(doc, term, share, len(first), n_terms, terms), table.column("id")
        out: list[tuple] = []
        for t in np.flatnonzero(np.diff(shard.list_at)):
            members, start = shard.blocked(t)
            asked, most = shard.summary(t, members, start)
            for b in range(len(start) - 1):
                inside = ids.take(pa.array(first[members[start[b]:start[b + 1]]])).to_pylist()
                out.append((table.column("shard")[0].as_py(), names[t], b, inside, [(names[asked[j]], int(most[b, j])) for j in np.flatnonzero(most[b])]))
        cols = list(zip(*out)) if out else [()] * 5
        return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int32()),
                         pa.array(cols[3], pa.list_(ids.type)), pa.array(cols[4], pa.map_(pa.string(), pa.int64()))],
                        ["shard", "term", "block", "documents", "summary"])

    return index


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item id, rank, document id, score): the ``k`` best documents of every item, scores above 0."""
    spark = docs.sparkSession
    forward, asked, n, length = _prepared(docs, items, doc_id, item_id, text)
    item_type, doc_type = items.schema[item_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()
    found = None
    for block in _item_blocks(asked):
        numbers, ids, terms, n_terms = _block_of_items(block)
        search = _searcher(ids, terms, n_terms, to_arrow_type(items.schema[item_id].dataType), k)
        part = _shares(forward, numbers, n, length).groupBy("shard").applyInArrow(search, f"item {item_type}, doc {doc_type}, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], f"item {item_type}, doc {doc_type}, score long")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return stored(found, "bests").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select(F.col("item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score")


def blocked_index(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The blocks as a table: (shard, term, block, documents, summary) with the summary as a map of term to maximum share."""
    forward, asked, n, length = _prepared(docs, items, doc_id, item_id, text)
    doc_type = docs.schema[doc_id].dataType.simpleString()
    found = None
    for block in _item_blocks(asked):
        numbers, _, terms, n_terms = _block_of_items(block)
        index = _indexer([r["term"] for r in numbers.orderBy("t").collect()], terms, n_terms)  # as many as the block's terms
        part = _shares(forward, numbers, n, length).groupBy("shard").applyInArrow(
            index, f"shard int, term string, block int, documents array<{doc_type}>, summary map<string, long>")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame(
        [], f"shard int, term string, block int, documents array<{doc_type}>, summary map<string, long>")
