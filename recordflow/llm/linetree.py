"""Line dedup by log templates.

A line is parsed down a tree of fixed depth: its number of tokens, then its
first ``DEPTH`` tokens; there tokens with a digit count as one variable token.
Lines of one leaf are generalised place by place. A token weighs as much as the
documents of the leaf that have it at its place. A line's places are put in the
order of their weights, and the heaviest ones that make up ``CONSTANT`` of the
line, over half of those after the leading tokens among them, are its constant
places; a token with a digit is only taken if it has ``SAME`` of the line's
greatest weight, and in a line of fewer than ``SHORT`` tokens all without a
digit are constant. The other places are fields.

Whether that is a template is decided by shares alone, step by step down the
constant places: of the lines that agree in the places so far, at least ``SAME``
must agree in the next one too. One step may fall short of it, as several
templates may begin alike. In a template the constant tokens come together, so
the shares stay near 1 in a leaf of any size; in unlike lines of frequent words
each step keeps only the word's own share, however large the leaf.

A template that at least ``min_docs`` documents have is recurring, and so is a
line that as many have word by word, or two documents if it has over ``LONG``
tokens: its lines stay in the document with the smallest id and are dropped from
the others. Lines with fewer than ``MIN_TOKENS`` tokens are never dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, arrow_batches, blocks, frugal, lower_ascii, mix, stored, temporary

DEPTH = 3
MIN_TOKENS = 5
SHORT = 8  # in a shorter line only tokens with a digit vary: two or three equal words are no template
MIN_DOCS = 5
LONG = 50  # a longer line is a passage: it recurs where two documents have it word by word
CONSTANT = 0.6  # share of constant places
SAME = 0.5  # least share of the lines so far that a constant place keeps
BRANCHES = 1  # constant places that may keep less

_U = np.uint64
_VARIABLE = _U(0x5BD1E995)


class Lines:
    """The lines of several texts that have ``MIN_TOKENS`` tokens: text, place among the text's lines, leaf and key."""

    def __init__(self, texts: list[bytes]):
        w = Words(texts)
        b = np.frombuffer(w.buf, np.uint8)
        digits = np.concatenate([[0], np.cumsum((b >= 0x30) & (b <= 0x39))])
        digit = digits[w.end] != digits[w.start]
        self.token = (w.hash & ~_U(1)) | digit.astype(_U)  # the lowest bit tells a token with a digit
        lead = np.where(digit, _VARIABLE, w.hash)
        end = np.flatnonzero(b[:-8] == 10)
        start = np.concatenate([[0], end[:-1] + 1])
        first, last = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
        text = np.searchsorted(w.offset, start, side="right") - 1
        self.per_text = np.bincount(text, minlength=len(texts))
        place = np.arange(len(text)) - np.searchsorted(text, text)
        use = last - first >= MIN_TOKENS
        self.text, self.place, self.first, self.n = text[use], place[use], first[use], (last - first)[use]
        leaf = mix(self.n.astype(_U) + _U(3))
        for j in range(DEPTH):
            leaf = mix(leaf ^ lead[self.first + j]) if len(leaf) else leaf
        self.leaf = leaf
        # Key of a line: a sum over its tokens, each mixed with its place.
        at = np.repeat(self.first - np.concatenate([[0], np.cumsum(self.n)[:-1]]), self.n) + np.arange(self.n.sum())
        seat = at - np.repeat(self.first, self.n)
        mixed = mix(self.token[at] ^ mix(seat.astype(_U) + _U(11)))
        cut = np.concatenate([[0], np.cumsum(self.n)])
        total = np.concatenate([[_U(0)], np.cumsum(mixed, dtype=_U)])
        self.key = mix((total[cut[1:]] - total[cut[:-1]]) ^ mix(self.n.astype(_U)))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _keys(batches):
    for batch in batches:
        for part in blocks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), lambda r: len(r[1] or "")):
            x = Lines([lower_ascii(t) for _, t in part])
            _, one = np.unique(mix(x.text.astype(_U) + _U(1)) ^ x.key, return_index=True)  # once per document
            ids = np.array([d for d, _ in part], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[x.text[one]]), pa.array(_signed(x.leaf[one])), pa.array(_signed(x.key[one])), pa.array(x.n[one])], names=["id", "leaf", "line", "n"])


def _tokens(batches):
    for batch in batches:
        for part in blocks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), lambda r: len(r[1] or "")):
            x = Lines([lower_ascii(t) for _, t in part])
            _, one = np.unique(x.key, return_index=True)
            first, n = x.first[one], x.n[one]
            cut = np.concatenate([[0], np.cumsum(n)])
            at = np.repeat(first - cut[:-1], n) + np.arange(cut[-1])
            tokens = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(_signed(x.token[at])))
            yield pa.RecordBatch.from_arrays([pa.array(np.array([d for d, _ in part], np.int64)[x.text[one]]), pa.array(_signed(x.key[one])), tokens], names=["first", "line", "tokens"])


def constant_places(n, words, count, weight, seat, digit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Constant places of several lines: their numbers among the places given, heaviest first, the line of each, and its number in the line.

    ``n``, ``words`` (tokens without a digit) and ``count`` (places given) are by
    line, the others by place, line after line. A line whose places don't
    suffice has none.
    """
    line = np.repeat(np.arange(len(n)), count)
    top = np.zeros(len(n), np.int64)
    np.maximum.at(top, line, weight)
    use = np.flatnonzero(~digit | (weight >= SAME * top[line]))
    order = use[np.lexsort((seat[use], -weight[use], line[use]))]
    line = line[order]
    first = np.searchsorted(line, np.arange(len(n)))
    k = np.arange(len(order)) - first[line]

    def so_far(x):
        total = np.concatenate([[0], np.cumsum(x)])
        return total[1:] - total[first[line]]

    enough = (k + 1 >= np.ceil(CONSTANT * n)[line]) & (so_far(seat[order] >= DEPTH) >= ((n - DEPTH) // 2 + 1)[line])
    enough &= (n >= SHORT)[line] | (so_far(~digit[order]) == words[line])  # in a short line every token without a digit
    last = np.full(len(n), -1)
    np.maximum.at(last, line[enough], -k[enough] + (1 << 40))
    last = np.where(last >= 0, (1 << 40) - last, -1)  # the first place that makes up enough
    keep = k <= last[line]
    return order[keep], line[keep], k[keep]


def _chains(batches):
    """For each line the keys of its constant places so far, from the first place on that not all lines of the leaf agree in."""
    names = ["line", "docs", "k", "last", "shared", "everyone", "key"]
    for batch in batches:
        line_key, leaf, docs, n, words, everyone = (batch.column(i).to_numpy() for i in range(6))
        lists = batch.column(6)
        flat = lists.flatten()
        weight, seat, place = (flat.field(f).to_numpy().astype(np.int64) for f in ("weight", "seat", "place"))
        digit = flat.field("digit").to_numpy(zero_copy_only=False)
        at, line, k = constant_places(n, words, lists.value_lengths().to_numpy(), weight, seat, digit)
        final = np.append(line[1:] != line[:-1], True) if len(line) else np.zeros(0, bool)
        shared = weight[at] == everyone[line]
        # The key of the places so far is a sum over them, so their order doesn't matter.
        total = np.cumsum(mix(place[at].view(_U)), dtype=_U)
        start = np.searchsorted(line, line)
        key = mix((total - np.where(start > 0, total[start - 1], _U(0))) ^ leaf[line].view(_U) ^ mix((k + 1).astype(_U))) if len(line) else total
        out = ~shared | final
        cols = [line_key[line], docs[line], k.astype(np.int32), final, shared, everyone[line], _signed(key)]
        yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in cols], names=names)


def _templates(plain: DataFrame, lines: DataFrame, min_docs: int) -> DataFrame:
    """(line, template, documents that make it recur) of every line of a leaf that enough documents reach; a line that enough documents have is a template itself."""
    distinct = lines.groupBy("leaf", "line", "n").agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first"))
    enough = F.when(F.col("n") > LONG, F.least(F.lit(2), F.lit(min_docs))).otherwise(F.lit(min_docs))
    leaves = distinct.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds"), F.sum("docs").alias("all"), F.first("n").alias("n")).where(F.col("all") >= enough).drop("n")
    near = stored(distinct.join(leaves, "leaf"), "lines/candidates")
    exact = near.where(F.col("docs") >= enough).select("line", F.col("line").alias("template"), enough.alias("enough"))
    # The tokens of a line come from the first document that has it.
    several = near.where((F.col("kinds") > 1) & (F.col("all") >= min_docs)).select("leaf", "line", "docs", "first", "n", "all")
    held = plain.join(several.select(F.col("first").alias("id")).distinct().hint("merge"), "id", "left_semi")
    tokens = stored(held.mapInArrow(frugal(_tokens), "first long, line long, tokens array<long>").join(several, ["first", "line"]).drop("first"), "lines/tokens")
    seats = tokens.select("line", "docs", "leaf", F.posexplode("tokens").alias("seat", "token")).select(
        "line", "docs", "seat", (F.col("token").bitwiseAND(1) == 1).alias("digit"), F.xxhash64("leaf", "seat", "token").alias("place"))
    # A token that fewer documents have is in no template, so it isn't carried on.
    weights = seats.groupBy("place").agg(F.sum("docs").alias("weight")).where(F.col("weight") >= min_docs)
    places = seats.join(weights, "place").groupBy("line").agg(F.collect_list(F.struct("weight", "seat", "place", "digit")).alias("places"))  # those of one line
    words = F.size(F.filter("tokens", lambda t: t.bitwiseAND(F.lit(1)) == 0))
    known = places.join(tokens.select("line", "leaf", "docs", "n", words.alias("words"), "all"), "line").where(F.size("places") >= F.ceil(CONSTANT * F.col("n"))) \
        .select("line", "leaf", "docs", "n", "words", "all", "places")
    chains = stored(known.mapInArrow(frugal(_chains), "line long, docs long, k int, last boolean, shared boolean, everyone long, key long"), "lines/chains")
    having = chains.where("not shared").groupBy("key").agg(F.sum("docs").alias("have"))
    steps = chains.where("not shared").join(having, "key").unionByName(chains.where("shared").withColumn("have", F.col("everyone")))
    # The lines so far are those of the step before, or all of the leaf before the first step that tells lines apart.
    each = steps.groupBy("line").agg(F.array_sort(F.collect_list(F.struct("k", "have"))).alias("steps"), F.max("everyone").alias("everyone"),
                                     F.max(F.when(F.col("last"), F.col("key"))).alias("template"))
    short = F.expr(f"""size(filter(sequence(0, size(steps) - 1), i ->
        steps[i].have < {SAME} * CASE WHEN i = 0 THEN everyone ELSE steps[i - 1].have END))""")
    found = each.where((short <= BRANCHES) & (F.expr("steps[size(steps) - 1].have") >= min_docs))
    return exact.unionByName(found.select("line", "template", F.lit(min_docs).alias("enough")))


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, lines): for each document the keys of the lines that it loses."""
    spark = docs.sparkSession
    arrow_batches(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    lines = stored(plain.mapInArrow(frugal(_keys), "id long, leaf long, line long, n long"), "lines/keys")
    templates = stored(_templates(plain, lines, min_docs), "lines/templates")
    having = lines.select("id", "line").join(templates, "line").select("id", "line", "template", "enough")
    known = having.select("id", "template", "enough").distinct().groupBy("template", "enough").agg(F.count(F.lit(1)).alias("docs"), F.min("id").alias("first")).where("docs >= enough")
    lost = having.join(known.select("template", "first"), "template").where("id <> first").select("id", "line")
    return lost.groupBy("id").agg(F.collect_set("line").alias("lines"))  # at most the lines of one document


COUNTS = ["n_lines", "n_dropped"]


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, counts: bool = False) -> DataFrame:
    """``docs`` with recurring lines cut out of their texts; with ``counts`` also n_lines and n_dropped, in place of columns of these names.

    Tokens are compared with A-Z lower-cased. Other lines, line ends and
    columns stay as they are; a text that loses all its lines becomes empty,
    its row stays. Null texts stay null. Rows that share an id are one document
    and lose the same lines. Rows with a null id have no place in the order of
    documents: they count for nothing and lose nothing. Texts and lines of any
    length are read whole. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with temporary(spark):
        lost = stored(recurring_lines(docs, id_col, text_col, min_docs), "lines/lost", keep=True)
    if counts:
        docs = docs.drop(*COUNTS)
    key, gone = "lost_id", "lost_lines"
    while key in docs.columns or gone in docs.columns:
        key, gone = f"_{key}", f"_{gone}"
    # Texts are shuffled by id at any size: the list of lost lines grows with them.
    both = docs.join(lost.select(F.col("id").alias(key), F.col("lines").alias(gone)).hint("merge"), F.col(id_col).cast("long") == F.col(key), "left").drop(key)
    text_at, gone_at, keep = docs.columns.index(text_col), len(docs.columns), docs.columns

    def cut(batches):
        for batch in batches:
            texts, lists = batch.column(text_at).to_pylist(), batch.column(gone_at).to_pylist()
            n_lines, n_dropped = [0 if t is None else t.count("\n") + 1 for t in texts], [0] * len(texts)
            todo = [i for i, x in enumerate(lists) if x and texts[i] is not None]
            for part in blocks(iter(todo), lambda i: len(texts[i])):
                x = Lines([lower_ascii(texts[i]) for i in part])
                own = np.concatenate([[0], np.cumsum(np.bincount(x.text, minlength=len(part)))])
                for k, i in enumerate(part):
                    here = slice(own[k], own[k + 1])
                    drop = set(x.place[here][np.isin(_signed(x.key[here]), np.array(lists[i], np.int64))].tolist())
                    texts[i] = "\n".join(line for j, line in enumerate(texts[i].split("\n")) if j not in drop)
                    n_dropped[i] = len(drop)
            cols = [pa.array(texts, batch.column(i).type) if i == text_at else batch.column(i) for i in range(len(keep))]
            names = list(keep)
            if counts:
                cols, names = [*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*names, *COUNTS]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = docs.schema
    if counts:
        from pyspark.sql.types import LongType, StructType

        schema = StructType(schema.fields).add("n_lines", LongType()).add("n_dropped", LongType())
    return both.mapInArrow(frugal(cut), schema)
