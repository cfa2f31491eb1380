"""Ranked lexical search over a length-stratified index.

Documents with the same length normaliser m form a stratum; a term's postings in a stratum are grouped by how often the
term occurs (tf), so the impact of (m, tf) is worked out once for all its documents. The index is a table of pieces:
documents are spread by stratum, those of a stratum with much of the postings by equal parts of it, and each task cuts its
documents in the order of m into pieces of bounded size, which hold a few strata or a part of one. A search looks up the
postings of its terms and brings those of a piece together. For each query a stratum's bound is the sum of its terms' weights times the impact of the term's largest tf there; strata
are visited by falling bound until it is below the score that the query's last place has in the task, so no document is
lost. The best of all tasks are ranked at the end. Queries are served in blocks of bounded size, which alone are broadcast.

A term is a run of ASCII letters and digits and of all other signs beyond ASCII; A-Z are lower-cased.

Nulls: a null text has no terms; rows of the queries with one id (also a null one) are one query with the terms of all;
a null doc_id is a document like any other and comes last among equal scores. Repeated rows are documents each; equal
scores go by doc_id, then by row. Very long texts are indexed whole; one may be a piece of its own. Empty tables, or
texts without terms, give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from placeforge.llm.words import bounds, gather, list_array, slices, split_words
from placeforge.operators.ordered import sum_before_in_group
from placeforge.session import durable

BEST = 50
PIECE_POSTINGS = 1_000_000  # a piece ends with the document that reaches it
BLOCK_TERMS = 100_000  # terms of the queries that are served at once; the last query of a block may go beyond
HEAVY = 1000
ROWS_PER_BATCH = 50_000

DOCS = "doc_id long, row long, n long, terms array<string>, tfs array<int>"
#: documents of a piece are a row without a term; m and its run lengths say the stratum of each
INDEX = "piece long, term string, df long, m array<long>, tf array<int>, runs array<int>, docs array<int>, ids array<long>, rows array<long>"

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def _split_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(terms per text, code of every term, distinct terms by code)."""
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    raw = (texts.buffers()[2] or pa.py_buffer(b""))[int(offsets[0]) : int(offsets[-1])].to_pybytes()
    folded = raw.translate(_FOLD)  # only ASCII bytes change, so the signs beyond stay whole
    own = pa.py_buffer((offsets - offsets[0]).astype(np.int32))
    return split_words(pa.StringArray.from_buffers(len(texts), own, pa.py_buffer(folded)))


def _term_table(rows: DataFrame) -> DataFrame:
    """(doc_id, row, n, terms, tfs): each text's number of terms, and its different terms with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            n, codes, words = _split_terms(texts)
            key, tf = np.unique(np.repeat(np.arange(len(n)), n) * max(1, len(words)) + codes, return_counts=True)
            doc, code = np.divmod(key, max(1, len(words)))
            each = np.bincount(doc, minlength=len(n))
            terms = pa.ListArray.from_arrays(pa.array(bounds(each), pa.int32()), words.take(pa.array(code)).cast(pa.string()))
            for first in range(0, len(n), ROWS_PER_BATCH):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n), terms, list_array(tf, each, pa.int32())], ["doc_id", "row", "n", "terms", "tfs"]
                ).slice(first, ROWS_PER_BATCH)

    return rows.mapInArrow(count, DOCS)


def build_index(docs: DataFrame) -> DataFrame:
    """The index of all documents of (doc_id, text), as a written table of ``INDEX``; it needs no other table to be searched."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("string").alias("text")
    )
    terms = durable(_term_table(texts).filter("n > 0"), "terms")
    n_docs, n_terms, total = terms.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1)), F.coalesce(F.sum(F.size("tfs")), F.lit(1))).first()
    strata = terms.withColumn("m", F.expr(f"100 - 50 + (50 * n * {n_docs}L) div {n_terms}L"))
    # strata with a thousandth of the postings or more, so at most 1,000, are cut into parts of about that size
    masses = strata.groupBy("m").agg(F.sum(F.size("tfs")).alias("mass"))
    masses = masses.select("m", F.expr(f"mass * {HEAVY} div {total}L").alias("parts")).filter("parts > 0")
    met = strata.join(F.broadcast(masses), "m", "left")
    spread = met.withColumn("share", F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts") + 1), F.lit(0)))
    ordered = spread.repartition("m", "share").sortWithinPartitions("m", "row")
    # the partition in the upper bits; a task adds the number of its piece
    numbered = ordered.select("doc_id", "row", "m", "terms", "tfs", F.shiftright(F.monotonically_increasing_id(), 33).alias("part"))

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = made = 0
        for batch in batches:
            ends = np.cumsum(np.diff(batch.column(3).offsets.to_numpy()).astype(np.int64))
            first = 0
            while first < batch.num_rows:
                before = ends[first - 1] if first else 0
                last = min(batch.num_rows, int(np.searchsorted(ends, before + PIECE_POSTINGS - size)) + 1)
                held.append(batch.slice(first, last - first))
                size += ends[last - 1] - before
                if size >= PIECE_POSTINGS:
                    yield from _piece(held, made)
                    held, size, made = [], 0, made + 1
                first = last
        if held:
            yield from _piece(held, made)

    return durable(numbered.mapInArrow(invert, INDEX), "index")


def _piece(held: list[pa.RecordBatch], made: int) -> Iterator[pa.RecordBatch]:
    whole = pa.Table.from_batches(held)
    column = lambda name: whole.column(name).combine_chunks()
    piece = (int(whole.column("part")[0].as_py()) << 32) + made
    m, lists = column("m").to_numpy(), column("terms")
    each = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    coded, tf = lists.flatten().dictionary_encode(), column("tfs").flatten().to_numpy()
    code, doc = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(each)), each)
    order = np.lexsort((doc, tf, m[doc], code))
    code, doc, tf = code[order], doc[order], tf[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (m[doc[1:]] != m[doc[:-1]]) | (tf[1:] != tf[:-1])
    run = np.flatnonzero(new)
    runs, of_term = np.diff(np.append(run, len(code))), np.bincount(code[run], minlength=len(coded.dictionary))
    df = np.bincount(code, minlength=len(coded.dictionary))
    count, names = len(df), [f.split()[0] for f in INDEX.split(", ")]
    strata, first, n = np.unique(m, return_index=True, return_counts=True)
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    yield pa.RecordBatch.from_arrays(
        [pa.array([piece]), pa.array([None], pa.string()), pa.array([len(m)]), one(strata, pa.int64()), one([], pa.int32()), one(n, pa.int32()),
         one([], pa.int32()), pa.array([column("doc_id").to_pylist()], pa.list_(pa.int64())), one(column("row").to_numpy(), pa.int64())],
        names,
    )
    blank = pa.nulls(count, pa.list_(pa.int64()))
    postings = pa.RecordBatch.from_arrays(
        [pa.array(np.full(count, piece)), coded.dictionary.cast(pa.string()), pa.array(df), list_array(m[doc[run]], of_term, pa.int64()),
         list_array(tf[run], of_term, pa.int32()), list_array(runs, of_term, pa.int32()), list_array(doc, df, pa.int32()), blank, blank],
        names,
    )
    for at in range(0, count, ROWS_PER_BATCH):
        yield postings.slice(at, ROWS_PER_BATCH)


def query_terms(queries: DataFrame) -> DataFrame:
    """(item_id, terms): the different terms of each query."""
    rows = queries.select(F.col("item_id"), F.lit(0).cast("long").alias("row"), F.col("text").cast("string").alias("text"))
    numbered = durable(rows.select("item_id").distinct().withColumn("item", F.monotonically_increasing_id()), "queries")
    met = rows.alias("r").join(numbered.alias("q"), F.col("r.item_id").eqNullSafe(F.col("q.item_id")))
    found = _term_table(met.select(F.col("q.item").alias("doc_id"), "row", "text")).select(F.col("doc_id").alias("item"), F.explode("terms").alias("term"))
    return numbered.join(found.distinct().groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")), "item")


class _Queries:
    """A block's queries: the terms and weights of one after the other."""

    def __init__(self, rows: list):
        self.items = [r["item"] for r in rows]
        self.terms = sorted({t for r in rows for t in r["terms"]})
        at = {t: i for i, t in enumerate(self.terms)}
        self.starts = bounds(np.array([len(r["terms"]) for r in rows]))
        self.term = np.array([at[t] for r in rows for t in r["terms"]], np.int64)
        self.weight = np.array([w for r in rows for w in r["weights"]], np.int64)


class _Best:
    """The best documents of each query so far."""

    def __init__(self, count: int, best: int):
        self.best = best
        self.rows = [(np.zeros(0, np.int64),) * 4 for _ in range(count)]  # score, null id, id, row
        self.least = np.ones(count, np.int64)

    def add(self, query: int, *rows: np.ndarray) -> None:
        score, no_id, doc_id, row = (np.concatenate(c) for c in zip(self.rows[query], rows, strict=True))
        order = np.lexsort((row, doc_id, no_id, -score))[: self.best]
        self.rows[query] = tuple(c[order] for c in (score, no_id, doc_id, row))
        if len(order) == self.best:
            self.least[query] = max(1, score[order[-1]])


def _search_piece(part: pa.Table, queries: _Queries, best: _Best) -> None:
    """Visits the strata of a piece for each query by falling bound."""
    is_docs = np.array(part.column("term").is_null().to_pylist())
    head = part.filter(pa.array(is_docs))
    ids, rows = head.column("ids").combine_chunks().flatten(), head.column("rows").combine_chunks().flatten().to_numpy()
    no_id = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
    ids = ids.fill_null(0).to_numpy()
    strata = head.column("m").combine_chunks().flatten().to_numpy()
    of_stratum = bounds(head.column("runs").combine_chunks().flatten().to_numpy())
    part = part.filter(pa.array(~is_docs))
    if not part.num_rows:
        return
    at = {t: i for i, t in enumerate(queries.terms)}
    term = np.array([at[t] for t in part.column("term").to_pylist()], np.int64)
    flat = lambda name: part.column(name).combine_chunks().flatten().to_numpy().astype(np.int64)
    m, tf, runs, docs = flat("m"), flat("tf"), flat("runs"), flat("docs")
    impact = 1_000_000_000 * tf // (1000 * tf + 20 * m)  # once per stratum and tf of a term
    term = np.repeat(term, np.diff(part.column("m").combine_chunks().offsets.to_numpy()))
    key = np.searchsorted(strata, m) * len(queries.terms) + term
    order = np.argsort(key, kind="stable")  # runs of a key keep their rising tf
    starts = bounds(runs)[:-1]
    docs = gather(docs, starts[order], runs[order])
    impacts = np.repeat(impact[order], runs[order])
    keys, first = np.unique(key[order], return_index=True)
    ends = bounds(runs[order])
    first, last = ends[first], np.append(ends[first[1:]], ends[-1])
    largest = impacts[last - 1]
    edges = np.searchsorted(keys, np.arange(len(strata) + 1) * len(queries.terms))
    place = np.full(len(queries.terms), -1, np.int64)
    bound = np.zeros((len(queries.items), len(strata)), np.int64)
    for s in range(len(strata)):
        some = np.zeros(len(queries.terms) + 1, np.int64)
        some[keys[edges[s] : edges[s + 1]] - s * len(queries.terms)] = largest[edges[s] : edges[s + 1]]
        bound[:, s] = np.add.reduceat(queries.weight * some[queries.term], queries.starts[:-1])
    for q in range(len(queries.items)):
        mine = slice(queries.starts[q], queries.starts[q + 1])
        terms, weights = queries.term[mine], queries.weight[mine]
        for s in np.argsort(-bound[q], kind="stable").tolist():
            if bound[q, s] < best.least[q]:
                break
            lo, hi = edges[s], edges[s + 1]
            place[keys[lo:hi] - s * len(queries.terms)] = np.arange(lo, hi)
            found = place[terms]
            place[keys[lo:hi] - s * len(queries.terms)] = -1
            held = found >= 0
            found, weight = found[held], weights[held]
            n = last[found] - first[found]
            score = np.zeros(of_stratum[s + 1] - of_stratum[s], np.int64)
            np.add.at(score, gather(docs, first[found], n) - of_stratum[s], np.repeat(weight, n) * gather(impacts, first[found], n))
            good = np.flatnonzero(score >= best.least[q])
            if len(good) > best.best:  # the score of the last place, and all that reach it
                good = good[score[good] >= np.partition(score[good], -best.best)[-best.best]]
            if len(good):
                at_doc = good + of_stratum[s]
                best.add(q, score[good], no_id[at_doc], ids[at_doc], rows[at_doc])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole pieces of batches that are sorted by piece."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        piece = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(piece[1:] != piece[:-1]) + 1).tolist(), len(piece)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            if held and held[-1].column(0)[0].as_py() != piece[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _search_block(index: DataFrame, rows: list, best: int) -> DataFrame:
    queries = _Queries(rows)
    terms = index.sparkSession.createDataFrame([(t,) for t in queries.terms], "_term string")
    postings = index.join(F.broadcast(terms), F.col("term") == F.col("_term"), "left_semi")
    parts = postings.union(index.filter("term is null")).repartition("piece").sortWithinPartitions("piece")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Best(len(queries.items), best)
        for part in _pieces(batches):
            _search_piece(part, queries, found)
        for q, item in enumerate(queries.items):
            score, no_id, doc_id, row = found.rows[q]
            columns = [pa.array(np.full(len(score), item)), pa.array(doc_id, mask=no_id.astype(bool)), pa.array(row), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "row", "score"])

    return parts.mapInArrow(search, "item long, doc_id long, row long, score long")


def search(index: DataFrame, queries: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): each query's ``best`` documents with a score above 0; ``queries`` has item_id and text."""
    n_docs = index.filter("term is null").agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    wanted = durable(query_terms(queries), "query_terms")
    terms = wanted.select("item", F.explode("terms").alias("term"))
    in_use = index.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = terms.join(in_use, "term").groupBy("item").agg(F.sort_array(F.collect_list(F.struct("term", weight.alias("w")))).alias("t"))
    weighed = sum_before_in_group(weighed, [], [F.col("item")], F.size("t"), "before")
    weighed = durable(weighed.select("item", "t.term", "t.w", F.expr(f"before div {BLOCK_TERMS}").alias("block")), "weights")
    found = None
    for block in range((weighed.agg(F.max("block")).first()[0] or 0) + 1):
        rows = [{"item": r["item"], "terms": r["term"], "weights": r["w"]} for r in weighed.filter(F.col("block") == block).orderBy("item").collect()]
        if rows:  # at most BLOCK_TERMS terms and one more query
            part = durable(_search_block(index, rows, best), "found")
            found = part if found is None else found.union(part)
    items = wanted.select("item", "item_id")
    if found is None:
        found = items.select("item", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("score")).limit(0)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(items, "item").select("item_id", "rank", "doc_id", "score")
