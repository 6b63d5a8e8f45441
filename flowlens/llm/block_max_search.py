"""Exact BM25 top-k search over an inverted index in shards, with block-max pruning.

A shard is a group of documents. Its index holds the postings of rare terms, and for frequent terms, which are in at least
``DENSE`` of its documents, a row of impacts and their maxima per block of ``BLOCK`` documents. Impacts are whole
numbers, so sums do not depend on their order. Document frequencies, lengths and counts are those of all documents:
shards send their terms to ranges once, which answer with the frequencies.

A query runs against a shard in three steps. The postings of its rare terms are summed. The documents best so far are
scored in full, which gives a threshold. A block's maxima bound what frequent terms can add: only documents whose sum and
bound reach the threshold are scored in full. The best ``k`` of every shard, ties by the smaller key, are merged.

Queries are sent to the shards in blocks of about ``QUERY_TERMS`` terms, one pass over the stored index each, so
neither queries nor index are ever in one place as a whole.

Edge cases: a null, empty or blank text has no terms, is never found, and as a query finds nothing; a query finds fewer than
``k`` rows when fewer share a term with it; rows without a key are neither found nor asked; repeated rows are found as
often as they occur. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.chunk_mail import SCHEMA, answers, mail, range_cuts, squeezed, unsqueezed
from flowlens.llm.worker_cache import clear
from flowlens.session import staged

K1, B = 1.2, 0.75
SCALE = 1_000_000
SHARD_DOCS, BLOCK = 2048, 4
SHARDS_PER_TASK, QUERIES_AT_ONCE = 16, 256
#: Share of a shard's documents from which on a term is frequent.
DENSE = 0.04
QUERY_TERMS = 2_000_000
LEAST_RANGES = 64


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and 64-bit term numbers of all words, in text order."""
    # Lower-cased first: a slice that is cast keeps offsets that the kernel does not take.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts).cast(pa.large_string()))
    words, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    filled = pc.not_equal(words, "")
    coded = words.filter(filled).dictionary_encode()
    numbers = np.array([*map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist())], np.uint64)
    return doc.filter(filled).to_numpy(), numbers[coded.indices.to_numpy()] if len(numbers) else np.zeros(0, np.uint64)


class Postings:
    """Terms of a shard's documents, with how often each document has them."""

    def __init__(self, table: pa.Table):
        clear()
        self.keys = table.column("key").to_numpy()
        doc, term = tokens(table.column("text").combine_chunks())
        self.lengths = np.bincount(doc, minlength=len(self.keys))
        self.terms, number = np.unique(term, return_inverse=True)
        pair, self.tf = np.unique(number * len(self.keys) + doc, return_counts=True)
        self.term, self.doc = pair // max(len(self.keys), 1), pair % max(len(self.keys), 1)
        self.df = np.bincount(self.term, minlength=len(self.terms))

    def send(self, n_ranges: int) -> list[tuple[int, bytes]]:
        cuts = range_cuts(self.terms, n_ranges)
        return [(r, squeezed(self.terms[a:b], self.df[a:b].astype(np.uint32))) for r, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]

    def index(self, heard: pa.Table, n_docs: int, n_words: int) -> bytes:
        df = np.concatenate([unsqueezed(data)[0] for _, data in answers(heard, 1)] or [np.zeros(0, np.uint64)]).astype(float)
        if len(df) != len(self.terms):
            raise RuntimeError("answers do not match what the shard sent")
        idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * self.lengths / max(n_words / max(n_docs, 1), 1e-9))
        impact = np.floor(SCALE * idf[self.term] * (self.tf * (K1 + 1) / (self.tf + norm[self.doc]))).astype(np.int64)
        return squeezed(self.keys, self.terms, self.df.astype(np.uint32), self.doc.astype(np.uint32), impact.astype(np.uint32))


class Index:
    """A shard's index as it is searched: postings of rare terms, rows and block maxima of frequent ones."""

    def __init__(self, data: bytes):
        keys, self.terms, df, doc, impact = unsqueezed(data)
        self.keys = keys.view(np.int64)
        n = len(self.keys)
        self.n_blocks = -(-n // BLOCK)
        begin = np.append(0, np.cumsum(df.astype(np.int64)))
        frequent = df >= max(DENSE * n, 8)
        self.row = np.where(frequent, np.cumsum(frequent) - 1, -1)
        own = np.repeat(self.row, df)
        dense = own >= 0
        # Impacts of frequent terms by document, and their largest in every block of neighbouring documents.
        n_dense = int(frequent.sum())
        self.by_doc = np.zeros((self.n_blocks * BLOCK, n_dense), np.int32)
        self.by_doc[doc[dense], own[dense]] = impact[dense]
        self.maxima = self.by_doc.reshape(self.n_blocks, BLOCK, n_dense).max(1, initial=0).T.astype(float)
        self.begin, self.end, self.doc, self.impact = begin[:-1], begin[1:], doc.astype(np.int64), impact.astype(np.int64)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Place of each of the sorted terms in the index; -1 for one that it lacks."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def top(self, places: list[np.ndarray], k: int, least: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every query, given by the places of its terms, keys and scores of the ``k`` best documents that have one of
        them and score ``least`` or more."""
        out = []
        for at in range(0, len(places), QUERIES_AT_ONCE):
            group = [p[p >= 0] for p in places[at:at + QUERIES_AT_ONCE]]
            asks = np.zeros((len(group), len(self.maxima)))
            for q, p in enumerate(group):
                rows = self.row[p]
                asks[q, rows[rows >= 0]] = 1
            # What frequent terms can add to a document of a block; sums of whole numbers below 2**53 are exact.
            bounds = asks @ self.maxima
            out += [self._best(p, bound, k, low) for p, bound, low in zip(group, bounds, least[at:at + QUERIES_AT_ONCE])]
        return out

    def _best(self, at: np.ndarray, bound: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows = self.row[at]
        rows, rare = rows[rows >= 0], at[rows < 0]
        n = len(self.keys)
        lengths = self.end[rare] - self.begin[rare]
        flat = np.arange(lengths.sum()) + np.repeat(self.begin[rare] - (np.cumsum(lengths) - lengths), lengths)
        part = np.bincount(self.doc[flat], weights=self.impact[flat], minlength=self.n_blocks * BLOCK)
        reach = (part.reshape(-1, BLOCK) + bound[:, None]).ravel()[:n]

        def full(docs: np.ndarray) -> np.ndarray:
            return part[docs].astype(np.int64) + self.by_doc[docs[:, None], rows].sum(1, dtype=np.int64)

        if n > 4 * k:
            # Promising documents give the threshold; every document that can reach it is scored in full.
            scores = full(np.argpartition(reach, n - 4 * k)[n - 4 * k:])
            least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        docs = np.flatnonzero(reach >= max(least, 1))
        scores = full(docs)
        docs, scores = docs[scores >= max(least, 1)], scores[scores >= max(least, 1)]
        best = np.lexsort((self.keys[docs], -scores))[:k]
        return self.keys[docs[best]], scores[best]


def _frequencies(table: pa.Table) -> pa.Table:
    """For each shard, in how many documents the terms of a range are."""
    rows = [unsqueezed(d) for d in table.column("data").to_pylist()]
    terms, number = np.unique(np.concatenate([r[0] for r in rows]), return_inverse=True)
    df = np.bincount(number, weights=np.concatenate([r[1] for r in rows]).astype(float), minlength=len(terms)).astype(np.uint64)
    ends = np.cumsum([len(r[0]) for r in rows])
    out = [(p, squeezed(df[own])) for p, own in zip(table.column("part").to_pylist(), np.split(number, ends[:-1]))]
    return mail(table.column("chunk").to_pylist(), out, 1)


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The stored index, a row per shard."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("key IS NOT NULL")
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    total = rows.agg(F.count("*").alias("n"), F.sum(words).alias("words")).first()
    n_docs, n_words = total["n"], total["words"] or 0
    n_shards = max(1, -(-n_docs // shard_docs))
    n_ranges = max(LEAST_RANGES, n_shards // 4)
    by_shard = rows.select(F.pmod(F.xxhash64("key", "text"), F.lit(n_shards)).alias("chunk"), "key", "text").groupBy("chunk")

    def send(of: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return mail(of[0].as_py(), Postings(table).send(n_ranges), 0)

    def index(of: tuple[pa.Scalar, ...], table: pa.Table, heard: pa.Table) -> pa.Table:
        return pa.table({"shard": pa.array([of[0].as_py()], pa.int64()),
                         "data": pa.array([Postings(table).index(heard, n_docs, n_words)], pa.binary())})

    heard = by_shard.applyInArrow(send, SCHEMA).groupBy("part").applyInArrow(_frequencies, SCHEMA)
    return staged(by_shard.cogroup(heard.groupBy("chunk")).applyInArrow(index, "shard long, data binary"), "search-index")


def query_terms(queries: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and distinct term numbers of every query."""
    @F.arrow_udf("array<long>")
    def terms(texts: pa.Array) -> pa.Array:
        doc, term = tokens(texts)
        lists = [np.unique(own).view(np.int64) for own in np.split(term, np.searchsorted(doc, np.arange(1, len(texts))))]
        return pa.array(lists, pa.list_(pa.int64()))

    return staged(queries.select(F.col(key).cast("long").alias("query"), F.col(text).alias("text")).where("query IS NOT NULL")
                  .select("query", terms("text").alias("terms")).withColumn("row", F.monotonically_increasing_id()), "search-queries")


def search(index: DataFrame, queries: DataFrame, k: int = 10, query_terms_at_once: int = QUERY_TERMS) -> DataFrame:
    """The ``k`` best documents of every query: query, rank, key, score."""
    terms = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-terms // query_terms_at_once))
    dealt = staged(queries.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))), "search-dealt")
    spark, found = index.sparkSession, None
    # A task searches several shards and returns its best, so that few rows are merged.
    tasks = max(spark.sparkContext.defaultParallelism, -(-index.count() // SHARDS_PER_TASK))
    shards = index.select("data").repartition(tasks)
    for block in range(blocks):
        own = dealt.where(F.col("block") == block).select("query", "row", "terms").toArrow()
        sent = spark.sparkContext.broadcast((
            own.column("query").to_numpy(), own.column("row").to_numpy(),
            np.append(0, np.cumsum(pc.list_value_length(own.column("terms")).to_numpy())),
            pc.list_flatten(own.column("terms")).to_numpy().view(np.uint64)))

        def run(batches, sent=sent):
            keys, rows, ends, terms = sent.value
            none = np.zeros(0, np.int64)
            best = [(none, none)] * len(keys)
            asked, number = np.unique(terms, return_inverse=True)
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = Index(batch.column("data")[i].as_py())
                    places = shard.find(asked)[number]
                    # What the task has found so far is the threshold for its next shard.
                    least = [int(scores[-1]) if len(scores) == k else 1 for _, scores in best]
                    for q, more in enumerate(shard.top(np.split(places, ends[1:-1]), k, least)):
                        found, scores = best[q]
                        if len(more[0]):
                            found, scores = np.append(found, more[0]), np.append(scores, more[1])
                            order = np.lexsort((found, -scores))[:k]
                            best[q] = found[order], scores[order]
            n = np.array([len(b[0]) for b in best], np.int64)
            if n.sum():
                yield pa.RecordBatch.from_pydict({
                    "query": np.repeat(keys, n), "row": np.repeat(rows, n), "key": np.concatenate([b[0] for b in best]),
                    "score": np.concatenate([b[1] for b in best])})

        hits = shards.mapInArrow(run, "query long, row long, key long, score long")
        if blocks > 1:
            hits = staged(hits, "search-hits")
        found = hits if found is None else found.unionByName(hits)
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "key", "score")


def every(key: Column, step: int = 100) -> Column:
    """Rows taken as queries: keys divisible by ``step``."""
    return key % step == 0
