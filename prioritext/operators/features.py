"""Text features: n-grams, vocabulary, smoothed IDF, L2-normalised TF-IDF,
balanced class weights.

Plan shape: documents are hash-partitioned by id once; the per-document
steps (explode, ``(doc, term)`` counts, per-document norms) then reuse that
partitioning, so the only other shuffle is the map-side-combined
``groupBy(term)`` of the vocabulary fit.  The vocabulary (at most
``max_features`` rows) is the only broadcast side.  Where every row is a
document (training), ``term_statistics`` counts inside the rows and no text is
shuffled at all.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prioritext.constants import MAX_FEATURES, MIN_DF
from prioritext.functions.text import ngrams, normalize_text, tokens
from prioritext.operators.common import checked_broadcast, spread
from prioritext.operators.ids import dense_index
from prioritext.session import scratch_path, ship_package


# Words of the rows whose n-grams are counted together: the more, the fewer
# counts of one term leave a task.  A word takes some 60 bytes meanwhile.
COUNTED_WORDS = 1_000_000

# Bytes of text whose n-grams are added up by one task: its hash maps then take
# some 130 MB, whatever the input.
ADDED_BYTES = 8 << 20

# The most that one task adds up where tasks of ``ADDED_BYTES`` would be so many
# that Spark sorts in memory whatever a task sends.
MOST_ADDED_BYTES = 64 << 20


def with_grams(df: DataFrame, text_col: str = "text", out_col: str = "grams") -> DataFrame:
    """Add the 1- and 2-gram array of the normalised text."""
    return df.withColumn(out_col, ngrams(tokens(normalize_text(F.col(text_col)))))


def by_repeats(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose id (null too) no other row has, and those that share theirs, or None.

    Ids are counted by one narrow shuffle; the repeated ones are written once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"repeated-ids-{uuid.uuid4().hex}")
    counted = df.groupBy(F.col(id_col).alias("_again")).agg(F.count(F.lit(1)).alias("_n"))
    counted.filter(F.col("_n") > 1).select("_again").write.parquet(path)
    again = spark.read.schema(counted.select("_again").schema).parquet(path)
    if again.isEmpty():
        return df, None
    side = checked_broadcast(again)
    same = df[id_col].eqNullSafe(side["_again"])
    return df.join(side, same, "left_anti"), df.join(side, same, "left_semi")


def doc_term_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", num_partitions: int | None = None
) -> DataFrame:
    """``(id, term, c)``: raw count of each n-gram in each document; rows of one id are one document.

    The documents are hash-partitioned by id first (this also evens out the
    cost of very long texts).  A document of one row is then counted inside its
    row, in Arrow arrays; only those of several rows have their n-grams
    exploded and added up.
    """
    alone, shared = by_repeats(df.select(id_col, text_col), id_col)
    counts = row_term_counts(partition_docs(alone, id_col, text_col, num_partitions), id_col, text_col)
    if shared is None:
        return counts
    exploded = exploded_grams(shared, id_col, text_col, num_partitions)
    return counts.unionByName(exploded.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("c")))


def row_term_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, term, c)`` of the n-grams of each row, map-only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _few_words(batch, "_words"):
                for of, terms, c in _terms_of_rows(some.column("_words")):
                    ids = some.column(id_col).take(pa.array(of))
                    yield pa.RecordBatch.from_arrays([ids, terms.cast(pa.string()), pa.array(c.astype(np.int64))], names=[id_col, "term", "c"])

    words = df.select(id_col, tokens(normalize_text(F.col(text_col))).alias("_words"))
    schema = T.StructType([df.schema[id_col], T.StructField("term", T.StringType()), T.StructField("c", T.LongType())])
    return words.mapInArrow(run, schema)


def explode_terms(df: DataFrame, id_col: str) -> DataFrame:
    """One row per n-gram.  ``explode_outer`` + a null filter on the generated
    column: a plain ``explode`` makes Catalyst infer a non-empty-array filter
    and push it below the repartition, which would tokenise every text twice."""
    return df.select(id_col, F.explode_outer("grams").alias("term")).filter(F.col("term").isNotNull())


def partition_docs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", num_partitions: int | None = None
) -> DataFrame:
    """``(id, text)`` hash-partitioned by id: the one text shuffle of the feature jobs."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(id_col, text_col).repartition(n, F.col(id_col))


def exploded_grams(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    num_partitions: int | None = None,
    partitioned: bool = False,
) -> DataFrame:
    """``(id, term)``, one row per n-gram occurrence, documents hash-partitioned by id."""
    parted = df if partitioned else partition_docs(df, id_col, text_col, num_partitions)
    return explode_terms(with_grams(parted, text_col), id_col)


def doc_vocab_counts(
    df: DataFrame,
    vocab: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    num_partitions: int | None = None,
    partitioned: bool = False,
) -> DataFrame:
    """``(id, idx, term, idf, c)``: counts of in-vocabulary n-grams only.

    Every occurrence is looked up in the broadcast vocabulary (bounded by
    ``max_features``) *before* aggregating, so out-of-vocabulary n-grams (most
    bigrams) never reach the aggregation.  The ``(id, idx)`` aggregate reuses
    the id partitioning: no exchange after the initial repartition.
    """
    grams = exploded_grams(df, id_col, text_col, num_partitions, partitioned)
    counts = (
        grams.join(F.broadcast(vocab.select("term", "idx")), "term", "inner")
        .groupBy(id_col, "idx")  # integer key: cheaper to hash than the term
        .agg(F.count(F.lit(1)).alias("c"))
    )
    return counts.join(F.broadcast(vocab.select("idx", "term", "idf")), "idx", "inner").select(
        id_col, "idx", "term", "idf", "c"
    )


class TermTable:
    """A vocabulary of words and word pairs with ``idf`` and class weights, for look-ups of whole Arrow batches.

    Bounded by ``max_features``.  Every word of the vocabulary, alone or in a
    pair, has a number; a pair of numbers is one integer, found by bisection.
    """

    def __init__(self, rows: Sequence[tuple[str, float, Sequence[float]]], n_classes: int):
        parts = sorted({w for term, _, _ in rows for w in term.split(" ")})
        number = {w: i for i, w in enumerate(parts)}
        self.words = pa.array(parts, pa.string())
        self.width = max(1, len(parts))
        self.idf = np.array([r[1] for r in rows], dtype=float)
        self.weights = np.array([list(r[2]) for r in rows], dtype=float).reshape(len(rows), n_classes)
        self.single = np.full(self.width, -1, dtype=np.int64)
        pairs = []
        for i, (term, _, _) in enumerate(rows):
            words = [number[w] for w in term.split(" ")]
            if len(words) == 1:
                self.single[words[0]] = i
            else:
                pairs.append((words[0] * self.width + words[1], i))
        pairs.sort()
        self.codes = np.array([c for c, _ in pairs], dtype=np.int64)
        self.places = np.array([i for _, i in pairs], dtype=np.int64)

    def weighted(self, tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, place of the term, c * idf)`` of every known term of every row."""
        n = len(tokens)
        row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
        word = pc.fill_null(pc.index_in(tokens.flatten(), value_set=self.words), -1).to_numpy(zero_copy_only=False)
        word = word.astype(np.int64)
        known = word >= 0
        place = np.where(known, self.single[np.maximum(word, 0)], -1)
        found_row, found = row[place >= 0], place[place >= 0]
        if len(self.codes):
            both = known[:-1] & known[1:] & (row[:-1] == row[1:])
            code = word[:-1][both] * self.width + word[1:][both]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[at] == code
            found_row = np.concatenate((found_row, row[:-1][both][hit]))
            found = np.concatenate((found, self.places[at[hit]]))
        key, count = np.unique(found_row * max(1, len(self.idf)) + found, return_counts=True)
        of, term = np.divmod(key, max(1, len(self.idf)))
        return of, term, count * self.idf[term]

    def sums(self, tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Per row: the sum of squared ``c * idf``, and the sums of ``c * idf * weight`` by class."""
        n = len(tokens)
        of, term, u = self.weighted(tokens)
        by_class = [np.bincount(of, weights=u * self.weights[term, c], minlength=n) for c in range(self.weights.shape[1])]
        return np.bincount(of, weights=u * u, minlength=n).astype(float), np.stack(by_class, axis=1).astype(float)


def tfidf_for(
    df: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text", num_partitions: int | None = None
) -> DataFrame:
    """``(id, idx, term, weight)`` of documents against a fitted vocabulary; rows of one id are one document.

    A document of one row is weighted inside its row (:func:`row_tfidf`); those
    of several rows have their counts added up first.
    """
    alone, shared = by_repeats(df.select(id_col, text_col), id_col)
    weights = row_tfidf(spread(alone, num_partitions, key=id_col), vocab, id_col, text_col)
    if shared is None:
        return weights
    counts = doc_vocab_counts(shared, vocab, id_col, text_col, num_partitions)
    w = F.col("c") * F.col("idf")
    norm = F.sqrt(F.sum(w * w).over(Window.partitionBy(id_col)))
    return weights.unionByName(counts.select(id_col, "idx", "term", (w / norm).alias("weight")))


def row_tfidf(df: DataFrame, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, idx, term, weight)`` of each row against a fitted vocabulary, map-only.

    Words are cut natively; a task looks those of a slice of rows up in the term
    table (at most ``max_features`` rows) and normalises row by row.
    """
    rows = vocab.select("term", "idx", "idf").orderBy("idx").collect()  # <= max_features rows
    table = TermTable([(r["term"], float(r["idf"]), ()) for r in rows], 0)
    terms, idx = pa.array([r["term"] for r in rows], pa.string()), pa.array([r["idx"] for r in rows], pa.int32())
    ship_package(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast((table, terms, idx))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, terms, idx = held.value
        for batch in batches:
            for some in _few_words(batch, "_words"):
                of, place, u = table.weighted(some.column("_words"))
                norm = np.sqrt(np.bincount(of, weights=u * u, minlength=some.num_rows))
                at = pa.array(place)
                yield pa.RecordBatch.from_arrays(
                    [some.column(id_col).take(pa.array(of)), idx.take(at), terms.take(at), pa.array(u / norm[of])],
                    names=[id_col, "idx", "term", "weight"],
                )

    words = df.select(id_col, tokens(normalize_text(F.col(text_col))).alias("_words"))
    schema = T.StructType(
        [df.schema[id_col], T.StructField("idx", T.IntegerType()), T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType())]
    )
    return words.mapInArrow(run, schema)


def fit_vocabulary(
    doc_terms: DataFrame,
    n_docs: int,
    id_col: str = "doc_id",
    min_df: int = MIN_DF,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """``(term, tf, df, idx, idf)``: terms in >= ``min_df`` documents, the top
    ``max_features`` by total count (ties by term), indexed in term order.

    ``idf = ln((1 + n) / (1 + df)) + 1`` (smoothed, with the ``+1``).
    The top-k is an exact distributed rank (see :func:`top_terms`), and the
    index window runs over those k rows only.
    """
    stats = doc_terms.groupBy("term").agg(F.sum("c").alias("tf"), F.count(F.lit(1)).alias("df"))
    return vocabulary_of(stats, n_docs, min_df, max_features)


def _coded(words: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, int, Callable[[np.ndarray], pa.Array]]]:
    """Single words, then pairs: ``(row, code, bound of the codes, the terms that codes stand for)`` of every occurrence."""
    n = len(words)
    row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
    coded = words.flatten().dictionary_encode()
    word, known = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
    width = max(1, len(known))
    yield row, word, width, lambda codes: known.take(pa.array(codes))
    both = row[:-1] == row[1:]
    pair = word[:-1][both] * width + word[1:][both]
    joined = lambda codes: pc.binary_join_element_wise(known.take(pa.array(codes // width)), known.take(pa.array(codes % width)), " ")
    yield row[:-1][both], pair, width * width, joined


def _row_terms(words: pa.ListArray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Single words, then pairs: ``(terms, occurrences, rows that hold the term)`` of some rows."""
    for row, code, most, named in _coded(words):
        distinct, tf = np.unique(code, return_counts=True)
        held = np.unique(row * most + code) % most
        yield named(distinct), tf, np.unique(held, return_counts=True)[1]


def _terms_of_rows(words: pa.ListArray) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Single words, then pairs: ``(row, term, occurrences in the row)`` of some rows."""
    for row, code, most, named in _coded(words):
        key, c = np.unique(row * most + code, return_counts=True)
        of, code = np.divmod(key, most)
        distinct, at = np.unique(code, return_inverse=True)
        yield of, named(distinct).take(pa.array(at)), c


def _few_words(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``COUNTED_WORDS`` words (more only where one row has more)."""
    upto = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        before = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, before + COUNTED_WORDS, side="right")))
        yield batch.slice(low, high - low)
        low = high


def adding_partitions(df: DataFrame, text_col: str = "text") -> int:
    """Partitions in which the n-grams of ``df`` are added up: one per ``ADDED_BYTES`` of text, so that what
    a task holds depends neither on the input's size nor on the session's shuffle partitions.  Beyond
    ``spark.shuffle.sort.bypassMergeThreshold`` partitions, Spark holds and sorts all that a task sends: there
    are no more than those until a task would add up ``MOST_ADDED_BYTES``.  Reads the texts once, without
    cutting them."""
    spark = df.sparkSession
    size = df.agg(F.sum(F.octet_length(text_col).cast("bigint")).alias("b")).first()["b"] or 0
    unsorted = int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    wanted = min(math.ceil(size / ADDED_BYTES), max(unsorted, math.ceil(size / MOST_ADDED_BYTES)))
    return max(spark.sparkContext.defaultParallelism, wanted)


def term_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(term, tf, df)`` of the n-grams of ``df``, every row a document of its own.

    Words are cut natively; a task counts the n-grams of a slice of rows in
    Arrow arrays, so texts stay where they are and only counts per term are
    shuffled.  They go as they come from a slice: added up in the task, most
    terms being rare, they would take memory in proportion to its input.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _few_words(batch, "_words"):
                for terms, tf, held in _row_terms(some.column("_words")):
                    yield pa.RecordBatch.from_arrays(
                        [terms.cast(pa.string()), pa.array(tf.astype(np.int64)), pa.array(held.astype(np.int64))],
                        names=["term", "tf", "df"],
                    )

    words = df.select(tokens(normalize_text(F.col(text_col))).alias("_words"))
    parts = words.mapInArrow(run, "term string, tf long, df long")
    n = adding_partitions(df, text_col)
    return parts.repartition(n, "term").groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def vocabulary_of(stats: DataFrame, n_docs: int, min_df: int = MIN_DF, max_features: int = MAX_FEATURES) -> DataFrame:
    """The vocabulary of :func:`fit_vocabulary` from ``stats(term, tf, df)``."""
    # the eligible terms are written once (checkpoint folder): the rank reads
    # its range exchange from two branches, which must see the same rows in
    # the same order, and a shuffled aggregate does not guarantee that
    spark = stats.sparkSession
    path = scratch_path(spark, f"vocab-terms-{uuid.uuid4().hex}")
    stats.filter(F.col("df") >= min_df).write.mode("overwrite").parquet(path)
    top = top_terms(spark.read.parquet(path), max_features)
    w = Window.orderBy("term")  # over at most max_features rows
    return top.select(
        "term",
        F.col("tf").cast("bigint").alias("tf"),
        F.col("df").cast("bigint").alias("df"),
        (F.row_number().over(w) - 1).cast("int").alias("idx"),
        (F.log((F.lit(1.0) + F.lit(float(n_docs))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"),
    )


def _least_tf(stats: DataFrame, k: int) -> int | None:
    """The ``tf`` of the ``k``-th largest term, below which none need be ranked; None with fewer terms.

    The window runs over the distinct values of ``tf``: at most
    ``sqrt(2 * occurrences)`` rows, as each is that of some term.
    """
    per_tf = stats.groupBy("tf").agg(F.count(F.lit(1)).alias("n"))
    upto = per_tf.select("tf", F.sum("n").over(Window.orderBy(F.desc("tf"))).alias("upto"))
    return upto.filter(F.col("upto") >= k).agg(F.max("tf").alias("tf")).first()["tf"]


def top_terms(stats: DataFrame, k: int) -> DataFrame:
    """The ``k`` terms with the largest ``tf`` (ties by term), exactly.

    A TakeOrdered would send ``k`` rows from every partition to one task
    (partitions x 20,000 rows at scale).  Instead the terms are ranked by
    ``(-tf, term)`` with range partitioning and per-partition offsets
    (``dense_index``): every task ranks its own range, and only ranks
    below ``k`` are kept.  Terms rarer than the ``k``-th are left out before.  ``stats`` must be a stable input (a scan of a
    written table), see ``dense_index``.
    """
    least = _least_tf(stats, k)
    if least is not None:
        stats = stats.filter(F.col("tf") >= F.lit(least))
    # every column rides inside the ordering struct (term is unique, so tf
    # and df never decide the order): both branches of the rank then read
    # the same columns and share one range exchange (two exchanges would
    # sample different range bounds)
    order = F.struct(
        (-F.col("tf")).alias("neg_tf"), F.col("term").alias("term"), F.col("tf").alias("tf"), F.col("df").alias("df")
    )
    keyed = stats.select(F.lit(0).alias("_g"), order.alias("_o"))
    ranked = dense_index(keyed, "_g", "_o", "_rank")
    return ranked.filter(F.col("_rank") < k).select("_o.term", "_o.tf", "_o.df")


def tfidf_weights(doc_terms: DataFrame, vocab: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(id, idx, term, weight)``: raw tf x idf, L2-normalised per document over
    in-vocabulary terms.  Documents without a known term produce no rows (the
    zero vector); consumers left-join from the documents to keep them."""
    v = F.broadcast(vocab.select("term", "idx", "idf"))  # bounded by max_features
    raw = doc_terms.join(v, "term", "inner").withColumn("_w", F.col("c") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "idx", "term", (F.col("_w") / norm).alias("weight"))


def class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Balanced weights ``n / (k * n_c)`` per class (one row per class)."""
    per = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_c"))
    whole = Window.partitionBy()  # over the k class rows only
    return per.select(
        "label",
        F.col("n_c").cast("bigint").alias("n_c"),
        (F.sum("n_c").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n_c"))).alias("weight"),
    )
