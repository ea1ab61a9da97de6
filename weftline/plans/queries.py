"""One query per operator over the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import (
    basics,
    cur,
    expwindow,
    kmeans,
    least_squares,
    linkage,
    matrix,
    minhash,
    numbering,
    pairs,
    polyfit,
    users,
    words,
)
from weftline.plans import inputs
from weftline.plans.settings import (
    CLUSTERS,
    COEFFICIENTS,
    CUR_SEED,
    CUR_SIZE,
    DEGREE,
    HASHES,
    K,
    LAST_K,
    MATRIX_COLUMNS,
    MATRIX_ROWS,
    MODULUS,
    NEAREST_USERS,
    RADIUS,
    RATE,
    ROUNDS,
    SAMPLE_FRACTION,
    SAMPLE_ROWS,
    SAMPLE_SEED,
    TOP_WORDS,
    USERS,
    WIDTH,
)
from weftline.shared import new_path
from weftline.sources import text
from weftline.sources.tables import table
from weftline.streaming.expwindow import replay_events, resume_events

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources --------------------------------------------------------------------------------


def read_vectors(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "vectors")
    points = inputs.points(spark, folder)
    text.write_vectors(points, path)
    size = F.size("v")
    back = text.read_vectors(spark, path).where(F.col("_corrupt").isNull())
    cells = [F.round(F.get("v", F.lit(i)), 6).alias(f"v{i}") for i in range(64)]
    return back.select(size.alias("dimensions"), *cells)


def read_alias(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "aliases")
    line = F.concat_ws("\t", "bad_id", "good_id")
    # Each bad id twice, as files may hold it: the later line counts.
    older = inputs.aliases(spark, folder).select("bad_id", F.lit(-1).alias("good_id"))
    older.select(line).write.text(f"{path}/1")
    inputs.aliases(spark, folder).select(line).write.text(f"{path}/2")
    return text.read_alias_table(spark, f"{path}/*")


def read_triples(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "triples")
    line = F.concat_ws(" ", "user_id", "item_id", "cnt")
    inputs.plays(spark, folder).select(line).write.text(path)
    return text.read_triples(spark, path).where("_corrupt IS NULL").drop("_corrupt")


def read_ints(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "ints")
    table(spark, folder, "orders").select(F.col("o_custkey").cast("string")).write.text(path)
    return text.read_ints(spark, path).where("_corrupt IS NULL").drop("_corrupt")


def matrix_coo(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "matrix")
    text.write_vectors(inputs.points(spark, folder).orderBy("id"), path)
    return _rounded(text.read_matrix(spark, path).drop("_corrupt"), "v")


# --- basics ---------------------------------------------------------------------------------


def _line_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select("l_linenumber")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_custkey")


def row_count(spark, folder):
    return basics.row_count(_line_numbers(spark, folder))


def int_sum(spark, folder):
    return basics.total(_line_numbers(spark, folder), "l_linenumber")


def int_avg(spark, folder):
    return _rounded(basics.average(_line_numbers(spark, folder), "l_linenumber"), "average")


def int_distinct(spark, folder):
    return basics.distinct_values(_customers(spark, folder), "o_custkey")


def int_count_distinct(spark, folder):
    return basics.count_distinct(_customers(spark, folder), "o_custkey")


def int_distinct_avg(spark, folder):
    found = basics.distinct_average(_customers(spark, folder), "o_custkey")
    return _rounded(found, "distinct_average")


def _keys(spark, folder):
    ordering = _customers(spark, folder).select(F.col("o_custkey").alias("key"))
    return ordering, table(spark, folder, "customer").select(F.col("c_custkey").alias("key"))


def union_all(spark, folder):
    return basics.bag_union(*_keys(spark, folder))


def intersect_keys(spark, folder):
    return basics.intersection(*_keys(spark, folder))


def take_first(spark, folder):
    return basics.first_rows(table(spark, folder, "customer").select("c_custkey"), ["c_custkey"], 2)


def _orders(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey")


def sample_by_hash(spark, folder):
    return basics.hash_sample(_orders(spark, folder), ["o_orderkey"], SAMPLE_FRACTION, SAMPLE_SEED)


def sample_exact(spark, folder):
    return basics.exact_sample(_orders(spark, folder), ["o_orderkey"], SAMPLE_ROWS, SAMPLE_SEED)


def row_index(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderdate", "o_orderkey")
    return numbering.ordered_index(rows, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "idx")


# --- words ----------------------------------------------------------------------------------


def _document_words(spark, folder):
    return words.words(table(spark, folder, "documents"), "text", ("doc_id",))


def all_words(spark, folder):
    return _document_words(spark, folder)


def vowel_counts(spark, folder):
    counted = words.vowel_counts(_document_words(spark, folder))
    return counted.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"),
        F.sum("vowels").cast("long").alias("vowels"),
        F.max("vowels").alias("most_vowels"),
    )


def vowel_topk(spark, folder):
    return words.most_vowels(_document_words(spark, folder).select("word"), TOP_WORDS)


# --- vectors --------------------------------------------------------------------------------


def pairwise_sqdist(spark, folder):
    return _rounded(pairs.centre_sqdist(inputs.label_centres(spark, folder)), "sqdist")


def pairwise_euclid(spark, folder):
    return _rounded(pairs.centre_distances(inputs.label_centres(spark, folder)), "d")


def pairwise_square(spark, folder):
    return _rounded(pairs.centre_square(inputs.label_centres(spark, folder)), "d")


def pairs_within(spark, folder):
    return _rounded(pairs.pairs_within(inputs.points(spark, folder), RADIUS), "d")


def nearest_pair(spark, folder):
    return _rounded(pairs.nearest_pair(inputs.points(spark, folder)), "d")


def _start(spark, folder):
    return inputs.points(spark, folder), inputs.first_centres(spark, folder, K)


def kmeans_assign(spark, folder):
    return _rounded(kmeans.assign(*_start(spark, folder)), "sqdist").drop("v")


def kmeans_update(spark, folder):
    return _rounded(kmeans.updated_centres(*_start(spark, folder)), "value")


def kmeans_sizes(spark, folder):
    return kmeans.sizes(*_start(spark, folder))


def kmeans_wcv(spark, folder):
    return _rounded(kmeans.within_variation(*_start(spark, folder)), "wcv")


def _first_move(spark, folder):
    points, start = _start(spark, folder)
    moved = kmeans.one_round(points, start)
    return kmeans.centre_table(spark, start), kmeans.centre_table(spark, moved)


def kmeans_bcv(spark, folder):
    return _rounded(kmeans.between_variation(_first_move(spark, folder)[1]), "bcv")


def kmeans_shift(spark, folder):
    return _rounded(kmeans.shift(*_first_move(spark, folder)), "shift")


def kmeans_changed(spark, folder):
    return kmeans.changed(*_first_move(spark, folder))


def kmeans_fit(spark, folder):
    points, start = _start(spark, folder)
    fitted = kmeans.fit(points, K, ROUNDS, start)
    centres = kmeans.centre_table(spark, fitted.centres)
    return _rounded(centres.select("cluster", F.posexplode("v").alias("dim", "value")), "value")


def _linked(linkage_of: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: _rounded(linkage_of(inputs.points(spark, folder)), "height")


def link_labels(spark, folder):
    """The points' clusters when so many are left."""
    points = inputs.points(spark, folder)
    return linkage.cluster_labels(linkage.centroid_linkage(points, CLUSTERS), points, CLUSTERS)


# --- MinHash --------------------------------------------------------------------------------


def hash_rows(spark, folder):
    numbers = table(spark, folder, "part").select("p_partkey")
    return minhash.hash_rows(numbers, HASHES[:3], MODULUS, "p_partkey")


def minhash_signatures(spark, folder):
    found = minhash.signatures(inputs.word_sets(spark, folder), HASHES, MODULUS)
    return found.select("set_id", F.concat_ws(",", "signature").alias("signature"))


def _compared(column: str) -> Query:
    def query(spark, folder):
        lowest = table(spark, folder, "documents").agg(F.min("doc_id")).first()[0]
        sets = inputs.word_sets(spark, folder)
        compared = minhash.compare_with_reference(sets, HASHES, MODULUS, lowest)
        return _rounded(compared.select("set_id", column), column)

    return query


# --- users ----------------------------------------------------------------------------------


def alias_resolve(spark, folder):
    plays, aliases = inputs.plays(spark, folder), inputs.aliases(spark, folder)
    resolved = users.resolve_aliases(plays, aliases)
    return resolved.select("o_orderkey", "l_linenumber", "user_id", "item_id", "cnt")


def _matrix_of_plays(spark, folder, mode="last"):
    plays, aliases = inputs.plays(spark, folder), inputs.aliases(spark, folder)
    resolved = users.resolve_aliases(plays, aliases)
    return users.utility_matrix(resolved, inputs.ARRIVAL, mode)


def utility_matrix(spark, folder):
    return _matrix_of_plays(spark, folder)


def utility_matrix_sum(spark, folder):
    return _matrix_of_plays(spark, folder, "sum")


def user_similarity(spark, folder):
    found = users.user_similarity(_matrix_of_plays(spark, folder), *USERS)
    return _rounded(found, "ratio", "jaccard")


def user_neighbours(spark, folder):
    found = users.nearest_users(_matrix_of_plays(spark, folder), NEAREST_USERS)
    return _rounded(found, "ratio", "jaccard")


# --- matrix ---------------------------------------------------------------------------------


def _entries(spark, folder):
    return matrix.dense_to_entries(table(spark, folder, "embeddings"), "vec_id", "embedding")


def matrix_rows(spark, folder):
    return _rounded(matrix.select_rows(_entries(spark, folder), MATRIX_ROWS), "v")


def matrix_cols(spark, folder):
    return _rounded(matrix.select_columns(_entries(spark, folder), MATRIX_COLUMNS), "v")


def matrix_intersection(spark, folder):
    met = matrix.intersection(_entries(spark, folder), MATRIX_ROWS, MATRIX_COLUMNS)
    return _rounded(met, "v")


def cur_drawn(spark, folder):
    """The rows and columns drawn by squared norm."""
    entries = _entries(spark, folder)
    found = [
        cur.drawn(entries, axis, CUR_SIZE, CUR_SEED).select(F.lit(axis).alias("axis"), "pos", "id", "norm2")
        for axis in ("r", "c")
    ]
    return _rounded(found[0].unionByName(found[1]), "norm2")


def cur_link(spark, folder):
    found = cur.cur(_entries(spark, folder), CUR_SIZE, CUR_SIZE, CUR_SEED)
    return _rounded(cur.link_table(spark, found), "u")


def cur_cells(spark, folder):
    """Every cell beside its value in C U R."""
    entries = _entries(spark, folder)
    return _rounded(cur.approximated(entries, cur.cur(entries, CUR_SIZE, CUR_SIZE, CUR_SEED)), "v", "approx")


# --- polynomials ----------------------------------------------------------------------------


def poly_predict(spark, folder):
    predicted = polyfit.predict(inputs.samples(spark, folder), COEFFICIENTS)
    return _rounded(predicted.select("l_orderkey", "l_linenumber", "predicted"), "predicted")


def poly_sse(spark, folder):
    return _rounded(polyfit.squared_error(inputs.samples(spark, folder), COEFFICIENTS), "sse")


def poly_moments(spark, folder):
    """Per row, so that the size of the table does not eat the digits compared."""
    sums = polyfit.moments(inputs.samples(spark, folder), DEGREE)
    return sums.select("n", *[F.round(F.col(c) / F.col("n"), 6).alias(c) for c in sums.columns[1:]])


def _split_coefficients(fitted: DataFrame, *keep: str) -> DataFrame:
    cells = F.posexplode("coefficients").alias("power", "coefficient")
    return _rounded(fitted.select(*keep, "epochs", "sse", cells), "coefficient", "sse")


def poly_fit(spark, folder):
    samples = inputs.samples(spark, folder)
    return _split_coefficients(polyfit.fit(samples, DEGREE, RATE, ["l_orderkey", "l_linenumber"]))


def poly_fit_grouped(spark, folder):
    samples = inputs.samples(spark, folder).withColumnRenamed("l_returnflag", "key")
    fitted = polyfit.fit_by_key(samples, DEGREE, RATE, ["l_orderkey", "l_linenumber"])
    return _split_coefficients(fitted, "key")


def _powers(fitted: DataFrame, *keep: str) -> DataFrame:
    cells = F.posexplode("coefficients").alias("power", "coefficient")
    return _rounded(fitted.select(*keep, cells), "coefficient")


def poly_least_squares(spark, folder):
    return _powers(least_squares.fit(inputs.samples(spark, folder), DEGREE))


def poly_least_squares_grouped(spark, folder):
    samples = inputs.samples(spark, folder).withColumnRenamed("l_returnflag", "key")
    return _powers(least_squares.fit_by_key(samples, DEGREE), "key")


# --- exponential windows --------------------------------------------------------------------


def ones_exact(spark, folder):
    return expwindow.ones_exact(inputs.bits(spark, folder), LAST_K)


def expwin_blocks(spark, folder):
    return expwindow.final_blocks(inputs.bits(spark, folder), WIDTH)


def expwin_estimate(spark, folder):
    return expwindow.estimates(inputs.bits(spark, folder), WIDTH, LAST_K)


def ones_error_report(spark, folder):
    report = expwindow.error_report(inputs.bits(spark, folder), WIDTH, LAST_K)
    return _rounded(report, "relative_error")


def ones_exact_global(spark, folder):
    """All events as one stream, whose bits fill many tasks."""
    return expwindow.ones_exact(inputs.all_bits(spark, folder), LAST_K)


def ones_error_report_global(spark, folder):
    report = expwindow.error_report(inputs.all_bits(spark, folder), WIDTH, LAST_K)
    return _rounded(report, "relative_error")


def expwin_stream(spark, folder):
    return replay_events(spark, folder, WIDTH, LAST_K).select("key", "n", "estimate")


def expwin_resumed(spark, folder):
    """The estimates of the later half, from a stream that starts with the earlier half's blocks."""
    return resume_events(spark, folder, WIDTH, LAST_K).select("key", "n", "estimate")


def queries() -> dict[str, Query]:
    return {
        "read_vectors": read_vectors,
        "read_alias": read_alias,
        "read_triples": read_triples,
        "read_ints": read_ints,
        "matrix_coo": matrix_coo,
        "words": all_words,
        "take_first": take_first,
        "pairwise_sqdist": pairwise_sqdist,
        "pairwise_euclid": pairwise_euclid,
        "pairwise_square": pairwise_square,
        "pairs_within": pairs_within,
        "nearest_pair": nearest_pair,
        "alias_resolve": alias_resolve,
        "row_count": row_count,
        "int_sum": int_sum,
        "int_avg": int_avg,
        "int_distinct": int_distinct,
        "int_count_distinct": int_count_distinct,
        "int_distinct_avg": int_distinct_avg,
        "union_all": union_all,
        "intersect_keys": intersect_keys,
        "sample_by_hash": sample_by_hash,
        "sample_exact": sample_exact,
        "row_index": row_index,
        "vowel_counts": vowel_counts,
        "vowel_topk": vowel_topk,
        "kmeans_assign": kmeans_assign,
        "kmeans_update": kmeans_update,
        "kmeans_sizes": kmeans_sizes,
        "kmeans_wcv": kmeans_wcv,
        "kmeans_bcv": kmeans_bcv,
        "kmeans_shift": kmeans_shift,
        "kmeans_changed": kmeans_changed,
        "kmeans_fit": kmeans_fit,
        "link_single": _linked(linkage.single_linkage),
        "link_complete": _linked(linkage.complete_linkage),
        "link_average": _linked(linkage.average_linkage),
        "link_centroid": _linked(linkage.centroid_linkage),
        "link_labels": link_labels,
        "hash_rows": hash_rows,
        "minhash_signatures": minhash_signatures,
        "minhash_overlap": _compared("overlap"),
        "minhash_similarity": _compared("similarity"),
        "utility_matrix": utility_matrix,
        "utility_matrix_sum": utility_matrix_sum,
        "user_similarity": user_similarity,
        "user_neighbours": user_neighbours,
        "matrix_rows": matrix_rows,
        "matrix_cols": matrix_cols,
        "matrix_intersection": matrix_intersection,
        "cur_drawn": cur_drawn,
        "cur_link": cur_link,
        "cur_cells": cur_cells,
        "poly_predict": poly_predict,
        "poly_sse": poly_sse,
        "poly_moments": poly_moments,
        "poly_fit": poly_fit,
        "poly_fit_grouped": poly_fit_grouped,
        "poly_least_squares": poly_least_squares,
        "poly_least_squares_grouped": poly_least_squares_grouped,
        "ones_exact": ones_exact,
        "expwin_blocks": expwin_blocks,
        "expwin_estimate": expwin_estimate,
        "ones_error_report": ones_error_report,
        "ones_exact_global": ones_exact_global,
        "ones_error_report_global": ones_error_report_global,
        "expwin_stream": expwin_stream,
        "expwin_resumed": expwin_resumed,
    }
