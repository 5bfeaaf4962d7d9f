"""The operators as registered queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (
    convtrie,
    linededup,
    minhash,
    mixing,
    nndescent,
    packing,
    pii,
    quality,
    runindex,
    tokencount,
    urlfilter,
    warc,
    whitening,
)
from shelfwise.llm.common import Work, table

#: of the made-up tables only; jobs bring a secret of their own
BENCHMARK_KEY = b"benchmark tables"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_minhash_groups(spark, sf_dir):
    return minhash.near_duplicate_groups(table(spark, sf_dir, "documents"), size=2, percent=80)


@query
def op3_source_mix(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"), Work(spark))


@query
def op8_packed_sequences(spark, sf_dir):
    return packing.packed_places(table(spark, sf_dir, "documents"), Work(spark))


@query
def op9_quality_rules(spark, sf_dir):
    found = quality.judged(table(spark, sf_dir, "documents"), Work(spark))
    return found.select("doc_id", *quality.COUNTS, "base_failed", "kept", "distance")


@query
def op4_token_counts(spark, sf_dir):
    return tokencount.token_counts(table(spark, sf_dir, "documents"))


@query
def op10_pseudonyms(spark, sf_dir):
    return pii.pseudonymised(table(spark, sf_dir, "documents"), BENCHMARK_KEY)


@query
def op1_line_templates(spark, sf_dir):
    found = linededup.without_recurring_lines(table(spark, sf_dir, "documents"), Work(spark))
    return found.select("doc_id", "text", "n_lines", "n_dropped")


@query
def op5_url_verdicts(spark, sf_dir):
    return urlfilter.judged(table(spark, sf_dir, "pages"), urlfilter.rule_table(spark), Work(spark))


@query
def op7_warc_records(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"), Work(spark))


@query
def op6_embedding_links(spark, sf_dir):
    return nndescent.linked_vectors(table(spark, sf_dir, "embeddings"), Work(spark))


@query
def op12_whitened_embeddings(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"), Work(spark))


@query
def op13_conversation_trie(spark, sf_dir):
    return convtrie.trie_nodes(table(spark, sf_dir, "conversations"), Work(spark))


@query
def op11_repeated_bytes(spark, sf_dir):
    return runindex.without_repeats(table(spark, sf_dir, "documents"), Work(spark)).drop("spans")
