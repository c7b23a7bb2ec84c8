"""Registered queries of the corpus operators, one for each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLE[fn.__name__] = oracle
        return fn
    return register


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by PPM code length."""
    from .language_id import fit, held_out, language_id

    docs = table(spark, sf_dir, "documents")
    out = held_out()
    model = fit(docs, train=~F.coalesce(out, F.lit(False)))
    return (language_id(docs, model)
            .select("doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "lang_pred", "score"))


@query()
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by composite text density."""
    from .html_text import main_texts

    return main_texts(table(spark, sf_dir, "pages"))


@query()
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by overlap resynchronisation."""
    import public_tokenizers

    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query(sql.OP1)
def op1_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference pairs of conversations that open alike, then of neighbours."""
    from .common import stored
    from .preference import conversations, opening_pairs, preferences

    turns = table(spark, sf_dir, "conversations")
    convs = stored(conversations(turns))
    out = preferences(turns, opening_pairs(convs), convs=convs)
    # Spans as text (start-end,start-end), so that engines compare alike.
    return out.withColumns({c: F.array_join(F.transform(c, lambda x: F.concat_ws("-", x["start"], x["end"])), ",")
                            for c in ("chosen_spans", "rejected_spans")})


@query(sql.OP2)
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents at Jaccard similarity 0.8 of 5-word shingles."""
    from .jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


@query(sql.OP3)
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and redirect equivalence over every page's url."""
    from .url_filter import url_verdicts

    return url_verdicts(table(spark, sf_dir, "pages"))


@query()
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings at cosine 0.95 by dual cover-tree traversal."""
    from .cover_tree import cosine_links

    return cosine_links(table(spark, sf_dir, "embeddings"))


@query()
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed as repeats of 50-word windows of smaller documents."""
    from .substring_dedup import substring_dedup

    return substring_dedup(table(spark, sf_dir, "documents"))


@query()
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, as they are or re-parameterised."""
    from .templates import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in bins of 16 KiB without source or duplicate conflicts."""
    from .packing import best_fit

    return best_fit(table(spark, sf_dir, "documents"))


@query()
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned by bytes in every document."""
    import public_tokenizers

    from .alignment import alignment

    return alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                     public_tokenizers.path("piece_bpe_32k.model")).documents


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words' most frequent form."""
    from .spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


@query()
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity bands over every whole document."""
    from .perplexity import quality

    return quality(table(spark, sf_dir, "documents"))
