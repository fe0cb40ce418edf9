"""Labels near an ad: each text field searched by itself, the hits put together in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.config import JobConfig
from jobweave.functions.prompts import retrieval_query
from jobweave.functions.sections import keywords_text
from jobweave.operators.models import Backend, distinct_texts, join_by_text
from jobweave.operators.retrieval import embed_column, ordered_union, top_k
from jobweave.storage import materialise

SHOWN = ("doc", "code", "label", "info")


def multi_field_hits(
    ads: DataFrame,
    index: DataFrame,
    title: str,
    description: str,
    keywords: str = "keywords",
    config: JobConfig = JobConfig(),
    embedder: Backend | None = None,
    once: bool = False,
) -> DataFrame:
    """Add ``hits``: labels near the title, then the description, then the keywords.

    Each field is embedded and searched on the ad's own row, so nothing is shuffled. With ``once``, for a dear
    embedder, the distinct texts of all fields are embedded and searched once and the hits are
    joined back. ``index`` is read more than once, so give a stored one.
    """
    queries = {
        "_title": retrieval_query(F.col(title)),
        "_description": retrieval_query(F.col(description)),
        "_keywords": retrieval_query(keywords_text(F.col(keywords))),
    }
    if once:
        found = _search_distinct(ads.withColumns(queries), list(queries), index, config, embedder)
    else:
        vectors = {f: embed_column(query, config, embedder) for f, query in queries.items()}
        found = top_k(
            ads, vectors, index, "embedding", "place", SHOWN, config.top_k, limits=config.limits,
            hashed=None if embedder else queries, dimensions=config.dimensions,
        )

    def shown(hits: str) -> Column:
        # a label found for two fields has two scores and is still the same label
        return F.transform(hits, lambda h: F.struct(*(h[name].alias(name) for name in SHOWN)))

    return found.withColumn("hits", ordered_union(*map(shown, queries))).select(*ads.columns, "hits")


def _search_distinct(
    asked: DataFrame,
    fields: list[str],
    index: DataFrame,
    config: JobConfig,
    embedder: Backend | None,
) -> DataFrame:
    """Each field's text replaced by its hits."""
    keyed, texts = distinct_texts(asked, *fields)
    vectors = materialise(
        texts.select("_text_key", embed_column(F.col("_text"), config, embedder).alias("vector")),
        "query-vectors",
    )
    found = top_k(
        vectors, {"hits": F.col("vector")}, index, "embedding", "place", SHOWN, config.top_k,
        limits=config.limits,
    )
    hits = materialise(found.select("_text_key", "hits"), "hits")
    keyed = keyed.drop(*fields)
    for field in fields:
        keyed = join_by_text(keyed, field, hits.withColumnRenamed("hits", field))
    return keyed
