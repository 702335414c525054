"""Deterministic lookalike scoring of a population against a seed."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.functions import codes
from cohortry.operators import (category_importance, category_shares, materialise, numeric_profile,
                                top_n)

log = logging.getLogger(__name__)
IMPORTANCE_FLOOR = 0.1
BANDWIDTH_FLOOR = 0.5
#: fields whose values come from a fixed table of codes
CODE_LISTS = frozenset(out for out, *_ in codes.DECODED_FIELDS)


def population_features(attrs: DataFrame, rfm: DataFrame, seed: DataFrame,
                        base: str = "attributes", id_col: str = "individual_id",
                        numeric: Sequence[str] = tuple(codes.NUMERIC_FIELDS),
                        categorical: Sequence[str] = tuple(codes.CATEGORICAL_FIELDS)) -> DataFrame:
    """Scoring features of everybody with an ``is_seed`` flag.

    ``base`` says who is everybody: all people with attributes, or all with RFM features.  All three
    inputs meet on the person id, so one hash partitioning serves every join.
    """
    seeds = seed.select(id_col).distinct().withColumn("_seed", F.lit(1))
    wanted = [*numeric, *categorical]
    a = attrs.select(id_col, *[c for c in wanted if c in attrs.columns])
    r = rfm.select(id_col, *[c for c in wanted if c in rfm.columns and c not in a.columns])
    left, right = (a, r) if base == "attributes" else (r, a)
    return left.join(right, id_col, "left").join(seeds, id_col, "left").select(
        id_col, F.coalesce("_seed", F.lit(0)).alias("is_seed"), *wanted)


def gaussian_weights(profile) -> dict[str, tuple[float, float, float]]:
    """{feature: (centre, bandwidth, importance)} of the features that can score at all.

    A missing or zero population deviation, or a zero bandwidth, makes a feature's term NULL for
    everybody, hence 0; such features are left out.
    """
    out = {}
    for r in profile:
        if r["pop_std"] is None or r["pop_std"] == 0 or r["seed_mean"] is None:
            continue
        bandwidth = max(r["seed_std"] or 0.0, BANDWIDTH_FLOOR * r["pop_std"])
        importance = max(abs(r["seed_mean"] - r["pop_mean"]) / r["pop_std"], IMPORTANCE_FLOOR)
        out[r["feature"]] = (r["seed_mean"], bandwidth, importance)
    return out


def numeric_score(weights: dict[str, tuple[float, float, float]]) -> Column:
    """Sum over features of ``importance * exp(-z*z/2)``; a missing value contributes 0."""
    terms = []
    for feature, (centre, bandwidth, importance) in sorted(weights.items()):
        z = (F.col(feature).cast("double") - F.lit(centre)) / F.lit(bandwidth)
        terms.append(F.coalesce(F.exp(F.lit(-0.5) * z * z) * F.lit(importance), F.lit(0.0)))
    return reduce(lambda a, b: a + b, terms, F.lit(0.0))


def categorical_score(pop: DataFrame, shares: DataFrame, categorical: Sequence[str],
                      joined: Sequence[str] | None = None):
    """(population with any columns needed, score): seed share of the value times importance.

    Fields decoded from a code list become literal maps, so no join is needed.  Fields named in ``joined``, by
    default all others (a city, an id), may have any number of values and are looked up by a join instead; the
    result is the same.
    """
    if joined is None:
        joined = [c for c in categorical if c not in CODE_LISTS]
    weighted = shares.where(F.col("seed_share").isNotNull()) \
        .join(F.broadcast(category_importance(shares, IMPORTANCE_FLOOR)), "field") \
        .select("field", "value", (F.col("seed_share") * F.col("importance")).alias("points"))
    rows = weighted.where(~F.col("field").isin(*joined)).collect() if joined else weighted.collect()
    terms = []
    for field in categorical:
        if field in joined:
            points = weighted.where(F.col("field") == field) \
                .select(F.col("value").alias(f"_v_{field}"), F.col("points").alias(f"_p_{field}"))
            pop = pop.join(points, F.col(field).cast("string") == F.col(f"_v_{field}"), "left")
            terms.append(F.coalesce(F.col(f"_p_{field}"), F.lit(0.0)))
            continue
        pairs = [F.lit(x) for r in rows if r["field"] == field for x in (r["value"], r["points"])]
        if pairs:
            terms.append(F.coalesce(F.create_map(*pairs)[F.col(field).cast("string")], F.lit(0.0)))
    return pop, reduce(lambda a, b: a + b, terms, F.lit(0.0))


def score_population(pop: DataFrame, numeric: Sequence[str] = tuple(codes.NUMERIC_FIELDS),
                     categorical: Sequence[str] = tuple(codes.CATEGORICAL_FIELDS),
                     id_col: str = "individual_id", store: bool = True,
                     joined: Sequence[str] | None = None) -> DataFrame:
    """Similarity scores of the whole population; no rows when the seed is empty.

    The statistics are two small aggregates whose results become literals, so scoring itself is a
    single projection, but for the categorical fields in ``joined``, which have no short list of values.
    The population is stored first (``store``) as three jobs read it.
    """
    if store:
        pop = materialise(pop)
    profile = numeric_profile(pop, "is_seed", numeric).collect()
    seeds = profile[0]["n_seeds"] if profile else 0
    if seeds == 0:
        log.warning("the seed is empty: no audience is scored")
        pop = pop.limit(0)
    else:
        log.info("seed of %d people", seeds)
    shares = category_shares(pop, "is_seed", categorical)
    pop, by_category = categorical_score(pop, shares, categorical, joined)
    scored = pop.select(id_col, "is_seed",
                        numeric_score(gaussian_weights(profile)).alias("numeric_similarity_score"),
                        by_category.alias("categorical_similarity_score"))
    return scored.withColumn("similarity_score", F.col("numeric_similarity_score")
                             + F.col("categorical_similarity_score"))


def lookalike_scores(pop: DataFrame, n: int | None = None, id_col: str = "individual_id",
                     digits: int | None = None, **fields) -> DataFrame:
    """Scored population; with ``n`` its best ``n`` with their ``rank`` from 1, ties to the lowest id.

    Ranks go by the score rounded to ``digits`` where given, so that they do not depend on the order of sums.
    """
    scored = score_population(pop, id_col=id_col, **fields)
    if digits is not None:
        scored = scored.withColumn("similarity_score", F.round("similarity_score", digits))
    return scored if n is None else top_n(scored, "similarity_score", id_col, n, rank="rank")
