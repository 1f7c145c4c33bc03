"""Probability and class-array expressions (E2, F1, H6, H7, H8) and the
router (E3, E4) in array form: no shuffle, evaluated per row in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenor import vocab


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def softmax(col, temperature: float = 1.0) -> Column:
    """Softmax of a logit array, max-shifted for stability."""
    a = _c(col)
    m = F.array_max(a)
    t = F.lit(float(temperature))
    e = F.transform(a, lambda x: F.exp((x - m) / t))
    total = F.aggregate(e, F.lit(0.0), lambda acc, y: acc + y)
    return F.transform(e, lambda x: x / total)


def log_softmax(col, temperature: float = 1.0) -> Column:
    a = _c(col)
    t = F.lit(float(temperature))
    m = F.array_max(a)
    lse = F.log(F.aggregate(a, F.lit(0.0), lambda acc, y: acc + F.exp((y - m) / t)))
    return F.transform(a, lambda x: (x - m) / t - lse)


def p_binary(l0, l1) -> Column:
    """P(class 1) from two logits: softmax(l0, l1)[1]."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(_c(l0) - _c(l1)))


def argmax(col) -> Column:
    """0-based index of the largest element (first on ties)."""
    a = _c(col)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def zip_classes(col) -> Column:
    """MAP<group, value> from an 11-element array in group order."""
    return F.map_from_arrays(vocab.groups_array(), _c(col))


def rank_classes(col) -> Column:
    """ARRAY<STRUCT<idx INT, p DOUBLE>> ordered by p descending, ties by class index."""
    a = _c(col)
    pairs = F.transform(a, lambda x, i: F.struct(i.cast("int").alias("idx"), x.alias("p")))

    def cmp(l, r):
        return (F.when(l["p"] > r["p"], F.lit(-1)).when(l["p"] < r["p"], F.lit(1))
                .when(l["idx"] < r["idx"], F.lit(-1)).when(l["idx"] > r["idx"], F.lit(1)).otherwise(F.lit(0)))

    return F.array_sort(pairs, cmp)


def route(col, max_groups: int = vocab.ROUTER_MAX_GROUPS, threshold: float = vocab.ROUTER_THRESHOLD,
          min_proba: float = vocab.ROUTER_MIN_PROBA) -> Column:
    """Retained classes of a probability array: ARRAY<STRUCT<idx, p>> in rank order.

    Classes are taken in descending p while the total of those already taken is
    below ``threshold`` and fewer than ``max_groups`` are taken. When the top p
    is below ``min_proba`` the result is the fallback group with p = 1.

    As one expression this re-ranks at every use of the ranking; on DataFrames
    prefer :func:`tenor.operators.routing.add_routing`, which materialises each step.
    """
    return route_ranked(rank_classes(col), max_groups, threshold, min_proba)


def route_ranked(ranked, max_groups: int = vocab.ROUTER_MAX_GROUPS, threshold: float = vocab.ROUTER_THRESHOLD,
                 min_proba: float = vocab.ROUTER_MIN_PROBA, fallback: int = vocab.GROUPS.index(vocab.FALLBACK_GROUP)) -> Column:
    """:func:`route` on an already ranked array (see :func:`rank_classes`); ``fallback`` is the class taken
    when the top p is too small."""
    ranked = _c(ranked)
    last = F.array(F.struct(F.lit(fallback).alias("idx"), F.lit(1.0).alias("p")))

    def before(i):
        return F.aggregate(F.slice(ranked, 1, i), F.lit(0.0), lambda acc, y: acc + y["p"])

    kept = F.filter(ranked, lambda x, i: (i < F.lit(max_groups)) & (before(i) < F.lit(threshold)))
    return F.when(F.get(ranked, 0)["p"] < F.lit(min_proba), last).otherwise(kept)


def normalize_weights(routed) -> Column:
    """Retained p divided by their total: ARRAY<STRUCT<idx, weight>>."""
    r = _c(routed)
    total = F.aggregate(r, F.lit(0.0), lambda acc, y: acc + y["p"])
    return F.transform(r, lambda x: F.struct(x["idx"].alias("idx"), (x["p"] / total).alias("weight")))


def group_names(idx_array, groups: Sequence[str] = tuple(vocab.GROUPS)) -> Column:
    """Array of class indices -> array of group names."""
    names = F.array(*[F.lit(g) for g in groups])
    return F.transform(_c(idx_array), lambda i: F.get(names, i))
