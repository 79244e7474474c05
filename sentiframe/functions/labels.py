"""Label algebra and numeric scalars (L1, L6-L12) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EMOTION_TO_MOOD, MOOD_LABELS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def single_class(columns: list[str], mapping: dict[str, str] = EMOTION_TO_MOOD) -> Column:
    """Collapse active one-hot label columns through a many-to-one mapping (L1).

    Result is the class when exactly one distinct class is active, else null.
    Labels outside the mapping are ignored; mapped labels missing from
    ``columns`` count as inactive.
    """
    present = set(columns)
    classes: dict[str, list[str]] = {}
    for e, m in mapping.items():
        if e in present:
            classes.setdefault(m, []).append(e)
    if not classes:
        return F.lit(None).cast("string")
    active = {m: _any_one(es) for m, es in classes.items()}
    n_active = sum(a.cast("int") for a in active.values())
    pick = F.coalesce(*[F.when(a, F.lit(m)) for m, a in active.items()])
    return F.when(n_active == 1, pick)


def _any_one(cols: list[str]) -> Column:
    cond = None
    for c in cols:
        term = F.coalesce(F.col(c) == 1, F.lit(False))
        cond = term if cond is None else cond | term
    return cond


def label_position(label, labels: list[str] = MOOD_LABELS) -> Column:
    """Label -> id by list position (L2); unknown -> null."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), _col(label)).cast("int") - 1


def label_at(idx, labels: list[str] = MOOD_LABELS) -> Column:
    """Id -> label (L2)."""
    return F.get(F.array(*[F.lit(x) for x in labels]), _col(idx))


def id_list(labels) -> Column:
    """Comma-separated id string -> array<int> (empty/null -> empty)."""
    s = _col(labels)
    return F.when(F.coalesce(s, F.lit("")) == "", F.array().cast("array<int>")).otherwise(
        F.transform(F.split(s, ","), lambda x: x.cast("int")))


def count_labels(labels) -> Column:
    """Number of labels in a comma list; null or '' -> 0."""
    s = _col(labels)
    return F.when(F.coalesce(s, F.lit("")) != "", F.size(F.split(s, ","))).otherwise(F.lit(0))


def multi_hot(ids, k: int) -> Column:
    """array<int> of label ids -> 0/1 array of length k."""
    arr = _col(ids)
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda j: F.array_contains(arr, j).cast("int"))


def softmax(logits) -> Column:
    """Numerically stable softmax of an array<double>."""
    z = _col(logits)
    m = F.array_max(z)
    e = F.transform(z, lambda x: F.exp(x - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / total)


def argmax(values) -> Column:
    """0-based position of the first maximum."""
    v = _col(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def repair_probabilities(probs, raw_idx, final_idx) -> Column:
    """After an override the raw class gets the smaller and the final class
    the larger of their two scores, then renormalise (L11).  Unchanged when
    raw == final."""
    p = _col(probs)
    r = _col(raw_idx)
    f = _col(final_idx)
    pr = F.get(p, r)
    pf = F.get(p, f)
    swapped = F.transform(p, lambda x, i: F.when(i == f, F.greatest(pr, pf))
                          .when(i == r, F.least(pr, pf)).otherwise(x))
    total = F.aggregate(swapped, F.lit(0.0), lambda acc, x: acc + x)
    renorm = F.when(total > 0, F.transform(swapped, lambda x: x / total)).otherwise(swapped)
    return F.when(r == f, p).otherwise(renorm)


def rank_labels(probs, labels: list[str] = MOOD_LABELS) -> Column:
    """Labels ordered by probability descending; ties keep list order."""
    p = _col(probs)
    pairs = F.transform(p, lambda x, i: F.struct(F.negative(x).alias("k"), i.alias("i")))
    order = F.transform(F.array_sort(pairs), lambda s: s["i"])
    names = F.array(*[F.lit(x) for x in labels])
    return F.transform(order, lambda i: F.get(names, i))
