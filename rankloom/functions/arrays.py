"""Array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def tail(arr: Column, n: int) -> Column:
    """Last ``n`` elements; the whole array when it is shorter."""
    start = F.greatest(F.size(arr) - F.lit(n), F.lit(0)) + 1
    return F.slice(arr, start, F.lit(n))


def head(arr: Column, n: int) -> Column:
    return F.slice(arr, F.lit(1), F.lit(n))


def pad_to(arr: Column, depth: int, default: Column, surplus: str = "raise") -> Column:
    """Exactly ``depth`` values: the shortage is filled, a surplus is an error or, on demand, cut."""
    if surplus not in ("raise", "cut"):
        raise ValueError("surplus must be 'raise' or 'cut'")
    padded = F.slice(F.concat(arr, F.array_repeat(default, depth)), 1, depth)
    if surplus == "cut":
        return padded
    message = F.concat(F.lit(f"more than {depth} values: "), F.size(arr).cast("string"))
    return F.when(F.size(arr) > depth, F.raise_error(message)).otherwise(padded)


def sort_by_index(arr: Column, index: str = "pos", value: str = "item") -> Column:
    """Sort an array of structs by one field, keep the other."""
    keyed = F.transform(arr, lambda s: F.struct(s[index].alias("i"), s[value].alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def zip_padded(fill: str, **arrays: Column) -> Column:
    """Zip arrays of different lengths; short ones are padded with ``fill``."""
    names = list(arrays)
    zipped = F.arrays_zip(*[arrays[n].alias(n) for n in names])
    return F.transform(
        zipped,
        lambda s: F.struct(*[F.coalesce(s[n], F.lit(fill)).alias(n) for n in names]),
    )


def total(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def mean(arr: Column) -> Column:
    """Mean; the mean of nothing is 0."""
    return F.when(F.size(arr) > 0, total(arr) / F.size(arr)).otherwise(F.lit(0.0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once, so a lambda below does not evaluate it per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def value_counts(arr: Column) -> Column:
    """``array<struct<value, n>>``: the distinct values that are not NULL, in order; one sort per row."""

    def runs(s: Column) -> Column:
        begins = F.transform(s, lambda x, i: F.when((i == 0) | (x != F.get(s, i - 1)), i))

        def count(b: Column) -> Column:
            upto = lambda j: F.coalesce(F.get(b, j + 1), F.size(s))
            return F.transform(b, lambda at, j: F.struct(F.get(s, at).alias("value"), (upto(j) - at).cast("bigint").alias("n")))

        return let(F.filter(begins, lambda i: i.isNotNull()), count)

    return let(F.array_sort(F.filter(arr, lambda x: x.isNotNull())), runs)


def centered_l2(arr: Column) -> Column:
    """Square root of the summed squared distance to the mean."""

    def spread(center: Column) -> Column:
        return F.aggregate(
            arr,
            F.lit(0.0),
            lambda acc, x: acc + (x.cast("double") - center) * (x.cast("double") - center),
        )

    return F.sqrt(let(mean(arr), spread))


def reduce_values(arr: Column, how: str) -> Column:
    """``sum``, ``mean``, ``max`` or ``centered_l2`` of a multi-value field."""
    if how == "sum":
        return total(arr)
    if how == "mean":
        return mean(arr)
    if how == "max":
        return F.array_max(arr)
    if how == "centered_l2":
        return centered_l2(arr)
    raise ValueError(f"unknown reduction {how!r}")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )


def masked_softmax(scores: Column, mask: Column) -> Column:
    """Softmax over the positions whose mask is 1; the others get weight 0.

    The row maximum over unmasked positions is subtracted first, so large
    scores do not overflow.  A row without any unmasked position gets zeros.
    """
    shown = F.zip_with(scores, mask, lambda s, m: F.when(m != 0, s.cast("double")))
    powers = let(
        shown,
        lambda vals: let(
            F.array_max(vals),
            lambda peak: F.transform(vals, lambda s: F.coalesce(F.exp(s - peak), F.lit(0.0))),
        ),
    )
    return let(
        powers,
        lambda ps: let(
            total(ps),
            lambda norm: F.transform(ps, lambda p: F.when(norm > 0, p / norm).otherwise(F.lit(0.0))),
        ),
    )


def interaction(a: Column, b: Column) -> Column:
    """``[a, b, a - b, a * b]`` of two equal-length vectors."""
    return F.concat(a, b, F.zip_with(a, b, lambda x, y: x - y), F.zip_with(a, b, lambda x, y: x * y))


def thirds(arr: Column) -> tuple[Column, Column, Column]:
    """Cut an array into three equal parts."""
    step = F.floor(F.size(arr) / 3).cast("int")
    return F.slice(arr, F.lit(1), step), F.slice(arr, step + 1, step), F.slice(arr, step * 2 + 1, step)
