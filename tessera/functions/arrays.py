"""Column functions over id arrays: length fitting, masks, shifts, cuts.

All are higher-order SQL expressions on one row: no shuffle, JVM only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _sql_ints(xs) -> str:
    return "array(" + ", ".join(str(int(x)) for x in xs) + ")"


def truncate_right(col, n: int) -> Column:
    """First ``n`` ids."""
    return F.slice(_c(col), 1, n)


def pad_right(col, n: int, pad: int = 0) -> Column:
    """Pad to exactly ``n`` ids (expects at most ``n``)."""
    c = _c(col)
    return F.concat(c, F.array_repeat(F.lit(pad), F.greatest(F.lit(n) - F.size(c), F.lit(0))))


def fit_length(col, n: int, pad: int = 0) -> Column:
    return pad_right(truncate_right(col, n), n, pad)


def real_length(col, n: int) -> Column:
    return F.least(F.size(_c(col)), F.lit(n))


def real_mask(n_real, n: int) -> Column:
    """1 on the first ``n_real`` positions, 0 on the rest of ``n``."""
    r = _c(n_real)
    return F.concat(F.array_repeat(F.lit(1), r), F.array_repeat(F.lit(0), F.lit(n) - r))


def span_list_sql(ids_sql: str, header, end: int) -> str:
    """SQL for the answer spans ``array<struct<s:int, p:int>>``.

    Every occurrence of ``header`` (scanning left to right, resuming after a
    matched header) opens a span from the position right after the header
    (``s``, 0-based) to the first ``end`` id at or after it, inclusive; ``p``
    is that id's 1-based offset from ``s``. No ``end`` after a header (cut by
    truncation) gives no span."""
    h = len(header)
    if h == 0:
        raise ValueError("header must not be empty")
    H = _sql_ints(header)
    n = f"size({ids_sql})"
    starts_all = (f"filter(sequence(0, greatest({n} - {h}, 0)), i_ -> element_at({ids_sql}, i_ + 1) = {int(header[0])} "
                  f"AND slice({ids_sql}, i_ + 1, {h}) = {H})")
    # drop starts that overlap an earlier kept header (scan resumes after it)
    starts = (f"aggregate({starts_all}, CAST(array() AS array<int>), (acc_, i_) -> "
              f"IF(size(acc_) = 0 OR i_ >= element_at(acc_, -1) + {h}, array_append(acc_, i_), acc_))")
    spans = (f"filter(transform({starts}, i_ -> named_struct('s', i_ + {h}, 'p', "
             f"array_position(slice({ids_sql}, i_ + {h} + 1, greatest({n} - i_ - {h}, 1)), {int(end)}))), "
             f"x_ -> x_.p > 0)")
    return f"CASE WHEN {n} < {h} THEN filter(array(named_struct('s', 0, 'p', 0L)), x_ -> false) ELSE {spans} END"


def span_mask_from_spans_sql(ids_sql: str, spans_sql: str) -> str:
    """0/1 per position, 1 inside any span. The span list is the input of an
    ``aggregate`` (not referenced inside a per-position lambda), so it is
    evaluated once per row; cost O(spans x length)."""
    n = f"size({ids_sql})"
    return (f"CAST(aggregate({spans_sql}, array_repeat(0, {n}), (acc_, x_) -> "
            f"transform(acc_, (v_, q_) -> IF(q_ >= x_.s AND q_ <= x_.s + CAST(x_.p AS int) - 1, 1, v_))) "
            f"AS array<int>)")


def span_mask_sql(ids_sql: str, header, end: int) -> str:
    """Answer-span mask as one SQL expression (see ``span_list_sql``)."""
    return span_mask_from_spans_sql(ids_sql, span_list_sql(ids_sql, header, end))


def shift_x(col, n: int) -> Column:
    return F.slice(_c(col), 1, n - 1)


def shift_y(col, n: int) -> Column:
    return F.slice(_c(col), 2, n - 1)


def keep_last(col, n: int) -> Column:
    """Last ``n`` ids (context cut)."""
    c = _c(col)
    return F.when(F.size(c) <= n, c).otherwise(F.slice(c, F.size(c) - n + 1, F.lit(n)))


def drop_prompt(col, prompt_len) -> Column:
    """Ids after the first ``prompt_len`` ones."""
    c = _c(col)
    p = prompt_len if isinstance(prompt_len, Column) else F.lit(prompt_len)
    return F.when(F.size(c) <= p, F.array().cast("array<int>")).otherwise(
        F.slice(c, p + 1, F.size(c) - p))


def cut_at(col, stop: int, inclusive: bool) -> Column:
    """Cut at the first ``stop`` id, keeping it when ``inclusive``."""
    c = _c(col)
    p = F.array_position(c, F.lit(stop))
    keep = p if inclusive else p - 1
    return F.when(p == 0, c).otherwise(F.slice(c, F.lit(1), keep.cast("int")))


def first_numbers(n: int) -> Column:
    """0, 1, ... n - 1 as an array literal: exploded, each row comes ``n`` times without a join.
    ``n`` is a caller's count of epochs, draws or runs; its array is held once a task."""
    return F.slice(F.sequence(F.lit(0), F.lit(n)), 1, n)
