"""Column-level functions (no actions, no shuffles)."""

from .arrays import (cut_at, drop_prompt, fit_length, keep_last, pad_right, real_length,
                     real_mask, shift_x, shift_y, span_mask_sql, truncate_right)
from .bytes import byte_order, decode_sql, encode_sql
from .schedule import learning_rate
from .text import blank_class, excerpt, not_blank, pieces, with_prefix

__all__ = [
    "cut_at", "drop_prompt", "fit_length", "keep_last", "pad_right", "real_length",
    "real_mask", "shift_x", "shift_y", "span_mask_sql", "truncate_right",
    "byte_order", "decode_sql", "encode_sql",
    "learning_rate", "blank_class", "excerpt", "not_blank", "pieces", "with_prefix",
]
