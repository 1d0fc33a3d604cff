"""Sample builders: pretraining samples (D3) and chat samples (D4).

Both are per-row projections: one stage, no shuffle, so they scale with the
number of input splits. Materialise them once (``write_samples``) when
several epochs read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import masks as M
from ..operators import tokens as TK
from ..operators.chat import render_messages, with_bos
from ..options import SampleOptions


def pretrain_samples(df: DataFrame, text: str = "text", keys: list[str] | None = None,
                     opts: SampleOptions = SampleOptions(), merges: DataFrame | None = None) -> DataFrame:
    """BOS + text -> ids -> first ``max_length`` -> pad -> real mask -> shift.

    Output: ``keys`` + ``n_real, x, y, loss_mask`` (each ``max_length-1``)."""
    keys = keys if keys is not None else [c for c in df.columns if c != text]
    n = opts.max_length
    d = with_bos(df.select(*keys, text), text, opts.bos, out="bos_text_")
    d = TK.encode(d, "bos_text_", "ids", merges=merges)
    d = TK.fit_length(d, "ids", n, opts.pad_id)
    d = M.real_mask(d, "n_real", n)
    d = M.shift(d, "ids", "loss_mask", n)
    return d.select(*keys, "n_real", "x", "y", "loss_mask")


def chat_samples(df: DataFrame, messages: str | None = "messages", text: str | None = None,
                 keys: list[str] | None = None, opts: SampleOptions = SampleOptions(),
                 header: list[int] | None = None, merges: DataFrame | None = None) -> DataFrame:
    """Render (unless ``text`` is already rendered) -> ids -> fit -> answer
    span mask -> shift. The mask is computed on the padded ids, before the
    shift, and aligned with ``y``."""
    n = opts.max_length
    if text is None:
        keys = keys if keys is not None else [c for c in df.columns if c != messages]
        d = render_messages(df.select(*keys, messages), messages, out="chat_text_")
        src = "chat_text_"
    else:
        keys = keys if keys is not None else [c for c in df.columns if c != text]
        d = df.select(*keys, F.col(text).alias("chat_text_"))
        src = "chat_text_"
    d = TK.encode(d, src, "ids", merges=merges)
    d = TK.fit_length(d, "ids", n, opts.pad_id)
    if header is None:
        header = M.answer_header("assistant", merges)
    d = M.span_mask(d, "ids", header, opts.end_id)
    d = M.shift(d, "ids", "loss_mask", n)
    return d.select(*keys, "n_real", "x", "y", "loss_mask")
