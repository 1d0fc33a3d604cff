"""Arrow-batched byte codec (the fast path of ``encode``/``decode``).

The SQL forms in ``bytes.py`` interpret one lambda call per byte. Here a
whole Arrow batch is handled at once: the string column's UTF-8 data buffer
*is* the byte sequence of all rows, so one vectorized table lookup over that
buffer gives every byte id and the string offsets become the list offsets.
Special-token strings are searched in that buffer as a whole: the first byte of
an occurrence takes the token's id, its other bytes are dropped, so no row is
handled by itself.

Decoding gathers each id's bytes from a flat piece table in one vectorized
pass; rows whose bytes are not valid UTF-8 (ids cut inside a character) are
decoded with U+FFFD replacement.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..options import SPECIAL_TOKENS
from .bytes import byte_order, byte_to_id_table

_LUT = np.asarray(byte_to_id_table(), dtype=np.int32)
_SPECIAL_IDS = {t: i for i, t in enumerate(SPECIAL_TOKENS)}
_SPECIAL_BYTES = re.compile(b"|".join(re.escape(t.encode()) for t in
                                       sorted(SPECIAL_TOKENS, key=len, reverse=True)))


def _string_parts(arr: pa.Array):
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    off_t = np.int64 if large else np.int32
    bufs = arr.buffers()
    offsets = np.frombuffer(bufs[1], dtype=off_t)[arr.offset: arr.offset + len(arr) + 1]
    data = (np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None
            else np.zeros(0, dtype=np.uint8))
    return arr, offsets.astype(np.int64), data


def encode_batch(texts: pa.Array) -> pa.Array:
    arr, offsets, data = _string_parts(texts)
    n = len(arr)
    data = data[offsets[0]:offsets[-1]] if n else data[:0]
    list_off = offsets - offsets[0] if n else np.zeros(1, np.int64)
    values = _LUT[data]
    mask = arr.is_null().to_numpy(zero_copy_only=False) if arr.null_count else None
    found = [(m.start(), m.end(), _SPECIAL_IDS[m.group().decode()]) for m in _SPECIAL_BYTES.finditer(data)]
    if found:
        start, end, ids = (np.array(x, np.int64) for x in zip(*found))
        # the buffer holds the rows back to back: a string across two rows is none
        same = np.searchsorted(list_off, start, "right") == np.searchsorted(list_off, end - 1, "right")
        start, end, ids = start[same], end[same], ids[same]
        values[start] = ids
        step = np.zeros(len(data) + 1, np.int64)
        np.add.at(step, start + 1, 1)
        np.add.at(step, end, -1)
        keep = np.cumsum(step[:-1]) == 0
        values = values[keep]
        list_off = np.concatenate([[0], np.cumsum(keep)])[list_off]
    return list_array(list_off, values, mask)


def list_array(offsets: np.ndarray, values: np.ndarray, mask: np.ndarray | None) -> pa.Array:
    """``array<int>`` rows; refuses a batch whose offsets pass 32 bits."""
    if len(offsets) and offsets[-1] >= 1 << 31:
        raise OverflowError("more than 2^31 ids in one Arrow batch: lower "
                            "spark.sql.execution.arrow.maxRecordsPerBatch")
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, pa.int32()),
                                    mask=pa.array(mask) if mask is not None else None)


def count_batch(lists: pa.Array) -> pa.Array:
    """The distinct ids of each list in ascending order (null first), with their numbers."""
    n = len(lists)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    mask = lists.is_null().to_numpy(zero_copy_only=False) if lists.null_count else None
    ids = lists.flatten()  # without what lies under null lists
    row = np.repeat(np.arange(n), pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    there = ids.is_valid().to_numpy(zero_copy_only=False)
    values = ids.fill_null(0).cast(pa.int64()).to_numpy()
    low, span = (int(values.min()), int(values.max()) - int(values.min()) + 2) if len(values) else (0, 2)
    known = None
    if span * max(n, 1) >= 1 << 62:  # the row and the id share 64 bits: far ids by their rank
        known, values = np.unique(values, return_inverse=True)
        low, span = 0, len(known) + 1
    key = row * span + np.where(there, values - low + 1, 0)
    key.sort()
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    row, code = np.divmod(key[first], span)
    found = np.maximum(code - 1, 0) + low
    pairs = pa.StructArray.from_arrays(
        [pa.array(known[found] if known is not None else found, pa.int64(), mask=code == 0),
         pa.array(np.diff(np.append(first, len(key))), pa.int64())], names=["id", "n"])
    offsets = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pairs, mask=pa.array(mask) if mask is not None else None)


def count_ids_arrow(col: Column) -> Column:
    """``array<struct<id, n>>``: how often each id is in the list of its row."""
    return arrow_udf(count_batch, ArrayType(StructType([StructField("id", LongType()), StructField("n", LongType())])))(col)


def _piece_table(extra: dict[int, bytes] | None = None):
    pieces: dict[int, bytes] = {i: t.encode("utf-8") for i, t in enumerate(SPECIAL_TOKENS)}
    for r, b in enumerate(byte_order()):
        pieces[5 + r] = bytes([b])
    if extra:
        pieces.update(extra)
    size = max(pieces) + 1
    lens = np.zeros(size, dtype=np.int64)
    starts = np.zeros(size, dtype=np.int64)
    flat = bytearray()
    for i in range(size):
        p = pieces.get(i, b"")
        starts[i] = len(flat)
        lens[i] = len(p)
        flat += p
    return lens, starts, np.frombuffer(bytes(flat), dtype=np.uint8)


def make_decoder(extra: dict[int, bytes] | None = None):
    lens_t, starts_t, flat = _piece_table(extra)
    size = len(lens_t)

    def decode_batch(ids: pa.Array) -> pa.Array:
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        n = len(ids)
        loff = np.asarray(ids.offsets, dtype=np.int64)
        vals = np.asarray(ids.values.to_numpy(zero_copy_only=False), dtype=np.int64)
        vals = vals[loff[0]:loff[-1]]
        loff = loff - loff[0]
        ok = (vals >= 0) & (vals < size)
        safe = np.where(ok, vals, 0)
        lens = np.where(ok, lens_t[safe], 0)
        starts = starts_t[safe]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        idx = np.repeat(starts - (ends - lens), lens) + np.arange(total, dtype=np.int64)
        data = flat[idx] if total else np.zeros(0, dtype=np.uint8)
        cum = np.concatenate([[0], ends])
        if total >= 1 << 31:
            raise OverflowError("more than 2^31 bytes in one Arrow batch: lower "
                                "spark.sql.execution.arrow.maxRecordsPerBatch")
        soff = cum[loff]
        validity = None if not ids.null_count else pa.array(
            ids.is_valid().to_numpy(zero_copy_only=False)).buffers()[1]
        binary = pa.Array.from_buffers(pa.binary(), n, [validity, pa.py_buffer(soff.astype(np.int32)),
                                                        pa.py_buffer(data.tobytes())],
                                       null_count=ids.null_count)
        try:
            return binary.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([None if b is None else b.decode("utf-8", errors="replace")
                             for b in binary.to_pylist()], pa.string())

    return decode_batch


# The results are deterministic; the flag only stops the optimizer from
# inlining a codec result into a later lambda (higher-order function), where
# a Python UDF could not be extracted for evaluation.
_encode_udf = arrow_udf(encode_batch, ArrayType(IntegerType())).asNondeterministic()
_decode_udf = arrow_udf(make_decoder(), StringType()).asNondeterministic()


def encode_bytes_arrow(col: str | Column) -> Column:
    """Column: text -> array<int> of special and byte ids (Arrow batches)."""
    return _encode_udf(col)


def decode_bytes_arrow(col: str | Column) -> Column:
    """Column: array<int> of special and byte ids -> text (Arrow batches)."""
    return _decode_udf(col)


def decoder_for_pieces(extra: dict[int, bytes]):
    """Decoder UDF that also knows merged tokens ``{id: bytes}`` (bounded by
    the vocabulary size)."""
    return arrow_udf(make_decoder(extra), StringType()).asNondeterministic()
