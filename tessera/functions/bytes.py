"""Byte-level token ids as column expressions.

Ids 0..4 are the special tokens, ids 5..260 the 256 byte symbols. The byte
symbols are ranked the way a byte-level BPE alphabet sorts: the bytes that
stand for themselves (printable Latin-1) first, then the remaining bytes,
each group in byte order. The table is built from that rule, not listed.

Bytes are reached in linear time without a UDF: ``encode(text,'UTF-8')`` is
re-read as ISO-8859-1, which maps every byte to one code point, and
``split(s, '')`` then yields one element per byte.
"""

from __future__ import annotations

import re


from ..options import FIRST_BYTE_ID, SPECIAL_TOKENS

# Byte ranges in rank order: self-standing bytes first, then the rest.
_RANK_SEGMENTS = ((33, 126), (161, 172), (174, 255), (0, 32), (127, 160), (173, 173))


def byte_order() -> list[int]:
    """Bytes in id order: ``byte_order()[i]`` has id ``FIRST_BYTE_ID + i``."""
    out: list[int] = []
    for lo, hi in _RANK_SEGMENTS:
        out.extend(range(lo, hi + 1))
    return out


def byte_to_id_table() -> list[int]:
    ids = [0] * 256
    for rank, b in enumerate(byte_order()):
        ids[b] = FIRST_BYTE_ID + rank
    return ids


def _byte_to_id_sql(b: str) -> str:
    parts, rank = [], FIRST_BYTE_ID
    for lo, hi in _RANK_SEGMENTS:
        parts.append(f"WHEN {b} BETWEEN {lo} AND {hi} THEN {b} + ({rank - lo})")
        rank += hi - lo + 1
    return "CASE " + " ".join(parts) + " END"


def _id_to_byte_sql(i: str) -> str:
    parts, rank = [], FIRST_BYTE_ID
    for lo, hi in _RANK_SEGMENTS:
        top = rank + (hi - lo)
        parts.append(f"WHEN {i} BETWEEN {rank} AND {top} THEN {i} - ({rank - lo})")
        rank = top + 1
    return "CASE " + " ".join(parts) + " END"


def special_regex(tokens=SPECIAL_TOKENS) -> str:
    # longest first so that no token is cut by a shorter one
    return "|".join(re.escape(t).replace("\\<", "<").replace("\\>", ">")
                    for t in sorted(tokens, key=len, reverse=True))


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _special_id_sql(m: str, tokens=SPECIAL_TOKENS) -> str:
    return "CASE " + " ".join(
        f"WHEN {m} = {_sql_str(t)} THEN {i}" for i, t in enumerate(tokens)) + " END"


def _byte_ids_sql(text_sql: str) -> str:
    latin = f"decode(encode({text_sql}, 'UTF-8'), 'ISO-8859-1')"
    body = _byte_to_id_sql("ascii(c_)")
    return (f"CASE WHEN length({text_sql}) = 0 THEN array() "
            f"ELSE transform(split({latin}, ''), c_ -> {body}) END")


def encode_sql(text_sql: str, tokens=SPECIAL_TOKENS) -> str:
    """SQL for text -> ids: special-token strings become their ids, all other
    text becomes byte ids. Texts without '<' skip the split."""
    rx = _sql_str(special_regex(tokens))
    parts = f"split({text_sql}, {rx}, -1)"
    marks = f"regexp_extract_all({text_sql}, {_sql_str('(' + special_regex(tokens) + ')')}, 1)"
    piece_ids = _byte_ids_sql("p_")
    # zip_with pads the shorter array with null: n+1 pieces, n marks
    split_path = (
        f"flatten(zip_with({parts}, {marks}, (p_, m_) -> concat({piece_ids}, "
        f"IF(m_ IS NULL, array(), array({_special_id_sql('m_', tokens)})))))"
    )
    return (f"CAST(CASE WHEN instr({text_sql}, '<') = 0 THEN {_byte_ids_sql(text_sql)} "
            f"ELSE {split_path} END AS array<int>)")


def _piece_sql(i: str, tokens=SPECIAL_TOKENS, merged_sql: str | None = None) -> str:
    specials = " ".join(f"WHEN {i} = {k} THEN {_sql_str(t)}" for k, t in enumerate(tokens))
    byte_piece = f"chr({_id_to_byte_sql(i)})"
    merged = f"WHEN {i} >= 261 THEN {merged_sql}" if merged_sql else ""
    return (f"CASE {specials} WHEN {i} BETWEEN 5 AND 260 THEN {byte_piece} {merged} "
            f"ELSE '' END")


def decode_sql(ids_sql: str, tokens=SPECIAL_TOKENS, merged_sql: str | None = None) -> str:
    """SQL for ids -> text. Pieces are Latin-1 strings (one code point per
    byte) joined, turned back into bytes and read as UTF-8; invalid sequences
    (ids cut inside a character) become U+FFFD."""
    joined = f"array_join(transform({ids_sql}, t_ -> {_piece_sql('t_', tokens, merged_sql)}), '')"
    return f"make_valid_utf8(CAST(encode({joined}, 'ISO-8859-1') AS string))"
