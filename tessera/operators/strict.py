"""Strict JSON route for lines that the VARIANT parser cannot judge.

Arrow UDFs over the few lines sent to them (all others are null): ``json.loads``
decides, so the last of equal keys counts, ``NaN`` and the infinities are numbers,
text behind the value is an error, and there is no size limit but memory.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql.functions import arrow_udf

from ..options import BLANK_CODE_POINTS

BLANK, SKIP, OK, ERROR = "blank", "skip", "ok", "error"
CHAT_ITEMS = "array<struct<from:string,value:string,missing:boolean>>"
_BLANKS = "".join(map(chr, BLANK_CODE_POINTS))
_ITEMS = pa.list_(pa.struct([("from", pa.string()), ("value", pa.string()), ("missing", pa.bool_())]))
_TYPES = {type(None): "VOID", bool: "BOOLEAN", int: "BIGINT", float: "DOUBLE", list: "ARRAY", dict: "OBJECT", str: "STRING"}


def _sound(text: str) -> str:
    """``text`` with halves of surrogate pairs (possible in escapes) as U+FFFD."""
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def _as_text(x) -> str | None:
    if x is None or isinstance(x, str):
        return None if x is None else _sound(x)
    return _sound(json.dumps(x, ensure_ascii=False, separators=(",", ":")))


def text_of(line: str, field: str):
    """(outcome, reason, text) of a corpus line."""
    try:
        record = json.loads(line)
    except (ValueError, RecursionError):
        return ERROR, "json", None
    if not isinstance(record, dict):
        return ERROR, "not_object", None
    if field not in record:
        return SKIP, None, None
    text = record[field]
    if not isinstance(text, str):
        return ERROR, "type:" + _TYPES[type(text)], None
    return (OK, None, _sound(text)) if text.strip(_BLANKS) else (SKIP, None, None)


def items_of(line: str, key: str):
    """(outcome, reason, chat items) of a chat line."""
    try:
        record = json.loads(line)
    except (ValueError, RecursionError):
        return ERROR, "json", None
    if not isinstance(record, dict):
        return ERROR, "not_object", None
    items = record.get(key)
    if items is None:
        return ERROR, "type:VOID" if key in record else "missing", None
    if not isinstance(items, list):
        return ERROR, "type:" + _TYPES[type(items)], None
    if not all(isinstance(x, dict) for x in items):
        return ERROR, "item", None
    return OK, None, [{"from": _as_text(x.get("from")), "value": _as_text(x.get("value")), "missing": "value" not in x}
                      for x in items]


def _route(judge, name: str, key: str, kind: pa.DataType, returns: str):
    def judged(lines: pa.Array) -> pa.Array:
        rows = [None if x is None else dict(zip(("outcome", "reason", name), judge(x, key))) for x in lines.to_pylist()]
        return pa.array(rows, pa.struct([("outcome", pa.string()), ("reason", pa.string()), (name, kind)]))
    return arrow_udf(judged, f"struct<outcome:string,reason:string,{name}:{returns}>").asNondeterministic()


def strict_text(field: str):
    return _route(text_of, "text", field, pa.string(), "string")


def strict_chat(key: str):
    return _route(items_of, "items", key, _ITEMS, CHAT_ITEMS)
