"""Special tokens, chat-template settings and the byte vocabulary as tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bytes import byte_order
from ..options import (BOS_TOKEN, EOS_TOKEN, FIRST_BYTE_ID, SPECIAL_TOKENS)

VOCAB_SCHEMA = "token_id int, piece string, kind string"


def special_tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t) for i, t in enumerate(SPECIAL_TOKENS)],
                                 "token_id int, token string")


def special_tokens_map(path: str | None = None) -> dict:
    """The special-token map (from a JSON file when given)."""
    if path:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    return {"bos_token": BOS_TOKEN, "eos_token": EOS_TOKEN, "unk_token": SPECIAL_TOKENS[0],
            "pad_token": EOS_TOKEN, "additional_special_tokens": list(SPECIAL_TOKENS[1:3])}


def byte_vocab(spark: SparkSession, merges: DataFrame | None = None) -> DataFrame:
    """``(token_id, piece, kind)``; ``piece`` holds the token's bytes as a
    Latin-1 string (one code point per byte). Specials, then the 256 byte
    symbols, then the merges' new ids when a merge table is given."""
    rows = [(i, t, "special") for i, t in enumerate(SPECIAL_TOKENS)]
    rows += [(FIRST_BYTE_ID + r, chr(b), "byte") for r, b in enumerate(byte_order())]
    base = spark.createDataFrame(rows, VOCAB_SCHEMA)
    if merges is None:
        return base
    return base.unionByName(
        merges.select(F.col("new_id").cast("int").alias("token_id"), "piece",
                      F.lit("merge").alias("kind")))
