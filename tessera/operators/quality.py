"""Line classification (blank / skip / ok / error), counters, reject samples.

Each raw line is untrusted text. First route, in the JVM: the line is parsed once
with ``try_parse_json`` into a VARIANT, and ``schema_of_variant`` tells a missing
key, a JSON null and a wrong type apart, which a schema-bound ``from_json`` cannot.
The line is parsed as the first item of an array whose second item is the line's
hash, so text behind the first JSON value cannot go unnoticed.

Second route: object lines that the VARIANT parser refuses (duplicate keys, ``NaN``,
sizes beyond its limit, broken lines) or that are followed by more text go through a
strict parser over Arrow batches (``strict.py``), which decides outcome, reason and
text by the rules of ``json.loads``: the last of equal keys counts, ``NaN`` is a
number, and no line is too long. All other lines reach it as nulls.

Outcomes: ``blank`` (empty line, skipped and not counted), ``skip`` (no usable text,
not an error), ``ok``, ``error`` with a ``reason``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import excerpt, not_blank
from ..options import BLANK_CODE_POINTS
from ..session import ship_package
from .strict import BLANK, CHAT_ITEMS, ERROR, OK, SKIP, strict_chat, strict_text


def strip_blank(col: Column) -> Column:
    """Python ``str.strip()``: drop leading and trailing whitespace (linear in the
    line, however long its runs of blanks are)."""
    return F.btrim(col, F.lit("".join(map(chr, BLANK_CODE_POINTS))))


def _is_object(top: Column) -> Column:
    return F.coalesce(top.startswith("OBJECT"), F.lit(False))


# Classification is built as stacked projections in which every derived
# column (parsed variant, its type, the field, the field's type) is used at
# least twice, so the optimizer keeps each in its own projection and computes
# it once per line. Consumers must not filter on ``outcome`` directly above
# this (a pushed-down filter would inline the parse into the predicate);
# use ``ok_rows`` / ``first_errors``.
def _parsed(df: DataFrame, line: Column, key: str, strict) -> DataFrame:
    """Adds ``s_`` (stripped line), ``v_`` (its VARIANT, null if not one value), ``top_`` and
    ``fv_`` (the type and the field of it) and ``r_`` (the strict parser's verdict)."""
    ship_package(df.sparkSession)
    d = df.withColumn("s_", strip_blank(line)).withColumn("h_", F.xxhash64("s_"))
    d = d.withColumn("w_", F.try_parse_json(F.concat(F.lit("["), "s_", F.lit(","), "h_", F.lit("]"))))
    d = d.withColumn("v_", F.expr("if(try_variant_get(w_, '$[1]', 'bigint') = h_, variant_get(w_, '$[0]'), null)"))
    d = (d.withColumn("top_", F.schema_of_variant("v_"))
          .withColumn("fv_", F.expr(f"variant_get(v_, '$.{key}')")))
    return d.withColumn("r_", strict(F.when(F.col("v_").isNull() & F.col("s_").startswith("{"), F.col("s_")))).drop("h_", "w_")


def classify_corpus(df: DataFrame, line_col: str = "value", field: str = "text") -> DataFrame:
    """Adds ``outcome``, ``reason`` and ``text`` (the field's string value for
    ``ok`` rows). Stateless, no shuffle."""
    line = F.col(line_col)
    d = _parsed(df, line, field, strict_text(field))
    d = (d.withColumn("ft_", F.schema_of_variant("fv_"))
          .withColumn("txt_", F.expr("coalesce(r_.text, try_variant_get(fv_, '$', 'string'))")))
    v, top, fv, ft, txt = (F.col(c) for c in ("v_", "top_", "fv_", "ft_", "txt_"))
    outcome = (
        F.when(~F.coalesce(not_blank(line), F.lit(False)), F.lit(BLANK))
        .when(F.col("r_").isNotNull(), F.col("r_.outcome"))
        .when(v.isNull(), F.lit(ERROR))
        .when(~_is_object(top), F.lit(ERROR))
        .when(fv.isNull(), F.lit(SKIP))
        .when(ft != F.lit("STRING"), F.lit(ERROR))
        .when(~not_blank(txt), F.lit(SKIP))
        .otherwise(F.lit(OK))
    )
    reason = (
        F.when(F.col("outcome") != F.lit(ERROR), F.lit(None).cast("string"))
        .when(F.col("r_").isNotNull(), F.col("r_.reason"))
        .when(v.isNull(), F.lit("json"))
        .when(~_is_object(top), F.lit("not_object"))
        .otherwise(F.concat(F.lit("type:"), ft))
    )
    return (d.withColumn("outcome", outcome)
            .withColumn("reason", reason)
            .withColumn("text", F.when(F.col("outcome") == OK, txt))
            .drop("s_", "v_", "top_", "fv_", "r_", "ft_", "txt_"))


def _chat_item(x: Column) -> Column:
    value = F.try_variant_get(x, "$.value", "variant")
    return F.struct(F.try_variant_get(x, "$.from", "string").alias("from"),
                    F.when(~F.is_variant_null(value), F.try_variant_get(x, "$.value", "string")).alias("value"),
                    value.isNull().alias("missing"))


def classify_chats(df: DataFrame, line_col: str = "value", key: str = "conversations") -> DataFrame:
    """Adds ``outcome``, ``reason`` and ``items`` (``CHAT_ITEMS``: speaker, text and
    whether the text is missing, for ``ok`` rows). ``key`` missing, null, not an array,
    or holding a non-object item is an error; ``[]`` is kept."""
    line = F.col(line_col)
    d = _parsed(df, line, key, strict_chat(key))
    d = (d.withColumn("ct_", F.schema_of_variant("fv_"))
          .withColumn("it_", F.expr("try_variant_get(fv_, '$', 'array<variant>')")))
    v, top, conv, ctype, items = (F.col(c) for c in ("v_", "top_", "fv_", "ct_", "it_"))
    bad_item = F.exists(items, lambda x: ~F.coalesce(
        F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)))
    outcome = (
        F.when(~F.coalesce(not_blank(line), F.lit(False)), F.lit(BLANK))
        .when(F.col("r_").isNotNull(), F.col("r_.outcome"))
        .when(v.isNull(), F.lit(ERROR))
        .when(~_is_object(top), F.lit(ERROR))
        .when(conv.isNull(), F.lit(ERROR))
        .when(~ctype.startswith("ARRAY"), F.lit(ERROR))
        .when(bad_item, F.lit(ERROR))
        .otherwise(F.lit(OK))
    )
    reason = (
        F.when(F.col("outcome") != F.lit(ERROR), F.lit(None).cast("string"))
        .when(F.col("r_").isNotNull(), F.col("r_.reason"))
        .when(v.isNull(), F.lit("json"))
        .when(~_is_object(top), F.lit("not_object"))
        .when(conv.isNull(), F.lit("missing"))
        .when(~ctype.startswith("ARRAY"), F.concat(F.lit("type:"), ctype))
        .otherwise(F.lit("item"))
    )
    found = F.coalesce(F.col("r_.items"), F.transform(items, _chat_item)).cast(CHAT_ITEMS)
    return (d.withColumn("outcome", outcome)
            .withColumn("reason", reason)
            .withColumn("items", F.when(F.col("outcome") == OK, found))
            .drop("s_", "v_", "top_", "fv_", "r_", "ct_", "it_"))


def ok_rows(classified: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """Rows whose outcome is ``ok`` with their payload column, selected by a
    generator over ``[payload]`` or ``[]``: unlike a filter it cannot be
    pushed below the classification, so the parse is not repeated."""
    one = F.when(F.col("outcome") == OK, F.array(F.col(payload))).otherwise(
        F.array().cast(f"array<{classified.schema[payload].dataType.simpleString()}>"))
    return classified.select(*keep, F.explode(one).alias(payload))


def first_errors(classified: DataFrame, n: int, ids: list[str], cols) -> DataFrame:
    """The first ``n`` error rows by ``ids``: a top-k on a sort key that is
    null for non-errors (no filter below the classification)."""
    key = F.when(F.col("outcome") == ERROR, F.struct(*ids))
    return (classified.select(*cols, key.alias("k_"))
            .orderBy(F.col("k_").asc_nulls_last()).limit(n)
            .filter(F.col("k_").isNotNull()).drop("k_"))


def run_counters(classified: DataFrame, group_cols: tuple = ()) -> DataFrame:
    """Row counts per outcome (and optional extra keys). Map-side partial
    aggregation keeps the shuffle at one row per key per task."""
    return classified.groupBy("outcome", *group_cols).agg(F.count(F.lit(1)).alias("n"))


def reject_samples(classified: DataFrame, n: int, ids: list[str] = ("line_id",),
                   line_col: str = "value", chars: int = 50) -> DataFrame:
    """The first ``n`` error lines by ``ids`` (file and line number), with a
    short excerpt of the stripped line. ``orderBy().limit()`` plans as a top-k:
    each task keeps n rows."""
    cols = [*(F.col(c) for c in ids), F.col("reason"),
            excerpt(strip_blank(F.col(line_col)), chars).alias("excerpt")]
    return first_errors(classified, n, list(ids), cols)
