"""Reading JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MODES = ("failfast", "quarantine")


def parsed_once(df: DataFrame, document: Column, name: str) -> DataFrame:
    """``df`` with the parsed ``document`` as column ``name``.

    As the output of a generator it is computed once per row. A plain column would be copied into
    every later filter on its fields, and each copy parses the text again.
    """
    return df.select("*", F.explode(F.array(document)).alias(name))


def parse_lines(raw: DataFrame, schema: str, mode: str = "failfast", column: str = "value") -> DataFrame:
    """``raw`` with the parsed document in ``doc``.

    ``failfast`` stops the job at a malformed line; ``quarantine`` leaves such lines out, and
    :func:`malformed_lines` returns them.
    """
    assert mode in MODES
    if mode == "failfast":
        return raw.withColumn("doc", F.from_json(column, schema, {"mode": "FAILFAST"}))
    doc = parsed_once(raw, _permissive(column, schema), "doc")
    return doc.where(F.col("doc._corrupt_record").isNull() & F.col("doc").isNotNull())


def malformed_lines(raw: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Lines that :func:`parse_lines` leaves out in ``quarantine`` mode."""
    doc = parsed_once(raw, _permissive(column, schema), "doc")
    return doc.where(F.col("doc").isNull() | F.col("doc._corrupt_record").isNotNull()).drop("doc")


def _permissive(column: str, schema: str) -> Column:
    return F.from_json(column, f"{schema}, _corrupt_record string",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})


def must_have(value: Column, name: str, document: Column) -> Column:
    """``value``, or an error if its field is missing from the JSON text ``document``.

    An explicit JSON null is accepted. The document is looked at only where the value is null.
    """
    present = F.coalesce(F.array_contains(F.json_object_keys(document), name), F.lit(False))
    message = F.concat(F.lit(f"missing field {name}: "), F.coalesce(document, F.lit("")))
    # coalesce and when are lazy; an OR would have the document parsed for every row
    return F.coalesce(value, F.when(~present, F.raise_error(message)))


def open_object(document: Column) -> Column:
    """JSON object text without its closing brace, to append fields to."""
    return document.substr(F.lit(1), F.length(document) - 1)
