"""Step contracts of the corpus tables and the check that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


# The names and types of the step contract below.


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


CRAWL_RECORD = _strings("warc_id", "url", "date", "html_content", "warc_filename")
FILTERED_PAGE = _strings("warc_id", "url", "date", "html_content")
TEXT_DOCUMENT = _strings("warc_id", "url", "date", "extracted_text")
TOKEN_SEQUENCE = T.StructType(
    [
        T.StructField("warc_id", T.StringType(), True),
        T.StructField("tokens", T.ArrayType(T.IntegerType()), True),
        T.StructField("attention_mask", T.ArrayType(T.IntegerType()), True),
    ]
)
STEP_CONTRACTS = {
    1: CRAWL_RECORD,
    2: FILTERED_PAGE,
    3: TEXT_DOCUMENT,
    4: TEXT_DOCUMENT,
    5: TEXT_DOCUMENT,
    6: TOKEN_SEQUENCE,
}


class SchemaMismatch(ValueError):
    """A table lacks a contract column or holds it with another type."""


def check_schema(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df`` when every contract column is present with its type; extra columns pass."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    faults = []
    for field in contract.fields:
        wanted = field.dataType.simpleString()
        found = actual.get(field.name)
        if found is None:
            faults.append(f"{field.name}: missing")
        elif found != wanted:
            faults.append(f"{field.name}: {found}, expected {wanted}")
    if faults:
        raise SchemaMismatch("; ".join(faults))
    return df


def check_step(df: DataFrame, step: int) -> DataFrame:
    return check_schema(df, STEP_CONTRACTS[step])
