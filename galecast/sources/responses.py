"""Landed service responses to item rows.

One row per response text in, one row per item out. The texts are read by
Spark's own JSON and XML functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galecast.sources.schemas import ITEM

# What the service says.
GOOD_CODE = "00"
NO_DATA = "NO_DATA"
QUOTA = "LIMITED_NUMBER_OF_SERVICE_REQUESTS_EXCEEDS_ERROR"

ENVELOPE = (
    "response struct<"
    "header struct<resultCode string, resultMsg string>, "
    "body struct<items struct<item string>>>"
)
XML_ENVELOPE = (
    "struct<"
    "header: struct<resultCode: string, resultMsg: string>, "
    "cmmMsgHeader: struct<returnAuthMsg: string, returnReasonCode: string>, "
    "body: struct<items: struct<item: array<map<string, string>>>>>"
)


def read_responses(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Response texts as ``text`` with the file they came from."""
    texts = spark.read.text(path, wholetext=one_per_file)
    return texts.select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("file"))


def triage(responses: DataFrame, text: str = "text") -> DataFrame:
    """Add ``status`` and ``item_text``.

    ``good``, ``no_data`` (skip and try an older base), ``error`` (the service
    refused), ``unreadable`` (a good code, but no items that can be read) or
    ``not_json``. One scan serves all outcomes.
    """
    parsed = responses.withColumn("_r", F.from_json(F.col(text), ENVELOPE)["response"])
    code, message = F.col("_r.header.resultCode"), F.col("_r.header.resultMsg")
    no_data = F.contains(F.coalesce(message, F.lit("")), F.lit(NO_DATA)) | (
        F.coalesce(code, F.lit("")) == NO_DATA
    )
    readable = F.get_json_object(as_list(F.col("_r.body.items.item")), "$[0]").isNotNull()
    status = (
        F.when(F.col("_r").isNull(), "not_json")
        .when(code == GOOD_CODE, F.when(readable, "good").otherwise("unreadable"))
        .when(no_data, "no_data")
        .otherwise("error")
    )
    return parsed.withColumns(
        {"status": status, "item_text": F.col("_r.body.items.item")}
    ).drop("_r")


def as_list(item_text: Column) -> Column:
    """A single item is written without a list around it."""
    return F.when(F.startswith(F.ltrim(item_text), F.lit("{")), F.concat(F.lit("["), item_text, F.lit("]"))).otherwise(item_text)


def explode_items(
    triaged: DataFrame, schema: T.StructType = ITEM, keep: tuple[str, ...] = (), only_good: bool = True
) -> DataFrame:
    """Item rows in response order (``pos``), with the ``keep`` columns of their response."""
    items = F.from_json(as_list(F.col("item_text")), T.ArrayType(schema))
    # Not a filter: it would be pushed below the envelope's projection and parse every text again.
    wanted = F.when(F.col("status") == "good", items) if only_good else items
    exploded = triaged.select(*keep, F.posexplode(wanted).alias("pos", "item"))
    return exploded.where(F.col("item").isNotNull()).select(*keep, "pos", "item.*")


def quarantine(triaged: DataFrame) -> DataFrame:
    """The responses that gave neither items nor a plain "no data"."""
    return triaged.where(F.col("status").isin("error", "not_json", "quota", "unreadable"))


def fill_cells(items: DataFrame, nx: Column, ny: Column) -> DataFrame:
    """Cells from the request where the item does not name them."""
    own_nx = F.col("nx").try_cast("int")
    own_ny = F.col("ny").try_cast("int")
    return items.withColumns(
        {"nx": F.coalesce(own_nx, nx.try_cast("int")), "ny": F.coalesce(own_ny, ny.try_cast("int"))}
    )


def request_cell(file: Column) -> tuple[Column, Column]:
    """The asked cell from a landed path with ``nx=<n>/ny=<n>`` in it."""
    return (
        F.nullif(F.regexp_extract(file, r"nx=(\d+)", 1), F.lit("")),
        F.nullif(F.regexp_extract(file, r"ny=(\d+)", 1), F.lit("")),
    )


def index_items(responses: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Responses in JSON, or else in XML, to ``status`` and ``item`` maps, one row per item.

    A response without items keeps one row with a null ``item``: status
    ``quota`` when the service's limit was hit, ``empty`` otherwise.
    """
    body = F.from_json(F.col(text), ENVELOPE)["response"]
    parsed = responses.select(
        *keep,
        F.col(text),
        F.from_json(as_list(body["body"]["items"]["item"]), "array<map<string, string>>").alias("_json"),
        body.isNotNull().alias("_is_json"),
    )
    xml = F.when(~F.col("_is_json"), F.from_xml(F.col(text), XML_ENVELOPE))
    parsed = parsed.withColumn("_xml", xml)
    complaint = F.coalesce(
        F.col("_xml.cmmMsgHeader.returnAuthMsg"), F.col("_xml.cmmMsgHeader.returnReasonCode"), F.lit("")
    )
    items = F.coalesce("_json", "_xml.body.items.item")
    status = (
        F.when(F.contains(complaint, F.lit(QUOTA)), "quota")
        .when(F.size(items) > 0, "good")
        .otherwise("empty")
    )
    return parsed.select(
        *keep, status.alias("status"), F.posexplode_outer(items).alias("pos", "item")
    )


def parse_items(responses: DataFrame, text: str = "text", keep: tuple[str, ...] = (), xml: Column | bool = False) -> DataFrame:
    """All responses in one parse: ``keep``, status, pos and item (a map), one row per item.

    Status is as in ``triage``, and ``quota`` where the service's limit was hit.
    A response that is not good keeps one row without an item, which alone
    carries its text. Where ``xml`` holds, a text that is no JSON may be XML.
    """
    parsed = responses.select(*keep, F.col(text), F.from_json(F.col(text), ENVELOPE)["response"].alias("_r"))
    may_be_xml = F.lit(xml) if isinstance(xml, bool) else xml
    parsed = parsed.withColumn("_x", F.when(F.col("_r").isNull() & may_be_xml, F.from_xml(F.col(text), XML_ENVELOPE)))
    items = F.coalesce(
        F.from_json(as_list(F.col("_r.body.items.item")), "array<map<string, string>>"), F.col("_x.body.items.item")
    )
    parsed = parsed.withColumn("_items", items)
    code = F.coalesce("_r.header.resultCode", "_x.header.resultCode")
    message = F.coalesce("_r.header.resultMsg", "_x.header.resultMsg", F.lit(""))
    complaint = F.coalesce("_x.cmmMsgHeader.returnAuthMsg", "_x.cmmMsgHeader.returnReasonCode", F.lit(""))
    no_data = F.contains(message, F.lit(NO_DATA)) | (F.coalesce(code, F.lit("")) == NO_DATA)
    status = (
        F.when(F.contains(complaint, F.lit(QUOTA)), "quota")
        .when(code == GOOD_CODE, F.when(F.size("_items") > 0, "good").otherwise("unreadable"))
        .when(no_data, "no_data")
        .when(F.col("_r").isNull() & code.isNull(), "not_json")
        .otherwise("error")
    )
    told = parsed.withColumn("status", status)
    wanted = F.when(F.col("status") == "good", F.col("_items"))
    return told.select(*keep, "status", F.when(F.col("status") != "good", F.col(text)).alias(text), F.posexplode_outer(wanted).alias("pos", "item"))
