"""Shredding of XML documents stored in table columns into rows.

Everything is a narrow transformation (decode -> root test -> from_xml ->
explode -> explode): no shuffle and no Python, so it scales with the input
partitions. Only the fields used are declared in the ``from_xml`` schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.functions.text import parent_folder, text_contains
from opslog.functions.xmlvalue import xml_fail_if_malformed, xml_first_text, xml_is_wellformed, xml_root_is, xml_text
from opslog.operators.ordering import sort_balanced

_CORRUPT = "_corrupt_record"
_REPORT_SCHEMA = (
    "DataSets STRUCT<DataSet: ARRAY<STRUCT<_Name: STRING, "
    "Query: ARRAY<STRUCT<DataSourceName: STRING, CommandType: STRING, CommandText: STRING>>>>>, "
    f"{_CORRUPT} STRING"
)
_XML_OPTIONS = {
    "ignoreNamespace": "true",          # *:Name steps match any prefix
    "ignoreSurroundingSpaces": "false",  # keep text exactly as written
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
}

# Fixed value: command type when a query declares none.
DEFAULT_COMMAND_TYPE = "T-SQL"


def _text_node(c):
    """First text node: an element without text, or with blanks only, has none."""
    return F.when(F.trim(c) != "", c)


def report_queries(catalog: DataFrame, strict: bool = False) -> DataFrame:
    """One row per (report, dataset, query) of every report definition.

    Items whose content is not a Report document (folders, data sources) give
    no rows. Malformed or undecodable content gives no rows either, unless
    ``strict``: then it fails the job, as in the source system
    (``invalid_documents`` lists such items).
    """
    content_type = dict((f.name, f.dataType) for f in catalog.schema.fields)["Content"]
    docs = catalog.select("Path", F.col("Name").alias("ReportName"),
                          xml_text(F.col("Content"), content_type).alias("_doc"), F.col("Content").alias("_raw"))
    if strict:
        undecodable = F.col("_raw").isNotNull() & F.col("_doc").isNull()
        docs = docs.filter(F.coalesce(F.when(undecodable, F.raise_error(F.lit("content is not UTF-8"))).cast("boolean"),
                                      F.lit(True)))
        docs = docs.filter(xml_fail_if_malformed(F.col("_doc"), "report definition"))
    docs = docs.filter(xml_root_is(F.col("_doc"), "Report"))
    parsed = docs.select("Path", "ReportName", F.from_xml("_doc", _REPORT_SCHEMA, _XML_OPTIONS).alias("_x"))
    parsed = parsed.filter(F.col(f"_x.{_CORRUPT}").isNull())
    ds = parsed.select("Path", "ReportName", F.explode("_x.DataSets.DataSet").alias("_ds"))
    q = ds.select("Path", "ReportName", F.col("_ds._Name").alias("DataSetName"), F.explode("_ds.Query").alias("_q"))
    return q.select(
        parent_folder("Path").alias("ReportPath"),
        "ReportName",
        "DataSetName",
        _text_node(F.col("_q.DataSourceName")).alias("DataSourceName"),
        F.coalesce(_text_node(F.col("_q.CommandType")), F.lit(DEFAULT_COMMAND_TYPE)).alias("CommandType"),
        _text_node(F.col("_q.CommandText")).alias("CommandText"),
    )


def invalid_documents(catalog: DataFrame, column: str = "Content") -> DataFrame:
    """Items whose document cannot be read: bytes that are not UTF-8, or
    malformed XML. A narrow filter, for routing such rows to a quarantine
    table instead of silently dropping them."""
    dtype = dict((f.name, f.dataType) for f in catalog.schema.fields)[column]
    doc = xml_text(F.col(column), dtype)
    reason = (F.when(F.col(column).isNotNull() & doc.isNull(), F.lit("not UTF-8"))
              .when(~xml_is_wellformed(doc), F.lit("malformed XML")))
    return catalog.select("ItemID", "Path", reason.alias("Reason")).filter(F.col("Reason").isNotNull())


# Fixed value: path of the first setting value in a subscription's settings document.
FIRST_SETTING_PATH = "//ParameterValue/Value"


def subscriptions_matching(catalog: DataFrame, subscriptions: DataFrame, text: str,
                           case_sensitive: bool = True, ordered: bool = True) -> DataFrame:
    """Subscriptions whose first setting value contains ``text``, with their report.

    The value is extracted once per subscription, before the join, through a
    one-row generator: the filter on it then works on the extracted column
    instead of repeating the extraction. The extraction has a stage of its own:
    documents are dealt to all tasks before it, however few files hold them, and
    what passes the filter is exchanged by the join key, so that neither the join
    nor the sampling of the sort reads the documents again.
    """
    spread = int(subscriptions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = subscriptions.select("SubscriptionID", "Report_OID", F.col("ExtensionSettings").alias("ActualXML"))
    s = s.repartition(spread, "SubscriptionID").select(
        "SubscriptionID", "Report_OID", "ActualXML",
        F.explode(F.array(xml_first_text(F.col("ActualXML"), FIRST_SETTING_PATH))).alias("ExtSettingsXML"),
    )
    s = s.filter(text_contains(F.col("ExtSettingsXML"), text, case_sensitive)).repartition("Report_OID")
    c = catalog.select("ItemID", "Path", "Name")
    j = c.join(s, c["ItemID"] == s["Report_OID"], "inner")
    out = j.select(
        "ItemID", F.col("Path").alias("ReportPath"), F.col("Name").alias("ReportName"),
        "SubscriptionID", "ExtSettingsXML", "ActualXML",
    )
    return sort_balanced(out, "ReportPath", "ReportName", ordered=ordered, case_sensitive=case_sensitive)
