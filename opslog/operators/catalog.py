"""Content-catalog operators: item listings, permission expansion, shared data sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.functions.text import text_equals, text_startswith
from opslog.functions.xmlvalue import xml_fail_if_malformed, xml_root_is, xml_root_namespace, xml_text
from opslog.operators.joins import preserving_left_join, salted_join
from opslog.operators.ordering import sort_balanced

# Catalog item type codes, credential retrieval codes, and the
# label shown for the item with an empty name (the root folder).
ITEM_TYPES = {1: "Folder", 2: "Report", 5: "Data Source"}
CREDENTIAL_TYPES = {1: "User Supplied", 2: "Stored", 3: "Windows Integrated", 4: "Not Required"}
ROOT_FOLDER_LABEL = "Root Folder"

_CORRUPT = "_corrupt_record"


def _case(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default) if default is not None else expr


def reports_with_sources(catalog: DataFrame, data_source: DataFrame, users: DataFrame, ordered: bool = True) -> DataFrame:
    """Every report (Type 2) with its data source(s) and creator, by name."""
    c = catalog.filter(F.col("Type") == 2)
    ds = data_source.select(F.col("ItemID").alias("_ds_item"), F.col("Name").alias("DataSourceName"))
    u = users.select(F.col("UserID").alias("_uid"), F.col("UserName").alias("CreatedByUser"))
    j = c.join(ds, c["ItemID"] == ds["_ds_item"], "left").join(u, c["CreatedByID"] == u["_uid"], "left")
    out = j.select(
        F.col("Name").alias("ReportName"), F.col("Path").alias("ReportManagerPath"),
        "DataSourceName", "CreatedByUser", "CreationDate", "ModifiedDate",
    )
    return sort_balanced(out, "ReportName", ordered=ordered)


def catalog_types(catalog: DataFrame, ordered: bool = True) -> DataFrame:
    """Every catalog item with its type decoded, by name."""
    out = catalog.select("Name", "Type", _case(F.col("Type"), ITEM_TYPES, "Other").alias("TypeDescription"))
    return sort_balanced(out, "Name", ordered=ordered)


def _permissions(catalog: DataFrame, policies: DataFrame, policy_user_role: DataFrame,
                 users: DataFrame, roles: DataFrame) -> DataFrame:
    """catalog -> policy -> (policy, user, role) bridge -> user, role.

    The bridge is resolved against its dimensions first (a result the size of
    the bridge), then joined to the catalog on the policy: the one join that
    multiplies rows comes last, and a policy with very many items is salted
    there (``salted_join``). Only the sort the callers ask for shuffles the
    expanded result; ``ordered=False`` leaves it out.
    """
    p = policies.select(F.col("PolicyID").alias("_pid"))
    pur = policy_user_role.select(
        F.col("PolicyID").alias("_pur_pid"), F.col("UserID").alias("_pur_uid"), F.col("RoleID").alias("_pur_rid")
    )
    u = users.select(F.col("UserID").alias("_uid"), "UserName", "AuthType")
    r = roles.select(F.col("RoleID").alias("_rid"), "RoleName", "Description")
    grants = (
        pur.join(u, F.col("_pur_uid") == F.col("_uid"), "inner")
        .join(r, F.col("_pur_rid") == F.col("_rid"), "inner")
        .join(p, F.col("_pur_pid") == F.col("_pid"), "inner")
        .select("_pid", "UserName", "AuthType", "RoleName", "Description")
    )
    c = catalog.select("Name", "Path", "PolicyID")
    j = salted_join(c, grants, "PolicyID", "_pid")
    return j.select(
        F.when(F.col("Name") == "", ROOT_FOLDER_LABEL).otherwise(F.col("Name")).alias("ObjectName"),
        F.col("Path").alias("ObjectPath"), "UserName", "RoleName", "Description", "AuthType",
        F.col("Name").alias("_name"),
    )


def user_permissions(users: DataFrame, policy_user_role: DataFrame, policies: DataFrame,
                     roles: DataFrame, catalog: DataFrame, user_name: str | None,
                     case_sensitive: bool = True, ordered: bool = True) -> DataFrame:
    """Every permission (item, path, role) given to one principal; all principals when None."""
    if user_name is not None:
        users = users.filter(text_equals("UserName", user_name, case_sensitive))
    out = _permissions(catalog, policies, policy_user_role, users, roles)
    return sort_balanced(out, "_name", "UserName", "RoleName", ordered=ordered, case_sensitive=case_sensitive).drop("_name")


def path_permissions(catalog: DataFrame, policies: DataFrame, policy_user_role: DataFrame,
                     users: DataFrame, roles: DataFrame, path_prefix: str | None,
                     case_sensitive: bool = True, ordered: bool = True) -> DataFrame:
    """Item permissions under a path prefix (a LIKE 'prefix%' test)."""
    if path_prefix is not None:
        catalog = catalog.filter(text_startswith("Path", path_prefix, case_sensitive))
    out = _permissions(catalog, policies, policy_user_role, users, roles)
    return sort_balanced(out, "_name", "ObjectPath", "UserName", "RoleName", ordered=ordered,
                         case_sensitive=case_sensitive).drop("_name")


def _shared_sources(catalog: DataFrame, users: DataFrame, data_source: DataFrame, namespace: str,
                    strict: bool = False) -> DataFrame:
    """Shared data sources (Type 5) with creator, modifier, extension, credential
    type and the fields of their definition document."""
    sds = catalog.filter(F.col("Type") == 5).select(
        F.col("ItemID").alias("_sds_item"), F.col("Name").alias("SharedDataSourceName"),
        F.col("Path").alias("DataSourcePath"), "Content", "CreatedByID", "ModifiedByID",
        "CreationDate", "ModifiedDate",
    )
    u = users.select(F.col("UserID").alias("_cu"), F.col("UserName").alias("CreatedBy"))
    um = users.select(F.col("UserID").alias("_mu"), F.col("UserName").alias("ModifiedBy"))
    ds = data_source.select(
        F.col("ItemID").alias("_ds_item"), "Extension",
        _case(F.col("CredentialRetrieval"), CREDENTIAL_TYPES).alias("CredentialType"),
    )
    j = (
        sds.join(u, F.col("CreatedByID") == F.col("_cu"), "inner")
        .join(um, F.col("ModifiedByID") == F.col("_mu"), "inner")
        .join(ds, F.col("_sds_item") == F.col("_ds_item"), "inner")
    )
    content_type = dict((f.name, f.dataType) for f in catalog.schema.fields)["Content"]
    doc = xml_text(F.col("Content"), content_type)
    parsed = F.from_xml(
        doc,
        f"ConnectString STRING, Enabled STRING, {_CORRUPT} STRING",
        {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false",
         "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    j = j.withColumn("DataSourceXML", doc).withColumn("_def", parsed)
    if strict:  # a malformed definition fails the job, as in the source system
        j = j.filter(xml_fail_if_malformed(F.col("DataSourceXML"), "data source definition"))
    # nodes('/DataSourceDefinition') under a default namespace: the document
    # element must have that local name in that namespace; malformed -> no row.
    ok = (
        xml_root_is(F.col("DataSourceXML"), "DataSourceDefinition")
        & (xml_root_namespace(F.col("DataSourceXML"), "DataSourceDefinition") == namespace)
        & F.col(f"_def.{_CORRUPT}").isNull()
    )
    return j.filter(ok).select(
        "_sds_item", "DataSourcePath", "SharedDataSourceName",
        F.col("_def.ConnectString").alias("ConnectionString"),
        F.col("_def.Enabled").alias("DataSourceEnabled"),
        "Extension", "CredentialType", "CreationDate", "CreatedBy", "ModifiedDate", "ModifiedBy",
        "DataSourceXML",
    )


def _dependents(catalog: DataFrame, users: DataFrame, sec_data: DataFrame, data_source: DataFrame) -> DataFrame:
    """Catalog items with a data-source link, one row per (item, matching sec row).

    The item -> data-source join (one row per item) comes first, so the user
    joins and the SecData join only see items that have a data source. The
    inner joins commute with the SecData left join (its condition does not
    involve them), so the rows are those of the source query.
    """
    c = catalog.select("ItemID", "Name", "CreatedByID", "ModifiedByID", "PolicyID")
    ds = data_source.select(F.col("ItemID").alias("_ds_item"), F.col("Link").alias("DSLink"))
    cu = users.select(F.col("UserID").alias("_cu"))
    mu = users.select(F.col("UserID").alias("_mu"))
    sd = sec_data.filter(F.col("AuthType") == 1).select(F.col("PolicyID").alias("_sd_pid"))
    return (
        c.join(ds, F.col("ItemID") == F.col("_ds_item"), "inner")
        .join(cu, F.col("CreatedByID") == F.col("_cu"), "inner")
        .join(mu, F.col("ModifiedByID") == F.col("_mu"), "inner")
        .join(sd, F.col("PolicyID") == F.col("_sd_pid"), "left")
        .select("DSLink", F.col("Name").alias("ObjectName"))
    )


def shared_data_sources(catalog: DataFrame, users: DataFrame, data_source: DataFrame, sec_data: DataFrame,
                        namespace: str, strict: bool = False, ordered: bool = True) -> DataFrame:
    """Shared data sources with the number of dependent items and connection fields.

    Dependents are counted per link first (partial+final aggregate), so the
    join to the data sources sees one row per link.
    """
    counts = _dependents(catalog, users, sec_data, data_source).groupBy("DSLink").agg(
        F.count(F.lit(1)).alias("_deps")
    )
    s = _shared_sources(catalog, users, data_source, namespace, strict)
    j = s.join(counts, s["_sds_item"] == counts["DSLink"], "left")
    out = j.select(
        "DataSourcePath", "SharedDataSourceName",
        F.coalesce(F.col("_deps"), F.lit(0)).alias("Dependents"),
        "ConnectionString", "DataSourceEnabled", "Extension", "CredentialType",
        "CreationDate", "CreatedBy", "ModifiedDate", "ModifiedBy", "DataSourceXML",
    )
    return sort_balanced(out, "DataSourcePath", "SharedDataSourceName", ordered=ordered)


def data_source_dependents(catalog: DataFrame, users: DataFrame, data_source: DataFrame, sec_data: DataFrame,
                           path: str | None, namespace: str, strict: bool = False,
                           case_sensitive: bool = True, ordered: bool = True) -> DataFrame:
    """Shared data sources with the name of every dependent item (one row per
    dependent; a source without dependents keeps one row with NULLs). ``path``
    keeps one data source; None keeps all.

    One data source may be used by a large share of all items, so the
    dependents side is never the unsplittable side of an outer join
    (see ``preserving_left_join``); the definitions are parsed once, after the
    path filter.
    """
    sources = catalog
    if path is not None:  # only the data sources are cut; any item may depend on them
        sources = catalog.filter(text_equals("Path", path, case_sensitive))
    s = _shared_sources(sources, users, data_source, namespace, strict)
    deps = _dependents(catalog, users, sec_data, data_source)
    ids = sources.filter(F.col("Type") == 5).select("ItemID")
    j = preserving_left_join(s, deps, "_sds_item", "DSLink", ids)
    out = j.select(
        "DataSourcePath", "SharedDataSourceName", "DSLink", "ObjectName",
        "ConnectionString", "DataSourceEnabled", "Extension", "CredentialType",
        "CreationDate", "CreatedBy", "ModifiedDate", "ModifiedBy", "DataSourceXML",
    )
    return sort_balanced(out, "DataSourcePath", "SharedDataSourceName", ordered=ordered,
                         case_sensitive=case_sensitive)


def configuration(config: DataFrame) -> DataFrame:
    """The whole configuration table."""
    return config.select("*")
