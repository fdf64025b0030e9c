"""XML shredding fidelity."""

from opslog.functions import xml_first_text, xml_root_is, xml_root_namespace
from opslog.operators import data_source_dependents, report_queries, shared_data_sources, subscriptions_matching
from tests.conftest import rows

CAT = "ItemID long, Name string, Path string, Type int, Content string, PolicyID long, CreatedByID long, ModifiedByID long, CreationDate timestamp_ntz, ModifiedDate timestamp_ntz"


def catalog(spark, docs):
    data = [(i, f"r{i}", f"/F/r{i}", 2, d, 0, 1, 1, None, None) for i, d in enumerate(docs)]
    return spark.createDataFrame(data, CAT)


def shred(spark, docs):
    return sorted(rows(report_queries(catalog(spark, docs))), key=lambda r: (r["ReportName"], r["DataSetName"] or ""))


def test_default_namespace_two_datasets(spark):
    doc = ('<Report xmlns="urn:r"><DataSets><DataSet Name="A"><Query><DataSourceName>s1</DataSourceName>'
           '<CommandText>select 1</CommandText></Query></DataSet><DataSet Name="B"><Query><DataSourceName>s2'
           '</DataSourceName><CommandType>StoredProcedure</CommandType><CommandText>p</CommandText></Query>'
           '</DataSet></DataSets></Report>')
    out = shred(spark, [doc])
    assert [(r["DataSetName"], r["DataSourceName"], r["CommandType"], r["CommandText"]) for r in out] == [
        ("A", "s1", "T-SQL", "select 1"), ("B", "s2", "StoredProcedure", "p")]
    assert out[0]["ReportPath"] == "/F/"


def test_prefixed_bom_and_declaration(spark):
    doc = ('﻿<?xml version="1.0"?><!-- c --><r:Report xmlns:r="urn:r"><r:DataSets><r:DataSet Name="A">'
           '<r:Query><r:DataSourceName>s</r:DataSourceName><r:CommandText>q</r:CommandText></r:Query>'
           '</r:DataSet></r:DataSets></r:Report>')
    out = shred(spark, [doc])
    assert [(r["DataSetName"], r["DataSourceName"], r["CommandText"]) for r in out] == [("A", "s", "q")]


def test_no_dataset_wrong_root_malformed_null(spark):
    docs = ["<Report><DataSets/></Report>",
            "<Other><DataSets><DataSet Name='A'><Query><CommandText>x</CommandText></Query></DataSet></DataSets></Other>",
            "<Report><DataSets><DataSet Name='A'><Query>",
            None]
    assert shred(spark, docs) == []


def test_missing_empty_blank_command(spark):
    doc = ("<Report><DataSets><DataSet Name='A'><Query><CommandText/></Query></DataSet>"
           "<DataSet Name='B'><Query><CommandText>   </CommandText></Query></DataSet>"
           "<DataSet Name='C'><Query><DataSourceName>d</DataSourceName></Query></DataSet>"
           "<DataSet Name='D'><Query><CommandText>  keep  </CommandText></Query></DataSet></DataSets></Report>")
    out = {r["DataSetName"]: r for r in shred(spark, [doc])}
    assert out["A"]["CommandText"] is None
    assert out["B"]["CommandText"] is None
    assert out["C"]["CommandText"] is None and out["C"]["DataSourceName"] == "d"
    assert out["D"]["CommandText"] == "  keep  "


def test_root_helpers(spark):
    df = spark.createDataFrame([('<a:X xmlns:a="urn:a"/>',), ('<X xmlns="urn:d"><Y/></X>',), ("<Y/>",), ("<X",), (None,)], "d string")
    out = df.select(xml_root_is("d", "X").alias("r"), xml_root_namespace("d", "X").alias("n")).collect()
    assert [r["r"] for r in out] == [True, True, False, False, False]
    assert [r["n"] for r in out][:2] == ["urn:a", "urn:d"]


def test_first_text_missing_empty_malformed(spark):
    docs = [("<P><ParameterValue><Value>a</Value></ParameterValue><ParameterValue><Value>b</Value></ParameterValue></P>",),
            ("<P><ParameterValue><Name>x</Name></ParameterValue><ParameterValue><Value>b</Value></ParameterValue></P>",),
            ("<P><ParameterValue><Value/></ParameterValue></P>",),
            ("<P><Value>z</Value></P>",),
            ("<P><ParameterValue>",),
            (None,)]
    out = [r[0] for r in spark.createDataFrame(docs, "d string").select(xml_first_text("d", "//ParameterValue/Value")).collect()]
    assert out == ["a", "b", "", None, None, None]


def test_subscriptions_matching(spark):
    cat = catalog(spark, [None, None])
    subs = spark.createDataFrame([
        (10, 0, "<P><ParameterValue><Value>alice@x</Value></ParameterValue></P>"),
        (11, 1, "<P><ParameterValue><Value>bob@x</Value></ParameterValue></P>"),
        (12, 1, "<broken"),
    ], "SubscriptionID long, Report_OID long, ExtensionSettings string")
    out = rows(subscriptions_matching(cat, subs, "alice"))
    assert [(r["SubscriptionID"], r["ExtSettingsXML"]) for r in out] == [(10, "alice@x")]
    assert rows(subscriptions_matching(cat, subs, "ALICE", case_sensitive=False))[0]["SubscriptionID"] == 10


def _ds_tables(spark, doc_ns):
    cat = spark.createDataFrame([
        (1, "ds1", "/Data Sources/ds1", 5, f'<DataSourceDefinition xmlns="{doc_ns}"><ConnectString>cs</ConnectString><Enabled>true</Enabled></DataSourceDefinition>', 7, 1, 2, None, None),
        (2, "rep", "/R/rep", 2, None, 7, 1, 2, None, None),
        (3, "rep2", "/R/rep2", 2, None, 8, 1, 2, None, None),
        (4, "ds2", "/Data Sources/ds2", 5, '<DataSourceDefinition xmlns="urn:other"/>', 7, 1, 2, None, None),
    ], CAT)
    users = spark.createDataFrame([(1, "u1", 1), (2, "u2", 1)], "UserID long, UserName string, AuthType int")
    ds = spark.createDataFrame([(1, "ds1", None, "SQL", 2), (2, "dsr", 1, "SQL", 1), (3, "dsr2", 1, "SQL", 1),
                                (4, "ds2", None, "SQL", 9)],
                               "ItemID long, Name string, Link long, Extension string, CredentialRetrieval int")
    sec = spark.createDataFrame([(7, 1), (7, 1), (8, 2)], "PolicyID long, AuthType int")
    return cat, users, ds, sec


def test_shared_data_sources_counts_multiplied_rows(spark):
    cat, users, ds, sec = _ds_tables(spark, "urn:ds")
    out = rows(shared_data_sources(cat, users, ds, sec, namespace="urn:ds"))
    assert len(out) == 1
    r = out[0]
    # rep has two matching SecData rows (counted twice), rep2 none (left join keeps one)
    assert (r["SharedDataSourceName"], r["Dependents"], r["ConnectionString"], r["DataSourceEnabled"],
            r["CredentialType"], r["CreatedBy"], r["ModifiedBy"]) == ("ds1", 3, "cs", "true", "Stored", "u1", "u2")
    assert rows(shared_data_sources(cat, users, ds, sec, namespace="urn:else")) == []


def test_data_source_dependents_keeps_unused_source(spark):
    cat, users, ds, sec = _ds_tables(spark, "urn:ds")
    cat = cat.union(spark.createDataFrame([(5, "ds3", "/Data Sources/ds3", 5, '<DataSourceDefinition xmlns="urn:ds"/>', 7, 1, 2, None, None)], CAT))
    ds = ds.union(spark.createDataFrame([(5, "ds3", None, "SQL", 4)], ds.schema))
    out = sorted((r["SharedDataSourceName"], r["ObjectName"] or "") for r in rows(data_source_dependents(cat, users, ds, sec, None, "urn:ds")))
    assert out == [("ds1", "rep"), ("ds1", "rep"), ("ds1", "rep2"), ("ds3", "")]
    only = rows(data_source_dependents(cat, users, ds, sec, path="/Data Sources/ds3", namespace="urn:ds"))
    assert [(r["SharedDataSourceName"], r["DSLink"]) for r in only] == [("ds3", None)]


def test_binary_content_utf8_bom_and_invalid_bytes(spark):
    doc = "<Report><DataSets><DataSet Name='Ä'><Query><CommandText>sélect</CommandText></Query></DataSet></DataSets></Report>"
    data = [(1, "a", "/a", 2, doc.encode("utf-8")),
            (2, "b", "/b", 2, b"\xef\xbb\xbf" + doc.encode("utf-8")),
            (3, "c", "/c", 2, b"\xff\xfe<Report>"),
            (4, "d", "/d", 2, None)]
    cat = spark.createDataFrame(data, "ItemID long, Name string, Path string, Type int, Content binary")
    out = sorted((r["ReportName"], r["DataSetName"], r["CommandText"]) for r in rows(report_queries(cat)))
    assert out == [("a", "Ä", "sélect"), ("b", "Ä", "sélect")]


def test_strict_mode_fails_on_malformed_and_quarantine_lists_it(spark):
    import pytest

    from opslog.operators import invalid_documents

    good = "<Report><DataSets><DataSet Name='A'><Query><CommandText>q</CommandText></Query></DataSet></DataSets></Report>"
    cat = catalog(spark, [good, "<Report><DataSets>", None, "<Folder/>"])
    assert len(shred(spark, [good, "<Report><DataSets>", None, "<Folder/>"])) == 1
    with pytest.raises(Exception, match="malformed XML"):
        report_queries(cat, strict=True).collect()
    assert len(rows(report_queries(catalog(spark, [good, None, "<Folder/>"]), strict=True))) == 1
    bad = rows(invalid_documents(cat))
    assert [(r["ItemID"], r["Reason"]) for r in bad] == [(1, "malformed XML")]
    bin_cat = spark.createDataFrame([(7, "/x", b"\xff\xfe"), (8, "/y", good.encode())], "ItemID long, Path string, Content binary")
    assert [(r["ItemID"], r["Reason"]) for r in rows(invalid_documents(bin_cat))] == [(7, "not UTF-8")]


def test_subscriptions_prefilter_keeps_encoded_and_split_values(spark):
    cat = catalog(spark, [None])
    subs = spark.createDataFrame([
        (1, 0, "<P><ParameterValue><Value>&#97;lice@x</Value></ParameterValue></P>"),
        (2, 0, "<P><ParameterValue><Value>al<![CDATA[ice]]>@x</Value></ParameterValue></P>"),
        (3, 0, "<P><ParameterValue><Value>al<!-- c -->ice@x</Value></ParameterValue></P>"),
        (4, 0, "<P><ParameterValue><Value>bob@x</Value></ParameterValue><X>alice</X></P>"),
        (5, 0, "<P><ParameterValue><Value>bob@x</Value></ParameterValue></P>"),
    ], "SubscriptionID long, Report_OID long, ExtensionSettings string")
    out = sorted((r["SubscriptionID"], r["ExtSettingsXML"]) for r in rows(subscriptions_matching(cat, subs, "alice")))
    assert out == [(1, "alice@x"), (2, "alice@x"), (3, "alice@x")]


def test_value_split_by_elements_and_instructions_is_found(spark):
    cat = catalog(spark, [None])
    subs = spark.createDataFrame([
        (1, 0, "<P><ParameterValue><Value>justina@x</Value></ParameterValue></P>"),
        (2, 0, "<P><ParameterValue><Value>jus<b>tin</b>a@x</Value></ParameterValue></P>"),
        (3, 0, "<P><ParameterValue><Value>jus<?p?>tina@x</Value></ParameterValue></P>"),
    ], "SubscriptionID long, Report_OID long, ExtensionSettings string")
    assert sorted(r["SubscriptionID"] for r in rows(subscriptions_matching(cat, subs, "justina"))) == [1, 2, 3]


def test_any_prolog_before_the_root(spark):
    body = "<Report><DataSets><DataSet Name='A'><Query><CommandText>q</CommandText></Query></DataSet></DataSets></Report>"
    heads = ['<?xml version="1.0"?><?xml-stylesheet href="a>b"?>', "<!-- <Other> --><?a?><!-- b -->", "\n<?xml-stylesheet a?>\n<!--x-->\n",
             "<!DOCTYPE Report>"]
    assert len(shred(spark, [h + body for h in heads])) == len(heads)
    assert shred(spark, ["<!-- " + body + " --><Other/>", "<?x <Report ?><Other/>"]) == []


def test_namespace_of_the_root_tag_only(spark):
    docs = ['<!-- <X xmlns="urn:no"/> --><X a="1 > 0" xmlns="urn:yes"/>', '<X note=" xmlns=\'urn:no\'" xmlns="urn:yes"/>',
            '<p:X xmlns="urn:no" xmlns:p="urn:yes"/>', "<X b='>' xmlns='urn:yes'><Y xmlns='urn:no'/></X>"]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    assert [r[0] for r in df.select(xml_root_namespace("d", "X")).collect()] == ["urn:yes"] * 4
