"""XML helpers over text columns.

Documents arrive as text or UTF-8 bytes. Malformed documents never fail a job:
every path evaluation is guarded by a well-formedness test.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType

_CORRUPT = "_corrupt_record"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def xml_text(content, dtype: DataType | None = None) -> Column:
    """Document text: bytes are decoded as UTF-8 (invalid bytes -> NULL), a
    leading byte-order mark is removed."""
    c = _c(content)
    if isinstance(dtype, BinaryType):
        c = F.when(F.is_valid_utf8(c), F.decode(c, "UTF-8"))
    return F.regexp_replace(c, r"^\uFEFF", "")


# What may stand before the document element: white space, an XML declaration and processing
# instructions, comments, and a document type. Possessive, so that a match never looks inside them.
_PROLOG = (r"^\s*+(?:(?:<\?(?s:.*?)\?>|<!--(?s:.*?)-->|<!DOCTYPE(?:[^\[>\"']|\"[^\"]*\"|'[^']*')*+(?:\[(?s:.*?)\]\s*)?>)\s*+)*+")
_ATTRIBUTES = r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)"


def xml_root_is(doc, local_name: str) -> Column:
    """True when the document element has this local name (any prefix).

    Skips any number of instructions and comments before it. Meant for
    documents that also parse (malformed ones are dropped by the parser);
    safe on malformed text.
    """
    return F.coalesce(_c(doc).rlike(_PROLOG + r"<(?:[\w.-]+:)?" + local_name + r"[\s/>]"), F.lit(False))


def xml_root_namespace(doc, local_name: str) -> Column:
    """Namespace URI of the document element: its default ``xmlns`` when it has
    no prefix, otherwise the URI bound to its prefix on the root tag."""
    d = _c(doc)
    tag = _PROLOG + r"<(?:([\w.-]+):)?" + local_name + r"(?=[\s/>])" + _ATTRIBUTES + r">"
    prefix = F.regexp_extract(d, tag, 1)
    attrs = F.regexp_extract(d, tag, 2)
    # a value is taken where an attribute starts, not inside another attribute's value
    head = r"^(?:\s*+[^\s=]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*?\s+"
    default_ns = F.regexp_extract(attrs, head + r"xmlns\s*=\s*[\"']([^\"']*)[\"']", 1)
    # the pattern depends on the row's prefix, so it is a column
    prefixed_ns = F.call_function(
        "regexp_extract", attrs,
        F.concat(F.lit(head + "xmlns:"), prefix, F.lit(r"\s*=\s*[\"']([^\"']*)[\"']")), F.lit(1),
    )
    return F.when(prefix == "", default_ns).otherwise(prefixed_ns)


def xml_is_wellformed(doc) -> Column:
    """True for a parseable document, False for malformed text, NULL for NULL."""
    parsed = F.from_xml(
        _c(doc),
        f"{_CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    return F.when(_c(doc).isNotNull(), parsed[_CORRUPT].isNull())


def xml_fail_if_malformed(doc, what: str = "document") -> Column:
    """TRUE for a parseable or NULL document; raises for a malformed one.

    Used as a filter in strict mode, where a malformed document fails the
    job as it does in the source system.
    """
    bad = F.coalesce(~xml_is_wellformed(doc), F.lit(False))
    return F.coalesce(F.when(bad, F.raise_error(F.lit(f"malformed XML {what}"))).cast("boolean"), F.lit(True))


def xml_first_text(doc, path: str) -> Column:
    """String value of the first node selected by ``path`` (as ``(path)[1]``).

    NULL when nothing matches or the document is malformed; an empty element
    gives ''. One XPath evaluation answers both "is there a node" and "its
    value": ``concat(count(p), ':', string(p))``.
    """
    first = f"({path})[1]"
    both = F.xpath_string(_c(doc), F.lit(f"concat(count({first}), ':', string({first}))"))
    # through a one-element array, so that the path is evaluated once
    hit = F.transform(F.array(both), lambda b: F.when(F.startswith(b, F.lit("1:")), F.substr(b, F.lit(3))))[0]
    return F.when(xml_is_wellformed(doc), hit)
