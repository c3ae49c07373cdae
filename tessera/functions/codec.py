"""Payload codecs: base64, XML (namespace-stripped) and JSON, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Namespace prefixes removed from opening and closing tags before XML parsing.
NS_PREFIX_PATTERN = r"<(/?)[A-Za-z_][A-Za-z0-9_.-]*:"
# Tag that wraps the base64 body of a reporting flow.
FLOW_BODY_TAG = "xmlRendicontazione"
# ------------------------------------------------------------------------------


def b64_text(col: Column) -> Column:
    """base64 → UTF-8 text (null for null)."""
    return F.decode(F.unbase64(col), "UTF-8")


def text_b64(col: Column) -> Column:
    return F.base64(F.encode(col, "UTF-8"))


def strip_namespaces(xml: Column) -> Column:
    """One pass over the document: ``<ns:tag`` → ``<tag``, ``</ns:tag`` → ``</tag``."""
    return F.regexp_replace(xml, NS_PREFIX_PATTERN, "<$1")


def parse_xml(xml: Column, schema: str) -> Column:
    """Parse an XML document against a declared DDL schema (root tag = row)."""
    return F.from_xml(xml, schema)


def tagged_body(doc: Column, tag: str = FLOW_BODY_TAG) -> Column:
    """Text between ``<tag>`` and ``</tag>`` ('' when the tag is missing)."""
    return F.regexp_extract(doc, f"(?s)<{tag}>(.*?)</{tag}>", 1)
