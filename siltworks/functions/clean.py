"""Raw responses to clean content with a sniffed type. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts of content types that decide before the body is looked at.
REJECT = ("x-download", "jnlp", "forcedownload", "flash", "silverlight", "x-trash", "x-unknown", "x-upload", "cache-manifest", "force-download", "quicktime")
JSON_TYPES = ("application/json", "text/json", "+json")
XML_TYPES = ("application/xml", "text/xml", "+xml", "_xml")


def _any_of(c: Column, parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def unwrap_cdata(c: Column) -> Column:
    """The inside of a text that is one CDATA section; null if the section does not end."""
    inside = F.regexp_extract(c, r"(?s)^<!\[CDATA\[(.*?)\]\]>$", 1)
    whole = c.rlike(r"(?s)^<!\[CDATA\[.*?\]\]>$")
    return F.when(~c.startswith("<![CDATA["), c).when(whole, inside)


def strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, "^\ufeff", "")


def strip_replacement_marks(c: Column) -> Column:
    """Written-out and real U+FFFD become blanks."""
    return F.regexp_replace(c, r"\\{1,2}ufffd|\x{FFFD}", " ")


def collapse_space(c: Column) -> Column:
    """Written-out newlines and tabs, and runs of white space, become one blank."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\\[nt]", " "), r"\s+", " "))


def well_formed(c: Column) -> Column:
    """Whether a text is well-formed XML, asked of the JVM's own parser."""
    return F.coalesce(F.from_xml(c, "_corrupt_record string")["_corrupt_record"].isNull() & F.ltrim(c).startswith("<"), F.lit(False))


def sniff_type(content: Column, content_type: Column) -> Column:
    """reject, json, xml or '': by header first, then by what parses."""
    head = F.lower(F.coalesce(content_type, F.lit("")))
    return (
        F.when(_any_of(head, REJECT), "reject")
        .when(_any_of(head, JSON_TYPES), "json")
        .when(_any_of(head, XML_TYPES), "xml")
        .when(F.try_parse_json(content).isNotNull(), "json")
        .when(well_formed(content), "xml")
        .otherwise("")
    )


def strip_invalid_start(content: Column, datatype: Column) -> Column:
    """XML is cut to its first tag."""
    return F.when((datatype == "xml") & (F.instr(content, "<") > 0), F.substring(content, F.instr(content, "<"), F.length(content))).otherwise(content)


def clean(raw: DataFrame, raw_content: str = "raw_content", content_type: str = "content_type") -> DataFrame:
    """Adds content and datatype. content_type may be a string or an array of strings."""
    kind = F.concat_ws(" ", F.col(content_type))
    out = raw.withColumn("content", collapse_space(strip_replacement_marks(unwrap_cdata(strip_bom(F.col(raw_content))))))
    out = out.withColumn("datatype", sniff_type(F.col("content"), kind))
    return out.withColumn("content", strip_invalid_start(F.col("content"), F.col("datatype")))
