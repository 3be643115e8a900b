"""WARC derivatives: metadata and plain-text conversion records of response records.

Each response yields one metadata record (title, outgoing links, the source's headers and
digests) and one conversion record (the text of its HTML). Both have identifiers of their
own, made from the response's, name it in WARC-Refers-To, and keep its target and date.

Character references are decoded once, all of HTML5's named and numeric ones, by Python's
tables; everything else is built-in functions.
"""

from __future__ import annotations

import html
import re
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: a reference in text, where a name may run on; the pattern of html.unescape
REFERENCE = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: in an attribute, names without a semicolon end before = and alphanumerics: ?a=1&copy=2
REFERENCE_IN_ATTRIBUTE = (
    r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]{0,31}(?:;|(?![a-zA-Z0-9=])))")
#: a referenced blank is one space: none makes a line of its own
BLANK = dict.fromkeys(map(ord, "\xa0\t\n\r\f"), " ")
#: what is no text
HIDDEN = r"(?is)<(?:script|style)\b[^>]*>.*?</(?:script|style)\s*>|<!--.*?-->|<!doctype[^>]*>"
#: scripts, styles and comments that are not closed run to the end
UNCLOSED = r"(?is)<(?:script|style)\b[^>]*>.*|<!--.*"
BREAKS = (r"(?i)</?(?:p|br|div|h[1-6]|li|ul|ol|tr|table|article|section|nav|header|footer|title"
          r"|head|body|html|blockquote|pre)\b[^>]*>")
TAG = r"<[^>]*>"
#: attributes before href are passed over whole; the value has its quotes
LINK = (r"""(?i)<a(?=[\s/])(?:[\s/]*+(?!href\s*=)[^\s/=>]++"""
        r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+)*+"""
        r"""[\s/]*+href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)""")
TITLE = r"(?is)<title[^>]*>(.*?)</title"
CRLF = "\r\n"


def unescaped(text: str, attribute: bool = False) -> str:
    """Text with its character references decoded once; a no-break space becomes a space."""
    def decoded(found: re.Match) -> str:
        reference = found.group()
        if reference[1] == "#":
            # int() refuses very long numbers, which are beyond Unicode
            digits = reference[2:].rstrip(";").lstrip("0")
            reference = f"&#{digits or 0};" if len(digits) < 10 else "\ufffd"
        elif attribute and reference[1:] not in html5:
            return reference
        out = html.unescape(reference)
        return out[:1].translate(BLANK) + out[1:]

    if "&" not in text:
        return text
    return re.sub(REFERENCE_IN_ATTRIBUTE if attribute else REFERENCE, decoded, text)


def _unescaped(text: Column) -> Column:
    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else unescaped(x) for x in column.to_pylist()],
                        pa.string())

    return run(text)


def _link_targets(values: Column) -> Column:
    @F.arrow_udf("array<string>")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if links is None else [
            unescaped(x[1:-1] if x[0] in "\"'" else x, attribute=True) for x in links]
            for links in column.to_pylist()], pa.list_(pa.string()))

    return run(values)


def _tidy(text: Column) -> Column:
    """Runs of blanks to one; lines trimmed, empty ones dropped."""
    text = F.regexp_replace(text, r"[ \t\r\f]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(text, r"^[ \n]+|[ \n]+$", "")


def plain_text(html: Column) -> Column:
    """Readable text of HTML: a line for each block, without scripts, styles and comments."""
    text = F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), UNCLOSED, " ")
    text = F.regexp_replace(text, r"\n", " ")
    text = F.regexp_replace(text, BREAKS, "\n")
    return _tidy(_unescaped(F.regexp_replace(text, TAG, "")))


def record_id(*parts: Column | str) -> Column:
    """A urn:uuid of the MD5 of the parts, the same on every run."""
    digest = F.md5(F.concat_ws("|", *parts))
    cuts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def sha256(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame) -> DataFrame:
    """Response records of pages (page_id, url, html): record_id, target_uri, warc_date,
    http_header, payload. Dates are a second apart in the order of page_id."""
    html = F.coalesce("html", F.lit(""))
    header = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF
              + "Content-Length: "), F.octet_length(html).cast("string"), F.lit(CRLF + CRLF))
    begin = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    date = F.date_format(
        begin + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.coalesce("page_id", F.lit(0))),
        "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return pages.select(
        "page_id",
        record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                  F.coalesce("url", F.lit(""))).alias("record_id"),
        F.coalesce("url", F.lit("")).alias("target_uri"), date.alias("warc_date"),
        header.alias("http_header"), html.alias("payload"))


def derivatives(source: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records, two rows per response.

    Columns: record_id, record_type, refers_to, target_uri, warc_date, content_type,
    content_length (octets of the block), block_digest, source_payload_digest (of the
    response's payload), source_block_digest, warc_header (the record's header lines) and
    block. All null texts count as empty; a page without title or links has empty fields;
    one without text an empty block. Repeated responses give repeated records. Other
    columns of `source` are passed over.
    """
    empty = F.lit("")
    payload, header = F.coalesce("payload", empty), F.coalesce("http_header", empty)
    base = source.select(
        F.coalesce("record_id", empty).alias("source_id"),
        F.coalesce("target_uri", empty).alias("target_uri"),
        F.coalesce("warc_date", empty).alias("warc_date"),
        payload.alias("payload"), header.alias("http_header"),
        sha256(payload).alias("source_payload_digest"),
        sha256(F.concat(header, payload)).alias("source_block_digest"))
    raw_title = F.regexp_replace(F.regexp_extract("payload", TITLE, 1), r"\n", " ")
    links = F.regexp_extract_all("payload", F.lit(LINK), F.lit(1))
    read = base.select(
        "*", _tidy(_unescaped(raw_title)).alias("title"), _link_targets(links).alias("links"),
        plain_text(F.col("payload")).alias("plain"))
    fields = F.concat(
        F.lit("title: "), F.col("title"), F.lit(CRLF),
        F.array_join(F.transform("links", lambda x: F.concat(
            F.lit("outlink: "), x, F.lit(CRLF))), ""),
        F.lit("source-payload-digest: "), F.col("source_payload_digest"), F.lit(CRLF),
        F.lit("source-block-digest: "), F.col("source_block_digest"), F.lit(CRLF),
        # header lines of the source, each as a field
        F.array_join(F.transform(
            F.filter(F.split(F.col("http_header"), "\r?\n"), lambda x: x != ""),
            lambda x: F.concat(F.lit("source-header: "), x, F.lit(CRLF))), ""))
    made = read.select("*", F.explode(F.array(
        F.struct(F.lit("metadata").alias("record_type"),
                 F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("record_type"),
                 F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("plain").alias("block")))).alias("made"))
    named = made.select(
        record_id(F.col("made.record_type"), "source_id").alias("record_id"), "made.record_type",
        F.col("source_id").alias("refers_to"), "target_uri", "warc_date", "made.content_type",
        F.octet_length("made.block").cast("bigint").alias("content_length"),
        sha256(F.col("made.block")).alias("block_digest"), "source_payload_digest",
        "source_block_digest", "made.block")
    lines = [("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"),
             ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
             ("WARC-Date", "warc_date"), ("WARC-Block-Digest", "block_digest"),
             ("Content-Type", "content_type"), ("Content-Length", "content_length")]
    rendered = F.concat(F.lit("WARC/1.1" + CRLF), *[
        x for name, column in lines
        for x in (F.lit(f"{name}: "), F.col(column).cast("string"), F.lit(CRLF))], F.lit(CRLF))
    return named.withColumn("warc_header", rendered)
