"""E-mail files: headers, body text and attachments, one row per file, failures kept as rows."""

from __future__ import annotations

import email
import email.policy
import hashlib
from collections.abc import Iterator
from email.message import EmailMessage
from email.utils import parseaddr, parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalmill.functions.text import clean_lines, strip_html

_ATTACHMENT = "array<struct<filename:string,content_type:string,size_bytes:bigint,sha256:string,text:string>>"
_MAIL = f"struct<message_id:string,from_address:string,subject:string,sent_at:timestamp,body_text:string,body_html:string,attachments:{_ATTACHMENT},error:string>"


def _pdf_text(data: bytes) -> str | None:
    """Text of a PDF where a reader is installed, else null."""
    try:
        import io

        import pdfplumber
    except ImportError:
        return None
    with pdfplumber.open(io.BytesIO(data)) as pdf:
        return "\n".join(page.extract_text() or "" for page in pdf.pages)


def _text(part: EmailMessage) -> str:
    try:
        return part.get_content()
    except (LookupError, KeyError):
        return (part.get_payload(decode=True) or b"").decode("utf-8", "replace")


def parse_mail(data: bytes) -> tuple:
    """One message as the fields of a row; what fails is told in the last one."""
    try:
        msg = email.message_from_bytes(data, policy=email.policy.default)
        sent = None
        if msg["Date"]:
            try:
                sent = pd.Timestamp(parsedate_to_datetime(str(msg["Date"])))
                sent = sent.tz_convert("UTC").tz_localize(None) if sent.tzinfo else sent
            except (TypeError, ValueError):
                sent = None
        plain, html, files = [], [], []
        for part in msg.walk():
            if part.is_multipart():
                continue
            name = part.get_filename()
            if name or part.get_content_disposition() == "attachment":
                raw = part.get_payload(decode=True) or b""
                kind = part.get_content_type()
                text = _pdf_text(raw) if kind == "application/pdf" else _text(part) if kind.startswith("text/") else None
                files.append((name, kind, len(raw), hashlib.sha256(raw).hexdigest(), text))
            elif part.get_content_type() == "text/plain":
                plain.append(_text(part))
            elif part.get_content_type() == "text/html":
                html.append(_text(part))
        return str(msg["Message-ID"] or "") or None, parseaddr(str(msg["From"] or ""))[1] or None, str(msg["Subject"] or "") or None, sent, "\n".join(plain) or None, "\n".join(html) or None, files, None
    except Exception as e:  # noqa: BLE001  one bad file is a row, not a failed job
        return None, None, None, None, None, None, [], f"{type(e).__name__}: {e}"


def _parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = ["message_id", "from_address", "subject", "sent_at", "body_text", "body_html", "attachments", "error"]
    files = ["filename", "content_type", "size_bytes", "sha256", "text"]
    for contents in batches:
        rows = [parse_mail(bytes(c)) for c in contents]
        out = pd.DataFrame([(*r[:6], [dict(zip(files, f, strict=True)) for f in r[6]], r[7]) for r in rows], columns=names)
        out["sent_at"] = pd.to_datetime(out["sent_at"])
        yield out


def read_mail(spark: SparkSession, folder: str) -> DataFrame:
    """A row per .eml file of ``folder``: path, the message's fields and ``body``, its text or that of its HTML."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").load(folder)
    m = files.select("path", F.pandas_udf(_parse, _MAIL)("content").alias("m")).select("path", "m.*")
    return m.withColumn("body", F.coalesce(F.nullif(clean_lines(F.col("body_text")), F.lit("")), strip_html(F.col("body_html"))))
