"""Decoders that the built-in functions cannot express, as Arrow UDFs over batches."""

from __future__ import annotations

import html
import io
import json
import re
import unicodedata
import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Characters that RTF control words stand for, and groups that hold no text.
RTF_WORDS = {"par": "\n", "line": "\n", "row": "\n", "page": "\n", "sect": "\n", "tab": "\t", "cell": "\t", "emdash": "—", "endash": "–", "bullet": "•", "lquote": "‘", "rquote": "’", "ldblquote": "“", "rdblquote": "”", "enspace": " ", "emspace": " ", "qmspace": " "}
RTF_SILENT = {
    "fonttbl", "colortbl", "stylesheet", "info", "pict", "object", "header", "headerf",
    "headerl", "headerr", "footer", "footerf", "footerl", "footerr", "footnote", "annotation",
    "fldinst", "xmlnstbl", "listtable", "listoverridetable", "themedata", "datastore",
    "latentstyles", "generator", "revtbl", "rsidtbl", "protusertbl", "shp", "shpinst",
}
_RTF = re.compile(rb"\\([a-z]+)(-?\d+)? ?|\\'([0-9a-fA-F]{2})|\\([^a-z])|([{}])|[\r\n]+|([^\\{}\r\n]+)", re.S)


def bytes_to_text(data: bytes, declared: str | None = None) -> str:
    """The first charset that decodes: the declared one, that of a byte-order mark, UTF-8, Windows-1251, Latin-1. The text itself names none."""
    mark = "utf-8-sig" if data[:3] == b"\xef\xbb\xbf" else "utf-16" if data[:2] in (b"\xff\xfe", b"\xfe\xff") else None
    for name in (declared, mark, "utf-8", "cp1251"):
        try:
            if name:
                return data.decode(name)
        except (UnicodeDecodeError, LookupError):
            pass
    return data.decode("latin-1")


def rtf_to_text(data: bytes) -> str:
    """Text of an RTF document: code page bytes, ``\\u`` characters with their fallbacks skipped, silent groups left out."""
    page, out, stack = "cp1251", [], []
    silent, fallback, skip = False, 1, 0
    held = bytearray()

    def flush() -> None:
        if held:
            out.append(held.decode(page, "replace"))
            held.clear()

    start = False  # right after an opening brace
    for m in _RTF.finditer(data):
        word, number, hexed, sign, brace, plain = m.groups()
        if brace == b"{":
            flush()
            stack.append((silent, fallback))
            start = True
            continue
        if brace == b"}":
            flush()
            if stack:
                silent, fallback = stack.pop()
            skip = 0
        elif sign == b"*" and start:
            silent = True
        elif word:
            name = word.decode("ascii")
            value = int(number) if number else None
            if start and name in RTF_SILENT:
                silent = True
            if name == "ansicpg" and value:
                try:
                    b"".decode(f"cp{value}")
                    page = f"cp{value}"
                except LookupError:
                    pass
            elif name == "uc":
                fallback = value or 0
            elif name == "u" and value is not None:
                flush()
                if not silent:
                    out.append(chr(value % 65536))
                skip = fallback
            elif name in RTF_WORDS and not silent:
                flush()
                out.append(RTF_WORDS[name])
        elif hexed:
            if skip:
                skip -= 1
            elif not silent:
                held.append(int(hexed, 16))
        elif sign:
            if not silent and sign in (b"\\", b"{", b"}"):
                held += sign
            elif not silent and sign == b"~":
                held += b" "
            elif not silent and sign == b"_":
                held += b"-"
        elif plain and not silent:
            take = plain[skip:]
            skip = max(0, skip - len(plain))
            held += take
        start = False
    flush()
    text = "".join(out).encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return "\n".join(re.sub(r"[ \t]+", " ", x).strip() for x in text.split("\n")).strip()


def html_to_text(text: str) -> str:
    """Scripts and styles dropped, block ends and breaks as line ends, tags as spaces, entities resolved."""
    text = re.sub(r"(?is)<(script|style|noscript)\b.*?</\1\s*>", " ", text)
    text = re.sub(r"(?i)<br\s*/?>|</(?:p|div|tr|li|h[1-6]|table|section|article)\s*>", "\n", text)
    text = html.unescape(re.sub(r"(?s)<[^>]+>", " ", text)).replace("\xa0", " ")
    text = re.sub(r"[ \t]+", " ", text)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r" *\n *", "\n", text)).strip()


def document_to_text(data: bytes, content_type: str | None, url: str | None) -> str:
    """By type, address or first bytes: RTF, HTML, DOCX, else plain text."""
    kind, name = (content_type or "").lower(), (url or "").lower()
    if "rtf" in kind or name.endswith(".rtf") or data[:5] == b"{\\rtf":
        return rtf_to_text(data)
    if name.endswith(".docx") or data[:4] == b"PK\x03\x04":
        return docx_to_text(data)
    text = bytes_to_text(data, (re.search(r"charset\s*=\s*['\"]?([^;\s'\"]+)", kind) or [None, None])[1])
    return html_to_text(text) if "html" in kind or re.search(r"(?i)<(?:html|body|p)\b", text) else text.strip()


#: Entities in the order in which they are resolved; as the ampersand comes early, ``&amp;lt;`` becomes ``<``.
ENTITIES = [("&nbsp;", " "), ("&amp;", "&"), ("&quot;", '"'), ("&#039;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">")]


def entities_to_text(text: str) -> str:
    """Named entities one after the other, then numbers."""
    for name, char in ENTITIES:
        text = re.sub(name, lambda _, c=char: c, text, flags=re.I)
    number = lambda m: chr(int(m[1]) % 65536) if m[1] else chr(int(m[2], 16) % 65536)
    return re.sub(r"&#(?:(\d+)|[xX]([0-9a-fA-F]+));", number, text)


def docx_to_text(data: bytes) -> str:
    """Paragraphs of the main part of a DOCX file; empty for a file that is none."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            xml = z.read("word/document.xml").decode("utf-8", "replace")
    except (zipfile.BadZipFile, KeyError):
        return ""
    xml = re.sub(r"<w:tab\b[^>]*/>", "\t", re.sub(r"<w:br\b[^>]*/>", "\n", xml))
    return html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</w:p>", "\n", xml))).strip()


def first_json(text: str) -> str | None:
    """The text if it is JSON, else a fenced block that is, else the first balanced object in it."""
    fenced = re.search(r"```(?:json)?\s*(.*?)```", text, re.S)
    for part in (text, fenced[1] if fenced else None):
        try:
            if part:
                json.loads(part)
                return part.strip()
        except ValueError:
            pass
    start = text.find("{")
    while start >= 0:
        try:
            _, end = json.JSONDecoder().raw_decode(text, start)
            return text[start:end]
        except ValueError:
            start = text.find("{", start + 1)
    return None


def _mapped(f):
    @F.pandas_udf(StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action="ignore")

    return run


nfkc = _mapped(lambda x: unicodedata.normalize("NFKC", x))
rtf_text = _mapped(lambda x: rtf_to_text(bytes(x)))
decoded = _mapped(lambda x: bytes_to_text(bytes(x)))
unescaped = _mapped(entities_to_text)
file_name = _mapped(lambda x: re.sub(r"#U([0-9a-fA-F]{4})", lambda m: chr(int(m[1], 16)), x))
json_text = _mapped(first_json)


@F.pandas_udf(StringType())
def document_text(data: pd.Series, content_type: pd.Series, url: pd.Series) -> pd.Series:
    return pd.Series([None if d is None else document_to_text(bytes(d), c, u) for d, c, u in zip(data, content_type, url)], dtype="object")
