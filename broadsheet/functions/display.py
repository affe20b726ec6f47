"""Values shown for a hit: file type, link, title."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# ---- fixed values: MIME type to short file type --------------------------------------
MIME_EXTENSIONS = {
    "application/x-7z-compressed": "7z",
    "application/postscript": "ai",
    "application/pgp-signature": "asc",
    "application/octet-stream": "bin",
    "application/x-bzip2": "bz2",
    "text/x-c": "c",
    "application/vnd.ms-htmlhelp": "chm",
    "application/java-vm": "class",
    "text/css": "css",
    "text/csv": "csv",
    "application/x-debian-package": "deb",
    "application/msword": "doc",
    "message/rfc822": "eml",
    "image/gif": "gif",
    "application/winhlp": "hlp",
    "text/html": "html",
    "application/java-archive": "jar",
    "text/x-java-source": "java",
    "image/jpeg": "jpeg",
    "application/javascript": "js",
    "application/vnd.oasis.opendocument.chart": "odc",
    "application/vnd.oasis.opendocument.formula": "odf",
    "application/vnd.oasis.opendocument.graphics": "odg",
    "application/vnd.oasis.opendocument.image": "odi",
    "application/vnd.oasis.opendocument.presentation": "odp",
    "application/vnd.oasis.opendocument.spreadsheet": "ods",
    "application/vnd.oasis.opendocument.text": "odt",
    "application/pdf": "pdf",
    "application/pgp-encrypted": "pgp",
    "image/png": "png",
    "application/vnd.ms-powerpoint": "ppt",
    "audio/x-pn-realaudio": "ram",
    "application/x-rar-compressed": "rar",
    "application/vnd.rn-realmedia": "rm",
    "application/rtf": "rtf",
    "application/x-shockwave-flash": "swf",
    "application/vnd.sun.xml.calc": "sxc",
    "application/vnd.sun.xml.draw": "sxd",
    "application/vnd.sun.xml.impress": "sxi",
    "application/vnd.sun.xml.writer": "sxw",
    "application/x-tar": "tar",
    "application/x-tex": "tex",
    "text/plain": "txt",
    "text/x-vcard": "vcf",
    "application/vnd.visio": "vsd",
    "audio/x-wav": "wav",
    "audio/x-ms-wma": "wma",
    "video/x-ms-wmv": "wmv",
    "application/vnd.ms-excel": "xls",
    "application/xml": "xml",
    "application/x-xpinstall": "xpi",
    "application/zip": "zip",
}


def literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(entries.items())])


def lookup(entries: dict[str, str], key: Column) -> Column:
    """Value of ``key`` in a fixed dictionary, NULL when absent.

    The membership test is a hashed set, so the linear map search runs for hits only.
    """
    return F.when(key.isin(*entries), F.try_element_at(literal_map(entries), key))


def file_type(content_type: Column, filename: Column) -> Column:
    """Short type by MIME type (parameters dropped), else the text after the last dot."""
    mime = F.substring_index(content_type, ";", 1)
    return F.coalesce(lookup(MIME_EXTENSIONS, mime), F.substring_index(filename, ".", -1))


def display_url(url: Column, resource: Column, doc_id: Column) -> Column:
    return F.coalesce(url, F.concat(F.lit("file:///"), resource), doc_id.cast("string"))


def display_title(title: Column, doc_id: Column) -> Column:
    return F.coalesce(title, F.concat(F.lit("["), doc_id.cast("string"), F.lit("]")))
