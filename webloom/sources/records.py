"""Fetching and decoding records: manifest row -> byte range -> document."""

from __future__ import annotations

import gzip
import http.client
import random
import re
import time
import urllib.parse
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from webloom.functions.arrow import map_rows

Fetch = Callable[[str, int, int], bytes]
ATTEMPTS, BASE_SECONDS = 6, 2.0
_CHARSET = re.compile(rb"charset=[\"']?([A-Za-z0-9_.:-]+)", re.I)


def local_fetch(root: str) -> Callable[[], Fetch]:
    """A backend that reads ranges of files below a folder; made once a task."""

    def make() -> Fetch:
        def fetch(key: str, start: int, end: int) -> bytes:
            with Path(root, key).open("rb") as f:
                f.seek(start)
                return f.read(end - start + 1)

        return fetch

    return make


def http_fetch(root: str, timeout: float = 60.0) -> Callable[[], Fetch]:
    """A backend that asks a web store for ranges below an address, over one kept connection a task."""

    def make() -> Fetch:
        at = urllib.parse.urlsplit(root)
        held: list[http.client.HTTPConnection] = []

        def fetch(key: str, start: int, end: int) -> bytes:
            if not held:
                held.append((http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection)(at.netloc, timeout=timeout))
            try:
                held[0].request("GET", f"{at.path.rstrip('/')}/{urllib.parse.quote(key)}", headers={"Range": f"bytes={start}-{end}"})
                answer = held[0].getresponse()
                data = answer.read()
            except (OSError, http.client.HTTPException):
                held.pop().close()  # the next try opens a new one
                raise
            if answer.status not in (200, 206):
                raise OSError(f"{answer.status} for {key}")
            return data if answer.status == 206 else data[start : end + 1]

        return fetch

    return make


def s3_fetch(bucket: str, region: str = "us-east-1", client_attempts: int = 8) -> Callable[[], Fetch]:
    """A backend for an S3 bucket with one adaptive client a task; it needs boto3 on the executors and credentials in their environment."""

    def make() -> Fetch:
        try:
            import boto3
            from botocore.config import Config
        except ImportError as e:
            raise RuntimeError("fetching from S3 needs boto3; http_fetch reads public buckets without it") from e
        client = boto3.client("s3", region_name=region, config=Config(retries={"mode": "adaptive", "max_attempts": client_attempts}))

        def fetch(key: str, start: int, end: int) -> bytes:
            return client.get_object(Bucket=bucket, Key=key, Range=f"bytes={start}-{end}")["Body"].read()

        return fetch

    return make


def backend(root: str) -> Callable[[], Fetch]:
    """The backend of a place: s3://bucket, http(s)://address or a folder."""
    if root.startswith("s3://"):
        return s3_fetch(root[5:].strip("/"))
    return http_fetch(root) if root.startswith(("http://", "https://")) else local_fetch(root)


def with_retry(fetch: Fetch, attempts: int = ATTEMPTS, base: float = BASE_SECONDS, sleep: Callable[[float], None] = time.sleep) -> Fetch:
    """Try again with full jitter on a doubling bound; the last error is raised."""

    def run(key: str, start: int, end: int) -> bytes:
        for k in range(attempts):
            try:
                return fetch(key, start, end)
            except Exception:
                if k == attempts - 1:
                    raise
                sleep(random.uniform(0, base * 2**k))
        raise AssertionError

    return run


def decode_record(data: bytes) -> tuple[str, str] | None:
    """(content type, body as text) of the first record of a gzip member; None if there is none."""
    try:
        raw = zlib.decompressobj(wbits=31).decompress(data)
    except zlib.error:
        return None
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/"):
        return None
    http, sep, body = rest.partition(b"\r\n\r\n")
    if not sep:
        return None
    kind = next((x.split(b":", 1)[1].strip() for x in http.split(b"\r\n") if x.lower().startswith(b"content-type:")), b"")
    if re.search(rb"(?im)^content-encoding:\s*gzip", http):
        try:
            body = gzip.decompress(body)
        except (OSError, EOFError, zlib.error):
            return None
    body = body.removesuffix(b"\r\n\r\n")
    named = _CHARSET.search(kind) or _CHARSET.search(body[:2048])
    for charset in ([named[1].decode()] if named else []) + ["utf-8"]:
        try:
            return kind.decode("latin-1"), body.decode(charset)
        except (UnicodeDecodeError, LookupError):
            continue
    return kind.decode("latin-1"), body.decode("latin-1")


SCHEMA = "id string, text string, crawl string, content_digest string, url string, url_host_registered_domain string, warc_filename string, warc_record_offset bigint, content_type string"


def read_records(manifest: DataFrame, crawl: str, backend: Callable[[], Fetch], attempts: int = ATTEMPTS, base: float = BASE_SECONDS, carry: tuple[str, ...] = (), extract: Callable[[str], str | None] | None = None) -> DataFrame:
    """Documents of manifest rows, with the columns `carry` of the manifest added.

    `extract` makes the text from the body in the same pass; bodies without text give no row. Rows without a file, offset or length, or without a decodable record, give none; a range that cannot be fetched is an
    error. The digest is the document's id, as it is the same in every run. Repartition the manifest for more fetches at a time.
    """

    def make() -> Callable[..., Iterator[tuple[Any, ...]]]:
        fetch = with_retry(backend(), attempts, base)

        def f(*columns: list[Any]) -> Iterator[tuple[Any, ...]]:
            for url, domain, digest, file, offset, length, *more in zip(*columns, strict=True):
                if file is None or offset is None or length is None:
                    continue
                got = decode_record(fetch(file, offset, offset + length - 1))
                text = (extract(got[1]) if extract else got[1]) if got else None
                if got and text is not None:
                    yield digest, text, crawl, digest, url, domain, file, offset, got[0], *more

        return f

    schema = T.StructType([*T.StructType.fromDDL(SCHEMA).fields, *[manifest.schema[c] for c in carry]])
    return map_rows(manifest, ["url", "url_host_registered_domain", "content_digest", "warc_filename", "warc_record_offset", "warc_record_length", *carry], schema, make, each=16)
