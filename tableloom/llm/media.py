"""Media columns: payloads kept as progressive JPEG files, read back as coefficients and RGB tensors.

A payload is a text's bytes, filled up with zero bytes to a positive multiple of
64; each of its bytes is one coefficient of the file (see ``jpeg``), so the file gives
it back exactly whatever the picture looks like.

Defined cases: a null or empty text is 64 zero bytes; a null file has no payload and no
tensor; a text of more than about 100 MB gets a wider image, up to the format's 16 bits each
way (some 6 GB, more than one value of a column can hold); equal texts give equal files; a file that is no progressive JPEG fails the job;
an empty table gives an empty result. Extra columns are carried along, and one named
like a result column is replaced.
"""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import DataFrame

from tableloom.llm import jpeg
from tableloom.llm.batches import with_columns

#: Bytes of payload that are worked on together in a task.
TOGETHER = 1 << 20


def _payload(text: str) -> bytes:
    raw = text.encode()
    return raw + bytes(-len(raw) % 64 or (64 if not raw else 0))


def _groups(values: list[bytes]):
    """Runs of values of about ``TOGETHER`` bytes."""
    out, size = [], 0
    for v in values:
        out.append(v)
        size += len(v)
        if size >= TOGETHER:
            yield out
            out, size = [], 0
    if out:
        yield out


def store_media(docs: DataFrame, text: str = "text", out: str = "media", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_bytes`` of the text and the progressive JPEG file that keeps its payload."""
    def make():
        def work(texts):
            payloads = [_payload(t) for t in texts]
            return [[len(t.encode()) for t in texts], [f for group in _groups(payloads) for f in jpeg.store(group)]]

        return work

    return with_columns(docs, text, f"n_bytes long, `{out}` binary", make, keep)


def read_tensors(media: DataFrame, column: str = "media", keep: list[str] | None = None) -> DataFrame:
    """``media`` with ``height, width, channels int``, the full-resolution ``rgb`` samples row by row, and the ``payload``."""
    def make():
        def work(files):
            rows = [r for group in _groups(files) for r in _read(group, lambda image, coef, t: (*t.shape, t.tobytes(), jpeg.payload(image, coef)))]
            return list(zip(*rows)) or [[]] * 5

        return work

    return with_columns(media, column, "height int, width int, channels int, rgb binary, payload binary", make, keep)


def _read(files: list[bytes], give):
    full = [f for f in files if f]
    images, coef = jpeg.decode(full)
    found = iter(images)
    for f in files:
        image = next(found) if f else None
        yield give(image, coef, jpeg.tensor(image, coef)) if image else (None,) * 5


def media_digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes and digests of each document's payload, file and picture, from the file's own bytes."""
    def feature(t) -> str:
        sums = t.reshape(-1, t.shape[2]).sum(0, dtype="int64")
        return f"{t.shape[1]}x{t.shape[0]}:" + ":".join(map(str, sums.tolist())) + f":{zlib.crc32(t):08x}"

    def digest(image, coef, t):
        p = jpeg.payload(image, coef)
        return len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), feature(t)

    def make():
        def work(files):
            rows = [r for group in _groups(files) for r in _read(group, digest)]
            named = list(zip(*rows)) or [[]] * 4
            return [*named, [len(f) for f in files], [hashlib.sha256(f).hexdigest() for f in files]]

        return work

    stored = store_media(docs, text, "media", [key])
    ddl = "payload_bytes long, payload_sha256 string, tail_crc32 long, feature string, media_bytes long, media_sha256 string"
    read = with_columns(stored, "media", ddl, make, [key, "n_bytes"])
    return read.select(key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
