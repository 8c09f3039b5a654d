"""WARC archives: writing records with revisits, and reading them back by their boundary chain.

Writing: payloads of at least `least_bytes` that are equal share one response record, the one of
the largest key; the others become revisit records, which carry the digest and length of the
payload but not the payload. Keys and digests alone are grouped and joined; a payload moves only
to meet the decision on its own row. Archives are gzip files of bounded size: records are written
by size class, those of up to SMALL bytes `per_file` to an archive, those of up to STEP times as
many bytes STEP times fewer, and so on down to one, so an archive holds at most `per_file` times
SMALL bytes (128 MB) besides the headers, or one record.

Reading: a payload may hold anything, even whole records, so the magic alone proves nothing. A
task takes one archive, notes every place with the magic and a readable header as a candidate, and
the place where its record would end as its successor. Pointer jumping from the file's start
(next = next[next], marking what has been reached) keeps the records on the chain in a
logarithmic number of steps over whole arrays; all other candidates are payload.

Edge cases: a null payload is empty; a null key is written as an empty id and read back as null,
and is a response unless a copy has a key; rows that repeat key and payload are all the response;
a truncated or broken record ends the chain of its archive, what came before it stays. One record
above 2 GB cannot be read back: neither a cell nor a file can be held whole. An empty table gives
archives without a record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PER_FILE = 2000
SMALL, STEP = 1 << 16, 16  # bytes of the payloads of the first size class, and how classes widen


def base32(digits: Column) -> Column:
    """A SHA-1 of forty hex digits in upper-case base 32: five digits are four characters."""

    def char(i: Column) -> Column:
        part = F.conv(F.substring(digits, (i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10)
        shift = 15 - 5 * (i % 4)
        five = F.call_function("shiftright", part.cast("int"), shift).bitwiseAND(F.lit(31))
        return F.substring(F.lit(BASE32), five + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), char), "")


def _header(kind: str, key: str, extra: list[Column], length: Column) -> Column:
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    uri = F.regexp_replace(F.coalesce(F.col("__uri"), F.lit("")), r"[\x00-\x20\x7f]", "")
    return F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.lit(kind)),
        line("WARC-Record-ID", _urn(F.col(key))),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("__hash")))),
        line("Payload-Length", F.col("__bytes").cast("string")),
        *extra,
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
    )


def _urn(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def write(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    payload: str = "html",
    uri: str = "url",
    least_bytes: int = 0,
    per_file: int = PER_FILE,
) -> None:
    """Write a record per row to gzip archives under `path`."""
    body = F.coalesce(F.col(payload), F.lit(""))
    facts = [
        F.col(key).alias("__key"), F.col(uri).alias("__uri"),
        F.sha1(F.encode(body, "UTF-8")).alias("__hash"), F.octet_length(body).alias("__bytes"),
    ]
    slim, full = pages.select(*facts), pages.select(*facts, body.alias("__body"))
    shared = F.col("__bytes") >= least_bytes
    first = slim.filter(shared).groupBy("__hash").agg(F.max("__key").alias("__first"))
    revisits = (
        slim.filter(shared).join(first, "__hash")
        .filter(~F.col("__key").eqNullSafe(F.col("__first")))
    )
    owner = first.withColumnRenamed("__hash", "__own")
    same = F.col("__key").eqNullSafe(F.col("__first")) & (F.col("__hash") == F.col("__own"))
    responses = full.filter(shared).join(owner, same, "left_semi").unionByName(full.filter(~shared))
    refers = F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("__first")), F.lit("\r\n"))
    whole = responses.select(
        "__bytes",
        F.concat(_header("response", "__key", [], F.col("__bytes")), "__body").alias("value"),
    )
    slight = revisits.select(_header("revisit", "__key", [refers], F.lit(0)).alias("value"))
    sizes = [r[0] for r in slim.select(size_class(F.col("__bytes"))).distinct().collect()]
    for size in sorted({0, *sizes}):  # a handful: each is STEP times the one before
        own = whole.filter(size_class(F.col("__bytes")) == size).select("value")
        records = own.unionByName(slight) if size == 0 else own
        (
            records.write.mode("append").option("lineSep", END).option("compression", "gzip")
            .option("maxRecordsPerFile", max(1, per_file // STEP**size)).text(path)
        )


def size_class(size: Column) -> Column:
    """0 for payloads of up to SMALL bytes, one more for each STEP times as many."""
    found = F.lit(0)
    for n in range(1, 5):  # the last class starts at 4 GB / STEP, no payload is above it
        found = F.when(size > SMALL * STEP ** (n - 1), F.lit(n)).otherwise(found)
    return found


# -- reading -------------------------------------------------------------------------------

_MAGIC_AT = re.compile(rb"WARC/1\.[01]\r\n")
_END_AT = re.compile(rb"(?=\r\n\r\n)")
_LENGTH_AT = re.compile(rb"(?<=\n)Content-Length: *(\d{1,18})(?=\r\n)", re.IGNORECASE)


def candidates(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offset, end of header and successor of everything that looks like a record."""
    starts = np.array([m.start() for m in _MAGIC_AT.finditer(content)], np.int64)
    ends = np.array([m.start() for m in _END_AT.finditer(content)], np.int64)
    found = [(m.start(), int(m[1])) for m in _LENGTH_AT.finditer(content)]
    at, length = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else ((), ())
    if not (len(starts) and len(ends) and len(at)):
        return (np.zeros(0, np.int64),) * 3
    header = np.append(ends, len(content))[np.searchsorted(ends, starts)]
    which = np.searchsorted(at, starts)
    stated = np.append(at, len(content))[which]
    successor = header + len(END) + np.append(length, 0)[which] + len(END)
    good = (header < len(content)) & (stated < header) & np.isin(successor - len(END), ends)
    return starts[good], header[good], successor[good]


def reachable(starts: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Which candidates lie on the chain from offset 0, by pointer jumping."""
    size = len(starts)
    following = np.searchsorted(starts, successor)
    on = following < size
    on[on] = starts[following[on]] == successor[on]
    jump = np.append(np.where(on, following, size), size)
    reached = np.zeros(size + 1, bool)
    reached[0] = size > 0 and starts[0] == 0
    for _ in range(max(1, size.bit_length())):
        reached[jump[reached]] = True
        jump = jump[jump]
    return np.flatnonzero(reached[:size])


def records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, header and payload of each record of an archive."""
    starts, header, successor = candidates(content)
    for i in reachable(starts, successor):
        lines = content[starts[i] : header[i]].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {n.lower(): v for n, _, v in (x.partition(": ") for x in lines)}
        yield int(starts[i]), fields, content[header[i] + len(END) : successor[i] - len(END)]


READ = (
    "archive string, offset long, record_id string, record_type string, target_uri string, "
    "refers_to string, payload_bytes long, payload_digest string, intact boolean, payload binary"
)


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives under `path`.

    Length and digest are those of the payload read; for revisits those the record states.
    `intact` says whether a response's payload has the stated digest.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name.endswith(".gz"):
                    content = gzip.decompress(content)
                rows = []
                for offset, fields, payload in records(content):
                    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                    size, digest = len(payload), stated
                    if fields.get("warc-type") != "revisit":
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    elif fields.get("payload-length", "").isdigit():
                        size = int(fields["payload-length"])
                    rows.append(
                        (
                            name, offset, fields.get("warc-record-id"), fields.get("warc-type"),
                            fields.get("warc-target-uri"), fields.get("warc-refers-to"), size,
                            digest, digest == stated, payload if with_payload else None,
                        )
                    )
                columns = zip(*rows, strict=True) if rows else [()] * len(TYPES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, TYPES.values(), strict=True)],
                    names=list(TYPES),
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(parse, READ)


TYPES = {
    "archive": pa.string(), "offset": pa.int64(), "record_id": pa.string(),
    "record_type": pa.string(), "target_uri": pa.string(), "refers_to": pa.string(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "intact": pa.bool_(),
    "payload": pa.binary(),
}


def key_of(urn: str) -> Column:
    """The long key in a record id; null if there is none."""
    digits = F.regexp_extract(urn, "^<urn:page:(.*)>$", 1)
    return F.nullif(digits, F.lit("")).try_cast("long")
