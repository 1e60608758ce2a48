"""WARC archives: a zstandard frame for each record, the dictionary in the archive's leading skippable frame.

An archive is one ``.warc.zst`` file as the format has it: a skippable frame (magic 0x184D2A5D) with the
dictionary, then a frame for each record, so a record can be read alone.  Archives are written by Spark's own
writer, so any store works and a task that is run again leaves one copy: a row is a whole archive of about
``archive_bytes``, each row goes to a file of its own, and the line separator that ends the file is an empty skippable frame.

Pages with equal payloads of at least ``least_bytes`` bytes are one class: that with the smallest page_id is
a ``response``, the others ``revisit`` it (profile identical-payload-digest) and repeat its HTTP head without
the payload.  Classes come from an aggregation of digests and a join back, so a class with a third of all pages
is combined before the shuffle, and its join is split by adaptive execution.

The reader walks an archive frame by frame.  It raises an error where a frame, a mandatory field, a length or a
digest isn't right; ``restored`` gives revisits their payloads again.

Defined cases: null html is an empty payload; a null page_id comes after all others and is read back as null; of rows that share the
smallest page_id and the payload one is the response and the others revisit it; a null url leaves its field out; an empty
table gives an empty folder; a very long page is a record like others (an archive of its own); other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.token_files import train_dictionary
from ledgerloom.plans.shared import exists, staged

DICTIONARY, SKIPPABLE, FRAME = 0x184D2A5D, range(0x184D2A50, 0x184D2A60), 0xFD2FB528
#: An empty skippable frame, all of whose bytes are ASCII: it ends an archive where Spark's writer wants a line separator.
END = "P*M\x18\0\0\0\0"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = re.compile(r"<urn:ledgerloom:page:(-?\d*):(\d+)>")
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, record_id string, refers_to_record string"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id: int | None, row: int, url: str | None, payload: bytes, refers: tuple[int | None, int] | None, date: str) -> bytes:
    """A response, or where refers names another page's (page_id, row) a revisit of it."""
    name = lambda p, r: f"<urn:ledgerloom:page:{'' if p is None else p}:{r}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    fields = {"WARC-Type": "revisit" if refers else "response", "WARC-Record-ID": name(page_id, row), "WARC-Date": date}
    if url is not None:  # what can't stand in a header line is percent-encoded
        fields["WARC-Target-URI"] = re.sub(rb"[^\x21-\x7E]", lambda m: b"%%%02X" % m[0][0], url.encode()).decode()
    if refers:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": name(*refers)}
    fields |= {"WARC-Payload-Digest": "sha1:" + base32(hashlib.sha1(payload).digest()), "WARC-Block-Digest": "sha1:" + base32(hashlib.sha1(block).digest())}
    fields |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def skippable(magic: int, content: bytes) -> bytes:
    return magic.to_bytes(4, "little") + len(content).to_bytes(4, "little") + content


def numbered(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, same (its SHA-256) and row, a number of its own. Written once, so that a row's number stays whatever tasks are run again."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    return staged(named.select("*", F.sha2("payload", 256).alias("same"), F.monotonically_increasing_id().alias("row")), "payloads")


def classes(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """From numbered rows page_id, url, payload, row, and of its class's response first_id and first_row; for a response row = first_row."""
    shared = rows.where(F.octet_length("payload") >= least_bytes)
    first = shared.groupBy("same").agg(F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "row")).alias("first"))
    found = rows.join(first, "same", "left").select("page_id", "url", "payload", "row", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row"))
    alone = F.octet_length("payload") < least_bytes
    return found.withColumns({"first_id": F.when(alone, F.col("page_id")).otherwise(F.col("first_id")), "first_row": F.when(alone, F.col("row")).otherwise(F.col("first_row"))})


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = 16 << 20,
    level: int = 3, dictionary_bytes: int = 1 << 15, sample_pages: int = 400, sample_bytes: int = 8192,
) -> str:
    """One record for each row of pages; gives the folder.

    The dictionary is trained on the first sample_bytes bytes of at most sample_pages pages; these bounds touch the dictionary only.
    """
    whole = numbered(pages)
    # Chosen by hashes alone, so that tasks send no texts that aren't in the sample.
    picked = F.broadcast(whole.select("row", F.xxhash64("same", "page_id").alias("h")).orderBy("h", "row").limit(sample_pages))
    sample = whole.join(picked, "row").select("h", F.substring("payload", 1, sample_bytes).alias("x")).collect()
    data = train_dictionary(sorted(bytes(r.x) for r in sample if len(r.x)), dictionary_bytes)
    rows = classes(whole, least_bytes)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=level, dict_data=opener(data), write_checksum=True, write_content_size=True)
        leading = skippable(DICTIONARY, data)
        held, size = [leading], 0
        for frame in frames:
            columns = [frame.column(c) for c in range(6)]
            for i in range(frame.num_rows):
                page_id, url, payload, row, first_id, first_row = (c[i].as_py() for c in columns)
                held.append(packer.compress(record(page_id, row, url, payload, None if row == first_row else (first_id, first_row), date)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])
                    held, size = [leading], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])

    archives = rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", END).option("maxRecordsPerFile", 1).option("compression", "none").text(folder)
    return folder


def opener(data: bytes) -> zstandard.ZstdCompressionDict | None:
    """A dictionary, which an archive may hold compressed."""
    if data[:4] == FRAME.to_bytes(4, "little"):
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends: its head, its blocks, its checksum."""
    head = data[at : at + 18]
    end = at + zstandard.frame_header_size(head)
    checksum, last = zstandard.get_frame_parameters(head).has_checksum, False
    while not last:
        if end + 3 > len(data):
            raise ValueError("a frame is cut off")
        block = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        end += 3 + (1 if kind == 1 else size)
    return end + 4 * checksum


def frames_of(archive: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and decompressed content of each record's frame."""
    data, at, unpacker = memoryview(archive), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic = int.from_bytes(data[at : at + 4], "little")
        if magic in SKIPPABLE:
            end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            if magic == DICTIONARY:
                if at:
                    raise ValueError(f"a dictionary at {at}; only the leading frame may be one")
                own = opener(bytes(data[8:end]))
                unpacker = zstandard.ZstdDecompressor(dict_data=own) if own else unpacker
        elif magic == FRAME:
            end = frame_end(data, at)
            if end <= len(data):
                out = unpacker.decompressobj()
                content = out.decompress(data[at:end])
                if not out.eof:
                    raise ValueError(f"the frame at {at} isn't whole")
                yield at, content
        else:
            raise ValueError(f"no frame begins at {at}")
        if end > len(data):
            raise ValueError(f"the frame at {at} is cut off")
        at = end


def fields_of(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        key = name.decode("ascii").lower()
        if not colon or not key or key != key.strip():
            raise ValueError(f"no header field: {line[:80]!r}")
        if key in out:
            raise ValueError(f"repeated field {key}")
        out[key] = value.strip().decode("utf-8")
    return out


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """The fields of a record, its payload (empty for a revisit) and the payload's length as its HTTP head has it."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not blank or not re.fullmatch(rb"WARC/\d\.\d", version):
        raise ValueError(f"no WARC record: {data[:40]!r}")
    fields = fields_of(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"a record without {name}")
    if not re.fullmatch(r"\d+", fields["content-length"]) or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"{fields['warc-record-id']}: {len(rest) - 4} bytes, its header has {fields['content-length']}")
    block = rest[:-4]
    same = lambda name, x: name not in fields or fields[name] == "sha1:" + base32(hashlib.sha1(x).digest())
    http, blank, payload = block.partition(b"\r\n\r\n")
    size = int(fields_of(http.split(b"\r\n")[1:]).get("content-length", "-1"))
    revisit = fields["warc-type"] == "revisit"
    if not blank or not http.startswith(b"HTTP/") or len(payload) != (0 if revisit else size) or size < 0:
        raise ValueError(f"{fields['warc-record-id']}: {len(payload)} bytes of payload, its HTTP head has {size}")
    if not same("warc-block-digest", block) or not revisit and not same("warc-payload-digest", payload):
        raise ValueError(f"{fields['warc-record-id']}: its digest isn't that of its content")
    if revisit and not {"warc-refers-to", "warc-profile", "warc-payload-digest"} <= fields.keys():
        raise ValueError(f"{fields['warc-record-id']}: a revisit that names no record, profile or digest")
    return fields, payload, size


def _page(record_id: str) -> int | None:
    if (m := RECORD_ID.fullmatch(record_id)) is None:
        raise ValueError(f"{record_id} names no page")
    return int(m[1]) if m[1] else None


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """A row for each record, validated; payload (empty for a revisit) if asked for."""
    schema = RECORDS + (", payload binary" if payloads else "")
    if not exists(spark, folder):
        raise FileNotFoundError(folder)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in schema.split(", ")]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for path, data in zip(frame.column(0), frame.column(1)):
                rows, size = [], 0
                try:
                    for _, content in frames_of(data.as_py()):
                        f, payload, n = parse(content)
                        to = f.get("warc-refers-to")
                        row = (_page(f["warc-record-id"]), n, f.get("warc-payload-digest", "").removeprefix("sha1:"), f["warc-type"], _page(to) if to else None, f.get("warc-target-uri"), f["warc-record-id"], to)
                        rows.append((*row, payload) if payloads else row)
                        size += len(payload) * payloads
                        if len(rows) >= 5000 or size > 1 << 24:
                            yield pack(rows)
                            rows, size = [], 0
                except (ValueError, zstandard.ZstdError) as e:
                    raise ValueError(f"{path.as_py()}: {e}") from e
                if rows:
                    yield pack(rows)

    return spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content").mapInArrow(run, schema)


def restored(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload: revisits get the payload of the record they refer to. A revisit of a record that isn't there has none."""
    rows = read_archives(spark, folder, payloads=True)
    whole = rows.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("payload").alias("first"))
    revisits = rows.where("record_type = 'revisit'").select("page_id", "refers_to_record").join(whole, "refers_to_record", "left").select("page_id", F.col("first").alias("payload"))
    return rows.where("record_type = 'response'").select("page_id", "payload").unionByName(revisits)
