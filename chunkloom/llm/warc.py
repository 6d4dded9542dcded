"""WARC archives: written by Spark, read back by verified boundary chains.

Writing. Every page is one record of WARC/1.1 text; a page whose payload (of ``min_bytes`` or more)
occurs again under a larger id is a ``revisit`` that names that page. Spark's text writer puts the
records into files, with the four bytes that end a record as its line separator.

Reading. The magic line cuts a file into pieces, in parallel over its splits. A piece is only a
candidate record: the magic may also stand inside a payload. Tasks follow candidate-to-successor
offsets (head + Content-Length + 4) inside their split and emit, for each candidate, the first offset
it reaches behind the split. Pointer jumping over the splits of a file, doubling the reach each round,
then finds which offsets the chain from the file's first byte enters, and only candidates on that
chain are records. Payloads that hold the magic are put together again from their pieces.

Defined cases: a null html is an empty payload; a null url leaves out its header, line breaks in a url
are percent-encoded; a record with a null id is a response and is never referred to; rows that repeat
an id and a payload are all responses if they have the largest id; no pages give no records. Of the
input only the id, the url and the html are read. Memory: one record, and the heads of one split.

Damage: a file whose chain breaks off (a wrong length, a record cut short, no archive at all) ends the
reading with ``ValueError`` naming the file and the byte, and so does, as an error of the job, a payload
that is not what its headers say. With ``skip_damaged`` the records before a break and all sound ones are
returned, and ``damaged_parts`` lists what was left out. An empty file is an archive without records.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chunkloom.llm.common import Columns, lists, map_columns
from chunkloom.operators.storage import remove, staged

MAGIC = b"WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MIN_BYTES = 1000
BROADCAST_DIGESTS = 400_000  # of 28 bytes each


def records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> tuple[DataFrame, str]:
    """``page_id, url, payload, digest, first``: ``first`` is the page a revisit refers to, else null;
    and the path of a copy to remove afterwards.

    Digests that occur twice are found without the payloads. Where these digests fit a broadcast, by
    their number, pages stay where they are; only beyond that are payloads shuffled to them.
    """
    page = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"").cast("binary")).alias("payload"))
    page = page.withColumn("digest", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= min_bytes
    shared = (
        page.where(long_enough)
        .groupBy(F.unhex("digest").alias("of"))
        .agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
        .where("n > 1 AND largest IS NOT NULL")
        .drop("n")
    )
    shared, copy = staged(shared, "warc-shared")
    if shared.count() <= BROADCAST_DIGESTS:
        shared = F.broadcast(shared)
    # else AQE splits the pages of a payload that very many pages have
    found = page.join(shared, F.when(long_enough, F.unhex("digest")) == F.col("of"), "left")
    found = found.withColumn("first", F.when(F.col("largest") > F.col("page_id"), F.col("largest"))).drop("of", "largest")
    return found, copy


def _header(name: str, value) -> object:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """WARC files in the folder ``path``."""
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.when(F.col("first").isNull(), F.concat(F.lit(HTTP_HEAD), F.col("payload").cast("string"))).otherwise(HTTP_HEAD)
    head = F.concat(
        F.lit(MAGIC.decode()),
        F.when(F.col("first").isNull(), F.lit("WARC-Type: response\r\n")).otherwise("WARC-Type: revisit\r\n"),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _header("X-Payload-Length", F.octet_length("payload").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    found, copy = records(pages, min_bytes)
    lines = found.withColumn("block", block)
    lines.select(F.concat(head, F.col("block")).alias("value")).write.option("lineSep", END).text(path)
    remove(pages.sparkSession, copy)


_HEAD = re.compile(rb"(?:[A-Za-z-]+: [^\r\n]*\r\n)+\r\n")
_FIELD = re.compile(rb"([A-Za-z-]+): ([^\r\n]*)\r\n")
_PAGE = re.compile(rb"<urn:page:(-?\d+)>")
_FIELDS = "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"
_FIELD_NAMES = [part.split()[0] for part in _FIELDS.split(", ")]
PART_BYTES = 4 << 20


def parse_record(piece: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Bytes of the whole record without its magic, and its headers; None if it is no record's start."""
    head = _HEAD.match(piece)
    if head is None:
        return None
    fields = dict(_FIELD.findall(head.group()))
    if not fields.get(b"Content-Length", b"").isdigit():
        return None
    return head.end() + int(fields[b"Content-Length"]) + len(END), fields


def describe_record(piece: bytes) -> tuple:
    """``page_id, record_type, refers_to, payload_bytes, payload_digest`` of a whole record.

    All null if headers are missing or a stored payload is not what they say.
    """
    size, fields = parse_record(piece)
    start = _HEAD.match(piece).end()
    page = _PAGE.match(fields.get(b"WARC-Record-ID", b""))
    first = _PAGE.match(fields.get(b"WARC-Refers-To", b""))
    digest = fields.get(b"WARC-Payload-Digest", b"").removeprefix(b"sha1:").decode("latin-1")
    length = fields.get(b"X-Payload-Length", b"").decode("latin-1")
    kind = fields.get(b"WARC-Type", b"").decode("latin-1")
    if kind == "response":
        payload = memoryview(piece)[start + len(HTTP_HEAD) : size - len(END)]
        sound = sha1(payload).hexdigest() == digest and length == str(len(payload))
    else:
        sound = kind == "revisit" and first is not None and length.isdigit()
    if not sound:
        return (None,) * 5
    return (page and int(page.group(1)), kind, first and int(first.group(1)), int(length), digest)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, split, piece``: what stands between two magics, in the order of the file."""
    read = spark.read.option("lineSep", MAGIC.decode()).text(path)
    where = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    return read.select(*where, F.col("value").cast("binary").alias("piece"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """``file, split, at, piece``; ``at`` counts from the first piece of the split.

    Each piece counts the magic behind it, so the text of the record whose magic stands at byte ``b``
    of the file is the piece at ``b + 10``, and the empty piece before the first magic is at 0.
    """
    here, at = None, 0
    for batch in batches:
        for file, split, piece in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (file, split) != here:
                here, at = (file, split), 0
            yield file, split, at, piece
            at += len(piece) + len(MAGIC)


def _candidates(pieces: DataFrame) -> DataFrame:
    """One row per piece, with its successor and, if the piece is one whole record, its fields.

    ``leaves`` is the first offset behind the split on the chain from here, null if that breaks off.
    """
    ddl = f"file string, split bigint, at bigint, succ bigint, leaves bigint, total bigint, whole boolean, {_FIELDS}"
    names = [part.split()[0] for part in ddl.split(", ")]

    def settled(here: tuple[str, int], heads: list[tuple], total: int) -> Columns:
        reach: dict[int, int | None] = {}
        for at, succ, *_ in reversed(heads):
            reach[at] = succ if succ is None or succ >= total else reach.get(succ)
        return lists([(*here, at, succ, reach[at], total, *rest) for at, succ, *rest in heads], names)

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        here, heads, total = None, [], 0
        for file, split, at, piece in _walk(batches):
            if (file, split) != here:
                if heads:
                    yield settled(here, heads, total)
                here, heads = (file, split), []
            total = at + len(piece) + len(MAGIC)
            head = parse_record(piece)
            if head is None:
                # nothing before the first magic: the chain begins behind it
                begins = split == 0 and at == 0 and not piece
                heads.append((at, total if begins else None, False, *[None] * 5))
            else:
                whole = head[0] == len(piece)
                heads.append((at, at + head[0] + len(MAGIC), whole, *(describe_record(piece) if whole else [None] * 5)))
        if heads:
            yield settled(here, heads, total)

    return map_columns(pieces, ddl, worker)


def _entered(placed: DataFrame, scratch: list[str]) -> DataFrame:
    """``file, abs``: the offsets at which the chain from each file's start enters its splits.

    Pointer jumping. Only offsets that some chain leaves to are of interest, about one per split;
    each round doubles the number of splits that one link passes.
    """
    links = placed.where("leaves IS NOT NULL").select("file", "abs", (F.col("base") + F.col("leaves")).alias("to"))
    heads = links.select("file", F.col("to").alias("abs")).union(links.select("file", F.lit(0).cast("bigint")))
    links, copy = staged(links.join(heads.distinct(), ["file", "abs"], "left_semi"), "warc-links")
    scratch.append(copy)
    reached = placed.select("file", F.lit(0).cast("bigint").alias("abs")).distinct()
    most = placed.select("file", "split").distinct().groupBy("file").count().agg(F.max("count")).first()[0] or 1
    for _ in range(max(0, most - 1).bit_length()):
        stepped = reached.join(links, ["file", "abs"]).select("file", F.col("to").alias("abs"))
        reached, copy = staged(reached.union(stepped).distinct(), "warc-reached")
        scratch.append(copy)
        far = links.select("file", F.col("abs").alias("to"), F.col("to").alias("far"))
        links, copy = staged(links.join(far, ["file", "to"]).select("file", "abs", F.col("far").alias("to")), "warc-links")
        scratch.append(copy)
    return reached


def _on_chain(placed: DataFrame, entered: DataFrame) -> DataFrame:
    """The rows of ``placed`` that the chain passes.

    ``owner`` is the last record of the chain that begins at or before the row within its split, as
    ``abs, size, whole``; null where the split begins inside a record of an earlier one.
    """
    entry = placed.join(entered, ["file", "abs"], "left_semi").select("file", "split", F.col("at").alias("entry"))
    rows = placed.join(entry, ["file", "split"], "left")
    ordered = rows.repartition("file", "split").sortWithinPartitions("file", "split", "at")
    ddl = (
        f"file string, split bigint, at bigint, abs bigint, succ bigint, whole boolean, {_FIELDS}, chained boolean, "
        "owner struct<abs:bigint,size:bigint,whole:boolean>"
    )
    names = ["file", "split", "at", "abs", "succ", "whole", *_FIELD_NAMES]

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        here, expected, owner = None, None, None
        for batch in batches:
            out = []
            for row in batch.select([*names, "entry"]).to_pylist():
                if (row["file"], row["split"]) != here:
                    here, expected, owner = (row["file"], row["split"]), row["entry"], None
                chained = row["at"] == expected
                if chained:
                    expected = row["succ"]
                    size = None if expected is None else expected - row["at"]
                    owner = {"abs": row["abs"], "size": size, "whole": row["whole"]}
                out.append((*(row[n] for n in names), chained, owner))
            yield lists(out, [*names, "chained", "owner"])

    return map_columns(ordered, ddl, worker)


def _in_parts(pieces: DataFrame, chain: DataFrame) -> DataFrame:
    """``file, abs`` and the fields of records whose payload holds the magic, put together from their pieces."""
    # the record in which a split begins is the last one of the splits before it: a row per split
    last = chain.where("chained").groupBy("file", "split").agg(F.max_by("owner", "abs").alias("last"))
    splits = chain.select("file", "split").distinct().join(last, ["file", "split"], "left")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = splits.select("file", "split", F.last("last", ignorenulls=True).over(before).alias("carried"))
    owned = chain.join(carried, ["file", "split"]).withColumn("owner", F.coalesce("owner", "carried"))
    owned = owned.where("owner.size IS NOT NULL AND NOT owner.whole AND owner.abs > 0 AND abs < owner.abs + owner.size")
    keys = owned.select("file", "split", "at", F.col("owner.abs").alias("owner"))

    def placed_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        rows, held = [], 0
        for row in _walk(batches):
            rows.append(row)
            held += len(row[3])
            if held > PART_BYTES:
                yield lists(rows, ["file", "split", "at", "piece"])
                rows, held = [], 0
        yield lists(rows, ["file", "split", "at", "piece"])

    bytes_of = map_columns(pieces, "file string, split bigint, at bigint, piece binary", placed_pieces)
    parts = bytes_of.join(keys, ["file", "split", "at"]).groupBy("file", "owner").agg(
        F.array_sort(F.collect_list(F.struct("split", "at", "piece"))).alias("parts")
    )

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[Columns]:
        for batch in batches:
            rows = []
            for file, owner, parts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                record = MAGIC.join(p["piece"] for p in parts)
                size = parse_record(record)[0]
                if size <= len(record):  # else the file ends inside it
                    rows.append((file, owner, *describe_record(record[:size])))
            yield lists(rows, ["file", "abs", *_FIELD_NAMES])

    return map_columns(parts.select("file", "owner", "parts"), f"file string, abs bigint, {_FIELDS}", worker)


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``file, abs`` and fields of every record on the chain (no fields where the payload is not what the
    headers say), and ``file, offset`` of files whose chain ends early."""
    pieces = _pieces(spark, path)
    found, copy = staged(_candidates(pieces), "warc")
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    # a row per split, thousands of times fewer than records
    splits = found.groupBy("file", "split").agg(F.max("total").alias("size"))
    splits = splits.withColumn("base", F.coalesce(F.sum("size").over(in_file), F.lit(0)))
    placed = found.join(splits.drop("size"), ["file", "split"]).withColumn("abs", F.col("base") + F.col("at"))
    scratch = [copy]
    chain, _ = staged(_on_chain(placed, _entered(placed, scratch)), "warc-chain")
    # a sound chain reaches the end of its file; other chains end where their last record begins or leads
    leads = F.col("abs") - F.col("at") + F.col("succ")
    ends = splits.groupBy("file").agg(F.sum("size").alias("end"))
    reached = chain.where("chained").groupBy("file").agg(F.max(leads).alias("reached"), F.max("abs").alias("begins"))
    ends, copy = staged(ends.join(reached, "file", "left").where("reached IS NULL OR reached <> end"), "warc-ends")
    for used in scratch:
        remove(spark, used)
    inside = F.coalesce(F.when(F.col("reached") < F.col("end"), F.col("reached")), F.col("begins"), F.lit(0))
    broken = ends.select("file", F.greatest(inside - len(MAGIC), F.lit(0)).alias("offset"))
    fields = ["file", "abs", *_FIELD_NAMES]
    whole = chain.where("chained AND whole").select(*fields)
    if not chain.where("chained AND succ IS NOT NULL AND NOT whole AND abs > 0").isEmpty():
        whole = whole.union(_in_parts(pieces, chain))
    return whole, broken


def damaged_parts(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, damage``: where chains end early (``chain``: what follows in the file cannot be
    read) and records whose payload is not what their headers say (``payload``)."""
    found, broken = _read(spark, path)
    wrong = found.where("record_type IS NULL").select("file", (F.col("abs") - len(MAGIC)).alias("offset"))
    return broken.withColumn("damage", F.lit("chain")).union(wrong.withColumn("damage", F.lit("payload")))


def read_archives(spark: SparkSession, path: str, skip_damaged: bool = False) -> DataFrame:
    """``page_id, record_type, refers_to, payload_bytes, payload_digest`` of every record on the chain."""
    found, broken = _read(spark, path)
    if skip_damaged:
        return found.where("record_type IS NOT NULL").select(*_FIELD_NAMES)
    first = broken.orderBy("file").first()
    if first is not None:
        raise ValueError(f"{first['file']} is damaged at byte {first['offset']}")
    wrong = F.raise_error(F.concat(F.lit("a payload is not what its headers say in "), F.col("file"))).cast("string")
    return found.withColumn("record_type", F.coalesce("record_type", wrong)).select(*_FIELD_NAMES)
