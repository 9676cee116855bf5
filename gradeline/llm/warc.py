"""WARC archives: writing pages as response and revisit records, and reading records back.

Archives are read in splits, cut wherever the magic of a record occurs, also inside payloads. A piece
that looks like a record header says by its length where the next record must start. Pieces that lead
straight to the next one form runs; where a run ends, its last piece points into another run. Pointer
jumping from the start of each file over these few runs finds which are reached, and where; only what is
reached is a record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeline.llm.frames import id_key
from gradeline.sources.tables import keep
from gradeline.session import shared_folder

MIN_REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
MAGIC = "WARC/1."
#: A header has no line that starts with the magic, so no header is ever cut, and the separator has no
#: overlap with itself, so all splits agree on where it occurs.
SEPARATOR = "\r\n" + MAGIC
END = "\r\n\r\n"
#: Bytes of an archive that share a join key when cut payloads are put together.
REACH = 1 << 20


def first_pages(pages: DataFrame, html: str, page_id: str, least: int) -> DataFrame:
    """(_digest, _first): payloads of at least ``least`` bytes that several ids have, and the smallest id."""
    payload = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    sized = pages.select(id_key(page_id).alias("_id"), F.sha2(payload, 256).alias("_digest"), F.octet_length(payload).alias("_n"))
    groups = sized.where(F.col("_n") >= least).groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    return groups.where(F.col("_first") < F.col("_last")).drop("_last")


def write_archive(
    pages: DataFrame, path: str, html: str = "html", page_id: str = "page_id", url: str = "url",
    least: int = MIN_REVISIT_BYTES, date: str = DATE, compression: str = "gzip", records_per_file: int = 20_000,
) -> None:
    """A record per row of ``pages``; the payload is the html in UTF-8, empty for NULL.

    Of the rows with equal payloads of at least ``least`` bytes, those with the smallest id are
    responses; the others are revisits without payload that name its digest and the id. Rows without
    id sort last and name none. Line feeds in a url are escaped. An empty table writes no record.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), id_key(page_id).alias("_id"),
        F.col(f"`{html}`").alias("html"), F.regexp_replace(F.col(f"`{url}`"), "[\r\n]", "%0A").alias("url"),
        F.sha2(F.coalesce(F.col(f"`{html}`"), F.lit("")), 256).alias("_digest"),
    )
    firsts = keep(first_pages(pages, html, page_id, least), "first_pages")
    revisit = F.col("_first") < F.col("_id")

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value), F.lit(""))

    uri = lambda n: F.concat(F.lit("<urn:page:"), n.cast("string"), F.lit(">"))
    body = F.when(revisit, F.lit("")).otherwise(payload)
    record = F.concat(
        F.lit(MAGIC + "1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        line("WARC-Record-ID", uri(F.col("page_id"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
        line("WARC-Refers-To", F.when(revisit, uri(F.col("_first")))),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(END), body,
    )
    joined = rows.join(firsts, "_digest", "left").select(record.alias("value"))
    writer = joined.write.option("lineSep", END).option("compression", compression)
    writer.option("maxRecordsPerFile", records_per_file).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magics: file, split and order, length in bytes, and the header if it is one.

    ``exact``: as a record, the piece ends where the next magic is. ``digest``: of the payload, if the
    piece holds all of it. Bytes are there once, as ``raw``.
    """
    read = spark.read.option("lineSep", SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("turn"), F.col("value").alias("raw"),
    )
    opening = F.startswith("raw", F.lit(MAGIC))  # only the piece at the start of a file still has its magic
    cut = read.withColumn("skip", F.when(opening, F.lit(len(MAGIC))).otherwise(F.lit(0)))
    # Where a payload begins with the magic, the separator has taken half of the header's end.
    header = F.when(F.contains("raw", F.lit(END)), F.substring_index("raw", END, 1)).when(
        F.endswith("raw", F.lit("\r\n")), F.substring("raw", F.lit(1), F.char_length("raw") - 2)
    )
    sized = cut.withColumns({"header": header, "bytes": F.octet_length("raw").cast("long")})
    body = F.regexp_extract("header", r"(?i)\r\nContent-Length:[ \t]*(\d{1,18})[ \t]*(\r\n|$)", 1)
    parsed = sized.withColumns({
        "head": (F.octet_length("header") - F.col("skip") + len(END)).cast("long"),
        "body": F.when(F.rlike("header", F.lit(r"^(WARC/1\.)?\d+\r\n")) & (body != ""), body.cast("long")),
    })
    rest = F.col("bytes") - F.col("skip") - F.col("head")
    return parsed.withColumns({
        "exact": F.coalesce(F.col("body") + 2 == rest, F.lit(False)),
        "digest": F.when(F.col("body") <= rest, F.sha2(payload_of(F.col("raw"), F.col("skip"), F.col("head"), F.col("body")), 256)),
    })


def payload_of(raw: Column, skip: Column, head: Column, body: Column) -> Column:
    """The bytes after the header, as many as it says or as there are."""
    return F.substring(raw.cast("binary"), (skip + head + 1).cast("int"), F.least(body, F.lit(2**31 - 1)).cast("int"))


def placed(index: DataFrame) -> DataFrame:
    """The pieces with ``at``, where their magic is, ``run``, and ``next``, where the record after them is.

    Lengths and ends of runs are summed within splits, and over the few splits of each file. The
    windows hold no payloads.
    """
    light = index.select(
        "file", "block", "turn", "bytes", "skip", "head", "body",
        (F.col("bytes") + len(SEPARATOR)).alias("span"), (~F.col("exact")).cast("long").alias("ends"),
    )
    inside = Window.partitionBy("file", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    totals = light.groupBy("file", "block").agg(F.sum("span").alias("spans"), F.sum("ends").alias("all_ends"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "file", "block", F.coalesce(F.sum("spans").over(before), F.lit(0)).alias("start"),
        F.coalesce(F.sum("all_ends").over(before), F.lit(0)).alias("first_run"),
    )
    own = light.withColumns({
        "in_block": F.coalesce(F.sum("span").over(inside), F.lit(0)),
        "run": F.coalesce(F.sum("ends").over(inside), F.lit(0)),
    })
    at = F.col("start") + F.col("in_block") - F.when(F.col("skip") > 0, 0).otherwise(len(MAGIC))
    return own.join(starts, ["file", "block"]).select(
        "file", "turn", "ends", "body", at.alias("at"), (F.col("first_run") + F.col("run")).alias("run"),
        (at + len(MAGIC) + F.col("head") + F.col("body") + len(END)).alias("next"),
    )


def reached_runs(rows: DataFrame) -> DataFrame:
    """(file, run, entry): the runs that the chain of each file comes to, and where it enters them."""
    ends = rows.where((F.col("ends") == 1) & F.col("next").isNotNull()).select("file", "run", "next")
    landing = rows.where(F.col("body").isNotNull()).select("file", F.col("at").alias("next"), F.col("run").alias("to"))
    jumps = keep(ends.join(landing, ["file", "next"]).select("file", "run", "to", F.col("next").alias("entry")), "jumps")
    # The chain starts at place 0, so the file must open with a record.
    opened = rows.where((F.col("at") == 0) & F.col("body").isNotNull())
    reached = keep(opened.select("file", "run", F.lit(0).cast("long").alias("entry")).distinct(), "reached")
    while not jumps.isEmpty():
        steps = jumps.select("file", F.col("run").alias("from"), "to", F.col("entry").alias("there"))
        came = reached.join(steps.withColumnRenamed("from", "run"), ["file", "run"])
        came = came.select("file", F.col("to").alias("run"), F.col("there").alias("entry"))
        reached = keep(reached.unionByName(came), "reached")
        onward = steps.select("file", F.col("from").alias("to"), F.col("to").alias("last"), "there")
        further = jumps.join(onward, ["file", "to"])
        jumps = keep(further.select("file", "run", F.col("last").alias("to"), F.col("there").alias("entry")), "jumps")
    return reached


def whole_payloads(index: DataFrame, rows: DataFrame, cut: DataFrame) -> DataFrame:
    """(file, turn, payload): payloads that contain magics, put together from the pieces they were cut into."""
    wanted = cut.select(
        "file", F.col("turn").alias("record"), "at", "next", "body",
        F.explode(F.sequence((F.col("at") / REACH).cast("long"), (F.col("next") / REACH).cast("long"))).alias("slot"),
    )
    located = rows.select("file", "turn", F.col("at").alias("place"), (F.col("at") / REACH).cast("long").alias("slot"))
    parts = located.join(wanted, ["file", "slot"]).where("place >= at AND place < next")
    # Kept, so that Spark knows how few pieces there are and leaves the others where they are.
    parts = keep(parts.select("file", "turn", "place", "record", "body"), "cut_pieces")
    raw = index.select("file", "turn", "raw", "skip", "head")
    texts = parts.join(raw, ["file", "turn"]).groupBy("file", "record", "body").agg(
        F.sort_array(F.collect_list(F.struct("place", "raw", "skip", "head"))).alias("parts")
    )
    joined = F.array_join(F.transform("parts", lambda p: p["raw"]), SEPARATOR).cast("binary")
    first = F.col("parts")[0]
    payload = payload_of(joined, first["skip"], first["head"], F.col("body"))
    return texts.select("file", F.col("record").alias("turn"), payload.alias("mended"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, header, body, digest, payload): the records of the archives under ``path``.

    ``at`` counts uncompressed bytes. ``body`` is the Content-Length and ``digest`` the SHA-256 of the
    payload as read. What no chain from the start of a file reaches is left out: magic inside payloads,
    and everything after a broken record. A record that the file cuts off has a NULL payload. A folder
    without records gives an empty table. A payload is held by one task at a time. Plain files are
    read in splits, compressed ones by one task each.
    """
    index = keep(pieces(spark, path), "pieces")
    rows = keep(placed(index), "placed")
    reached = reached_runs(rows)
    records = rows.where(F.col("body").isNotNull()).join(reached, ["file", "run"]).where(F.col("at") >= F.col("entry"))
    records = keep(records.select("file", "turn", "at", "next", "body"), "records")
    all_records = records.join(index.select("file", "turn", "header", "digest", "raw", "skip", "head"), ["file", "turn"])
    # A length that leads beyond the file, as a damaged one may, has no payload to put together.
    sizes = index.groupBy("file").agg(F.sum(F.col("bytes") + len(SEPARATOR)).alias("size"))
    missing = all_records.where(F.col("digest").isNull()).select("file", "turn", "at", "next", "body").join(sizes, "file")
    cut = keep(missing.where(F.col("next") <= F.col("size") + len(MAGIC + END + SEPARATOR)).drop("size"), "cut")
    out = all_records.join(keep(whole_payloads(index, rows, cut), "mended"), ["file", "turn"], "left")
    full = F.octet_length("mended") == F.col("body")
    own = payload_of(F.col("raw"), F.col("skip"), F.col("head"), F.col("body"))
    return out.select(
        "file", "at", "header", "body",
        F.coalesce("digest", F.when(full, F.sha2("mended", 256))).alias("digest"),
        F.when(F.col("digest").isNotNull(), own).when(full, F.col("mended")).alias("payload"),
    )


def header_field(name: str, pattern: str) -> Column:
    value = F.regexp_extract("header", rf"(?i)\r\n{name}:[ \t]*{pattern}[ \t]*(\r\n|$)", 1)
    return F.when(value != "", value)


def archive_report(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to an archive in the shared folder, read it back: one row per page.

    A revisit's size and digest are those of the response it refers to.
    """
    spark = pages.sparkSession
    path = shared_folder(spark, "warc")
    write_archive(pages.select("page_id", "url", "html"), path)
    read = read_archive(spark, path).select(
        header_field("WARC-Record-ID", r"<urn:page:(-?\d+)>").cast("long").alias("page_id"),
        header_field("WARC-Type", r"(\w+)").alias("record_type"),
        header_field("WARC-Refers-To", r"<urn:page:(-?\d+)>").cast("long").alias("refers_to"),
        header_field("WARC-Payload-Digest", r"sha256:([0-9a-f]+)").alias("said"), "body", "digest",
    )
    records = keep(read, "read")
    own = records.where(F.col("record_type") == "response").select(
        "page_id", F.col("body").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )
    named = records.where(F.col("record_type") == "revisit").select("page_id", "record_type", "refers_to", "said")
    target = own.select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("said"), "payload_bytes").distinct()
    again = named.join(target, ["refers_to", "said"], "left").select(
        "page_id", "payload_bytes", F.col("said").alias("payload_digest"), "record_type", "refers_to"
    )
    return own.unionByName(again)


REPORT_SQL = """
WITH sized AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
placed AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id
  FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM placed"""
