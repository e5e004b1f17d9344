"""File sources: plan and event CSV files, landed JSON pages.

CSV columns are read as text by header name and parsed by expressions, so a bad value rejects or
defaults its own row and never fails the scan.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from parceltide import constants as K, schemas
from parceltide.functions import derive, parse
from parceltide.operators.shaping import clean_columns

REJECT = "reject_reason"
_ARRIVAL = "struct<file_time timestamp, file string, block bigint, row bigint>"


_HEADER_READERS = 16
_ROWS_PER_FILE = 1_000_000


def files_by_header(spark: SparkSession, path: str) -> dict[str | None, list[str]]:
    """The files below ``path`` grouped by their first line that is not blank, None for files without one.

    Only the beginning of each file is read, through the file system the path belongs to.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def header(name: str) -> tuple[str, str | None]:
        target = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        stream = target.getFileSystem(conf).open(target)
        try:
            codec = codecs.getCodec(target)
            text = codec.createInputStream(stream) if codec else stream
            lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8"))
            while (line := lines.readLine()) is not None:
                if line.strip():
                    return target.toString(), line.removeprefix("\ufeff")
            return target.toString(), None
        finally:
            stream.close()

    names = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(_HEADER_READERS) as pool:
        found = list(pool.map(header, names))
    groups: dict[str | None, list[str]] = {}
    for name, line in found:
        groups.setdefault(line, []).append(name)
    return groups


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with headers, quickly compressed. A compressed file is read by one task, so files are many."""
    df.write.option("header", True).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option(
        "maxRecordsPerFile", _ROWS_PER_FILE).csv(path)


def read_csv_groups(spark: SparkSession, path: str, multiline: bool = False,
                    with_arrival: bool = False) -> list[DataFrame]:
    """CSV files with headers, every column as text: one DataFrame for all files with the same header line, so that
    columns are found by name whatever their order or number. ``multiline`` allows line breaks inside
    quotes at the price of unsplittable files."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).option(
        "enforceSchema", False)
    groups = files_by_header(spark, path)
    groups.pop(None, None)
    if not groups:
        return [spark.createDataFrame([], "parcel_id string" + (f", arrival {_ARRIVAL}" if with_arrival else ""))]
    frames = []
    for line in sorted(groups):
        raw = reader.csv(groups[line])
        frames.append(clean_columns(raw.select("*", file_arrival().alias("arrival")) if with_arrival else raw))
    return frames


def read_csv_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """CSV files with headers as one DataFrame of text; a column that a file does not have is NULL there."""
    return _united(read_csv_groups(spark, path, multiline))


def _united(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _text(df: DataFrame, name: str, missing: str = "") -> Column:
    """Text of a column: empty where blank, ``missing`` where the file has no such column."""
    return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit(missing)


def file_arrival() -> Column:
    """Position of a row in the order the files arrived: file time, file, block, row."""
    return F.struct(
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def parse_planned(raw: DataFrame) -> DataFrame:
    """All plan rows, parsed; ``reject_reason`` names what is wrong with a row that is skipped.

    Numbers that do not parse count as 0 and are reported by ``bad_number`` only.
    """
    parcel = F.trim(_text(raw, "parcel_id"))
    times = {c: parse.timestamp(_text(raw, c)) for c in ("planned_pickup", "planned_delivery")}
    numbers = {c: _text(raw, c) for c in ("congestion_level", "distance_km", "weight_kg")}
    bad_number = F.lit(False)
    for text in numbers.values():
        bad_number = bad_number | ((F.trim(text) != "") & parse.number(text).isNull())
    columns: dict[str, Column] = {
        "parcel_id": parcel,
        **{c: _text(raw, c) for c in ("client_id", "route_id", "hub_id", "dest_hub_id")},
        **times,
        "weather_condition": _text(raw, "weather_condition", K.DEFAULT_WEATHER),
        **{c: parse.number_or_zero(text) for c, text in numbers.items()},
    }
    bad_time = times["planned_pickup"].isNull() | times["planned_delivery"].isNull()
    return raw.select(
        *[columns[c].alias(c) for c in schemas.PLANNED.names],
        bad_number.alias("bad_number"),
        F.when(parcel == "", "blank_parcel_id").when(bad_time, "bad_timestamp").alias(REJECT),
        *[F.col(c) for c in ("arrival",) if c in raw.columns],
    )


def parse_events(raw: DataFrame) -> DataFrame:
    """All event rows, parsed; rows whose time has none of the accepted layouts are rejected."""
    when = parse.replay_timestamp(_text(raw, "event_timestamp"))
    parcel, kind = _text(raw, "parcel_id"), _text(raw, "event_type")
    return raw.select(
        derive.event_id(parcel, kind, when).alias("event_id"),
        parcel.alias("parcel_id"), kind.alias("event_type"),
        when.alias("event_timestamp"),
        _text(raw, "event_timestamp").alias("event_timestamp_text"),
        _text(raw, "hub_id").alias("hub_id"),
        parse.number_or_zero(_text(raw, "latitude")).alias("latitude"),
        parse.number_or_zero(_text(raw, "longitude")).alias("longitude"),
        F.when(when.isNull(), "bad_timestamp").alias(REJECT),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECT).isNull()).drop(REJECT, "bad_number")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECT).isNotNull())


def scan_planned(spark: SparkSession, path: str) -> DataFrame:
    """Plan rows of CSV files, with their arrival order for upserts."""
    return accepted(_united([parse_planned(raw) for raw in read_csv_groups(spark, path, with_arrival=True)]))


def scan_events(spark: SparkSession, path: str) -> DataFrame:
    """Event rows of CSV files in replay order.

    The order among copies of one event means nothing; the random last key lets the range
    partitioning spread them when there are very many.
    """
    events = accepted(_united([parse_events(raw) for raw in read_csv_groups(spark, path)]))
    return events.orderBy("event_timestamp", "event_id", F.rand(11))


def scan_training(spark: SparkSession, planned_path: str, events_path: str) -> tuple[DataFrame, DataFrame]:
    """The two training files with tolerant times: a time that does not parse is NULL and the
    row stays."""
    plan_raw, event_raw = (read_csv_text(spark, p) for p in (planned_path, events_path))
    plan = plan_raw.select(*[
        typed(plan_raw, field).alias(field.name) for field in schemas.PLANNED.fields
        if field.name in plan_raw.columns
    ])
    parcel, kind, when = (F.col(c) if c in event_raw.columns else F.lit(None).cast("string")
                          for c in ("parcel_id", "event_type", "event_timestamp"))
    events = event_raw.select(parcel.alias("parcel_id"), kind.alias("event_type"),
                              parse.timestamp(when).alias("event_timestamp"))
    return plan, events


def typed(df: DataFrame, field: T.StructField) -> Column:
    if isinstance(field.dataType, T.TimestampNTZType):
        return parse.timestamp(F.col(field.name))
    if isinstance(field.dataType, T.DoubleType):
        return parse.number(F.col(field.name))
    return F.col(field.name)


def flatten_pages(spark: SparkSession, path: str, row_schema: T.StructType,
                  n_rows: int | None = None, one_page_per_file: bool = False) -> DataFrame:
    """Records of landed ``{"rows": [{"row": {...}}, ...]}`` pages, at most ``n_rows`` of them."""
    page = T.StructType([T.StructField("rows", T.ArrayType(
        T.StructType([T.StructField("row", row_schema)])
    ))])
    rows = (
        spark.read.schema(page).option("multiLine", one_page_per_file).json(path)
        .select(F.explode("rows").alias("item")).select("item.row.*")
    )
    return rows if n_rows is None else rows.limit(n_rows)


def parse_latlon_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Split ``"lat,lon"`` text columns; maps column name to the prefix of the two new columns."""
    for name, prefix in columns.items():
        point = parse.latlon(F.col(f"`{name}`"))
        df = df.withColumns({f"{prefix}_lat": point["lat"], f"{prefix}_lon": point["lon"]})
    return df
