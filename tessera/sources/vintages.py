"""Sources: vintage files with a quarantine for malformed lines, and unemployment series."""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import is_period, month_number, number, period, stripped
from ..functions.schemas import STATES, SUFFIX, TABLES, schema
from . import sinks
from .shared import exists, placed, removed


def vintage_path(base: str, year: int, kind: str) -> str:
    schema(kind)
    return f"{base}/sample_{year}/sample_{SUFFIX[kind]}_{year}.txt"


def _readable(spark: SparkSession, path: str) -> bool:
    files, place = placed(spark, path)
    try:
        files.open(place).close()
    except Py4JJavaError:
        return False
    return True


def vintage_files(spark: SparkSession, base: str, years: Iterable[int], kind: str, on_missing: str = "warn") -> dict[int, str]:
    """The years' files, plain or packed (.gz after the name). A file that isn't there or can't be opened
    is left out with a warning, or raises FileNotFoundError with on_missing="raise"."""
    found = {}
    for year in years:
        path = vintage_path(base, year, kind)
        here = next((p for p in (path, f"{path}.gz") if _readable(spark, p)), None)
        if here:
            found[year] = here
        elif on_missing == "raise":
            raise FileNotFoundError(path)
        else:
            warnings.warn(f"no file that can be read: {path}", stacklevel=3)
    return found


SPREAD_BYTES = 4 << 20  # packed files of more bytes have their lines dealt to all tasks


def _lines(spark: SparkSession, paths: Iterable[str], spread: bool = True) -> DataFrame:
    """Lines (value, vintage). A packed file is read by one task; with `spread`, lines of large ones are
    dealt to all tasks before they are parsed, which costs far more than to unpack them."""
    if not (paths := list(paths)):
        return spark.createDataFrame([], "value string, vintage int")
    lines = spark.read.text(paths).select("value", F.regexp_extract(F.col("_metadata.file_path"), r"_(\d+)\.txt(?:\.gz)?$", 1).try_cast("int").alias("vintage"))
    if spread and sum(_size(spark, p) for p in paths if p.endswith(".gz")) > SPREAD_BYTES:
        lines = lines.withColumn("__n", F.monotonically_increasing_id()).repartition("__n").drop("__n")
    return lines


def _size(spark: SparkSession, path: str) -> int:
    files, place = placed(spark, path)
    return files.getFileStatus(place).getLen()


def read_lines(spark: SparkSession, base: str, years: Iterable[int], kind: str, on_missing: str = "warn") -> DataFrame:
    """Lines (value, vintage) of many years in one scan; files as of vintage_files()."""
    return _lines(spark, vintage_files(spark, base, years, kind, on_missing).values())


def broken_files(spark: SparkSession, files: dict[int, str]) -> dict[int, str]:
    """Which of the files (by vintage) can't be read to their end, and why. All are read by one job;
    only if it fails are halves of them read on their own, and so on: a few jobs for each broken
    file, however many others there are."""
    if not files:
        return {}
    try:
        _lines(spark, files.values(), spread=False).agg(F.sum(F.octet_length("value"))).collect()
    except (PySparkException, Py4JJavaError) as e:
        if len(files) == 1:
            text = str(e)
            reason = re.search(r"(?:Caused by: )?(\w+(?:\.\w+)*(?:Exception|Error)): ([^\n]*)\Z|\[(FAILED_READ_FILE[^\]]*)\]", text)
            return {y: (reason[0] if reason else text.split("\n")[0])[:200] for y in files}
        years = list(files)
        half = len(years) // 2
        return {k: v for part in (years[:half], years[half:]) for k, v in broken_files(spark, {y: files[y] for y in part}).items()}
    return {}


def _fields(lines: DataFrame) -> DataFrame:
    """lines with their fields, stripped of white space all at once."""
    return lines.withColumn("__f", F.split(F.regexp_replace(stripped(F.col("value")), r"(?U)\s*\|\s*", "|"), r"\|", -1))


def parse(lines: DataFrame, kind: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows of the lines in column value with the right number of fields. Fields are
    stripped; an empty text stays empty, a number that can't be read is null. `extra`: further
    columns of lines to keep."""
    return _typed(_fields(lines), kind, extra)


def _typed(rows: DataFrame, kind: str, extra: tuple[str, ...] = ()) -> DataFrame:
    fields = schema(kind)
    good = rows.where(F.size("__f") == len(fields))
    at = lambda i: F.col("__f")[i]
    return good.select(*[(number(at(i)) if f.dataType.simpleString() == "double" else at(i)).alias(f.name) for i, f in enumerate(fields)], *extra)


REPORT = "vintage int, state string, n_rows long, n_rejected long, reason string"


def load_vintages(spark: SparkSession, base: str, years: Iterable[int], kind: str, folder: str, batch: int | str, on_missing: str = "warn", dedup_keys: list[str] | None = None) -> DataFrame:
    """Loads the years' files into their base table as one batch (sinks.load_batch) and returns a
    report, a row for each year: state ("loaded", "missing", "broken"), n_rows, n_rejected (lines with
    another number of fields), reason.

    A file that breaks while it is read (truncated, damaged), or has bytes that aren't UTF-8, costs its
    own rows only: nothing of it is loaded. Counts come from the write itself, which is the only scan
    where all files are sound; broken files are looked for when it fails, and it is repeated
    without them. With on_missing="raise", missing and broken files raise. A batch that the table
    has already isn't loaded again; its report has the state "held"."""
    years, name = list(years), TABLES[kind]
    if exists(spark, f"{folder}/{name}/batch={batch}"):
        return spark.createDataFrame([(y, "held", None, None, None) for y in years], REPORT)
    files = vintage_files(spark, base, years, kind, on_missing)
    held = sinks.base_table(spark, folder, name) if exists(spark, f"{folder}/{name}") else None
    broken: dict[int, str] = {}
    while True:
        sound = {y: p for y, p in files.items() if y not in broken}
        rows, good, seen = _fields(_lines(spark, sound.values())), F.size("__f") == len(schema(kind)), Observation()
        of = lambda y: F.col("vintage") == y
        counts = [x for y in sound for x in (F.count_if(of(y) & good).alias(f"rows_{y}"), F.count_if(of(y) & ~good).alias(f"rejected_{y}"), F.count_if(of(y) & ~F.is_valid_utf8("value")).alias(f"invalid_{y}"))]
        observed = rows.observe(seen, *counts) if counts else rows
        try:
            path = sinks.staged(sinks.new_rows(_typed(observed, kind), held, dedup_keys), name, folder)
        except (PySparkException, Py4JJavaError):
            if on_missing == "raise" or not (found := broken_files(spark, sound)):
                raise
            broken |= found
            continue
        got = seen.get if counts else {}
        invalid = {y: "bytes that aren't UTF-8" for y in sound if got[f"invalid_{y}"]}
        if not invalid:
            break
        removed(spark, path)
        if on_missing == "raise":
            raise ValueError(f"bytes that aren't UTF-8: {[files[y] for y in invalid]}")
        broken |= invalid
    sinks.commit_batch(spark, path, name, folder, batch)
    for y in broken:
        warnings.warn(f"left out, as it can't be read: {files[y]} ({broken[y]})", stacklevel=2)
    report = [(y, "broken", None, None, broken[y]) if y in broken else (y, "loaded", got[f"rows_{y}"], got[f"rejected_{y}"], None) if y in files else (y, "missing", None, None, None) for y in years]
    return spark.createDataFrame(report, REPORT)


def quarantine(lines: DataFrame, kind: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """The other lines: their number of fields and first 50 characters."""
    bad = _fields(lines).where(F.size("__f") != len(schema(kind)))
    return bad.select(F.size("__f").alias("n_fields"), F.substring(stripped(F.col("value")), 1, 50).alias("head"), *extra)


def audit(lines: DataFrame, kind: str) -> DataFrame:
    """Rows read and lines rejected by vintage."""
    good = F.size("__f") == len(schema(kind))
    return _fields(lines).groupBy("vintage").agg(F.count_if(good).alias("n_rows"), F.count_if(~good).alias("n_rejected"))


def key_check(table: DataFrame, columns: list[str]) -> DataFrame:
    """How many months (yyyyMM) each of the columns lacks (null or empty) or has in another form:
    one row per column. The time split and the joins compare them as text, so check them at ingest."""
    long = table.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("key")) for c in columns])).alias("x")).select("x.*")
    missing = F.coalesce(F.col("key"), F.lit("")) == ""
    return long.groupBy("column").agg(F.count("*").alias("n_rows"), F.count_if(missing).alias("n_missing"), F.count_if(~missing & ~is_period(F.col("key"))).alias("n_invalid"))


def unemployment(observations: DataFrame, numbers: bool = False) -> DataFrame:
    """(date yyyyMM, unemp, state) from observations (series_id, date, value) of the series
    <state>UR of the known states; date may be a date, a timestamp, or year * 100 + month. With
    numbers, date is a date or timestamp and comes out as the number year * 100 + month."""
    state = F.substring("series_id", 1, 2)
    rows = observations.where(F.col("series_id").rlike("^[A-Z]{2}UR$") & state.isin(STATES))
    date = month_number(F.col("date")) if numbers else period(F.col("date"), observations.schema["date"].dataType.simpleString())
    return rows.select(date.alias("date"), F.col("value").cast("double").alias("unemp"), state.alias("state"))
