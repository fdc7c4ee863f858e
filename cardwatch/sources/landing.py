"""Landing-area readers.

One landing folder holds, per business date D (tag ``DDMMYYYY``):
  transactions_<tag>.txt        ';'-separated text with a header
  terminals_<tag>.<ext>         full terminal snapshot (csv or parquet)
  passport_blacklist_<tag>.<ext>
A "file" may also be a folder of part files written by Spark (for example a
``partitionBy`` directory whose name ends in ``..._<tag>.txt``); readers and
date discovery only look at the ``_<tag>.`` part of the path.
"""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import amount, file_date
from ..schemas import LANDING_BLACKLIST, LANDING_TERMINALS, LANDING_TRANSACTIONS

TRANSACTIONS = "transactions"
TERMINALS = "terminals"
BLACKLIST = "passport_blacklist"
KINDS = (TRANSACTIONS, TERMINALS, BLACKLIST)
SEP = ";"

#: A landing file: the last part of its path that is <kind>_<DDMMYYYY>.<...>, maybe as the
#: value of a Spark partition folder ("name=<file>"). Folders above it have no say.
FILE = (r"^(.*/(?:[^/=]*=)?(" + "|".join(KINDS) + r")_(\d{8})\.[^/]*)(?:/[^/]*)*$")

EXT = {"csv": "csv", "text": "txt", "parquet": "parquet"}


def tag(day: dt.date) -> str:
    return day.strftime("%d%m%Y")


def _glob(root: str, kind: str, day: dt.date | None, ext: str) -> str:
    # The leading '*' also matches Spark partition folders ("name=<file>").
    stamp = tag(day) if day is not None else "[0-9]*"
    return f"{root.rstrip('/')}/*{kind}_{stamp}.{ext}"


def _is_missing(exc: Exception) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "does not exist" in text


def _require(names, schema, path: str) -> None:
    missing = [n for n in schema.fieldNames() if n not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")


def _csv_text(spark: SparkSession, schema, paths: str | Sequence[str]) -> DataFrame:
    """All columns of ';'-separated files as text, by the names of the header. Files of one
    pattern must have the same header (Spark checks each against the first one's); listed
    files are read together with those of the same header, whose first line is looked at."""
    reader = spark.read.option("sep", SEP).option("header", True)
    if isinstance(paths, str):
        groups = {tuple(reader.csv(paths).columns): [paths]}
    else:
        groups: dict[tuple, list[str]] = {}
        for p in paths:
            head = next(csv.reader([config.first_line(spark, p)], delimiter=SEP), [])
            groups.setdefault(tuple(head), []).append(p)
    parts = []
    for names, files in groups.items():
        _require(names, schema, files[0])
        text = ", ".join(f"`{n}` string" for n in names)
        part = reader.schema(text).option("enforceSchema", False).csv(files)
        parts.append(part.select(*[F.col(f"`{n}`") for n in schema.fieldNames()],
                                 F.col("_metadata.file_path").alias("_path")))
    return reduce(DataFrame.unionAll, parts)


def _typed(schema, skip=()) -> list:
    """The declared columns, by name; a value that does not fit becomes NULL."""
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields
            if f.name not in skip]


def _csv(spark: SparkSession, schema, path: str) -> DataFrame:
    return _csv_text(spark, schema, path).select(*_typed(schema))


def read_transactions(spark: SparkSession, root: str, day: dt.date | None = None,
                      paths: Sequence[str] | None = None) -> DataFrame:
    """Staged transactions of one date (``None``: all dates) or of listed files, typed. The
    amount accepts a decimal comma; a malformed value becomes NULL, not an error."""
    raw = _csv_text(spark, LANDING_TRANSACTIONS,
                    paths or _glob(root, TRANSACTIONS, day, "txt"))
    return raw.select(*_typed(LANDING_TRANSACTIONS, skip=("amount",)),
                      amount("amount").alias("amount"), file_date("_path").alias("file_date"))


def rejected_transactions(spark: SparkSession, root: str, day: dt.date | None = None,
                          paths: Sequence[str] | None = None) -> DataFrame:
    """The raw rows whose time or amount does not parse, with ``reason`` and ``file_date``."""
    raw = _csv_text(spark, LANDING_TRANSACTIONS,
                    paths or _glob(root, TRANSACTIONS, day, "txt"))
    time = F.col("transaction_date").try_cast("timestamp_ntz").isNull()
    value = F.col("amount").isNotNull() & amount("amount").isNull()
    return (raw.select(*LANDING_TRANSACTIONS.fieldNames(),
                       F.when(time, "transaction_date").when(value, "amount").alias("reason"),
                       file_date("_path").alias("file_date"))
            .filter("reason IS NOT NULL"))


def _snapshot(spark: SparkSession, root: str, kind: str, schema, day, fmt: str,
              paths: Sequence[str] | None = None) -> DataFrame:
    """A snapshot file; a missing one reads as empty. The daily run tells the two apart
    before (:func:`landing_kinds`): it needs all files of a date."""
    from pyspark.errors import AnalysisException
    path = _glob(root, kind, day, EXT[fmt])
    try:
        if fmt == "parquet":
            raw = spark.read.parquet(*(paths or [path]))
            _require(raw.columns, schema, path)
            raw = raw.withColumn("_path", F.col("_metadata.file_path"))
        else:
            raw = _csv_text(spark, schema, paths or path)
    except AnalysisException as exc:
        if not _is_missing(exc):
            raise
        return spark.createDataFrame([], schema).withColumn("file_date",
                                                            F.lit(None).cast("date"))
    return raw.select(*_typed(schema), file_date("_path").alias("file_date"))


def read_terminals(spark: SparkSession, root: str, day: dt.date | None = None,
                   fmt: str = "csv", paths: Sequence[str] | None = None) -> DataFrame:
    """Full terminal snapshots stamped with the dates of their file names."""
    return _snapshot(spark, root, TERMINALS, LANDING_TERMINALS, day, fmt, paths)


def read_blacklist(spark: SparkSession, root: str, day: dt.date | None = None,
                   fmt: str = "csv", paths: Sequence[str] | None = None) -> DataFrame:
    return _snapshot(spark, root, BLACKLIST, LANDING_BLACKLIST, day, fmt, paths).drop("file_date")


def stamped_blacklist(spark: SparkSession, root: str, paths: Sequence[str],
                      fmt: str = "csv") -> DataFrame:
    """Blacklist rows of listed files with the dates of their names."""
    return _snapshot(spark, root, BLACKLIST, LANDING_BLACKLIST, None, fmt, paths)


def landing_files(spark: SparkSession, root: str) -> DataFrame:
    """(file_date, kind, path) of the landing files, a folder of part files being one.

    Lists files with the ``binaryFile`` source selecting only ``path``, so no
    file content is read; file listing is distributed by Spark for large
    folders."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(root.rstrip("/")).select("path"))
    part = [F.regexp_extract("path", FILE, k) for k in (1, 2)]
    return (files.select(part[0].alias("path"), part[1].alias("kind"))
                 .filter("kind <> ''").distinct()
                 .select(file_date("path").alias("file_date"), "kind", "path")
                 .filter("file_date IS NOT NULL"))


def landing_kinds(spark: SparkSession, root: str) -> DataFrame:
    """(file_date, kinds): which kinds of files each business date has."""
    return landing_files(spark, root).groupBy("file_date").agg(
        F.array_sort(F.collect_set("kind")).alias("kinds"))


def landing_dates(spark: SparkSession, root: str) -> DataFrame:
    """Distinct business dates of which all files are there."""
    return (landing_kinds(spark, root).filter(F.size("kinds") == len(KINDS))
            .select("file_date"))


def write_landing(df: DataFrame, root: str, kind: str, date_col: str, fmt: str = "csv",
                  ext: str | None = None) -> None:
    """Write rows as landing files, one per business date in ``date_col``
    (a single distributed write; each date becomes a ``*_<tag>.<ext>`` folder)."""
    ext = ext or EXT[fmt]
    named = df.withColumn("_file", F.concat(F.lit(f"{kind}_"),
                                            F.date_format(F.col(date_col), "ddMMyyyy"),
                                            F.lit(f".{ext}"))).drop(date_col)
    if fmt != "parquet":  # times as text, with the fraction that they have
        named = named.select(*[F.col(f.name).cast("string").alias(f.name)
                               for f in named.schema.fields])
    w = named.write.mode("append").partitionBy("_file")
    if fmt == "parquet":
        w.parquet(root)
    else:
        w.option("sep", SEP).option("header", True).csv(root)


def read_seed(spark: SparkSession, path: str, schema, fmt: str = "csv") -> DataFrame:
    """A seed table (cards, accounts or clients) with its declared schema:
    ';'-CSV with a header, or Parquet. Identifiers stay text (client ids such
    as ``VIP-9807`` occur)."""
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    return _csv(spark, schema, path)
