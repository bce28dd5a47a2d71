"""Source formats: classification by name, loading, own formats."""

from __future__ import annotations

import hashlib
import inspect
import re
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import concat_tables, sanitize, sanitize_cells
from ..plans.staging import staged
from .delimited import scan_delimited, to_raw_columns
from .html import scan_html
from .textsalvage import drop_noise, scan_text_tables
from .workbook import scan_workbooks

Loader = Callable[[SparkSession, list[str]], DataFrame]


@dataclass(frozen=True)
class SourceFormat:
    """name and aliases (extensions, media types) of a format, and how to scan its files.

    The loader returns raw columns with the source columns `_src_path`, `_src_tz`,
    `_src_degraded`, `_row_ord`. `written` tells that its rows come from written tables, so
    they may be read several times.
    """

    name: str
    aliases: tuple[str, ...]
    load: Loader
    written: bool = False


FORMATS: dict[str, SourceFormat] = {}
_LOOKUP: dict[str, str] = {}


def register(fmt: SourceFormat) -> None:
    """Add a format. A repeated name is an error, a taken alias is overridden with a warning."""
    if fmt.name in _LOOKUP:
        raise ValueError(f"format {fmt.name} is already registered")
    FORMATS[fmt.name] = fmt
    _LOOKUP[fmt.name] = fmt.name
    for alias in fmt.aliases:
        if alias in _LOOKUP:
            warnings.warn(f"alias {alias} now stands for {fmt.name}", stacklevel=2)
        _LOOKUP[alias] = fmt.name


def format_of(path: Column, hint: str | None = None) -> Column:
    """Format of a file name: the hint if known, else the extension, else an extension
    that begins like a registered one; null if nothing fits."""
    if hint and hint.lower() in _LOOKUP:
        return F.lit(_LOOKUP[hint.lower()])
    if hint:
        warnings.warn(f"unknown format {hint}; using the file name", stacklevel=2)
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    exact = F.create_map(*[F.lit(x) for pair in _LOOKUP.items() for x in pair])
    out = F.try_element_at(exact, suffix)
    for alias, name in _LOOKUP.items():
        starts = (suffix != "") & F.startswith(F.lit(alias), suffix)
        out = F.coalesce(out, F.when(starts, F.lit(name)))
    return out


def list_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path and length of the files, without reading them."""
    return spark.read.format("binaryFile").load(paths).select("path", "length")


def classify(files: DataFrame, hint: str | None = None) -> DataFrame:
    return files.withColumn("format", format_of(F.col("path"), hint))


#: Larger files are digested through a buffer instead of as one value.
WHOLE_BYTES = 256 << 20


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of files read through a buffer of bounded size."""
    for batch in batches:
        sums = []
        for path in batch["path"]:
            files, name = pa_fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if re.match("file:/[^/]", path) else path)
            digest = hashlib.sha256()
            with files.open_input_stream(name) as stream:
                while block := stream.read(8 << 20):
                    digest.update(block)
            sums.append(digest.hexdigest())
        yield pd.DataFrame({"path": batch["path"], "checksum": sums})


def checksums(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, checksum): SHA-256 of each file, empty text for a given path that is not there.

    Files up to WHOLE_BYTES are digested by Spark as one value each, larger ones in a task
    that streams them.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    there = [p for p in given if _exists(spark, p)]
    absent = spark.createDataFrame([(p, "") for p in given if p not in there], "path string, checksum string")
    if not there:
        return absent
    files = spark.read.format("binaryFile").load(there)
    small = files.where(F.col("length") <= WHOLE_BYTES).select("path", F.sha2("content", 256).alias("checksum"))
    large = files.where(F.col("length") > WHOLE_BYTES).select("path")
    return small.unionByName(large.mapInPandas(_digests, "path string, checksum string")).unionByName(absent)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or a pattern of paths names something, asked of Spark's own file system."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = there.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(there)
    return found is not None and len(found) > 0


def load_flights(
    spark: SparkSession, paths: str | list[str], hint: str | None = None, noise: str | None = None, write: bool = False
) -> DataFrame:
    """Raw rows of files of any known format: one scan per format, united.

    A file of unknown format is an error. `noise` is a pattern of page headers and footers;
    rows with a cell that matches, and repeated header rows, are dropped. With `write` the rows
    of every format are written, so that they may be read several times and keep their order.
    """
    found: dict[str, list[str]] = {}
    # File names, as in Spark's own file index; one at a time.
    for r in classify(list_files(spark, paths), hint).orderBy("format", "path").toLocalIterator():
        found.setdefault(r.format, []).append(r.path)
    if None in found:
        raise ValueError(f"unknown source format: {found[None][:5]}")
    if not found:
        raise ValueError(f"no files in {paths}")
    tables = []
    for name in sorted(found):
        load = FORMATS[name].load
        own = {"noise": noise} if noise and "noise" in inspect.signature(load).parameters else {}
        rows = load(spark, found[name], **own)
        tables.append(staged(rows, "raw") if write and not FORMATS[name].written else rows)
    return concat_tables(*tables)


def _cells(cells: DataFrame, noise: str | None) -> DataFrame:
    return sanitize_cells(cells if noise is None else drop_noise(cells, noise))


def _load_csv(spark: SparkSession, files: list[str]) -> DataFrame:
    return sanitize(to_raw_columns(scan_delimited(spark, files, mixed_headers=len(files) > 1)))


def _load_html(spark: SparkSession, files: list[str], noise: str | None = None) -> DataFrame:
    return _cells(scan_html(spark, files), noise)


def _load_xlsx(spark: SparkSession, files: list[str], noise: str | None = None) -> DataFrame:
    return _cells(scan_workbooks(spark, files), noise)


def _load_text(spark: SparkSession, files: list[str], noise: str | None = None) -> DataFrame:
    return _cells(scan_text_tables(spark, files), noise)


# Names and aliases of the built-in formats.
register(SourceFormat("csv", ("text/csv",), _load_csv, written=True))
register(
    SourceFormat("xlsx", ("xlsm", "application/vnd.ms-excel", "application/vnd.openxmlformats"), _load_xlsx)
)
register(SourceFormat("html", ("htm", "text/html"), _load_html))
register(SourceFormat("pdf", ("application/pdf",), _load_text))
