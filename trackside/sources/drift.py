"""Schema drift of landed files: every footer against the declared schema.

Readers declare their schema, so a column that a file has under another name reads as NULL without a word.
Spark lists the files and deals them to tasks; each task reads the footers of its files, and nothing
but the footers, through Arrow's file systems.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOUND = "file string, rows bigint, column_name string, problem string, declared string, found string"
#: Footers that a task reads.
FILES_PER_TASK = 200


def _kind(kind: pa.DataType) -> str:
    """The name Spark has for a stored type; Arrow's own name for one that no declared column has."""
    names = (
        (pa.types.is_string, "string"), (pa.types.is_large_string, "string"), (pa.types.is_int64, "bigint"),
        (pa.types.is_int32, "int"), (pa.types.is_float64, "double"), (pa.types.is_float32, "float"),
        (pa.types.is_boolean, "boolean"), (pa.types.is_date32, "date"),
    )
    for test, name in names:
        if test(kind):
            return name
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    return str(kind)


def _footer(path: str) -> tuple[int, dict[str, tuple[str, str]]]:
    """The number of rows of a file, and its columns (name, type) by their names in lower case, as Spark matches them."""
    # Spark lists paths as they are, and local ones as file:/x; Arrow wants them quoted.
    if path.startswith("file:"):
        files, place = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    else:
        files, place = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    with files.open_input_file(place) as source:
        footer = pq.ParquetFile(source)
        return footer.metadata.num_rows, {
            f.name.lower(): (f.name, _kind(f.type)) for f in footer.schema_arrow
        }


def _in_path(path: str) -> set[str]:
    """The columns that directories of a path give (``session_id=…``)."""
    return {p.partition("=")[0].lower() for p in path.split("/")[:-1] if "=" in p}


def schema_drift(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What the parquet files below ``path`` have otherwise than declared, one row for each file and column.

    ``problem`` is ``missing`` (declared, but in no column of the file and no directory: reads as NULL),
    ``undeclared`` (in the file, but never read), ``type`` (another type than declared) or ``unreadable``
    (no footer; no column, no number of rows). ``rows`` is the number of rows in the file. An empty result passes.
    """
    declared = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in schema}

    def problems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "rows", "column_name", "problem", "declared", "found"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            found = []
            for file in batch.column("path").to_pylist():
                try:
                    rows, columns = _footer(file)
                except pa.ArrowInvalid as error:
                    found.append((file, None, None, "unreadable", None, str(error).split("\n")[0]))
                    continue
                placed = _in_path(file)
                for key, (name, kind) in declared.items():
                    if key not in columns and key not in placed:
                        found.append((file, rows, name, "missing", kind, None))
                    elif key in columns and columns[key][1] != kind:
                        found.append((file, rows, name, "type", kind, columns[key][1]))
                found += [
                    (file, rows, name, "undeclared", None, kind)
                    for key, (name, kind) in columns.items() if key not in declared
                ]
            by_column = list(zip(*found, strict=True)) or [[]] * len(names)
            arrays = [pa.array(v, k) for v, k in zip(by_column, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").load(path).select("path")
    )
    tasks = max(1, -(-files.count() // FILES_PER_TASK))
    return files.repartition(tasks, F.xxhash64("path")).mapInArrow(problems, FOUND)
