"""Readers and writers for tables, files and tensors."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.functions.images import image_tensor


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Header row; types inferred unless a schema is given; rows with too few or too many fields are dropped.

    Column pruning in the parser is turned off for this table, as a pruned read would count malformed rows that a full read drops.
    """
    reader = spark.read.option("header", True).option("mode", "DROPMALFORMED").option("columnPruning", False)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_by_format(spark: SparkSession, path: str) -> DataFrame:
    """The reader that the path's own suffix names."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    readers = {"csv": read_csv, "parquet": read_parquet}
    if suffix not in readers:
        raise ValueError(f"unsupported format: {suffix}")
    return readers[suffix](spark, path)


def read_feature_target(spark: SparkSession, path: str, features: str = "features", targets: str = "targets") -> DataFrame:
    """The two named columns as (features, target)."""
    df = spark.read.parquet(path)
    if missing := {features, targets} - set(df.columns):
        raise KeyError(f"columns not found: {sorted(missing)}")
    return df.select(F.col(features).alias("features"), F.col(targets).alias("target"))


_SAFETENSORS = {"F64": "<f8", "F32": "<f4", "F16": "<f2", "I64": "<i8", "I32": "<i4", "I16": "<i2", "I8": "<i1", "U8": "<u1", "BOOL": "?"}


#: Bytes of features that one task reads at a time.
RANGE_BYTES = 64 << 20


def tensor_header(content: bytes) -> dict:
    """Names, types, shapes and places (from the file's start) of the tensors of a safetensors file: an 8-byte header length, then a JSON header, then raw values."""
    size = int.from_bytes(content[:8], "little")
    header = json.loads(content[8 : 8 + size])
    return {k: v | {"start": 8 + size + v["data_offsets"][0]} for k, v in header.items() if k != "__metadata__"}


def _opened(path: str):
    """A file that can be read in parts, in any store that Arrow knows."""
    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, place = fs.FileSystem.from_uri(path)
    return store.open_input_file(place)


def _rows_of(file, about: dict, first: int, n: int) -> np.ndarray:
    """n rows of one tensor from `first` on."""
    kind = np.dtype(_SAFETENSORS[about["dtype"]])
    width = int(np.prod(about["shape"][1:], dtype=np.int64)) * kind.itemsize
    file.seek(about["start"] + first * width)
    return np.frombuffer(file.read(n * width), dtype=kind).reshape(n, *about["shape"][1:])


def read_safetensors(spark: SparkSession, path: str, features: str = "features", targets: str = "targets", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows (path, row, features, shape, target) of files whose two tensors have one first dimension.

    Headers are read first; then ranges of rows are dealt out, so that a large file is the work of many tasks, and none holds more than range_bytes of it.
    """

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with _opened(path) as file:
                    size = int.from_bytes(file.read(8), "little")
                    found = tensor_header(size.to_bytes(8, "little") + file.read(size))
                if missing := {features, targets} - set(found):
                    raise KeyError(f"tensors not found in {path}: {sorted(missing)}")
                x, y = found[features], found[targets]
                if x["shape"][0] != y["shape"][0]:
                    raise ValueError(f"{path}: {x['shape'][0]} features, {y['shape'][0]} targets")
                width = int(np.prod(x["shape"][1:], dtype=np.int64)) * np.dtype(_SAFETENSORS[x["dtype"]]).itemsize
                first = np.arange(0, x["shape"][0], max(1, range_bytes // max(width, 1)))
                yield pd.DataFrame({"path": path, "first": first, "n": np.diff(np.append(first, x["shape"][0])), "x": json.dumps(x), "y": json.dumps(y)})

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, first, n, x, y in batch.itertuples(index=False):
                with _opened(path) as file:
                    values, target = _rows_of(file, json.loads(x), first, n), _rows_of(file, json.loads(y), first, n)
                flat = values.reshape(n, -1).astype(np.float32)
                for i in range(0, n, 4096):
                    part = flat[i : i + 4096]
                    yield pd.DataFrame({"path": path, "row": np.arange(first + i, first + i + len(part)), "features": list(part), "shape": [list(values.shape[1:])] * len(part), "target": target[i : i + 4096].astype(np.int64).reshape(len(part))})

    files = spark.read.format("binaryFile").load(path).select("path")  # contents are not read here
    dealt = files.mapInPandas(ranges, "path string, first long, n long, x string, y string").repartition("path", "first")
    return dealt.mapInPandas(rows, "path string, row long, features array<float>, shape array<int>, target long")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """path, height, width, channels and data (bytes in BGR order, as decoded in the JVM); broken files are dropped."""
    images = spark.read.format("image").option("dropInvalid", True).load(path)
    return images.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"), F.col("image.width").alias("width"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))


def read_image_tensors(spark: SparkSession, path: str, layout: str = "chw", grayscale: bool = False, threshold: float | None = None) -> DataFrame:
    """path and tensor (shape, values from 0 to 1) of a folder's images; colours in the order red, green, blue, alpha. See image_tensor."""
    images = read_images(spark, path)
    return images.select("path", image_tensor(F.col("data"), F.col("height"), F.col("width"), F.col("channels"), layout, grayscale, True, threshold).alias("tensor"))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path and length of the files of a flat folder; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length")


def read_text_files(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """path and text of whole files."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.decode("content", encoding).alias("text"))


def read_binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A table bucketed and sorted by a key, so that later joins and roll-ups on the key need no exchange."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """A long table (metric, value) as JSON lines."""
    metrics.select("metric", "value").write.mode("overwrite").json(path)
