"""Provider folders: their files, listed in tasks level by level, and one folder made of several.

A level's folders are dealt out to tasks; what they hold goes to the shared folder, and the folders among it are the next level. So the driver lists nothing, no
task holds a whole tree, and there are as many rounds as the deepest folder has levels. Local paths (a mount that all executors see) are read by the operating
system, other stores by Arrow.

Defined results. Symbolic links are never followed nor listed. A root that is missing, or is a file, gives one row of kind `missing`. Folders are rows, too, so
that empty ones can be made again. Of one relative path the provider named first stays. Names may hold any character but a slash.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.link import first_wins
from tributary.plans.lineage import saved

LISTED = "provider string, root string, relative_path string, kind string, length long"
#: Bytes that are copied at once.
PIECE = 8 << 20


def _local(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return path if path.startswith("/") else None


def _entries(root: str, folder: str) -> list[tuple[str, str, int]] | None:
    """(name, kind, length) of what a folder holds, without links; None if there is no such folder."""
    if (local := _local(root)) is not None:
        if not os.path.isdir(os.path.join(local, folder)):
            return None
        with os.scandir(os.path.join(local, folder)) as found:
            own = [e for e in found if not e.is_symlink()]
        return [(e.name, "folder", 0) if e.is_dir(follow_symlinks=False) else (e.name, "file", e.stat(follow_symlinks=False).st_size) for e in own]
    store, place = fs.FileSystem.from_uri(root)
    place = f"{place.rstrip('/')}/{folder}".rstrip("/")
    if store.get_file_info(place).type != fs.FileType.Directory:
        return None
    return [(e.base_name, "folder", 0) if e.type == fs.FileType.Directory else (e.base_name, "file", e.size) for e in store.get_file_info(fs.FileSelector(place))]


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for provider, root, folder in zip(batch["provider"], batch["root"], batch["relative_path"], strict=True):
            found = _entries(root, folder)
            rows = [(provider, root, folder, "missing", 0)] if found is None else [(provider, root, f"{folder}/{name}" if folder else name, kind, length) for name, kind, length in found]
            for i in range(0, len(rows), 10_000):
                yield pd.DataFrame(rows[i : i + 10_000], columns=["provider", "root", "relative_path", "kind", "length"])


def list_folders(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """provider, root, relative_path, kind (file, folder, missing), length of all that lies below the providers' roots."""
    level = spark.createDataFrame([(name, root, "") for name, root in roots.items()], "provider string, root string, relative_path string")
    every = None
    while True:
        found = saved(level.repartition("provider", "relative_path").mapInPandas(_listed, LISTED))
        every = found if every is None else every.unionByName(found)
        level = found.filter("kind = 'folder'").select("provider", "root", "relative_path")
        if level.isEmpty():
            return every


def folder_union(listed: DataFrame, providers: list[str]) -> DataFrame:
    """Of list_folders' rows one for each relative path: the first provider that has it. Roots that are missing stay as rows of their own."""
    rank = F.array_position(F.array(*[F.lit(p) for p in providers]), F.col("provider"))
    there = listed.filter("kind <> 'missing'").withColumn("priority", rank).filter("priority > 0")
    kept = first_wins(there, "relative_path", "priority").drop("priority")
    return kept.unionByName(listed.filter("kind = 'missing'").select(kept.columns))


def _copy(root: str, relative: str, kind: str, target: str) -> None:
    source, goal = _local(root), _local(target)
    if source is not None and goal is not None:
        place = os.path.join(goal, relative)
        os.makedirs(place if kind == "folder" else os.path.dirname(place), exist_ok=True)
        if kind == "file":
            own = f"{place}.{uuid.uuid4().hex}.part"  # a task that runs twice never shows half a file
            shutil.copy2(os.path.join(source, relative), own, follow_symlinks=False)
            os.replace(own, place)
        return
    (here, a), (there, b) = (fs.FileSystem.from_uri(x if _local(x) is None else f"file://{_local(x)}") for x in (root, target))
    place = f"{b.rstrip('/')}/{relative}"
    there.create_dir(place if kind == "folder" else os.path.dirname(place), recursive=True)
    if kind == "file":
        with here.open_input_stream(f"{a.rstrip('/')}/{relative}") as src, there.open_output_stream(f"{place}.part") as out:
            while piece := src.read(PIECE):
                out.write(piece)
        there.move(f"{place}.part", place)


def copy_files(union: DataFrame, target: str) -> DataFrame:
    """Copy the files and folders of folder_union below `target`, in tasks; provider, relative_path, kind, length of what is there now."""

    def copied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                _copy(r.root, r.relative_path, r.kind, target)
            yield batch[["provider", "relative_path", "kind", "length"]]

    there = union.filter("kind <> 'missing'").select("provider", "root", "relative_path", "kind", "length")
    return saved(there.repartition("relative_path").mapInPandas(copied, "provider string, relative_path string, kind string, length long"))
