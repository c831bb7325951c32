"""Writing emitted files, caches and audits."""

from __future__ import annotations

import os
import posixpath
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import hadoop
from .operators.review import audit_lines, latest


def write_files(files: DataFrame, folder: str, by_document: bool = False) -> DataFrame:
    """Writes (doc_id, path, content) under ``folder``, a path or an address of a file system that all executors reach, each file by the task that has
    it; gives (path, bytes). A path that leads out of the folder is an error. With ``by_document`` each document has a folder of its own. A
    file is moved into place when it is whole, so that a task that runs again does no harm."""
    local = "://" not in folder and not folder.startswith("file:")
    folder = os.path.realpath(folder) if local else folder

    def run(batches):
        store, root = (fs.LocalFileSystem(), folder) if local else fs.FileSystem.from_uri(folder)
        root = root.rstrip("/")
        for b in batches:
            done: tuple[list, list] = ([], [])
            for doc, path, content in zip(*(c.to_pylist() for c in b.columns)):
                to = posixpath.normpath(posixpath.join(root, str(doc) if by_document else "", path))
                if not to.startswith(root + "/"):
                    raise ValueError(f"{path!r} leads out of the folder")
                store.create_dir(posixpath.dirname(to), recursive=True)
                data = (content or "").encode()
                part = f"{to}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as f:
                    f.write(data)
                store.move(part, to)
                done[0].append(posixpath.relpath(to, root))
                done[1].append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.string()), pa.array(done[1], pa.int64())], names=["path", "bytes"])

    return files.select("doc_id", "path", "content").mapInArrow(run, "path string, bytes bigint")


def read_cache(spark: SparkSession, path: str | None) -> DataFrame:
    """The response log, empty if there is none yet."""
    schema = "case_id string, response string, created_at timestamp"
    if path is not None:
        fs, at = hadoop(spark, path)
        if fs.exists(at):
            return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def append_cache(responses: DataFrame, path: str) -> None:
    """Adds (case_id, response) to the response log; the latest one of a case counts."""
    responses.select("case_id", "response", F.current_timestamp().alias("created_at")).write.mode("append").parquet(path)


def compact_cache(df: DataFrame, path: str) -> None:
    """Writes the log anew with one response a case."""
    latest(df).select("case_id", "response", F.current_timestamp().alias("created_at")).write.mode("overwrite").parquet(path)


def append_audit(answered: DataFrame, path: str) -> None:
    """Adds what was asked and answered as JSON lines."""
    audit_lines(answered).write.mode("append").text(path)
