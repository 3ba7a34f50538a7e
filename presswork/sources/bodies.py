"""A sink that writes one file per row: the bodies of images under the names of their records."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from presswork.sources.files import qualified


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


@dataclass
class _Written(WriterCommitMessage):
    files: int


class _BodyWriter(DataSourceArrowWriter):
    """Tasks write below a staging folder, which becomes the target when the job commits.

    A file is written under a name of its attempt and renamed when whole, so an attempt that runs
    again, or beside another, leaves the same files. A job that fails leaves nothing.
    """

    def __init__(self, target: str):
        self.target = target.rstrip("/")
        self.staging = f"{self.target}.staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _opened(self.staging)
        drafts = f"{root}/_drafts"
        store.create_dir(drafts, recursive=True)
        files = 0
        for batch in iterator:
            for name, body in zip(batch.column("name").to_pylist(), batch.column("body"), strict=True):
                if not name or "/" in name or name.startswith((".", "_")):
                    raise ValueError(f"not a file name: {name!r}")
                draft = f"{drafts}/{uuid.uuid4().hex}"
                with store.open_output_stream(draft) as out:
                    if body.is_valid:
                        out.write(body.as_buffer())
                store.move(draft, f"{root}/{name}")
                files += 1
        return _Written(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _opened(self.staging)
        _, target = _opened(self.target)
        store.create_dir(f"{root}/_drafts", recursive=True)  # of a job without rows
        store.delete_dir(f"{root}/_drafts")
        if store.get_file_info(target).type == fs.FileType.NotFound:
            store.move(root, target)
        else:
            earlier = f"{target}.earlier-{uuid.uuid4().hex}"
            store.move(target, earlier)
            store.move(root, target)
            store.delete_dir(earlier)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _opened(self.staging)
        if store.get_file_info(root).type != fs.FileType.NotFound:
            store.delete_dir(root)


class BodySink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "presswork-bodies"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _BodyWriter(self.options["path"])


def write_bodies(rows: DataFrame, folder: str) -> str:
    """Write each row (name, body) as the file ``name`` of ``folder``; the folder is replaced.

    Names must differ; a null body is an empty file. Bodies stay in the tasks that hold them.
    """
    spark = rows.sparkSession
    spark.dataSource.register(BodySink)
    target = qualified(spark, folder)
    rows.select("name", "body").write.format(BodySink.name()).mode("append").save(target)
    return folder
