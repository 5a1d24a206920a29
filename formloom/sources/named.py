"""Files under names of their own, one for each row: nothing of a run can be seen before all of it is written.

A task writes into a folder of its attempt. When all tasks have ended, the run's files are renamed to where they belong,
and a marker tells that they are all there; when a task fails for good, the folders go and nothing is left.
"""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT, DONE = "formloom-named-files", "_SUCCESS"


def filesystem(uri: str):
    """The file system of a folder, and the folder's path in it."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + os.path.abspath(uri.removeprefix("file:"))
    return fs.FileSystem.from_uri(uri)


@dataclass
class Written(WriterCommitMessage):
    """A task's folder and the names that it holds."""

    folder: str
    names: list[str] = field(default_factory=list)


class NamedWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path, overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        """A task's rows of (name, content); a name may hold folders, none of which leads out of the run's."""
        files, root = filesystem(self.path)
        out = Written(f"{root}/{self.staging}/{uuid.uuid4().hex}")
        files.create_dir(out.folder, recursive=True)
        for row in iterator:
            name = posixpath.normpath(row["name"])
            if name.startswith(("/", "..")) or name in (".", DONE) or name.startswith("_staging-"):
                raise ValueError(f"no name of a file: {row['name']!r}")
            files.create_dir(posixpath.dirname(f"{out.folder}/{name}"), recursive=True)
            with files.open_output_stream(f"{out.folder}/{name}") as sink:
                sink.write(bytes(row["content"]))
            out.names.append(name)
        return out

    def commit(self, messages: list[Written | None]) -> None:
        files, root = filesystem(self.path)
        told = [m for m in messages if m is not None]
        names = [n for m in told for n in m.names]
        if len(names) != len(set(names)):
            self.abort(messages)
            raise ValueError("a name is given to two files: " + sorted(n for n in set(names) if names.count(n) > 1)[0])
        if self.overwrite:
            from pyarrow.fs import FileSelector

            for x in files.get_file_info(FileSelector(root, allow_not_found=True)):
                if x.base_name != self.staging:
                    (files.delete_dir if x.type.name == "Directory" else files.delete_file)(x.path)
        for folder in {posixpath.dirname(n) for n in names}:
            files.create_dir(f"{root}/{folder}", recursive=True)
        for m in told:
            for n in m.names:
                files.move(f"{m.folder}/{n}", f"{root}/{n}")
        files.delete_dir(f"{root}/{self.staging}")
        with files.open_output_stream(f"{root}/{DONE}") as sink:
            sink.write(b"")

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow.fs import FileType

        files, root = filesystem(self.path)
        if files.get_file_info(f"{root}/{self.staging}").type != FileType.NotFound:
            files.delete_dir(f"{root}/{self.staging}")


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options["path"], overwrite)


def write_named(files: DataFrame, path: str, name: str = "name", content: str = "content", overwrite: bool = False) -> None:
    """Writes each row's content, text or bytes, as the file of its name below path. No two rows may have one name."""
    files.sparkSession.dataSource.register(NamedFiles)
    rows = files.select(F.col(name).cast("string").alias("name"), F.coalesce(F.col(content), F.lit("")).cast("binary").alias("content")).filter("name is not null")
    rows.write.format(FORMAT).mode("overwrite" if overwrite else "append").save(path)
