"""Named files as a data source, a row a file, and documents that are read a range of pages at a time.

Files go through ``pyarrow.fs``, so a path may be any address that it knows
(``file://``, ``hdfs://``, ``s3://`` ...) and that all executors share.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Folder of the lists of written files, and the file that says that a write is whole.
MANIFESTS, DONE = "_manifest", "_SUCCESS"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if not path.startswith("file:/") or path.startswith("file://") else f"file://{path[5:]}")


@dataclass
class Written(WriterCommitMessage):
    """A task's files: their number, their bytes, and where their names are listed."""

    files: int
    size: int
    manifest: str


class NamedFileWriter(DataSourceArrowWriter):
    """Writes each row's ``content`` to ``file`` below the path.

    A task writes a file under another name and renames it, so no reader sees
    half of one, and a task that runs twice leaves the same files.  What a task
    wrote is listed in a manifest; only the manifest's place and counts go to
    the driver.  Commit leaves the DONE mark with the counts; abort removes
    the files of this write that had not been there before.  A file that is
    there already is replaced in mode ``overwrite`` and an error otherwise;
    other files stay.
    """

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        if {f.name for f in schema.fields} != {"file", "content"}:
            raise ValueError("named files have the columns file and content")
        self.path, self.overwrite, self.run = path, overwrite, uuid.uuid4().hex
        self.at = [f.name for f in schema.fields].index("file")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        attempt = f"{task.partitionId()}-{task.taskAttemptId()}"
        store, root = file_system(self.path)
        made: set[str] = set()
        names, size = [], 0
        for batch in iterator:
            for name, content in zip(batch.column(self.at).to_pylist(), batch.column(1 - self.at).to_pylist(), strict=True):
                if name is None or content is None:
                    raise ValueError(f"a file needs a name and content: {name}")
                clean = posixpath.normpath(name)
                if clean.startswith(("/", "..")) or clean in (".", "") or clean.split("/")[0] in (MANIFESTS, DONE):
                    raise ValueError(f"not a name below the path: {name}")
                data = content.encode() if isinstance(content, str) else bytes(content)
                to = f"{root}/{clean}"
                folder, _, last = to.rpartition("/")
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                old = store.get_file_info(to).type != fs.FileType.NotFound
                # a first attempt of this very task may have left it
                if old and not self.overwrite and not self._is_ours(store, to, data):
                    raise FileExistsError(to)
                part = f"{folder}/.{last}.{attempt}"
                with store.open_output_stream(part) as out:
                    out.write(data)
                store.move(part, to)
                names.append((clean, old))
                size += len(data)
        manifest = f"{root}/{MANIFESTS}/{self.run}/{attempt}.json"
        store.create_dir(manifest.rpartition("/")[0], recursive=True)
        with store.open_output_stream(manifest) as out:
            out.write("".join(json.dumps({"file": n, "old": o}) + "\n" for n, o in names).encode())
        return Written(len(names), size, manifest)

    @staticmethod
    def _is_ours(store: fs.FileSystem, path: str, data: bytes) -> bool:
        with store.open_input_stream(path) as f:
            return f.read() == data

    def commit(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        done = [m for m in messages if m]
        with store.open_output_stream(f"{root}/{DONE}") as out:
            out.write(json.dumps({"run": self.run, "files": sum(m.files for m in done), "bytes": sum(m.size for m in done)}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        for m in messages:
            if m:
                with store.open_input_stream(m.manifest) as f:
                    for line in f.read().decode().splitlines():
                        entry = json.loads(line)
                        if not entry["old"]:
                            store.delete_file(f"{root}/{entry['file']}")
        folder = f"{root}/{MANIFESTS}/{self.run}"
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


class NamedFiles(DataSource):
    """``named_files``: see :class:`NamedFileWriter`."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema: StructType, overwrite: bool) -> NamedFileWriter:
        return NamedFileWriter(self.options["path"], schema, overwrite)


def write_files(files: DataFrame, path: str, mode: str = "overwrite") -> dict:
    """Writes ``file`` and ``content`` (text or bytes) below ``path``; the counts of the DONE mark."""
    files.sparkSession.dataSource.register(NamedFiles)
    files.select("file", "content").write.format("named_files").mode(mode).save(path)
    store, root = file_system(path)
    with store.open_input_stream(f"{root}/{DONE}") as f:
        return json.loads(f.read())


def read_pages(spark: SparkSession, path: str, open_document: Callable[[bytes], Sequence[bytes]], pages_a_task: int = 50, suffix: str = ".pdf") -> DataFrame:
    """``doc_id``, ``path``, ``page_index``, ``page_count``, ``page`` and ``error`` of every page of the documents below ``path``.

    ``open_document`` takes a document's bytes and gives its pages by number.
    Tasks count the pages of documents; ranges of ``pages_a_task`` pages are
    then dealt to tasks that open the document again, so one of any length
    spreads over many, and a page is in memory at a time.  A page or document
    that fails gives a row with its error, and the others go on.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").where(F.lower("path").endswith(suffix.lower()))

    def opened(at: str) -> Sequence[bytes]:
        store, inner = file_system(at)
        with store.open_input_stream(inner) as f:
            return open_document(f.read())

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for at in pdf["path"]:
                try:
                    rows.append((at, len(opened(at)), None))
                except Exception as e:  # one document's failure is a row
                    rows.append((at, 0, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "n", "error"])

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def row(*values) -> pd.DataFrame:
            made = pd.DataFrame([values], columns=["doc_id", "path", "page_index", "page_count", "page", "error"])
            return made.astype({"page_index": "Int32", "page_count": "Int32"})

        for pdf in frames:
            for at, n, error, first in pdf.itertuples(index=False):
                name = at.rpartition("/")[2].rpartition(".")[0]
                if error:
                    yield row(name, at, None, None, None, error)
                    continue
                pages = opened(at)
                for i in range(first, min(first + pages_a_task, n)):
                    try:
                        yield row(name, at, i, n, bytes(pages[i]), None)
                    except Exception as e:  # a bad page is a row
                        yield row(name, at, i, n, None, f"{type(e).__name__}: {e}")

    counted = files.mapInPandas(count, "path string, n int, error string")
    ranges = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1, F.lit(pages_a_task))).when(F.col("error").isNotNull(), F.array(F.lit(-1)))
    # a number of partitions keeps the few small rows from being put together again
    dealt = counted.withColumn("first", F.explode(ranges)).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "first")
    return dealt.mapInPandas(read, "doc_id string, path string, page_index int, page_count int, page binary, error string")
