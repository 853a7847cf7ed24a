"""Publishing to stores that are not Spark formats: a data source whose tasks write and whose driver commits.

A store gives receipts for what tasks put into it and makes them count all at once, or takes them back. ``FolderStore``
keeps JSON lines in a folder; a client of a document store offers the same four methods.
"""

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

import newslake
from newslake.sources.runs import _checked

cloudpickle.register_pickle_by_value(newslake)


@dataclass
class Receipt(WriterCommitMessage):
    """What a task has put into the store; nobody reads it before it is committed."""

    name: str
    rows: int


class FolderStore:
    """JSON lines below a folder: ``parts/`` holds what tasks have written, ``commits/{run}.json`` names what counts."""

    def __init__(self, path: str):
        self.path = path

    def _open(self):
        if ":" not in self.path.split("/", 1)[0]:
            return arrow_fs.LocalFileSystem(), self.path
        if self.path.startswith("file:"):
            return arrow_fs.LocalFileSystem(), "/" + self.path[5:].lstrip("/")
        return arrow_fs.FileSystem.from_uri(self.path.replace("s3a:", "s3:", 1))

    def committed(self, run: str) -> bool:
        files, root = self._open()
        return files.get_file_info(f"{root}/commits/{run}.json").type != arrow_fs.FileType.NotFound

    def put(self, batches) -> Receipt:
        """Write the batches of one task under a name of its own."""
        files, root = self._open()
        files.create_dir(f"{root}/parts", recursive=True)
        name, rows = f"{uuid.uuid4().hex}.json", 0
        with files.open_output_stream(f"{root}/parts/{name}") as sink:
            for batch in batches:
                for row in batch.to_pylist():
                    sink.write(json.dumps(row, ensure_ascii=False).encode() + b"\n")
                    rows += 1
        return Receipt(name, rows)

    def commit(self, run: str, receipts) -> None:
        """All receipts count from now on, as one file names them; a run that is committed already stays as it is."""
        if self.committed(run):
            self.take_back(receipts)
            return
        files, root = self._open()
        files.create_dir(f"{root}/commits", recursive=True)
        held = f"{root}/commits/.{uuid.uuid4().hex}"
        with files.open_output_stream(held) as sink:
            sink.write(json.dumps({"parts": [r.name for r in receipts], "rows": sum(r.rows for r in receipts)}).encode())
        files.move(held, f"{root}/commits/{run}.json")

    def take_back(self, receipts) -> None:
        files, root = self._open()
        for receipt in receipts:
            files.delete_file(f"{root}/parts/{receipt.name}")

    def parts(self) -> list:
        """The files that count."""
        files, root = self._open()
        found = []
        for info in files.get_file_info(arrow_fs.FileSelector(f"{root}/commits", allow_not_found=True)):
            if info.extension == "json":
                with files.open_input_stream(info.path) as source:
                    found += [f"{self.path}/parts/{name}" for name in json.loads(source.read())["parts"]]
        return found


class _Writer(DataSourceArrowWriter):
    def __init__(self, store, run):
        self.store, self.run = store, run

    def write(self, iterator):
        return self.store.put(iterator)

    def commit(self, messages):
        self.store.commit(self.run, [m for m in messages if m is not None])

    def abort(self, messages):
        """Tasks that ended have left receipts; one that failed may leave a file that no commit names."""
        self.store.take_back([m for m in messages if m is not None])


class PublishSource(DataSource):
    """``df.write.format("newslake").option("path", folder).option("run", name).mode("append").save()``"""

    @classmethod
    def name(cls):
        return "newslake"

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a store is added to, by runs; it is not overwritten")
        return _Writer(FolderStore(self.options["path"]), _checked(self.options["run"]))


def publish_to_store(documents: DataFrame, path: str, run: str) -> None:
    """Add rows to a folder store as a run; a run that is there already is left as it is."""
    spark = documents.sparkSession
    if FolderStore(path).committed(_checked(run)):
        return
    spark.dataSource.register(PublishSource)
    documents.write.format("newslake").option("path", path).option("run", run).mode("append").save()


def read_store(spark: SparkSession, path: str, schema) -> DataFrame:
    parts = FolderStore(path).parts()
    return spark.read.schema(schema).json(parts) if parts else spark.createDataFrame([], schema)
