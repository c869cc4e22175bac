"""A transactional sink of binary files: all files of a write appear together, with a manifest in input order, or none does.

    df.write.format("tesserae_files").mode("append").option("path", "hdfs://.../papers").option("magic", "%PDF").save()

``df`` has (ordinal long, name string, content binary).  Each task writes to a staging folder of its own attempt; commit
moves the files of the attempts that succeeded and writes ``manifest-<id>.jsonl`` by ordinal, abort removes the staging.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


@dataclass
class Written(WriterCommitMessage):
    folder: str
    rows: list[tuple[int, str, str, int]] = field(default_factory=list)  # ordinal, name, status, bytes


class FileWriter(DataSourceWriter):
    def __init__(self, path: str, magic: bytes):
        self.path, self.magic, self.id = path.rstrip("/"), magic, uuid.uuid4().hex

    def _at(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")

    def write(self, rows) -> Written:
        """Content that does not begin with the magic bytes, or is null, is refused and marked so; names keep their last part only."""
        files, top = self._at()
        task = TaskContext.get()
        out = Written(f"{top}/_staging-{self.id}/{task.partitionId()}-{task.taskAttemptId()}")
        files.create_dir(out.folder, recursive=True)
        for row in rows:
            name = (row["name"] or "").rpartition("/")[2] or f"unnamed-{row['ordinal']}"
            content = row["content"]
            good = content is not None and bytes(content[: len(self.magic)]) == self.magic
            if good:
                with files.open_output_stream(f"{out.folder}/{name}") as to:
                    to.write(bytes(content))
            out.rows.append((row["ordinal"], name, "written" if good else "refused", len(content) if good else 0))
        return out

    def commit(self, messages) -> None:
        """Moves the files; of equal names the one with the largest ordinal stays.  The driver holds a line for each file of one write."""
        files, top = self._at()
        listed = sorted((row, m.folder) for m in messages if m for row in m.rows)
        last = {row[1]: k for k, (row, _) in enumerate(listed) if row[2] == "written"}
        for name, k in last.items():
            files.move(f"{listed[k][1]}/{name}", f"{top}/{name}")
        lines = [{"ordinal": o, "name": n, "status": s if s == "refused" or last[n] == k else "replaced", "bytes": b} for k, ((o, n, s, b), _) in enumerate(listed)]
        with files.open_output_stream(f"{top}/manifest-{self.id}.jsonl") as to:
            to.write("".join(json.dumps(x, ensure_ascii=False) + "\n" for x in lines).encode())
        self._clear(files, top)

    def abort(self, messages) -> None:
        self._clear(*self._at())

    def _clear(self, files: fs.FileSystem, top: str) -> None:
        if files.get_file_info(f"{top}/_staging-{self.id}").type == fs.FileType.Directory:
            files.delete_dir(f"{top}/_staging-{self.id}")


class FileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tesserae_files"

    def schema(self) -> str:
        return "ordinal long, name string, content binary"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        if overwrite:
            raise ValueError("files are added; overwriting is not supported")
        return FileWriter(self.options["path"], self.options.get("magic", "").encode())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FileSink)
