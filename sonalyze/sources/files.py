"""Small files, listed and written by tasks: Python data sources, so that neither a path nor a file's text goes through
the driver. Local folders, and any store that Arrow opens by its address."""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from sonalyze.shared import ship

# Fixed value: the folder of an episode's line audio ends so.
PARTS = ".line_parts"
#: Named in a folder once a job's files are all there, with how many it wrote.
DONE = "_FILES"


#: Columns of files and what they hold.
TEXTS = {"path": "string", "value": "string"}


def opened(address: str):
    """The file system of an address, the path in it, and what stands before paths in addresses."""
    from pyarrow import fs

    if re.match(r"^(file:)?/", address):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", address).rstrip("/") or "/", ""
    system, path = fs.FileSystem.from_uri(address)
    return system, path.rstrip("/"), address.rstrip("/")[: -len(path.rstrip("/"))] if path.strip("/") else address


def in_batches(rows: Iterable[tuple], columns: dict[str, str], most: int = 8 << 20) -> Iterator:
    """Rows of texts and numbers as Arrow batches of about so many characters; columns: their types by name."""
    import pyarrow as pa

    kinds = [pa.type_for_alias(k) for k in columns.values()]
    batch = lambda held: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], list(columns))
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) if isinstance(x, str) else 8 for x in row)
        if size >= most:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


class LineAudio(DataSource):
    """folder, stem, file_name of the line audio anywhere below a folder, empty files too. Each partition walks the folders
    and lists those of episodes whose hash is its own; option partitions: how many there are."""

    @classmethod
    def name(cls) -> str:
        return "line_audio"

    def schema(self) -> str:
        return "folder string, stem string, file_name string"

    def reader(self, schema) -> LineAudioReader:
        return LineAudioReader(self.options["path"], int(self.options.get("partitions", 16)))


class LineAudioReader(DataSourceReader):
    def __init__(self, root: str, parts: int):
        self.root, self.parts = root, parts

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str, str]]:
        from pyarrow import fs

        system, root, before = opened(self.root)
        left = [root]
        while left:
            for found in system.get_file_info(fs.FileSelector(left.pop())):
                if found.type != fs.FileType.Directory:
                    continue
                if not found.base_name.endswith(PARTS):
                    left.append(found.path)
                elif zlib.crc32(found.path.encode()) % self.parts == partition.value:
                    folder = f"{before}{found.path[: -len(found.base_name)]}"
                    for part in system.get_file_info(fs.FileSelector(found.path)):
                        if part.type == fs.FileType.File and part.base_name.endswith(".mp3"):
                            yield folder, found.base_name[: -len(PARTS)], part.base_name


@dataclass
class Wrote(WriterCommitMessage):
    files: int


class TextFiles(DataSource):
    """A file for each row (path, value), UTF-8. Saved, it is written over any before; path is below the folder that is saved to,
    or an address. Loaded, the files below the folder whose place there matches the option pattern, a name for each level; those
    that Spark takes for hidden (by . or _) are left out, and bytes that are no UTF-8 are replaced, as by its reader. Option
    partitions: how many tasks deal the folders that hold files among them, or the files where all lie in one folder."""

    @classmethod
    def name(cls) -> str:
        return "text_files"

    def schema(self) -> str:
        return "path string, value string"

    def reader(self, schema) -> TextFilesReader:
        return TextFilesReader(self.options["path"], self.options.get("pattern", "*"), int(self.options.get("partitions", 16)))

    def writer(self, schema, overwrite: bool) -> TextFilesWriter:
        return TextFilesWriter(self.options["path"])


class TextFilesReader(DataSourceReader):
    def __init__(self, root: str, pattern: str, parts: int):
        self.root, self.pattern, self.parts = root, pattern.split("/"), parts

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator:
        return in_batches(self.texts(partition.value), TEXTS)

    def texts(self, own: int) -> Iterator[tuple[str, str]]:
        from pyarrow import fs

        system, root, before = opened(self.root)

        def below(folder: str, pattern: str, kind) -> list[str]:
            return sorted(f.path for f in system.get_file_info(fs.FileSelector(folder)) if f.type == kind and fnmatchcase(f.base_name, pattern) and f.base_name[0] not in "._")

        folders = [root]
        for level in self.pattern[:-1]:
            folders = [f for folder in folders for f in below(folder, level, fs.FileType.Directory)]
        many = len(folders) > 1
        for folder in folders[own :: self.parts] if many else folders:
            files = below(folder, self.pattern[-1], fs.FileType.File)
            for path in files if many else files[own :: self.parts]:
                with system.open_input_stream(path) as held:
                    yield f"{before}{path}", held.read().decode(errors="replace")


class TextFilesWriter(DataSourceWriter):
    """A task writes drafts beside its files, and renames them once all are whole: one that dies leaves no file cut off, and its
    next attempt writes them again. The job's commit adds the mark DONE."""

    def __init__(self, root: str):
        self.root = root

    def write(self, iterator) -> Wrote:
        system, root, _ = opened(self.root)
        moves: list[tuple[str, str]] = []
        seen: set[str] = set()
        try:
            for row in iterator:
                target = opened(row.path)[1] if re.match(r"^([a-z0-9]+:)?/", row.path) else f"{root}/{row.path}"
                folder, name = target.rsplit("/", 1)
                if folder not in seen:
                    system.create_dir(folder, recursive=True)
                    seen.add(folder)
                draft = f"{folder}/.{name[:40]}.{uuid.uuid4().hex}"
                with system.open_output_stream(draft) as out:
                    out.write((row.value or "").encode())
                moves.append((draft, target))
            done = 0
            for draft, target in moves:
                system.move(draft, target)
                done += 1
        except BaseException:
            for draft, _ in moves:
                try:
                    system.delete_file(draft)
                except OSError:  # it is a whole file already
                    pass
            raise
        return Wrote(done)

    def commit(self, messages: list) -> None:
        system, root, _ = opened(self.root)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/{DONE}") as out:
            out.write(json.dumps({"files": sum(m.files for m in messages if m)}).encode())


def registered(spark: SparkSession) -> SparkSession:
    """The session, knowing both sources; workers get the package."""
    ship(spark)
    for source in (LineAudio, TextFiles):
        spark.dataSource.register(source)
    return spark


def list_audio(spark: SparkSession, folder: str) -> DataFrame:
    parts = max(1, spark.sparkContext.defaultParallelism)
    return registered(spark).read.format(LineAudio.name()).option("partitions", parts).load(folder)


def read_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path and value of the files below folder whose place there matches pattern (one name, or * for part of one, a level), by tasks."""
    parts = 4 * max(1, spark.sparkContext.defaultParallelism)
    return registered(spark).read.format(TextFiles.name()).option("partitions", parts).option("pattern", pattern).load(folder)


def write_files(files: DataFrame, folder: str) -> None:
    """A file below folder for each row (path, value), by tasks."""
    registered(files.sparkSession)
    files.select("path", "value").write.format(TextFiles.name()).mode("append").save(folder)
