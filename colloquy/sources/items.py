"""A sink of one JSON file for each item and output, in two phases: tasks stage, one commit puts everything in place.

Every attempt of a task stages its files in a folder of its own. The commit first writes down what it is about to move, in one file
that appears whole; from then on the write counts as done, and whoever finds that file can end it (``recover``). So a run that dies
leaves all documents of its items or none, and running it again replaces files instead of adding to them.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

#: Folder of what is not in place yet, the list of moves in it, and moves at a time.
STAGED, LIST, THREADS = "_staged", "moves.json", 32


def system_of(folder: str) -> tuple[fs.FileSystem, str]:
    """A shared folder, or a file, as pyarrow reaches it: file, hdfs, s3, gs."""
    return fs.FileSystem.from_uri(folder if ":" in folder.split("/")[0] else f"file://{os.path.abspath(folder)}")


@dataclass
class Staged(WriterCommitMessage):
    """Places of the files that a task has staged, and its folder."""

    folder: str
    names: list[str]


class ItemWriter(DataSourceWriter):
    """Rows (name, content): a place below the folder, and a JSON document."""

    def __init__(self, folder: str):
        self.folder, self.job = folder, f"{STAGED}/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Staged:
        system, top = system_of(self.folder)
        own, names, made = f"{self.job}/{uuid.uuid4().hex}", [], set()
        for row in iterator:
            place = f"{top}/{own}/{row.name}"
            if (parent := place.rpartition("/")[0]) not in made:
                system.create_dir(parent, recursive=True)
                made.add(parent)
            with system.open_output_stream(place, compression=None) as out:
                out.write(json.dumps(json.loads(row.content), ensure_ascii=False, indent=2).encode())
            names.append(row.name)
        return Staged(own, names)

    def commit(self, messages: list[Staged | None]) -> None:
        moves = [(f"{m.folder}/{n}", n) for m in messages if m for n in m.names]
        system, top = system_of(self.folder)
        system.create_dir(f"{top}/{self.job}", recursive=True)
        with system.open_output_stream(f"{top}/{self.job}/{LIST}.part", compression=None) as out:
            out.write(json.dumps(moves).encode())
        system.move(f"{top}/{self.job}/{LIST}.part", f"{top}/{self.job}/{LIST}")
        _finish(system, top, self.job)

    def abort(self, messages: list[Staged | None]) -> None:
        system, top = system_of(self.folder)
        if system.get_file_info(f"{top}/{self.job}").type != fs.FileType.NotFound:
            system.delete_dir(f"{top}/{self.job}")


def _finish(system: fs.FileSystem, top: str, job: str) -> None:
    """Makes the listed moves that have not been made; may be repeated."""
    with system.open_input_stream(f"{top}/{job}/{LIST}", compression=None) as listed:
        moves = json.loads(listed.read())
    for parent in {to.rpartition("/")[0] for _, to in moves}:
        system.create_dir(f"{top}/{parent}", recursive=True)

    def move(pair: list[str]) -> None:
        staged, to = (f"{top}/{x}" for x in pair)
        if system.get_file_info(staged).type != fs.FileType.NotFound:
            system.move(staged, to)
        elif system.get_file_info(to).type == fs.FileType.NotFound:
            raise FileNotFoundError(to)

    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(move, moves))
    system.delete_dir(f"{top}/{job}")


def recover(folder: str) -> int:
    """Ends commits that were under way when their run died, deletes what was only staged, and says how many were ended.

    One run at a time writes to a folder.
    """
    system, top = system_of(folder)
    ended = 0
    for job in system.get_file_info(fs.FileSelector(f"{top}/{STAGED}", allow_not_found=True)):
        if system.get_file_info(f"{job.path}/{LIST}").type == fs.FileType.NotFound:
            system.delete_dir(job.path)
        else:
            _finish(system, top, f"{STAGED}/{job.base_name}")
            ended += 1
    return ended


class ItemSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "colloquy_items"

    def schema(self) -> str:
        return "name string, content string"

    def writer(self, schema: StructType, overwrite: bool) -> ItemWriter:
        return ItemWriter(self.options["folder"])


def write_items(rows: DataFrame, outputs: dict[str, str], folder: str) -> None:
    """Writes the documents in the columns ``outputs`` of ``rows`` as <folder>/<its value>/<id>.json; ids differ and are no paths.

    The commit moves files from the driver, some thousands a second on a file system; part files suit tables of many millions of items better.
    """
    rows.sparkSession.dataSource.register(ItemSource)
    safe = F.when(F.col("id").rlike(r"^[^/]*[^/.][^/]*$"), F.col("id")).otherwise(F.raise_error(F.concat(F.lit("no name for a file: "), F.col("id"))))
    one = F.explode(F.array(*(F.struct(F.concat(F.lit(f"{place}/"), safe, F.lit(".json")).alias("name"), F.to_json(column).alias("content")) for column, place in outputs.items())))
    rows.select(one.alias("x")).select("x.*").where("content IS NOT NULL").write.format("colloquy_items").mode("append").option("folder", folder if ":" in folder.split("/")[0] else os.path.abspath(folder)).save()


def item_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(id) of the documents in a folder of item files; contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)
    return listed.select(F.regexp_extract("path", r"([^/]*)\.json$", 1).alias("id"))
