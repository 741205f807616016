"""Documents from repositories and PDFs: local listing, page selection and bookmarks behind interfaces that tests can fill."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from docquarry import scratch
from docquarry.sources.files import relative_name

Converter = Callable[[bytes], str]


def list_tree(spark: SparkSession, root: str, subpath: str = "", suffix: str = ".md") -> DataFrame:
    """(filename, size) of the files below ``root``/``subpath`` with a suffix: what a repository listing gives for a checkout."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(f"{root.rstrip('/')}/{subpath}".rstrip("/"))
    return files.select(relative_name(root).alias("filename"), F.col("length").alias("size"))


class _Part(InputPartition):
    def __init__(self, folders: list[str]):
        super().__init__(folders)
        self.folders = folders


class TreeReader(DataSourceReader):
    """Lists a tree depth first with a visited set; folders are the partitions, and one that can't be read is left out."""

    def __init__(self, options: dict[str, str]):
        self.root, self.suffix = options["path"], options.get("suffix", ".md")

    def partitions(self) -> list[InputPartition]:
        import os

        seen, stack, out = set(), [self.root], []
        while stack:
            folder = os.path.realpath(stack.pop())
            if folder in seen:
                continue
            seen.add(folder)
            out.append(_Part([folder]))
            try:
                stack += sorted((e.path for e in os.scandir(folder) if e.is_dir()), reverse=True)
            except OSError:
                continue
        return out

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        import os

        for folder in partition.folders:
            try:
                names = sorted(e.name for e in os.scandir(folder) if e.is_file() and e.name.endswith(self.suffix))
            except OSError:
                continue
            for name in names:
                with open(os.path.join(folder, name), encoding="utf-8", errors="replace") as f:
                    yield os.path.relpath(os.path.join(folder, name), os.path.realpath(self.root)).replace(os.sep, "/"), f.read()


class TreeSource(DataSource):
    """``spark.read.format("docquarry_tree").option("path", ...)``: (filename, text) of a tree that all executors can see."""

    @classmethod
    def name(cls) -> str:
        return "docquarry_tree"

    def schema(self) -> str:
        return "filename string, text string"

    def reader(self, schema) -> DataSourceReader:
        return TreeReader(self.options)


def register(spark: SparkSession) -> None:
    scratch.ship(spark)
    spark.dataSource.register(TreeSource)


def converted(spark: SparkSession, root: str, convert: Converter, pattern: str = "*.pdf") -> DataFrame:
    """(filename, text) of binary documents by a converter that each worker calls; a document that fails has null."""
    scratch.ship(spark)

    @F.pandas_udf("string")
    def text(bodies: pd.Series) -> pd.Series:
        def one(b: bytes) -> str | None:
            try:
                return convert(bytes(b))
            except Exception:  # noqa: BLE001  one bad document must not end the run
                return None

        return bodies.map(one)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select(relative_name(root).alias("filename"), text("content").alias("text"))


def joined_halves(parts: DataFrame) -> DataFrame:
    """(doc_id, text): the converted parts (doc_id, part, text) of each document in order, with a blank line between."""
    return parts.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda p: p["text"]), "\n\n").alias("text"))


Outline = Callable[[bytes], list[tuple[int, str]]]
OBJECT = re.compile(rb"(\d+) \d+ obj(.*?)endobj", re.S)


def plain_outline(body: bytes) -> list[tuple[int, str]]:
    """(level, title) of a PDF's bookmarks, depth first, where its outline objects are not compressed."""
    objects = {int(m[1]): m[2] for m in OBJECT.finditer(body)}
    ref = lambda o, name: next((int(m[1]) for m in [re.search(rb"/" + name + rb"\s+(\d+)\s+\d+\s+R", o)] if m), None)

    def title(o: bytes) -> str:
        if m := re.search(rb"/Title\s*<([0-9A-Fa-f\s]*)>", o):
            raw = bytes.fromhex(re.sub(rb"\s", b"", m[1]).decode())
        elif m := re.search(rb"/Title\s*\(((?:\\.|[^\\)])*)\)", o, re.S):
            raw = re.sub(rb"\\([()\\])", rb"\1", m[1])
        else:
            return ""
        return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")

    out: list[tuple[int, str]] = []
    root = next((o for o in objects.values() if re.search(rb"/Type\s*/Outlines\b", o)), b"")
    stack, seen = [(ref(root, b"First"), 1)], set()
    while stack:
        at, level = stack.pop()
        if at is None or at in seen or at not in objects:
            continue
        seen.add(at)
        o = objects[at]
        out.append((level, title(o)))
        stack += [(ref(o, b"Next"), level), (ref(o, b"First"), level + 1)]
    return out


def bookmarks(spark: SparkSession, root: str, outline: Outline = plain_outline, pattern: str = "*.pdf") -> DataFrame:
    """(filename, pos, level, title): the bookmarks of each document; one that can't be read has none."""
    scratch.ship(spark)

    @F.pandas_udf("array<struct<level:int,title:string>>")
    def read(bodies: pd.Series) -> pd.Series:
        def one(b: bytes) -> list[dict]:
            try:
                return [{"level": n, "title": t} for n, t in outline(bytes(b))]
            except Exception:  # noqa: BLE001  one bad document must not end the run
                return []

        return bodies.map(one)

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return found.select(relative_name(root).alias("filename"), F.posexplode(read("content")).alias("pos", "e")).select("filename", "pos", "e.level", "e.title")
