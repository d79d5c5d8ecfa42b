"""Which header each file of a source has, from one distributed pass over the first lines."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pontualis.sources.scratch import fresh_path

INDEX_DDL = "file string, skipped int, header array<string>"
_LINES_DDL = "file string, start long, number int, line binary"
#: Larger than any file, so that a file is one split and a split one file.
_WHOLE_FILE = str(1 << 42)
_SPLITS = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
_MOST_SPLITS = "spark.sql.files.maxPartitionNum"
_BATCH = 64  # lines that go to Python at once
#: Every different header is a scan of its own.
MOST_HEADERS = 200


@dataclass(frozen=True)
class HeaderGroup:
    """The files whose header is the same and comes after the same number of lines.

    ``named`` holds their paths; the largest group of a source names none, and holds all files
    that the other groups do not.
    """

    header: tuple[str, ...]
    skipped: int
    files: int
    named: tuple[str, ...] = ()


def split_line(line: str, sep: str, quote: str | None) -> list[str]:
    """The fields of one line."""
    if quote is None:
        return line.split(sep)
    return next(csv.reader([line], delimiter=sep, quotechar=quote), [])


def header_index(spark: SparkSession, path: str, *, names: Sequence[str], sep: str, quote: str | None,
                 charset: str, banner_lines: int) -> DataFrame:
    """``file, skipped, header`` of every file under ``path`` that has a line.

    The header is, of the first two lines, the one that holds most of ``names``, the earlier one
    of a tie; ``skipped`` lines come before it.  A file of nothing but a banner has an empty
    header, and one without any of the names has NULL.  A task opens one file and stops after
    these lines, so the pass costs an open file each, whatever their sizes (up to 4 TB).

    That holds where a session may say how large splits are.  Where it may not, a file is in
    several blocks, and a task reads several: the first lines of each block are then found
    by reading all, and those of the file are the first of its first blocks.
    """
    wanted = frozenset(names)
    # A session of its own, so that the caller's scans keep their settings.
    own = spark.newSession()
    for setting in _SPLITS:
        own.conf.set(setting, _WHOLE_FILE)
    own.conf.unset(_MOST_SPLITS)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_BATCH))
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    alone = (own.conf.get(_MOST_SPLITS, None) is None
             and all(own.conf.get(s) == _WHOLE_FILE for s in _SPLITS))

    def first_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = None, 0
        for batch in batches:
            line, file, start = batch.columns
            last = len(batch) - 1
            # A block's lines come one after another.
            if last < 0 or number == 2 and block == (file[last].as_py(), start[last].as_py()):
                continue
            found = []
            for i, at in enumerate(zip(file.to_pylist(), start.to_pylist(), strict=True)):
                if at != block:
                    block, number = at, 0
                if number < 2:
                    found.append((*at, number, line[i].as_py()))
                    number += 1
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)],
                    ["file", "start", "number", "line"])
            if alone and number == 2:
                break

    types = (pa.string(), pa.int64(), pa.int32(), pa.binary())

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            skipped, header = [], []
            for lines in batch.column(1).to_pylist():
                fields = [split_line(x.decode(charset, "replace").lstrip("\ufeff").rstrip("\r"), sep, quote)
                          for x in lines]
                hits = [len(wanted.intersection(f)) for f in fields]
                best = hits.index(max(hits))
                skipped.append(best)
                header.append(fields[best] if hits[best] else [] if len(lines) <= banner_lines else None)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(skipped, pa.int32()),
                pa.array(header, pa.list_(pa.string()))], ["file", "skipped", "header"])

    lines = own.read.text(path).select(F.col("value").cast("binary").alias("line"),
                                       F.col("_metadata.file_path").alias("file"),
                                       F.col("_metadata.file_block_start").alias("start"))
    place = F.row_number().over(W.partitionBy("file").orderBy("start", "number"))
    firsts = (lines.mapInArrow(first_of_blocks, _LINES_DDL).withColumn("place", place).filter("place <= 2")
              .groupBy("file").agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("lines"))
              .select("file", F.col("lines.line").alias("lines")))
    index = fresh_path(spark, "header_index")
    firsts.mapInArrow(headers, INDEX_DDL).write.parquet(index)
    return spark.read.schema(INDEX_DDL).parquet(index)


def header_groups(index: DataFrame) -> list[HeaderGroup]:
    """The groups of an index, the largest first; files without header are one group of header
    ``()`` and -1 skipped lines, files of nothing but a banner one of header ``()``.

    The driver gets one row for each different header (``MOST_HEADERS`` at most) and the paths of
    files that are not in the largest group.
    """
    first = F.when(F.col("header").isNull(), -1).otherwise(F.col("skipped"))
    keyed = index.select("file", first.alias("skipped"),
                         F.coalesce("header", F.array().cast("array<string>")).alias("header"))
    counted = (keyed.groupBy("skipped", "header").agg(F.count(F.lit(1)).alias("files"))
               .orderBy(F.desc("files"), "skipped", "header").limit(MOST_HEADERS + 1).collect())
    if len(counted) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers")
    groups = []
    for i, row in enumerate(counted):
        own = (F.col("skipped") == row.skipped) & (
            F.col("header") == F.array(*[F.lit(h) for h in row.header]).cast("array<string>"))
        named = [] if i == 0 else [r.file for r in keyed.filter(own).select("file").collect()]
        groups.append(HeaderGroup(tuple(row.header), row.skipped, row.files, tuple(sorted(named))))
    return groups


def of_group(group: HeaderGroup, groups: Sequence[HeaderGroup]):
    """Which files are the group's, as a condition on ``_metadata.file_path`` (pruned when the files
    are listed); None if it is the only group."""
    others = [f for g in groups for f in g.named]
    path = F.col("_metadata.file_path")
    if group.named:
        return path.isin(*group.named)
    return ~path.isin(*others) if others else None
