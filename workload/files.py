"""Delimited files with banner and header, written from DataFrames for the scan queries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.sources.delimited import Layout

BANNER = "Atualizado em: 2026-08-01"


def _field(name: str, quote: str | None) -> Column:
    value = F.col(name).cast("string")
    if quote is not None:
        value = F.concat(F.lit(quote), F.replace(value, F.lit(quote), F.lit(quote * 2)),
                         F.lit(quote))
    return F.coalesce(value, F.lit(""))


def write_published(df: DataFrame, path: str, layout: Layout, tail: Column | None = None,
                    folder: Column | None = None) -> None:
    """One file per partition of ``df``, each with banner, header and its rows.

    ``tail`` is put behind each row as it is.  ``folder`` (a whole number) tells rows apart by
    folders named ``pasta=<value>``; then there is a file for each partition and folder.

    The leading lines are put before a partition's rows inside the task that writes it,
    so nothing is shuffled and a file is as large as its partition.
    """
    quote = layout.quote or ""
    header = layout.sep.join(f"{quote}{h}{quote}" for h in layout.columns)
    bom = "\ufeff" if layout.charset.upper() == "UTF-8" else ""
    head = [bom + BANNER] * layout.banner_lines + [header]

    def head_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Numbered lines, those of the head before the first of each folder."""
        seen, number = set(), len(head)
        for batch in batches:
            new = [f for f in batch.column(0).unique().to_pylist() if f not in seen]
            seen.update(new)
            if new:
                names = [n for n in new for _ in head]
                # Typed as the rows are, for all batches of a task must have one schema.
                yield _numbered(pa.array(names, batch.column(0).type), list(range(len(head))) * len(new),
                                pa.array(head * len(new), batch.column(1).type))
            yield _numbered(batch.column(0), range(number, number + len(batch)), batch.column(1))
            number += len(batch)

    fields = [_field(c, layout.quote) for c in layout.columns.values()]
    line = F.concat_ws(layout.sep, *fields)
    lines = df.select((F.lit(0) if folder is None else folder).cast("long").alias("pasta"),
                      (line if tail is None else F.concat(line, tail)).alias("line"))
    numbered = lines.mapInArrow(head_first, "pasta long, number long, line string")
    # The lines are complete: the writer must neither quote, escape nor trim them.
    options = dict(sep="\u0001", quote="", escape="", encoding=layout.charset, header="false",
                   ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    if folder is None:
        numbered.select("line").write.options(**options).csv(path)
        return
    rows = numbered.sortWithinPartitions("pasta", "number").drop("number")
    # Sorted by folder first, as the writer wants it, so that it does not sort again.
    rows.write.partitionBy("pasta").options(**options).csv(path)


def _numbered(folder: pa.Array, numbers: Sequence[int], line: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([folder, pa.array(numbers, pa.int64()), line],
                                      ["pasta", "number", "line"])
