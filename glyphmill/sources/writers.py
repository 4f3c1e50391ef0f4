"""Writers: JSONL, shards with exact names, three-view pairs, packs. Each returns how many rows it wrote."""

from __future__ import annotations

import gzip
import io
import tarfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from glyphmill.operators.lineage import numbered
from glyphmill.operators.pairs import split_views
from glyphmill.sources import files


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> int:
    """A folder of JSONL files, nulls kept; the number of rows is observed while they are written."""
    rows, seen = _counted(df)
    rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def as_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def shard_plan(df: DataFrame, order: str, size: int = 5000) -> DataFrame:
    """Each row's shard and place in it, shards filled in order."""
    rows = numbered(df, order)
    return rows.withColumns({"shard": F.floor(F.col("ord") / size).cast("long"), "place": (F.col("ord") % size).cast("long")}).drop("ord")


def write_shards(df: DataFrame, path: str, order: str, size: int = 5000, prefix: str = "part", compress: bool = False) -> int:
    """Files `prefix-00000.jsonl`, with .gz if compressed, of `size` rows each, in order; a file is written by one task.

    A row count that is a multiple of the size ends with an empty file, as a
    writer leaves it that opens the next shard when one is full; so does no
    row at all.
    """
    total = df.count()
    planned = shard_plan(df, order, size).select("shard", "place", as_json(df).alias("line"))
    suffix = ".jsonl.gz" if compress else ".jsonl"

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        body = "".join(f"{line}\n" for line in table.column("line").to_pylist()).encode()
        shard = table.column("shard")[0].as_py()
        files.put(path, f"{prefix}-{shard:05d}{suffix}", gzip.compress(body, mtime=0) if compress else body)
        return pa.table({"rows": [table.num_rows]})

    written = planned.groupBy("shard").applyInArrow(write, "rows long").agg(F.sum("rows")).first()[0] or 0
    if total % size == 0:
        files.put(path, f"{prefix}-{total // size:05d}{suffix}", gzip.compress(b"", mtime=0) if compress else b"")
    return written


def write_pairs(pairs: DataFrame, path: str) -> int:
    """The three views of pairs in the folders parallel, zh and en."""
    return max(write_jsonl(view, f"{path}/{name}") for name, view in zip(("parallel", "zh", "en"), split_views(pairs)))


def pack(df: DataFrame, path: str, format: str = "jsonl", name: str = "sample_id", images: dict[str, str] | None = None) -> int:
    """One dataset of rows as jsonl, parquet or webdataset archives; another format is an error."""
    if format == "jsonl":
        return write_jsonl(df, path)
    if format == "parquet":
        rows, seen = _counted(df)
        rows.write.mode("overwrite").parquet(path)
        return seen.get["n"]
    if format == "webdataset":
        return write_archives(df, path, name, {"": "image_path"} if images is None else images)
    raise ValueError(f"unknown format {format}")


def write_archives(df: DataFrame, path: str, name: str, images: dict[str, str], rows_per_archive: int = 1000) -> int:
    """Tar files `00000.tar`, `00001.tar`, ... of so many rows in order of their name.

    A row is a member `<name>.json`, after the files that the image columns
    name, where they exist: images maps a part of the member's name ("zh" for
    `<name>.zh.png`, empty for `<name>.png`) to a column, which may be dotted.
    """
    kinds = list(images)
    columns = [F.col(c).cast("string").alias(f"image{i}") if c.split(".")[0] in df.columns else F.lit(None).cast("string").alias(f"image{i}") for i, c in enumerate(images.values())]
    planned = shard_plan(df, name, rows_per_archive).select("shard", "place", F.col(name).cast("string").alias("name"), as_json(df).alias("body"), *columns)

    def write(table: pa.Table) -> pa.Table:
        raw = io.BytesIO()
        with tarfile.open(fileobj=raw, mode="w") as tar:
            def add(member: str, content: bytes) -> None:
                info = tarfile.TarInfo(member)
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))

            for row in table.sort_by("place").to_pylist():
                for i, kind in enumerate(kinds):
                    content = files.get(row[f"image{i}"])
                    if content is not None:
                        extension = row[f"image{i}"].rsplit("/", 1)[-1].rpartition(".")[2]
                        add(".".join(filter(None, (row["name"], kind, extension))), content)
                add(f"{row['name']}.json", row["body"].encode())
        files.put(path, f"{table.column('shard')[0].as_py():05d}.tar", raw.getvalue())
        return pa.table({"rows": [table.num_rows]})

    return planned.groupBy("shard").applyInArrow(write, "rows long").agg(F.sum("rows")).first()[0] or 0


def pack_pairs(pairs: DataFrame, path: str, format: str = "jsonl") -> int:
    """pack for pairs: an archive has `<pair>.zh.<ext>`, `<pair>.en.<ext>` and `<pair>.json` of each."""
    return pack(pairs, path, format, "pair_id", {lang: f"{lang}.image_path" for lang in ("zh", "en")})


def image_path(id, extension: str = "png"):
    return F.concat(F.left(id, F.lit(2)), F.lit("/"), id, F.lit(f".{extension}"))
