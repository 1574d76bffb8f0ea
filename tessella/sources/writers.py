"""Sinks: documents, reports, archives, and writes of changed rows only."""

from __future__ import annotations

import io
import json
import uuid
import warnings
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed_rows(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``new`` that ``old`` lacks or holds with other values."""
    before = old.select(F.col(key).alias("_k"), F.struct(*columns).alias("_old"))
    joined = new.join(before, F.col(key) == F.col("_k"), "left")
    return joined.where(F.col("_old").isNull() | ~F.struct(*columns).eqNullSafe(F.col("_old"))).drop("_k", "_old")


def write_changed(new: DataFrame, path: str, partition: str) -> None:
    """Overwrite only the partitions that ``new`` holds."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def yaml_text(rows: DataFrame, key: str, width: int = 100) -> DataFrame:
    """key and YAML text of each row: block style, field order kept, nulls dropped."""
    packed = rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("json"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        class Document(yaml.SafeDumper):
            """Lists stand indented under their key; text of several lines is literal."""

            def expect_block_sequence(self):
                self.increase_indent()
                self.state = self.expect_first_block_sequence_item

            def analyze_scalar(self, scalar):
                found = super().analyze_scalar(scalar)
                if self.event.style is None and found.multiline and found.allow_block:
                    self.event.style = "|"
                return found

        def text(value: dict) -> str:
            return yaml.dump(value, Dumper=Document, allow_unicode=True, sort_keys=False, width=width)

        for batch in batches:
            out = [text(json.loads(j)) for j in batch["json"]]
            yield pd.DataFrame({"key": batch["key"], "yaml": out})

    return packed.mapInPandas(run, "key string, yaml string")


def write_files(rows: DataFrame, name: str, data: str, folder: str) -> DataFrame:
    """One file per row below ``folder`` (a path or URI all executors share); returns name and bytes."""
    packed = rows.select(F.col(name).alias("name"), F.col(data).cast("binary").alias("data"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for n, d in zip(batch["name"], batch["data"], strict=True):
                # Two attempts of a task write apart; the whole file is then moved into its place.
                part = f"{root}/{n}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(part) as out:
                    out.write(d)
                store.move(part, f"{root}/{n}")
            yield pd.DataFrame({"name": batch["name"], "n_bytes": [len(d) for d in batch["data"]]})

    return packed.mapInPandas(run, "name string, n_bytes long")


def zip_by_group(rows: DataFrame, group: str, name: str, data: str) -> DataFrame:
    """One zip archive per group, as (group, archive)."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            for n, d in part.sort_values("name")[["name", "data"]].itertuples(index=False):
                z.writestr(n, d)
        return pd.DataFrame([(part["g"].iloc[0], buffer.getvalue())], columns=["g", "archive"])

    own = rows.select(F.col(group).cast("string").alias("g"), F.col(name).alias("name"), F.col(data).cast("binary").alias("data"))
    return own.groupBy("g").applyInPandas(run, "g string, archive binary").withColumnRenamed("g", group)


def report(rows: DataFrame, line: Column, path: str) -> None:
    rows.select(line.alias("value")).write.mode("overwrite").text(path)


def write_xml(rows: DataFrame, path: str, row_tag: str, root_tag: str) -> None:
    """Compressed XML documents, an element a row; columns named ``_x`` are attributes, ``_VALUE`` is an element's text."""
    rows.write.format("xml").options(rowTag=row_tag, rootTag=root_tag, compression="gzip", validateName="false").mode("overwrite").save(path)


def json_text(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def prompt(template: str, **columns: Column) -> Column:
    """A text template with columns in place of ``{name}``."""
    parts = [F.lit(template)]
    out = parts[0]
    for name, column in columns.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(column.cast("string"), F.lit("")))
    return out


def write_file_list(files: DataFrame, column: str, path: str) -> None:
    """The distinct paths of a column, sorted, one per line; over several parts they are in the parts' order."""
    files.select(F.col(column).alias("value")).where("value is not null").distinct().orderBy("value").write.mode("overwrite").text(path)


def write_summary(accumulator: DataFrame, folder: str) -> bool:
    """A fold's one row as JSON below ``folder``/summary; False, and nothing written, where there is none or it is null."""
    rows = accumulator.where(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in accumulator.columns]).isNotNull()).limit(1)
    if rows.isEmpty():
        return False
    json_text(rows).coalesce(1).write.mode("overwrite").text(f"{folder}/summary")
    return True


def publish(spark, paths: list[str], folder: str) -> list[str]:
    """Copy files into a folder, by the file systems of their URIs; returns the paths that do not exist."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    target = place(folder).getFileSystem(conf)
    target.mkdirs(place(folder))
    missing = []
    for path in paths:
        source = place(path).getFileSystem(conf)
        if source.exists(place(path)):
            jvm.org.apache.hadoop.fs.FileUtil.copy(source, place(path), target, place(f"{folder}/{place(path).getName()}"), False, True, conf)
        else:
            warnings.warn(f"{path} does not exist, skipped", stacklevel=2)
            missing.append(path)
    return missing
