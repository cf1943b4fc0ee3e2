"""Sinks: tab-separated files in a given order, id lists, pair tables by country, reports, packages, digests of files.

A file is written as a folder of parts that are the file in pieces: their lines, in the order of their names, are its
lines, and only the first has the header.  ``single_file`` joins them.
"""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.sources import records

# The headers of the two outputs.
MATCHED, CANDIDATES = ["source1_entity_id", "matched_entity_ids"], ["source1_entity_id", "candidate_entity_ids"]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def write_lines(lines: DataFrame, header: str, path: str) -> None:
    """``lines`` (place, line) in order of place below ``header``."""
    spark = lines.sparkSession
    kind = lines.schema["place"].dataType
    first = spark.range(1).select(F.lit(0).alias("part"), F.lit(None).cast(kind).alias("place"), F.lit(header).alias("line"))
    every = first.unionByName(lines.select(F.lit(1).alias("part"), "place", "line"))
    every.orderBy("part", "place").select("line").write.option("lineSep", "\n").text(path)


def write_tsv(df: DataFrame, columns: list[str], path: str) -> None:
    """``columns`` of ``df`` in order of its column place, no quoting; a null is an empty cell."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    write_lines(df.select("place", F.concat_ws("\t", *cells).alias("line")), "\t".join(columns), path)


def write_id_lists(s1: DataFrame, pairs: DataFrame, header: list[str], path: str) -> None:
    """A line per row of ``s1`` (entity_id, place), in order of place: the id, a tab, the ids of its pairs, distinct and sorted."""
    lists = records.id_lists(s1, pairs, "ids")
    write_lines(lists.select("place", F.concat_ws("\t", "s1_id", "ids").alias("line")), "\t".join(header), path)


def write_matched(s1: DataFrame, pairs: DataFrame, path: str) -> None:
    write_id_lists(s1, pairs, MATCHED, path)


def write_candidates(s1: DataFrame, pairs: DataFrame, path: str) -> None:
    write_id_lists(s1, pairs, CANDIDATES, path)


def write_empty(s1: DataFrame, folder: str) -> None:
    """Both outputs of a prediction of nothing."""
    none = s1.sparkSession.createDataFrame([], "s1_id string, cand_id string")
    write_matched(s1, none, f"{folder}/matching_results.tsv")
    write_candidates(s1, none, f"{folder}/candidate_pairs.tsv")


def write_pairs(pairs: DataFrame, path: str, block_bytes: int = 128 << 20) -> None:
    """Pairs as Parquet by country: a reader of one country reads its folder only."""
    pairs.write.mode("overwrite").option("parquet.block.size", block_bytes).partitionBy("country_n").parquet(path)


def read_pairs(spark: SparkSession, path: str, country: str | None = None, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    df = df if country is None else df.where(F.col("country_n") == country)
    return df.select(*columns) if columns else df


def single_file(spark: SparkSession, folder: str, path: str) -> None:
    """The parts of ``folder`` as one file, streamed by the driver."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, root = _fs(spark, folder)
    to, target = _fs(spark, path)
    out = to.create(target)
    for part in sorted((f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName()):
        source = fs.open(part)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
        source.close()
    out.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p)
    out.write(bytearray(text.encode()))
    out.close()


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    put_text(spark, path, json.dumps(report, indent=1, sort_keys=True, default=str) + "\n")


def summary(report: dict, title: str = "Run") -> str:
    """The report as a page of text: one line a figure, nested ones indented."""
    lines = [title, "=" * len(title)]

    def add(x: dict, depth: int) -> None:
        for k, v in x.items():
            if isinstance(v, dict):
                lines.append("  " * depth + f"{k}:")
                add(v, depth + 1)
            else:
                lines.append("  " * depth + f"{k}: {f'{v:,.6f}'.rstrip('0').rstrip('.') if isinstance(v, float) else f'{v:,}' if isinstance(v, int) and not isinstance(v, bool) else v}")

    add(report, 0)
    return "\n".join(lines) + "\n"


def sha256_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256) of each file at ``path``; a file is held by one task as a whole (under 2 GB)."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.substring_index("path", "/", -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


class Bundle:
    """The members of a zip file or of a folder, by name."""

    def __init__(self, path: str):
        self.zip = zipfile.ZipFile(path) if zipfile.is_zipfile(path) else None
        self.folder = Path(path)

    def names(self) -> list[str]:
        return sorted(self.zip.namelist() if self.zip else (p.name for p in self.folder.iterdir() if p.is_file()))

    def open(self, name: str):
        return self.zip.open(name) if self.zip else (self.folder / name).open("rb")

    def sha256(self, name: str) -> str:
        import hashlib

        with self.open(name) as f:
            return hashlib.file_digest(f, "sha256").hexdigest() if not self.zip else hashlib.sha256(f.read()).hexdigest()


def package(folder: str, names: list[str], path: str, expected: dict[str, str] | None = None) -> None:
    """Zip exactly ``names``; a missing one, or one whose digest is not as ``expected``, raises ValueError before anything is written."""
    have = Bundle(folder)
    lack = sorted(set(names) - set(have.names()))
    wrong = sorted(n for n, want in (expected or {}).items() if n not in lack and have.sha256(n) != want)
    if lack or wrong:
        raise ValueError(f"missing: {lack}; other digest than recorded: {wrong}")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for n in names:
            z.write(Path(folder) / n, n)


def read_lists(spark: SparkSession, path: str, header: list[str]) -> tuple[DataFrame, bool]:
    """((place, s1_id, ids) of the lines of an output, whether its header is right)."""
    raw = records.placed(spark.read.option("lineSep", "\n").text(path))
    top = raw.orderBy("place").limit(1).collect()
    if not top:
        return raw.select("place", F.lit("").alias("s1_id"), F.lit("").alias("ids")), False
    head = F.lit(True)
    for k in ("file", "at", "row"):
        head = head & (F.col(f"place.{k}") == F.lit(top[0].place[k]))
    cells: Column = F.split("value", "\t", 2)
    return raw.where(~head).select("place", F.get(cells, 0).alias("s1_id"), F.coalesce(F.get(cells, 1), F.lit("")).alias("ids")), top[0].value == "\t".join(header)
