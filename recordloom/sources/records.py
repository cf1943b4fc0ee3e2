"""Records and truth: from tab-separated files, or from the documents table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLS = ["entity_id", "business_name", "business_address", "country"]


def placed(df: DataFrame) -> DataFrame:
    """``df``, read from files, with the place of each row: (file, where its split begins, number within the task)."""
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")]
    return df.select("*", F.struct(*split, F.monotonically_increasing_id().alias("row")).alias("place"))


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None, with_place: bool = False) -> DataFrame:
    """All columns as strings, no quoting, an empty cell is the empty string, "NA" is text; ``with_place``: with the rows' places."""
    columns = columns or COLS
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.read.schema(schema).option("sep", "\t").option("quote", "").option("header", True).option("nullValue", "\0").csv(path)
    df = placed(df) if with_place else df
    return df.na.fill("", columns)


def row_count(df: DataFrame) -> DataFrame:
    """(rows): from the footers where the source has them."""
    return df.agg(F.count("*").alias("rows"))


def read_pair_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, cand_id) from the first two columns of a file, whatever their names."""
    raw = spark.read.option("sep", "\t").option("quote", "").option("header", True).csv(path)
    first, second = raw.columns[:2]
    return raw.select(F.col(f"`{first}`").alias("s1_id"), F.col(f"`{second}`").alias("cand_id")).na.fill("")


def copy_some(spark: SparkSession, path: str, ids: DataFrame, to: str) -> None:
    """The rows of a record file whose entity_id is in ``ids``, in their order."""
    from recordloom.sources import outputs

    outputs.write_tsv(read_tsv(spark, path, with_place=True).join(ids.select("entity_id").distinct(), "entity_id", "left_semi"), COLS, to)


def load_split(spark: SparkSession, folder: str, split: str) -> tuple[DataFrame, DataFrame]:
    """(source 1, source 2 and 3 together)."""
    one, two, three = (read_tsv(spark, f"{folder}/{split}/{split}_source{k}.tsv") for k in (1, 2, 3))
    return one, two.unionByName(three)


def id_list(c: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != ""))


def load_truth(spark: SparkSession, path: str) -> DataFrame:
    """(s1_id, ids array): an entity without matches has an empty array."""
    raw = read_tsv(spark, path, ["source1_entity_id", "matched_entity_ids"])
    return raw.select(F.col("source1_entity_id").alias("s1_id"), id_list(F.col("matched_entity_ids")).alias("ids"))


def truth_pairs(truth: DataFrame) -> DataFrame:
    """(s1_id, cand_id) of ``load_truth``."""
    return truth.select("s1_id", F.explode("ids").alias("cand_id"))


def id_lists(s1: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    found = pairs.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("cand_id")), ",").alias(column))
    keep = [c for c in ("place",) if c in s1.columns]
    return s1.select(F.col("entity_id").alias("s1_id"), *keep).join(found, "s1_id", "left").withColumn(column, F.coalesce(column, F.lit("")))


#: Tables under so many bytes (as stored) are dealt out anew before heavy work.
SPREAD = 256 << 20


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, as the optimizer knows them (no pass over the data); 0 for what has no files."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(n for n in sizes if n < 1 << 60)


def spread(df: DataFrame) -> DataFrame:
    """A small table may lie in one row group, which one task reads: it is dealt out to all cores.  A large one has row groups enough."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if 0 < input_bytes(df) < SPREAD else df


def from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a record: the first six words are the name, all others the address, the language the country.

    Documents are dealt to the three sources by id; none is left out.  One without an id goes to source 3, named by
    the hash of its text; a null text is empty; repeated ids give repeated records.
    """
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), "[ \\t\\n\\r]+"), "")
    src = F.concat(F.lit("S"), F.coalesce(F.pmod("doc_id", F.lit(3)) + 1, F.lit(3)).cast("string"))
    number = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("none-"), F.hex(F.xxhash64("text"))))
    out = docs.select(number.alias("number"), src.alias("src"), words.alias("w"), "lang")
    return out.select(
        F.concat("src", F.lit("-"), "number").alias("entity_id"),
        F.array_join(F.slice("w", 1, 6), " ").alias("business_name"),
        F.when(F.size("w") > 6, F.array_join(F.slice("w", 7, F.greatest(F.size("w"), F.lit(1))), " ")).otherwise(F.lit("")).alias("business_address"),
        F.col("lang").alias("country"),
        "src",
    )
