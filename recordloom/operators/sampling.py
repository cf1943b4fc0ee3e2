"""Folds kept in a file, subsamples of a split that keep its density, and a mini data set in the original layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators import evaluate
from recordloom.sources import outputs, records


def kept_folds(spark: SparkSession, ids: DataFrame, path: str, n: int = 5) -> DataFrame:
    """(s1_id, fold) of exactly ``ids``: from the file at ``path`` if there is one, else dealt and written there.

    A file may have more ids; an id that it lacks raises ValueError, as a fold must never change silently.
    """
    if outputs.exists(spark, path):
        have = spark.read.schema("s1_id string, fold int").option("header", True).csv(path)
        own = ids.select("s1_id").distinct().join(have, "s1_id", "left")
        lack = own.where("fold IS NULL").count()
        if lack:
            raise ValueError(f"{lack} entities have no fold in {path}")
        return own
    evaluate.folds(ids.select("s1_id").distinct(), n).write.option("header", True).csv(path)
    return kept_folds(spark, ids, path, n)


def _order(c: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(c)).cast("binary"))


def first_by_hash(df: DataFrame, c: str, n: int, seed: int) -> DataFrame:
    """The ``n`` rows of smallest digest of ``c``: an exact number, by TakeOrdered where it is small."""
    return df.orderBy(_order(c, seed), c).limit(max(0, n))


def subsample(s1: DataFrame, s23: DataFrame, n: int, seed: int = 42, truth: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(n entities, records): the records keep their number per entity.

    With ``truth`` (s1_id, cand_id) all true matches of the kept entities stay, and others fill up; without, records are
    thinned at the same rate.  If there are no more than ``n`` entities, all stays.
    """
    entities, pool = s1.count(), s23.count()
    if n >= entities:
        return s1, s23
    keep = first_by_hash(s1.select("entity_id"), "entity_id", n, seed)
    most = round(n * pool / entities)
    if truth is None:
        wanted = first_by_hash(s23.select("entity_id"), "entity_id", most, seed)
    else:
        own = truth.join(keep.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi").select(F.col("cand_id").alias("entity_id")).distinct()
        others = s23.select("entity_id").join(own, "entity_id", "left_anti")
        wanted = own.unionByName(first_by_hash(others, "entity_id", most - own.count(), seed))
    return s1.join(keep, "entity_id", "left_semi"), s23.join(wanted, "entity_id", "left_semi")


def mini_dataset(spark: SparkSession, folder: str, dest: str, sizes: dict[str, int], seed: int = 7) -> None:
    """A smaller copy of the splits ``sizes`` (split: entities) in the layout of the original, rows in their order."""
    for split, n in sizes.items():
        s1 = records.read_tsv(spark, f"{folder}/{split}/{split}_source1.tsv", with_place=True)
        each = {k: records.read_tsv(spark, f"{folder}/{split}/{split}_source{k}.tsv", with_place=True) for k in (2, 3)}
        path = f"{folder}/{split}/{split}_ground_truth.tsv"
        truth = None
        if outputs.exists(spark, path):
            raw = records.read_tsv(spark, path, ["source1_entity_id", "matched_entity_ids"], with_place=True)
            truth = records.truth_pairs(records.load_truth(spark, path))
        pool = each[2].select("entity_id").unionByName(each[3].select("entity_id"))
        some, wanted = subsample(s1, pool, n, seed, truth)
        outputs.write_tsv(some, records.COLS, f"{dest}/{split}/{split}_source1.tsv")
        for k, df in each.items():
            outputs.write_tsv(df.join(wanted, "entity_id", "left_semi"), records.COLS, f"{dest}/{split}/{split}_source{k}.tsv")
        if truth is not None:
            kept = raw.join(some.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
            outputs.write_tsv(kept, ["source1_entity_id", "matched_entity_ids"], f"{dest}/{split}/{split}_ground_truth.tsv")

