"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept. All but
the last return the columns of ``docs``; between stages the rows are written as Parquet to the
shared folder and read again, so a lost executor never costs more than its stage.

1. quality classifier: documents scored under 0.3 go.
2. line dedup: lines found in 10 documents or more go, everywhere; documents stay (a text may
   become empty), ``n_chars`` follows the text.
3. SimHash near-dedup: of each group the document with the smallest id stays.
4. benchmark decontamination: documents that hold a benchmark item go.
5. packing: pieces of token sequences.

Null ids, null and empty texts, repeated rows and empty tables: see the operators. A null text
is empty after stage 2. Every stage passes extra columns through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm import catalog, fm, latent, linededup, simhash
from wardlake.llm.common import table, written
from wardlake.session import prepare

#: The stages need a trained model, XXH64 fingerprints and a tokenizer: not expressible in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = fm.train(docs, table(spark, sf_dir, "labels"))
    return fm.score(docs, machine).where(F.col("score") >= catalog.QUALITY_CUT).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = linededup.dedup_lines(docs, min_docs=10, min_chars=1)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, written(simhash.near_groups(docs, shingle=3, radius=3), "groups"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return latent.without_leaks(docs, latent.leaks(docs, table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return catalog.packed(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("decontamination", decontaminate), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}", retire=docs)
    return docs
