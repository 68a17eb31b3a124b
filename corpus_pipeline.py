"""The training-corpus pipeline: documents in, packed training sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the
one before it kept; its result is written as Parquet to shared storage and read
again as the next one's documents. All stages but the last return the columns
of their documents, also extra ones, and empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import language, near_dups, packing, secrets
from touchline.llm.common import landed, table


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents with a language stay, or all with a letter if none could be learned; null, empty and letterless texts go."""
    names = _fresh(docs, "op8_language"), _fresh(docs, "op8_score")
    found = language.identify(docs, names, unlearned=None)
    return found.filter(~F.col(names[0]).eqNullSafe(language.UNKNOWN)).drop(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9, five words, 80 percent: one document of each group stays, that of the smallest id.

    Rows without an id stay. Of rows that repeat an id and its text one stays, the one
    whose columns, written as JSON, are least.
    """
    found = landed(near_dups.link(docs).select("doc_id", "kept"), "kept")
    gone = landed(found.filter("not kept").select("doc_id").distinct(), "gone")
    stay = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = landed(found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again")
    if again.isEmpty():
        return stay
    whole = F.struct(*docs.columns)
    once = stay.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min_by(whole, F.to_json(whole)).alias("row")).select("row.*")
    return stay.join(again, "doc_id", "left_anti").select(*docs.columns).union(once)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: all documents stay, the secrets in their texts are replaced by a mark."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the documents' pieces in sequences of 1024 tokens."""
    return packing.pack(packing.pieces(docs, packing.default_tokenizer())).drop("salt")


STAGES = [
    ("language", keep_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: The fitted language model and the tokenizer can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
