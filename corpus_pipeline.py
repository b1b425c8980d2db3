"""From raw documents to training tokens: five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as Parquet to the
shared folder and reads them again for the next. All stages but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campusgrid.llm.mixing import WORD, mix_sources
from campusgrid.llm.pieces import decode, encode
from campusgrid.llm.queries import MIX, PIECE_MODEL, domain, table
from campusgrid.llm.shelf import discard_all, fresh, save, tables
from campusgrid.llm.simhash import row_key, simhash_groups
from campusgrid.llm.substring_dedup import remove_repeats
from campusgrid.llm.toxicity import toxicity


def _restored(frame: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of ``docs`` from ``row`` and a text column."""
    return frame.select(*[F.col(text).alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain holds for toxic (probability 0.5 or more) go.

    A document without words (null, empty) has the models' base rate, so it stays unless most labelled documents are
    toxic. Rows are judged one by one, so repeated rows fare alike. Without labels nothing is learned and nothing goes.
    Null ids and extra columns of any name change nothing."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return _restored(scored.where("p_toxic < 0.5"), docs, "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near copies (fingerprints linked at two or fewer differing bits) one document stays: the
    one with the smallest id, of several with that id the one with the smallest hash of its text.

    Documents without words (null, empty) are copies of each other. Rows with a null id go where their fingerprint has
    a group with an id; of other rows with a null id one of each fingerprint stays. Of repeated rows one stays. No
    documents: no rows. Columns may have any names."""
    groups = save(simhash_groups(docs), "near_copies")
    first = F.min(F.struct(F.col("id").isNull(), "id", "row_key"))
    known = groups.where("component_id is not null").groupBy("component_id").agg(first.alias("first")).select("first.row_key")
    other = groups.where("component_id is null").groupBy("print").agg(F.min("row_key").alias("row_key")).select("row_key")
    times = groups.groupBy("row_key").agg(F.count(F.lit(1)).alias("times"))
    kept = save(times.join(known.unionByName(other).distinct(), "row_key", "left_semi"), "kept")
    rows = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    once = rows.join(kept.where("times = 1"), "row_key", "left_semi")
    again = rows.join(kept.where("times > 1"), "row_key", "left_semi").dropDuplicates(["row_key"])
    return once.unionByName(again).select(*[F.col(f"row.`{c}`") for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a document with a smaller id has are cut out; n_chars follows.

    No document goes, though its text may end up empty; a null text stays null. Rows with one id, repeated rows too,
    cut nothing from each other; a row with a null id loses nothing. Extra columns are kept."""
    cut = _restored(remove_repeats(docs, rejoin=False), docs, "kept_text")
    return cut.withColumn("n_chars", F.length("text").cast("bigint"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights; the one in which a leaf's budget ends is shortened to its share.

    Documents without words have nothing to add and are not drawn. A document may come once per epoch; repeated rows
    are drawn apart; ties of the seeded order go by id and text. Null languages or sources make leaves of their own."""
    mixed = mix_sources(docs, domain(), MIX, budget_share=0.8, max_epochs=2, seed=7)
    whole = F.col("take_tokens") >= F.col("n_tokens")
    words = F.regexp_extract_all(F.col("row.text"), F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(words, F.lit(1), F.col("take_tokens").cast("int")), " ")
    mixed = mixed.withColumn("part", F.when(whole, F.col("row.text")).otherwise(part))
    return _restored(mixed, docs, "part").withColumn("n_chars", F.length("text").cast("bigint"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the text they decode to as a hash: one row per row, null and empty texts without pieces."""
    coded = decode(encode(docs, PIECE_MODEL, dropout=0.1, seed=1), PIECE_MODEL)
    return coded.select(
        "row.doc_id", "row.lang", "row.source", "pieces", F.size("pieces").cast("bigint").alias("n_pieces"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("mixing", mix),
    ("sentencepiece", to_pieces),
]

#: No SQL: the classifier is fitted, and near copies are components of a link graph.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's own tables and its input go once its output is written."""
    docs, last = table(spark, sf_dir, "documents"), set()
    for name, stage in STAGES:
        before, path = tables(), fresh(spark, f"stage-{name}")
        docs = save(stage(spark, docs, sf_dir), name, path)
        discard_all(spark, (tables() - before - {path}) | last)
        last = {path}
    return docs
