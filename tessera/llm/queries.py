"""The registered queries of the subpackage: each applies one operator, with
production parameters, to its whole table.  ``QUERIES`` has the functions
(spark, sf_dir) -> DataFrame, ``ORACLE_SQL`` the DuckDB text where SQL can say
the same."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import table
from . import align, ann, chat, decontam, html_extract, langid, license_scan, mixing, repair, toxicity, warc
from . import token_count as tokens
from .jaccard import jaccard_components
from .sampling import held_out

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: Mixing: targets are the sources' sizes in characters to this power; a block has so many characters.
TEMPER, BLOCK = 0.5, 65_536


@query
def op1_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.char_length("text").alias("chars"))
    got = mixing.mix(docs, "source", TEMPER, BLOCK, F.col("chars"))
    return got.select("row.doc_id", "row.source", "row.chars", "phase", "block", "slot", "at")


@query
def op2_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out("doc_id", 3, 1)
    machine = toxicity.fit(docs, labels.where(~out))
    got = toxicity.score(docs, machine, carry=["doc_id"]).select("row.doc_id", "score")
    return got.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op3_block_matrix_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    got = html_extract.main_text(pages, html_extract.learn_weights(pages), carry=["page_id", "url"])
    return got.select("row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_matches(table(spark, sf_dir, "documents"))


ORACLE_SQL["op5_license_scan"] = license_scan.oracle()


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return got.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def conversation_events(rows: DataFrame) -> DataFrame:
    """The log of a table of turns: each row opens a message at its turn and
    streams its text as one delta; equal rows are messages of their own."""
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    message = rows.select("conv_id", "role", "text", F.struct("turn", nth.alias("nth")).alias("msg"))
    opened = message.select("conv_id", "msg", F.struct(F.col("msg.turn"), F.lit(0).alias("step")).alias("seq"),
                            F.lit("open").alias("op"), "role", F.lit("").alias("text"))
    delta = message.select("conv_id", "msg", F.struct(F.col("msg.turn"), F.lit(1).alias("step")).alias("seq"),
                           F.lit("delta").alias("op"), F.lit(None).cast("string").alias("role"), "text")
    return opened.union(delta)


@query
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"),
                                                               F.lit(role).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
                                                      for turn, role in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    messages = chat.fold_events(conversation_events(rows.union(probe)))
    return chat.digests(chat.format_conversations(messages))


@query
def op9_language_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 5, 0)
    model = langid.fit(docs.where(~out))
    got = langid.predict(docs, model, carry=["doc_id"]).select("row.doc_id", "lang_pred", "score", "ambiguous")
    return got.select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


@query
def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.Vocabulary.read(os.environ.get("TESSERA_UNIGRAM_MODEL", TOKENIZER))
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary, carry=["doc_id"]).select("row.doc_id", "n_tokens")


#: Of alignment: a byte-level BPE of the ``tokenizers`` library and a sentencepiece model.
BYTE_BPE, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = align.TokenizerPair.read(os.environ.get("TESSERA_BYTE_BPE", BYTE_BPE), os.environ.get("TESSERA_PIECES", PIECES))
    got = align.alignment_counts(table(spark, sf_dir, "documents"), pair, carry=["doc_id"])
    return got.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query
def op12_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.archive_pages(table(spark, sf_dir, "pages"))
    files = warc.export_warc(archive)
    archive.close()
    return warc.page_report(warc.read_warc(spark, files))


ORACLE_SQL["op12_warc_archive"] = warc.oracle()


@query
def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.report(repair.damaged(rows), rows)
