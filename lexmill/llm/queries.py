"""Registered queries of the training-data operators, with the equivalent SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import bpe, canon, case_links, langid, leakage, name_links
from lexmill.llm import incremental_dedup as inc
from lexmill.session import table

FIELDS = {"decision_number": "number", "liable_parties": "text", "search_blob": "text"}


def _records(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "practice").select(*columns).unionByName(table(spark, sf_dir, "practice_batches").select(*columns))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.canonical(_records(spark, sf_dir, "rec_id", *FIELDS), "rec_id", FIELDS, only_changed=True, texts=False).select("rec_id", "field_name")


def p2_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.canonical(_records(spark, sf_dir, "rec_id", *FIELDS), "rec_id", FIELDS)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrivals = table(spark, sf_dir, "practice_batches")
    index = inc.SegmentIndex(spark)
    index.accept(inc.act_parts(table(spark, sf_dir, "practice")))
    for row in arrivals.select("batch_no").distinct().orderBy("batch_no").collect():
        # each batch opens the index anew, as it would days later
        inc.SegmentIndex(spark, index.path).accept(inc.act_parts(arrivals.filter(F.col("batch_no") == row.batch_no)))
    return index.repeats(inc.act_parts(arrivals))


def p3_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return case_links.contested(table(spark, sf_dir, "practice"), table(spark, sf_dir, "court_docs"), table(spark, sf_dir, "court_texts"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_links(spark, sf_dir).select("rec_id", "cause_num")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_links.pairs(table(spark, sf_dir, "party_names"), "name_id").toDF("name_id_a", "name_id_b")


def p4_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_links.linked(table(spark, sf_dir, "party_names"), "name_id")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text", f"{bpe.TOKENIZERS}/{bpe.VOCABULARY}")


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.decode_corpus(p6_ids(spark, sf_dir), "doc_id", "ids", f"{bpe.TOKENIZERS}/{bpe.VOCABULARY}")


def _leaks(spark: SparkSession, sf_dir: str, detail: bool) -> DataFrame:
    return leakage.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), detail=detail)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir, False).select("doc_id", "item_id")


def p7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir, True)


def p7_clean_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return leakage.without_leaks(docs, _leaks(spark, sf_dir, False))


def _models(docs: DataFrame) -> langid.Models:
    return langid.train([(r.lang, r.t) for r in langid.sample(docs, "doc_id", "text", "lang").collect()])


def p8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.segments(docs, _models(docs)).drop("label", "langs")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.wrong_or_mixed(langid.segments(docs, _models(docs))).select("doc_id", "seg_no", "lang")


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_plain": p2_plain,
    "p3_found": p3_found,
    "p3_links": p3_links,
    "p4_found": p4_found,
    "p4_entities": p4_entities,
    "p6_ids": p6_ids,
    "p6_decoded": p6_decoded,
    "p7_found": p7_found,
    "p7_passages": p7_passages,
    "p7_clean_corpus": p7_clean_corpus,
    "p8_found": p8_found,
    "p8_segments": p8_segments,
}
SQL: dict[str, str] = {
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
