"""Sources and sinks: JSON with fallback, tab-separated registers, members of ZIP archives, binary documents, JSON and CSV sinks."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import clean, match_form

#: Entries of archives that are no documents.
JUNK = r"(?i)(?:^|/)(?:~\$|\._)|(?:^|/)(?:\.DS_Store|thumbs\.db)$|(?:^|/)__MACOSX(?:/|$)"


#: Parties that are no names.
GENERIC = ["інформація з обмеженим доступом", "інформація доступ до якої обмежено", "інформація доступ до якої є обмеженим", "особа 1", "особа 2", "особа 3", "фізична особа", "юридична особа"]
#: A practice record as files hold it (what loading needs).
PRACTICE = T.StructType([*[T.StructField(n, T.StringType()) for n in ("decision_key", "id", "decision_id", "decision_number", "decision_date", "decision_outcome")], T.StructField("liable_parties", T.ArrayType(T.StringType()))])


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def read_json(spark: SparkSession, schema: T.StructType, *paths: str, lines: bool = False) -> DataFrame:
    """The first of ``paths`` that exists, else an empty table. Records that don't parse come out as nulls and are dropped."""
    path = next((p for p in paths if exists(spark, p)), None)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", not lines).option("mode", "DROPMALFORMED").json(path)


def read_envelope(spark: SparkSession, schema: T.StructType, path: str, names: tuple[str, ...] = ("rows", "results", "items", "practice", "data")) -> DataFrame:
    """A JSON array of records, or an object that holds it under one of ``names`` (the first that is there)."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    text = spark.read.text(path, wholetext=True)
    bare = F.from_json("value", T.ArrayType(schema))
    inside = [F.from_json(F.get_json_object("value", f"$.{n}"), T.ArrayType(schema)) for n in names]
    rows = F.when(F.trim("value").startswith("["), bare).otherwise(F.coalesce(*inside))
    return text.select(F.posexplode(rows).alias("ord", "row")).select("ord", "row.*")


def practice_rows(rows: DataFrame) -> DataFrame:
    """Loaded records (see :func:`read_envelope`) with a number: ``row_id`` by the first key they have, clean parties, and parties in matched form without generic ones."""
    c = lambda n: F.when(clean(F.col(n)) != "", clean(F.col(n)))
    parties = F.filter(F.transform(F.coalesce("liable_parties", F.array().cast("array<string>")), clean), lambda x: x != "")
    norms = F.filter(F.transform(parties, match_form), lambda x: (x != "") & ~x.isin(*GENERIC) & ~x.rlike(r"^особа\s*\d+$"))
    key = F.coalesce(c("decision_key"), c("id"), c("decision_id"), F.concat(F.lit("practice-"), "ord"))
    return rows.filter(c("decision_number").isNotNull()).select(key.alias("row_id"), c("decision_number").alias("decision_number"), F.coalesce(c("decision_date"), F.lit("")).alias("decision_date"), "decision_outcome", parties.alias("liable_parties"), norms.alias("party_norms"))


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A tab-separated register with a header, all columns cleaned strings; rows with too few or too many fields are kept."""
    df = spark.read.csv(path, sep="\t", quote='"', header=True, encoding="UTF-8", mode="PERMISSIVE", inferSchema=False)
    df = df.toDF(*[c.replace("\ufeff", "") for c in df.columns])
    return df.select(*[(clean(F.col(f"`{c}`")) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in columns])


def dictionary(rows: DataFrame, code: str, name: str, order: Column) -> DataFrame:
    """Code to name; the last of repeated codes wins, empty codes are dropped."""
    return rows.filter(F.col(code).isNotNull() & (F.col(code) != "")).groupBy(code).agg(F.max_by(name, order).alias(name))


def archive_members(spark: SparkSession, path: str, pattern: str = r"(?i)\.(?:docx?|rtf|csv)$") -> DataFrame:
    """``archive, member, content`` of the members of ZIP files whose path matches; junk entries are left out, broken archives give no row.

    Each archive is read by one task; members come out one by one.
    """
    import re

    want, junk = re.compile(pattern), re.compile(JUNK)

    def run(batches):
        for b in batches:
            for archive, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue
                for name in z.namelist():
                    if want.search(name) and not junk.search(name):
                        yield pa.record_batch([pa.array([archive]), pa.array([name]), pa.array([z.read(name)], pa.binary())], names=["archive", "member", "content"])

    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(path).select("path", "content").mapInArrow(run, "archive string, member string, content binary")


def member(members: DataFrame, name: str) -> DataFrame:
    """The member of each archive whose file name is ``name`` in any case; of several the first by path."""
    base = F.lower(F.element_at(F.split("member", "/"), -1))
    return members.filter(base == name.lower()).groupBy("archive").agg(F.min_by(F.struct("member", "content"), "member").alias("_m")).select("archive", "_m.*")


def documents(spark: SparkSession, path: str) -> DataFrame:
    """``path, content, file_sha256`` of the documents of a folder and all below, without junk, in the order of the Ukrainian alphabet."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return df.filter(F.col("path").rlike(r"(?i)\.(?:docx?|rtf|html?|txt)$") & ~F.col("path").rlike(JUNK)).select("path", "content", F.sha2("content", 256).alias("file_sha256")).orderBy(F.collate("path", "uk"))


def archive_url(entries: DataFrame, name: str, order: str = "ord") -> DataFrame:
    """``url`` of a dataset's archive: the entry of exactly that name, else the first whose address ends in ``.zip``; one row, or none."""
    rank = F.when(F.col("name") == name, 0).when(F.lower("url").endswith(".zip"), 1)
    return entries.withColumn("_r", rank).filter("_r is not null").agg(F.min_by("url", F.struct("_r", order)).alias("url")).filter("url is not null")


def append_events(df: DataFrame, path: str, dry_run: bool = False) -> None:
    """Append rows to an event log of JSON lines, each with the time of writing; nothing on a dry run."""
    if not dry_run:
        df.withColumn("ts", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")).write.mode("append").json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Overwrite with JSON lines; the committer makes the folder appear as a whole."""
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """CSV of the named columns with a byte-order mark before its header; nested values as JSON text, other columns left out."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    df.select(*[(F.to_json(c) if isinstance(df.schema[c].dataType, nested) else F.col(c)).alias(("" if i else "\ufeff") + c) for i, c in enumerate(columns)]).write.mode("overwrite").option("header", True).csv(path)
