"""JSON, CSV, cache and file readers. Schemas are given, so nothing is scanned twice to infer them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = "struct<row:int,col:int,rowSpan:int,colSpan:int,text:string,bbox:array<double>>"
BOX = "struct<left:double,top:double,right:double,bottom:double,width:double,height:double>"
BLOCK = f"struct<id:string,type:string,text:string,code:string,bbox:{BOX},pageNumber:int,semanticRole:string,searchable:boolean,structureStatus:string,imageUri:string,assetSource:string,assetStatus:string,contentSha256:string,rows:array<array<string>>,cells:array<{CELL}>>"
ENTRY = f"struct<entryId:string,unitName:string,jobTitle:string,contentMarkdown:string,contentNormalized:string,pageNumber:int,position:int,kind:string,blocks:array<{BLOCK}>>"
META = "struct<schemaVersion:string,fileId:string,fileName:string,source:string,entriesCount:int,imagesCount:int,docSha256:string,pageSizes:map<string,array<double>>,coordinateUnit:string,buildTool:string>"
KB = f"fileMetadata {META}, entries array<{ENTRY}>"
MANIFEST = f"item_index int, kind string, pageNumber int, sourceEntryId string, outFile string, assetUri string, method string, score double, anchorText string, headingText string, bbox {BOX}"


def knowledge_bases(spark: SparkSession, path: str) -> DataFrame:
    """One row a file; a byte order mark is no harm, unknown keys are dropped, broken files have nulls."""
    return spark.read.schema(KB).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def kb_entries(kb: DataFrame) -> DataFrame:
    return kb.select(F.col("fileMetadata.fileId").alias("document_id"), F.posexplode("entries").alias("seq", "e")).select("document_id", "seq", "e.*")


def kb_blocks(kb: DataFrame) -> DataFrame:
    own = kb_entries(kb).select("document_id", "entryId", "position", F.posexplode("blocks").alias("block_seq", "b"))
    return own.select("document_id", "entryId", "position", "block_seq", "b.*")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"items array<struct<{', '.join(f'{a}:{b}' for a, b in (x.split(' ', 1) for x in MANIFEST.split(', ')))}>>").option("multiLine", True).json(path).select(F.explode("items").alias("i")).select("i.*")


def approvals(spark: SparkSession, path: str) -> DataFrame:
    """Pending corrections with a header line."""
    return spark.read.schema("entry_id string, before string, after string, confidence double").option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a partial run, whatever types were written; rows without an id are left out."""
    raw = spark.read.schema("entries array<struct<entryId:string,jobTitle:string,contentMarkdown:string,pageNumber:string,position:string>>").option("multiLine", True).json(path)
    own = raw.select(F.explode("entries").alias("e")).select("e.entryId", "e.jobTitle", "e.contentMarkdown", F.expr("try_cast(e.pageNumber as int)").alias("pageNumber"), F.expr("try_cast(e.position as int)").alias("position"))
    return own.where("entryId is not null")


IDENTITY = ("input_sha256", "page_number", "strategy", "fingerprint")


def cached_pages(cache: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hits and misses: a page is a hit only if all identity columns agree."""
    return wanted.join(cache, [*IDENTITY]), wanted.join(cache, [*IDENTITY], "left_anti")


def page_images(spark: SparkSession, path: str) -> DataFrame:
    """Pictures of pages with the page number of their name; contents are read only if they are used."""
    own = spark.read.format("binaryFile").option("pathGlobFilter", "*.{png,jpg,jpeg,webp}").load(path)
    number = F.regexp_extract(F.element_at(F.split("path", "/"), -1), r"([0-9]+)(?=\.[A-Za-z]+$)", 1)
    return own.where(number != "").withColumn("page_number", number.cast("int"))


def table_pictures(files: DataFrame) -> DataFrame:
    """Files with what their names tell of a table: page (null: for any page), position and idx, and rank: names with a page
    come first, then png, jpg, jpeg. files: path."""
    name = F.element_at(F.split("path", "/"), -1)
    found = lambda pattern: F.nullif(F.regexp_extract(name, rf"(?i)^{pattern}\.(?:png|jpg|jpeg)$", 1), F.lit("")).cast("long")
    page = F.coalesce(found(r"table_p(\d+)_pos\d+"), found(r"table_p(\d+)_idx\d+"))
    own = files.withColumns({"page_number": page, "position": F.coalesce(found(r"table_p\d+_pos(\d+)"), found(r"table_pos(\d+)")), "idx": found(r"table_p\d+_idx(\d+)")})
    kind = F.array_position(F.array(*map(F.lit, ("png", "jpg", "jpeg"))), F.lower(F.regexp_extract(name, r"\.([A-Za-z]+)$", 1)))
    return own.where("position is not null or idx is not null").withColumn("rank", F.when(page.isNotNull(), 0).otherwise(10) + kind)


def table_picture_of(tables: DataFrame, files: DataFrame) -> DataFrame:
    """Each table's picture by page and position, else by position alone; by page and index where names have that. tables:
    document_id, page_number, position, idx. files: document_id, path. Adds path."""
    own = table_pictures(files).withColumnRenamed("page_number", "f_page").withColumnRenamed("position", "f_position").withColumnRenamed("idx", "f_idx")
    placed = tables.join(own.where("f_position is not null"), "document_id").where("f_position = position and (f_page is null or f_page = page_number)")
    counted = tables.join(own.where("f_idx is not null"), "document_id").where("f_idx = idx and f_page = page_number")
    best = placed.unionByName(counted).groupBy("document_id", "page_number", "position", "idx").agg(F.min(F.struct("rank", "path")).alias("b"))
    return tables.join(best.select("document_id", "page_number", "position", "idx", "b.path"), ["document_id", "page_number", "position", "idx"], "left")
