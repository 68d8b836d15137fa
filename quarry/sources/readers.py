"""Readers: page files, volumes, page XML, shards, verse tables, word tables, postings, character frequencies, incremental discovery."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, FloatType, MapType, StringType, StructField, StructType

from ..functions.text import SCRIPTS


def page_files(spark: SparkSession, folder: str, suffix: str = "txt", recursive: bool = False) -> DataFrame:
    """volume, path, stem, page_num, raw: one row for each file of ``folder/<volume>/...``; names without a number at the end are passed
    over, leading zeros do not count (S01)."""
    reader = spark.read.option("wholetext", True).option("pathGlobFilter", f"*.{suffix}").option("recursiveFileLookup", recursive)
    files = reader.text(folder if recursive else f"{folder}/*/text").select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    return with_identity(files).where(F.col("page_num").isNotNull())


def with_identity(files: DataFrame) -> DataFrame:
    """volume, stem and page_num by the path ``.../<volume>/text/<stem>.<suffix>``."""
    stem = F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)
    number = F.nullif(F.regexp_extract(stem, r"([0-9]+)$", 1), F.lit("")).cast("int")
    return files.withColumn("volume", F.regexp_extract("path", r"/([^/]+)/text/[^/]+$", 1)).withColumn("stem", stem).withColumn("page_num", number)


def volume_parts(volume: Column, series: str = "PG|PL|PO") -> Column:
    """struct(series, number, suffix) of a volume's name; null if it has another form."""
    form = f"^({series})([0-9]+)(.*)$"
    return F.when(volume.rlike(form), F.struct(F.regexp_extract(volume, form, 1).alias("series"), F.regexp_extract(volume, form, 2).cast("int").alias("number"), F.regexp_extract(volume, form, 3).alias("suffix")))


def is_canonical(volume: str = "volume", stem: str = "stem", page: str = "page_num") -> Column:
    """Whether a file is named ``<volume>-NNN``."""
    return F.col(stem).rlike("^.*-[0-9]+$") & (F.regexp_replace(stem, "-[0-9]+$", "") == F.col(volume))


def chosen_pages(files: DataFrame, volume: str = "volume", page: str = "page_num", name: str = "stem") -> DataFrame:
    """volume, page, chosen, ambiguous: the canonical name wins, then the only candidate; else none is chosen."""
    found = files.withColumn("_c", is_canonical(volume, name, page)).groupBy(volume, page).agg(F.min(F.when(F.col("_c"), F.col(name))).alias("_canonical"), F.sum(F.col("_c").cast("int")).alias("_n"), F.count("*").alias("_all"), F.min(name).alias("_only"))
    chosen = F.when(F.col("_n") == 1, F.col("_canonical")).when(F.col("_all") == 1, F.col("_only"))
    return found.select(volume, page, chosen.alias("chosen"), chosen.isNull().alias("ambiguous"))


def unique_pages(files: DataFrame, **names) -> DataFrame:
    """``chosen_pages``; the job fails if a page is ambiguous."""
    found = chosen_pages(files, **names)
    return found.where(F.coalesce(F.assert_true(~F.col("ambiguous"), F.lit("an ambiguous page")).isNull(), F.lit(True)))


def preferred_pages(files: DataFrame, volume: str = "volume", page: str = "page_num", name: str = "stem") -> DataFrame:
    """The files without the UUID-named ones that have a canonical twin."""
    uuid = F.col(name).rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}-[0-9]+$")
    twin = F.max(is_canonical(volume, name, page)).over(Window.partitionBy(volume, page))
    return files.withColumn("_t", twin).where(~(uuid & F.col("_t"))).drop("_t")


# --- page XML

BLOCK = StructType([StructField(n, StringType()) for n in ("tag", "type", "script", "bbox", "text")])
PAGE = StructType([StructField("state", StringType()), StructField("type", StringType()), StructField("attributes", MapType(StringType(), StringType())), StructField("blocks", ArrayType(BLOCK)), StructField("how", StringType())])
_TAGS = ("bloco", "cabecalho", "rodape", "block", "header", "footer")
_BLOCK_FORM = re.compile(rf"<({'|'.join(_TAGS)})\b([^>]*)>(.*?)</\1\s*>", re.DOTALL)
_ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*[\"']([^\"']*)[\"']")


def parse_page(raw: str | None) -> dict:
    """A page's state, type, attributes and blocks in order: well-formed XML, then XML with bare ampersands repaired, then by pattern;
    what is no XML is one main block (S07, S08)."""
    text = (raw or "").strip()
    if not re.match(r"<(\?xml|pagina|page)\b", text):
        return {"state": None, "type": None, "attributes": {}, "blocks": [{"tag": "bloco", "type": "texto_principal", "script": None, "bbox": None, "text": text}] if text else [], "how": "plain"}
    for how, candidate in (("xml", text), ("repaired", re.sub(r"&(?!#?\w+;)", "&amp;", text))):
        try:
            root = ElementTree.fromstring(candidate)
        except ElementTree.ParseError:
            continue
        blocks = [_block(e.tag, e.attrib, "".join(e.itertext())) for e in root.iter() if e.tag in _TAGS]
        return _page(root.attrib, blocks, how)
    head = re.match(r"(?:<\?xml[^>]*>\s*)?<(?:pagina|page)\b([^>]*)>", text)
    blocks = [_block(tag, dict(_ATTRIBUTE.findall(attributes)), re.sub(r"<[^>]+>", " ", body)) for tag, attributes, body in _BLOCK_FORM.findall(text)]
    return _page(dict(_ATTRIBUTE.findall(head.group(1))) if head else {}, blocks, "pattern")


def _block(tag: str, attributes: dict, text: str) -> dict:
    kind = attributes.get("tipo", attributes.get("type", tag))
    return {"tag": tag, "type": kind, "script": attributes.get("script"), "bbox": attributes.get("bbox"), "text": text.strip()}


def _page(attributes: dict, blocks: list[dict], how: str) -> dict:
    return {"state": attributes.get("estado", attributes.get("state")), "type": attributes.get("tipo", attributes.get("type")), "attributes": dict(attributes), "blocks": blocks, "how": how}


@F.pandas_udf(PAGE)
def page_xml(raw: pd.Series) -> pd.DataFrame:
    """``parse_page`` of each page."""
    return pd.DataFrame([parse_page(r) for r in raw], columns=["state", "type", "attributes", "blocks", "how"])


def blocks_by_pattern(raw: Column) -> Column:
    """The contents of blocks of malformed XML, by built-in expressions."""
    bodies = F.regexp_extract_all(raw, F.lit(r"(?s)<(?:bloco|cabecalho|rodape)\b[^>]*>(.*?)</(?:bloco|cabecalho|rodape)>"), F.lit(1))
    return F.transform(bodies, lambda b: F.trim(F.regexp_replace(b, "<[^>]+>", " ")))


def page_text(page: Column) -> Column:
    """struct(text, non_latin_only): Latin and mixed blocks, unless they are fewer than half; then all. A block without a script is mixed
    if a tenth of its letters is Latin. An empty page has no text (S09)."""
    letters = lambda b, r: F.regexp_count(b["text"], F.lit(f"[{r}]"))
    latin = lambda b: b["script"].isin("latino", "misto", "latin", "mixed") | (b["script"].isNull() & (letters(b, SCRIPTS["latin"]) * 10 >= F.regexp_count(b["text"], F.lit(r"\p{L}"))))
    blocks = F.when(page["state"].isin("vazio", "empty"), F.array().cast(ArrayType(BLOCK))).otherwise(page["blocks"])
    kept = F.filter(blocks, lambda b: F.coalesce(latin(b), F.lit(False)))
    use = F.when(F.size(kept) * 2 >= F.size(blocks), kept).otherwise(blocks)
    return F.struct(F.array_join(F.transform(use, lambda b: b["text"]), "\n").alias("text"), ((F.size(blocks) > 0) & (F.size(kept) == 0)).alias("non_latin_only"))


# --- tables

SHARD = "volume string, page int, text string, summary string, keywords array<string>"


def shards(spark: SparkSession, path: str, schema: str = SHARD) -> DataFrame:
    """Page records of JSON lines files, plain or gzip."""
    return spark.read.schema(schema).json(path)


def with_translations(legacy: DataFrame, generations: DataFrame, translations: DataFrame, locales: list[str], key: str = "page_id") -> DataFrame:
    """Each legacy row with its current generation and, for each locale, its newest completed translation.

    ``generations``: key, generation_id, summary, is_current; ``translations``: generation_id, locale, id, status, text.
    """
    current = generations.where("is_current").select(key, "generation_id", F.col("summary").alias("current_summary"))
    newest = translations.where("status = 'completed'").groupBy("generation_id").pivot("locale", locales).agg(F.max_by("text", "id"))
    return legacy.join(current, key, "left").join(newest, "generation_id", "left").withColumn("summary", F.coalesce("current_summary", "summary")).drop("current_summary")


def embeddings(blobs: DataFrame, key: str, blob: str, dimension: str) -> DataFrame:
    """key, vector of float32 bytes; bytes of another length than the dimension's are null."""

    @F.pandas_udf(ArrayType(FloatType()))
    def unpack(data: pd.Series, size: pd.Series) -> pd.Series:
        return pd.Series([list(struct.unpack(f"<{n}f", d)) if d is not None and n is not None and len(d) == 4 * n else None for d, n in zip(data, size)])

    return blobs.select(key, unpack(F.col(blob), F.col(dimension)).alias("vector"))


def jdbc(spark: SparkSession, url: str, source: str, key: str, low: int, high: int, parts: int = 16, **options) -> DataFrame:
    """A table of another database, read in ranges of the key."""
    return spark.read.jdbc(url, source, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=options)


def verses(spark: SparkSession, path: str) -> DataFrame:
    """version, book, chapter, verse, text of CSV files with a header, one row for each verse."""
    rows = spark.read.option("header", True).schema("version string, book string, chapter int, verse int, text string").csv(path)
    return rows.groupBy("version", "book", "chapter", "verse").agg(F.min("text").alias("text"))


def word_blocks(words: DataFrame, page: list[str] | None = None) -> DataFrame:
    """block, bbox, text of a word table (level, block, line, word, left, top, width, height, text): words in order, lines by line ends."""
    keys = page or []
    rows = words.where("trim(text) <> ''")
    lines = rows.groupBy(*keys, "block", "line").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word", "text"))), lambda w: w["text"]), " ").alias("t"),
        F.min("left").alias("x1"), F.min("top").alias("y1"), F.max(F.col("left") + F.col("width")).alias("x2"), F.max(F.col("top") + F.col("height")).alias("y2"),
    )
    joined = lines.groupBy(*keys, "block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "t"))), lambda x: x["t"]), "\n").alias("text"), F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2")
    )
    return joined.select(*keys, "block", F.concat_ws(",", "x1", "y1", "x2", "y2").alias("bbox"), "text")


def running_sums(postings: DataFrame, keys: list[str], order: str, delta: str, value: str) -> DataFrame:
    """The postings with ``value``: delta-coded numbers undone."""
    return postings.withColumn(value, F.sum(delta).over(Window.partitionBy(*keys).orderBy(order)))


def decoded_locations(shards_: DataFrame, key: str, deltas: str, masks: str) -> DataFrame:
    """key, page, mask of arrays of page deltas and masks."""
    pages = F.transform(F.col(deltas), lambda _, i: F.aggregate(F.slice(deltas, F.lit(1), i + 1), F.lit(0), lambda a, x: a + x))
    return shards_.select(key, F.explode(F.arrays_zip(pages.alias("page"), F.col(masks).alias("mask"))).alias("l")).select(key, "l.page", "l.mask")


def character_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """character, n of lines such as ``  12 a``."""
    rows = spark.read.text(path)
    form = r"^\s*([0-9]+) (.)$"
    return rows.where(F.col("value").rlike(form)).select(F.regexp_extract("value", form, 2).alias("character"), F.regexp_extract("value", form, 1).cast("long").alias("n"))


# --- the binary side file of page places

MAGIC = b"QLOC1"


def varuint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def decode_places(payload: bytes) -> Iterator[tuple[int, str, int]]:
    """(doc_id, volume, page) of a side file: names of volumes, then for each document a volume's number and a page, as LEB128 numbers;
    the crc32 at the end must be right (S16)."""
    import zlib

    if payload[: len(MAGIC)] != MAGIC or int.from_bytes(payload[-4:], "little") != zlib.crc32(payload[:-4]):
        raise ValueError("not a side file of places")
    count, at = varuint(payload, len(MAGIC))
    volumes = []
    for _ in range(count):
        size, at = varuint(payload, at)
        volumes.append(payload[at : at + size].decode())
        at += size
    count, at = varuint(payload, at)
    for doc in range(count):
        volume, at = varuint(payload, at)
        page, at = varuint(payload, at)
        yield doc, volumes[volume], page


class PlacesSource(DataSource):
    """``spark.read.format("places").option("binary", hex)``: the rows of a side file given as hexadecimal digits; files come through
    ``places``, which reads by Spark's own reader."""

    @classmethod
    def name(cls) -> str:
        return "places"

    def schema(self) -> str:
        return "doc_id long, volume string, page int"

    def reader(self, schema) -> DataSourceReader:
        return _PlacesReader(self.options.get("binary", ""))


class _PlacesReader(DataSourceReader):
    def __init__(self, payload: str):
        self.payload = payload

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        yield from decode_places(bytes.fromhex(self.payload))


def places(spark: SparkSession, path: str) -> DataFrame:
    """path, doc_id, volume, page of side files, a task each."""

    def run(batches):
        for batch in batches:
            for path_, content in zip(batch["path"], batch["content"]):
                yield pd.DataFrame([(path_, *row) for row in decode_places(bytes(content))], columns=["path", "doc_id", "volume", "page"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, doc_id long, volume string, page int")
