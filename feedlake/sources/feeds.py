"""Landed feed documents (RSS and Atom) as rows of feed entries.

An entry has `link, title, published, updated, summary, description`, all
strings, null where the document has no such element. Fetching over the
network is left to whatever lands the files.

Names keep their prefixes, so that `<media:title>` or `<atom:link>` beside a `<title>`
or `<link>` is not taken for it; of the prefixed elements only `<dc:date>` is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from feedlake.functions.text import strip
from feedlake.operators.joins import lookup_join
from feedlake.schema import FEEDS
from feedlake.session import cut_lineage

ENTRY_FIELDS = ["link", "title", "published", "updated", "summary", "description"]


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


RSS_ITEM = StructType(
    [
        *_strings("title", "link", "pubDate", "dc:date", "date", "description", "summary"),
        StructField("guid", StructType(_strings("_VALUE", "_isPermaLink"))),
    ]
)

ATOM_ENTRY = StructType(
    [
        *_strings("title", "published", "updated"),
        StructField("link", ArrayType(StructType(_strings("_href", "_rel")))),
        StructField("summary", StructType(_strings("_VALUE", "_type"))),
        StructField("content", StructType(_strings("_VALUE", "_type"))),
    ]
)

# The name of the root element is not looked at, so one shape reads the three
# kinds of document: items in a channel, items at the root, and entries.
DOCUMENT = StructType(
    [
        StructField("channel", StructType([StructField("item", ArrayType(RSS_ITEM))])),
        StructField("item", ArrayType(RSS_ITEM)),
        StructField("entry", ArrayType(ATOM_ENTRY)),
    ]
)

_XML = {"ignoreNamespace": "false"}

_BARE_AMPERSAND = "&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)"


def _is_read(document: Column) -> Column:
    return document["channel"].isNotNull() | document["item"].isNotNull() | document["entry"].isNotNull()


def _rss_entry(item: Column) -> list[Column]:
    # A guid stands in for a missing link unless it is marked as no permalink.
    guid = item["guid"]
    is_link = F.coalesce(F.lower(guid["_isPermaLink"]), F.lit("true")) == "true"
    return [
        strip(F.coalesce(item["link"], F.when(is_link, guid["_VALUE"]))).alias("link"),
        item["title"].alias("title"),
        strip(item["pubDate"]).alias("published"),
        strip(F.coalesce(item["dc:date"], item["date"])).alias("updated"),
        item["summary"].alias("summary"),
        item["description"].alias("description"),
    ]


def _atom_entry(entry: Column) -> list[Column]:
    alternate = F.filter(entry["link"], lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")
    return [
        strip(F.get(alternate, F.lit(0))["_href"]).alias("link"),
        entry["title"].alias("title"),
        strip(entry["published"]).alias("published"),
        strip(entry["updated"]).alias("updated"),
        entry["summary"]["_VALUE"].alias("summary"),
        entry["content"]["_VALUE"].alias("description"),
    ]


def feed_list(spark: SparkSession, feeds: list[tuple[str, str]] = FEEDS) -> DataFrame:
    """(feed_no, source, feed_url) in list order."""
    rows = [(number, name, url) for number, (name, url) in enumerate(feeds)]
    return spark.createDataFrame(rows, "feed_no int, source string, feed_url string")


def _parsed(documents: DataFrame, xml: str) -> DataFrame:
    """All other columns, and `d`: the document, read strictly or else with its ampersands mended."""
    kept = [c for c in documents.columns if c != xml]
    strict = documents.select(*kept, xml, F.from_xml(F.col(xml), DOCUMENT, _XML).alias("_strict"))
    mended = F.from_xml(F.regexp_replace(F.col(xml), _BARE_AMPERSAND, "&amp;"), DOCUMENT, _XML)
    return strict.select(*kept, F.when(_is_read(F.col("_strict")), F.col("_strict")).otherwise(mended).alias("d"))


def _entries(parsed: DataFrame) -> DataFrame:
    kept = [c for c in parsed.columns if c != "d"]

    def all_of(items: Column, entry) -> Column:
        return F.coalesce(F.transform(items, lambda item: F.struct(*entry(item))), F.array())

    found = F.concat(
        all_of(F.col("d.channel.item"), _rss_entry),
        all_of(F.col("d.item"), _rss_entry),
        all_of(F.col("d.entry"), _atom_entry),
    )
    return parsed.select(*kept, F.posexplode(found).alias("entry_no", "e")).select(*kept, "entry_no", "e.*")


def _unread(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~_is_read(F.col("d")) | F.col("d").isNull()).drop("d")


def entries_from_documents(documents: DataFrame, xml: str = "xml") -> DataFrame:
    """Explode a column of whole RSS or Atom documents into entries.

    All other columns are kept; `entry_no` is the place within the document. A
    document that is no XML only because of its ampersands (`A & B`, `&nbsp;`)
    is read a second time with these escaped. Documents that cannot be read at all give no
    entries here; `unread_documents` has them.
    """
    return _entries(_parsed(documents, xml))


def unread_documents(documents: DataFrame, xml: str = "xml") -> DataFrame:
    """The other columns of the documents that cannot be read as a feed."""
    return _unread(_parsed(documents, xml))


def read_documents(documents: DataFrame, xml: str = "xml") -> tuple[DataFrame, DataFrame]:
    """(entries, unread documents): each document is parsed once, and what was parsed is stored."""
    parsed = cut_lineage(_parsed(documents, xml), "parsed-feeds")
    return _entries(parsed), _unread(parsed)


def read_feed_files(spark: SparkSession, path: str) -> DataFrame:
    """(feed_url, xml): landed files below `<path>/feed_url=<escaped url>/`, one document each."""
    schema = StructType(_strings("value", "feed_url"))
    return spark.read.schema(schema).text(path, wholetext=True).select("feed_url", F.col("value").alias("xml"))


# Feed formats by the element that holds an entry.
_BROKEN = "_broken"
_KINDS = {"item": (RSS_ITEM, _rss_entry), "entry": (ATOM_ENTRY, _atom_entry)}


def read_large_feeds(spark: SparkSession, path: str, tag: str = "item") -> DataFrame:
    """(feed_url, file, entry_no, link, …) of landed files with very many entries, below `<path>/feed_url=<escaped url>/`.

    A file is cut behind the end tags of its entries, so that several tasks read one file and no row holds more than an
    entry; each entry is then parsed alone. `tag` is `item` (RSS) or `entry` (Atom). Gives what
    `entries_from_documents` gives, for documents that can be read; of others, the entries that can, a last one without its end tag too. An
    end tag must be written without blanks and not stand in a comment or a CDATA section.
    """
    shape, entry = _KINDS[tag]
    text = spark.read.schema(StructType(_strings("value", "feed_url"))).option("lineSep", f"</{tag}>").text(path)
    begin = F.regexp_instr("value", F.lit(f"<{tag}(?=[\\s>])"))
    cut = text.select(
        "feed_url",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
        F.concat(F.substring("value", begin, F.length("value")), F.lit(f"</{tag}>")).alias("xml"),
    )
    cut = cut.filter(begin > 0).drop("value")
    # A broken entry leaves what was read before the break; it is told by its text in a column of its own.
    noted = StructType([*shape.fields, StructField(_BROKEN, StringType())])
    options = _XML | {"columnNameOfCorruptRecord": _BROKEN}
    strict = cut.withColumn("_strict", F.from_xml("xml", noted, options))
    mended = F.from_xml(F.regexp_replace("xml", _BARE_AMPERSAND, "&amp;"), noted, options)
    read = strict.withColumn("e", F.when(F.col("_strict")[_BROKEN].isNull(), F.col("_strict")).otherwise(mended))
    read = read.filter(F.col("e").isNotNull() & F.col("e")[_BROKEN].isNull())
    # Entries are numbered by their place in their piece and the counts of the pieces before it.
    rows = cut_lineage(read.select("feed_url", "file", "_block", "_row", "e"), "entries")
    piece = Window.partitionBy("file", "_block").orderBy("_row")
    counts = rows.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_nth", F.row_number().over(piece) - 1).join(offsets, ["file", "_block"])
    number = (F.col("_before") + F.col("_nth")).cast("int").alias("entry_no")
    return numbered.select("feed_url", "file", number, *entry(F.col("e")))


def tagged(entries: DataFrame, feeds: DataFrame) -> DataFrame:
    """Give each entry the name and list place of its feed."""
    return lookup_join(entries, feeds, "feed_url", spread_by=["link", "title"])
