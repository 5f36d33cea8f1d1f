"""Table shapes and the values that have to stay as they are."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

EVENT_FIELDS = ["id", "source", "title", "summary", "link", "published_raw", "ingested_at"]

EVENT = StructType([StructField(name, StringType()) for name in EVENT_FIELDS])

# One message of the log: the key is the event id, the value its JSON text.
MESSAGE = StructType(
    [
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("timestamp", TimestampType()),
    ]
)

BRONZE = StructType([*EVENT.fields, StructField("kafka_ts", TimestampType())])

SILVER = StructType(
    [
        StructField("id", StringType()),
        StructField("source", StringType()),
        StructField("title", StringType()),
        StructField("body", StringType()),
        StructField("link", StringType()),
        StructField("published_at", TimestampType()),
        StructField("ingested_at", TimestampType()),
        StructField("dt", DateType()),
    ]
)

# A silver row on its way into the log also carries its arrival time.
SILVER_LOG = StructType([*SILVER.fields, StructField("kafka_ts", TimestampType())])

PAYLOAD = StructType(
    [StructField(n, StringType()) for n in ["article_id", "source", "title", "body", "link", "published_at"]]
)

POINT = StructType(
    [
        StructField("point_id", DecimalType(20, 0)),
        StructField("vector", ArrayType(DoubleType())),
        StructField("payload", PAYLOAD),
    ]
)

# A point in the log: the id as a long, and the bucket that holds it.
POINT_LOG = StructType([*POINT.fields, StructField("vec_id", LongType()), StructField("bucket", IntegerType())])

# What is kept of titles: Hangul syllables, Latin letters, digits, and white space, at which
# the title is then split.
NON_WORD_PATTERN = "[^가-힣A-Za-z0-9\\s]"

# ---------------------------------------------------------------------------
# Results depend on them, so they are stated as they are.
# ---------------------------------------------------------------------------

FEEDS = [
    ("연합뉴스_경제", "https://www.yonhapnewstv.co.kr/browse/feed/"),
    ("한겨레_경제", "https://www.hani.co.kr/rss/economy/"),
    ("경향신문_경제", "https://www.khan.co.kr/rss/rssdata/economy_news.xml"),
    ("SBS_경제", "https://news.sbs.co.kr/news/SectionRssFeed.do?sectionId=02"),
    ("매일경제_전체", "https://www.mk.co.kr/rss/30000001/"),
    ("한국경제_전체", "https://rss.hankyung.com/feed/economy.xml"),
]

STOP_WORDS = [
    "기자", "종합", "속보", "단독", "그", "이", "및", "등", "위해",
    "관련", "대한", "오늘", "지난", "올해", "경제", "뉴스", "코스피", "코스닥",
]

TAG_PATTERN = "<[^>]+>"
SPACE_PATTERN = "\\s+"
MIN_TOKEN_CHARS = 2

ID_HEX_CHARS = 16
EMBED_DIM = 1536
EMBED_BATCH = 64
LOOKBACK_DAYS = 3
TOP_K = 5
BRIEFING_TOP_K = 6
MAX_LOOPS = 2
WATERMARK = "2 hours"
POLL_SECONDS = 60

BODY_CHARS = 2000
SNIPPET_CHARS = 200
ECHO_CHARS = 400
ROLE_CHARS = 24

NO_HITS = "(검색 결과 없음)"
DEFAULT_QUERY = "오늘 한국 경제의 주요 이슈"
# ---------------------------------------------------------------------------

# Code points that count as blank at either end of a text: the Unicode white
# space characters and the four ASCII separators before the space.
_BLANK_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
BLANKS = "".join(chr(c) for low, high in _BLANK_RANGES for c in range(low, high + 1))
