"""Personal data replaced by keyed surrogates.

One pattern finds e-mail addresses, IP addresses, phone, card, account and social-security numbers,
and names after a title or a phrase that gives a name, or led by a known given name. Every different entity gets one
surrogate from a keyed hash, so all its mentions in the corpus stay the same entity:

* digits are replaced by digits and letters by letters of the same case, in the
  places and with the punctuation of the mention; a phone number keeps its first digit, a card number
  its first digit and a valid check digit, an account number its country and valid check digits; addresses come
  from 10.0.0.0/8;
* e-mail users and the domains below the top level are entities of their own;
* the parts of a name are entities of their own, so "Ms Maria Keller" and "Ms Keller"
  keep their family name in common, as a later "Keller" or "KELLER" by itself in the same document does;
  titles and particles such as "de la" stay; given names keep the gender that title or name shows, and
  all names the script (Latin, Cyrillic, Greek, Armenian) and capitals.

Collision check: a surrogate that two entities share, or that is itself an entity of the
corpus, goes to the least of them or to none, and the others draw again until none
is left; every few attempts surrogates of names, users and domains get longer. Numbers cannot: where phone,
social-security or address entities fill an eighth of their format, all of them get the free values of it in
a keyed order, and those beyond the free values each other's, in a cycle. The drawing ends when all have one; no
number of attempts stops it. Entities are few against texts; they are drawn, checked and joined as stored tables. The
surrogates of each text go to the texts by broadcast if they are small enough, else both are shuffled.

Built-in expressions only. Defined results: null texts stay null, texts without a mention stay as
they are; rows with equal id and text get equal results; an empty table gives an
empty result; other columns are passed through by `pseudonymized`.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage
from feedlake.session import BROADCAST_BYTES, measure

# Titles with the gender they show, and given names by gender and script.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "Signora", "госпожа", "г-жа"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "господин", "г-н"),
    "n": (
        "Dr", "Prof", "Professor", "[Mm]y name is", "[Nn]ame:", "[Ii]ch heiße", "[Ii]ch heisse", "[Mm]ein Name ist", "[Jj]e m['’]appelle",
        "[Mm]e llamo", "[Mm]i nombre es",
    ),
}
GIVEN = {
    "f": (
        "Mary", "Anna", "Maria", "Emma", "Olivia", "Sophia", "Elizabeth", "Jennifer", "Linda", "Sarah", "Laura", "Julia",
        "Claire", "Camille", "Isabelle", "Hannah", "Katharina", "Sabine", "Carmen", "Lucía", "Sofía", "María",
        "Анна", "Мария", "Елена", "Ольга",
    ),
    "m": (
        "John", "James", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Paul", "Daniel", "Martin", "Pierre",
        "Jean", "Michel", "Hans", "Klaus", "Jürgen", "Stefan", "Carlos", "José", "Juan", "Miguel",
        "Иван", "Пётр", "Алексей", "Сергей",
    ),
}
# What surrogate names are made of, and their ends by gender.
SYLLABLES = {
    "latin": ("ba", "be", "bo", "da", "de", "do", "fa", "ga", "ka", "ke", "la", "le", "li", "lo", "ma", "me", "mi", "mo", "na", "ne", "no", "ra", "re", "ri", "ro", "sa", "se", "ta", "te", "ti", "va", "ve"),
    "greek": ("βα", "γε", "δα", "δο", "ζα", "κα", "κε", "κο", "λα", "λε", "λι", "λο", "μα", "με", "μι", "μο", "να", "νε", "νο", "πα", "πε", "ρα", "ρε", "ρι", "σα", "σε", "τα", "τε", "τι", "φα", "φε", "χα"),
    "armenian": ("բա", "գա", "գե", "դա", "դե", "զա", "լա", "լե", "լի", "խա", "կա", "կե", "կո", "մա", "մե", "մի", "մո", "նա", "նե", "նո", "պա", "պե", "ռա", "ռե", "սա", "սե", "վա", "վե", "տա", "տե", "րա", "րե"),
    "cyrillic": ("ба", "бе", "бо", "ва", "ве", "во", "га", "да", "де", "до", "за", "зе", "ка", "ке", "ко", "ла", "ле", "ли", "ло", "ма", "ме", "ми", "мо", "на", "не", "но", "ра", "ре", "ри", "са", "та", "те"),
}
ENDS = {
    "latin": {"f": "lia", "m": "ton", "n": "ren", "family": "mann"},
    "cyrillic": {"f": "лия", "m": "тон", "n": "рен", "family": "енко"},
    "greek": {"f": "λια", "m": "τον", "n": "ρεν", "family": "ιδη"},
    "armenian": {"f": "լիա", "m": "տոն", "n": "րեն", "family": "յան"},
}
# How a script is told from a word; Latin letters stand for all others.
_SCRIPTS = {"cyrillic": r"\p{IsCyrillic}", "greek": r"\p{IsGreek}", "armenian": r"\p{IsArmenian}"}
KINDS = ("email", "ip", "iban", "phone", "ssn", "card", "name")

# Words within a name that stay as they are.
PARTICLES = (
    "de", "la", "las", "los", "del", "y", "da", "do", "dos", "das", "di", "du", "le", "von", "vom", "van", "der", "den", "dem",
    "zu", "zum", "zur", "ten", "ter", "bin", "ibn", "фон",
)

# A trailing 's is no part of the name.
_JOINED = r"(?:['’-](?!s(?!\p{L}))\p{L}+)"
_PART = rf"\p{{Lu}}(?:\p{{L}}++{_JOINED}*+|{_JOINED}++)(?![0-9])"
_TITLE = "(?:" + "|".join(t for group in TITLES.values() for t in group) + ")"
_KNOWN = "(?:" + "|".join(n for group in GIVEN.values() for n in group) + ")"
# Chains are bounded, so that a text of nothing else is not searched to its end from each place.
_TITLES = rf"{_TITLE}\.?(?: {_TITLE}(?!\p{{L}})\.?){{0,9}}+"
_PARTICLES = rf"(?:(?:{'|'.join(PARTICLES)}) ){{0,9}}+"
_MORE = _PARTICLES + _PART
_BARE_PART = rf"(?<!\p{{L}}){_PART}"
PATTERNS = {
    # As long as the standards allow: 64 characters of a user, 127 labels of 63. No text makes the search deep or slow.
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}+){0,126}\.[A-Za-z]{2,63}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "iban": r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "phone": r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\p{L}\d])\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,4}(?![\p{L}\d])",
    "name": rf"(?<!\p{{L}})(?:{_TITLES} {_MORE}(?: {_MORE})*+|{_KNOWN}(?: {_MORE})++)",
}
# Which characters a pattern can begin with is looked at first, which spares most places the rest.
_FIRST = {"ip": "[0-9]", "iban": "[A-Z]{2}[0-9]", "phone": r"[0-9+(]", "ssn": "[0-9]", "card": "[0-9]", "name": r"[\p{Lu}гmnij]"}
_GUARDED = {kind: (f"(?={_FIRST[kind]})" if kind in _FIRST else "") + f"(?:{pattern})" for kind, pattern in PATTERNS.items()}
# One alternation; the numbered group of the card pattern is the only one.
MENTION = "|".join(_GUARDED.values())
# Surrogates that can, grow each so many attempts.
LONGER_EACH = 4
# Unions of so many attempts are stored.
STORED_EACH = 8
# Pools of numbers with fewer values than so many an entity are dealt out instead of drawn from.
ROOM = 8
_CHUNK = 1 << 16


def _keyed(docs: DataFrame) -> tuple[Column, Column]:
    return docs["doc_id"].cast("long"), F.xxhash64(docs["text"])


def kind_of(mention: Column) -> Column:
    """Which pattern a mention belongs to."""
    kind = F.when(F.contains(mention, F.lit("@")), "email")
    for name in ("ip", "iban", "phone", "ssn", "card"):
        kind = kind.when(mention.rlike("^(?:" + PATTERNS[name] + ")$"), name)
    return kind.otherwise("name")


def _characters(value: Column) -> Column:
    return F.filter(F.split(value, ""), lambda c: c != "")


def _bare(value: Column) -> Column:
    return F.regexp_replace(value, r"[^\p{L}\d]", "")


def _words(mention: Column) -> Column:
    """The words of a name after its titles, each with the particles before it."""
    return F.regexp_extract_all(F.regexp_replace(mention, rf"^{_TITLES} ", ""), F.lit(_MORE), 0)


def _gender(mention: Column) -> Column:
    """What title or given name of a mention show."""
    shown = {}
    for gender in ("f", "m"):
        titled = f"^(?:{_TITLE}\\.? ){{0,9}}(?:{'|'.join(TITLES[gender])})\\.? "
        shown[gender] = mention.rlike(titled) | mention.rlike(f"(?:^| )(?:{'|'.join(GIVEN[gender])}) ")
    return F.when(shown["f"], "f").when(shown["m"], "m").otherwise("n")


def _parts(kind: Column, mention: Column, words: Column, gender: Column) -> Column:
    """array<struct<part, value, style>>: the entities of a mention in order; style holds gender and script, or what the number keeps."""
    known = lambda word: F.when(F.initcap(word).isin(*GIVEN["f"]), "f").when(F.initcap(word).isin(*GIVEN["m"]), "m")
    part = lambda name, value, style: F.struct(F.lit(name).alias("part"), value.alias("value"), style.alias("style"))

    def script(word: Column) -> Column:
        found = F.lit("latin")
        for name, letters in _SCRIPTS.items():
            found = F.when(word.rlike(letters), name).otherwise(found)
        return found

    def of_name(lead: Column, i: Column) -> Column:
        """The first of several words is a given name, the last one a family name, others as far as known."""
        written = F.regexp_replace(lead, f"^{_PARTICLES}", "")
        word = F.lower(written)  # "Keller" and "KELLER" are one entity
        first, last = i == 0, i == F.size(words) - 1
        is_given = ~last & F.when(first, written == lead).otherwise(known(word).isNotNull())
        given = part("given", word, F.concat(F.when(first, gender).otherwise(known(word)), F.lit(" "), script(word)))
        return F.when(is_given, given).otherwise(part("family", word, F.concat(F.lit("family "), script(word))))

    user = part("user", F.lower(F.substring_index(mention, "@", 1)), F.lit(""))
    domain = part("domain", F.lower(F.substring_index(mention, "@", -1)), F.lit(""))
    number = F.struct(kind.alias("part"), F.when(kind == "ip", mention).otherwise(F.upper(_bare(mention))).alias("value"), _number_style(kind, mention).alias("style"))
    return (
        F.when(kind == "email", F.array(user, domain))
        .when(kind == "name", F.transform(words, of_name))
        .otherwise(F.array(number))
    )


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of an array of digits, the last one at weight 1."""
    weighed = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(weighed, F.lit(0), lambda s, d: s + d) % 10


def _digits(value: Column) -> Column:
    return F.transform(_characters(value), lambda c: c.cast("int"))


def _rest_97(value: Column) -> Column:
    """An account number modulo 97, its country and check digits taken from its front to its end, letters counting from A = 10."""
    moved = F.concat(F.substr(value, F.lit(5), F.length(value)), F.left(value, F.lit(4)))
    step = lambda rest, c: F.when(c.rlike("[0-9]"), rest * 10 + c.cast("int")).otherwise(rest * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(_characters(moved), F.lit(0), step)


def _number_style(kind: Column, mention: Column) -> Column:
    card = _luhn(_digits(F.regexp_replace(mention, r"\D", ""))) == 0
    account = _rest_97(F.upper(_bare(mention))) == 1
    return F.when((kind == "card") & card, "valid").when((kind == "iban") & account, "valid").otherwise("")


def _drawn(key: str, part: Column, value: Column, style: Column, attempt: int) -> Column:
    """The surrogate of an entity at an attempt."""
    digest = F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(f"{key}{half}"), part, value, F.lit(str(attempt))), 512) for half in (0, 1)])
    byte = lambda i: F.conv(F.substr(digest, F.pmod(i, F.lit(128)) * 2 + 1, F.lit(2)), 16, 10).cast("int")

    def swapped(text: Column, kept: Column) -> Column:
        """Digits for digits, letters for letters of the same case; the first `kept` characters stay."""

        def one(c: Column, i: Column) -> Column:
            letter = lambda first: F.char(F.lit(ord(first)) + byte(i) % 26)
            fresh = F.when(c.rlike("[0-9]"), (byte(i) % 10).cast("string")).when(c.rlike("[a-z]"), letter("a")).when(c.rlike("[A-Z]"), letter("A"))
            return F.when(i < kept, c).otherwise(F.coalesce(fresh, c))

        return F.array_join(F.transform(_characters(text), one), "")

    number = swapped(value, F.when(part == "iban", 2).when(part.isin("phone", "card"), 1).otherwise(0))
    head = F.left(number, F.length(number) - 1)
    check = (10 - _luhn(_digits(F.concat(head, F.lit("0"))))) % 10
    card = F.when(style == "valid", F.concat(head, check.cast("string"))).otherwise(number)
    country, account = F.left(number, F.lit(2)), F.substr(number, F.lit(5), F.length(number))
    checked = F.lpad((98 - _rest_97(F.concat(country, F.lit("00"), account))).cast("string"), 2, F.lit("0"))
    iban = F.when(style == "valid", F.concat(country, checked, account)).otherwise(number)
    ip = F.concat_ws(".", F.lit("10"), *[byte(F.lit(i)).cast("string") for i in (0, 1, 2)])
    # Surrogates of a length run out; later attempts are longer.
    longer = attempt // LONGER_EACH
    more = F.concat(F.lit(""), *[x for i in range(longer) for x in (F.char(F.lit(97) + byte(F.lit(99 - 2 * i)) % 26), byte(F.lit(100 - 2 * i)).cast("string"))])
    user = F.concat(swapped(value, F.lit(0)), more)
    labels = F.substring_index(value, ".", -1)
    domain = F.concat(swapped(F.left(value, F.length(value) - F.length(labels) - 1), F.lit(0)), more, F.lit("."), labels)
    name = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        table = F.array(*[F.lit(s) for s in syllables])
        stem = F.concat(*[F.get(table, byte(F.lit(i)) % len(syllables)) for i in range(3 + longer)])
        for shown, end in ENDS[script].items():
            name = F.when(style == f"{shown} {script}", F.initcap(F.concat(stem, F.lit(end)))).otherwise(name)
    return (
        F.when(part == "ip", ip).when(part == "card", card).when(part == "iban", iban).when(part == "user", user).when(part == "domain", domain)
        .when(part.isin("given", "family"), name).otherwise(number)
    )


def _pool() -> tuple[Column, Column]:
    """(name, size) of the pool of an entity: values of one format. Null for parts whose surrogates can grow or
    whose formats (cards, accounts) have 10^11 values or more."""
    length = F.length("value")
    name = F.when(F.col("part") == "ip", "ip").when(F.col("part") == "ssn", "ssn")
    size = F.when(F.col("part") == "ip", F.lit(1 << 24)).when(F.col("part") == "ssn", F.lit(10**9))
    is_phone = (F.col("part") == "phone") & (length <= 18)
    phone = F.concat_ws(" ", "part", F.left("value", F.lit(1)), length.cast("string"))
    return name.when(is_phone, phone), size.when(is_phone, F.pow(F.lit(10.0), length - 1)).cast("long")


def _pool_ranks(rows: DataFrame, order: Column) -> DataFrame:
    """The (stored) rows with their rank from 1 in a keyed order of their pool, counted in two levels: within the first
    digits of the key, and over them. So no task ranks a whole pool."""
    rows = rows.withColumn("_order", order).withColumn("_lot", F.left("_order", F.lit(3)))
    lots = rows.groupBy("pool", "_lot").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("pool").orderBy("_lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select("pool", "_lot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("pool", "_lot").orderBy("_order", "value"))
    ranked = rows.withColumn("_nth", within).join(F.broadcast(lots), ["pool", "_lot"])  # 4,096 lots of a pool at most
    return ranked.withColumn("rank", F.col("_before") + F.col("_nth")).drop("_order", "_lot", "_nth", "_before")


def _dealt(entities: DataFrame, key: str) -> tuple[DataFrame, list]:
    """(part, value, style, surrogate) of the entities of crowded pools, and the names of these.

    The free values of the pool are ranked in a keyed order and joined to the ranked entities. Entities
    beyond them get the value of the next entity in the cycle of all, which nobody else gets.
    """
    name, size = _pool()
    pooled = entities.withColumns({"pool": name, "size": size}).filter("pool IS NOT NULL")
    crowded = pooled.groupBy("pool", "size", "part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("size") < ROOM * F.col("n"))
    crowded = crowded.collect()  # a few formats at most
    if not crowded:
        return None, []
    order = F.sha2(F.concat_ws("\x1f", F.lit(key), "pool", "value"), 256)
    mine = pooled.join(F.broadcast(entities.sparkSession.createDataFrame([(c["pool"],) for c in crowded], "pool string")), "pool")
    mine = cut_lineage(_pool_ranks(mine, order), "surrogates-ranked")
    sizes = mine.groupBy("pool").agg(F.count(F.lit(1)).alias("_of"))
    after = mine.join(F.broadcast(sizes), "pool")  # one row per format
    after = after.select("pool", F.when(F.col("rank") == 1, F.col("_of")).otherwise(F.col("rank") - 1).alias("rank"), F.col("value").alias("next"))
    mine = mine.join(after, ["pool", "rank"])
    pools = entities.sparkSession.createDataFrame([(c["pool"], c["part"], c["size"]) for c in crowded], "pool string, part string, size long")
    chunks = pools.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(_CHUNK).cast("long")))).repartition("pool", "at")
    whole = chunks.withColumn("no", F.explode(F.sequence("at", F.least(F.col("at") + _CHUNK, "size") - 1)))
    digits = F.length(F.col("size").cast("string")) - 1
    octet = lambda place: F.shiftright("no", place).bitwiseAND(F.lit(255)).cast("string")
    number = F.lpad(F.col("no").cast("string"), digits, F.lit("0"))
    value = (
        F.when(F.col("part") == "ip", F.concat_ws(".", F.lit("10"), octet(16), octet(8), octet(0)))
        .when(F.col("part") == "ssn", number)
        .otherwise(F.concat(F.substring_index(F.substring_index("pool", " ", 2), " ", -1), number))
    )
    free = whole.select("pool", value.alias("value")).join(pooled.select("pool", "value"), ["pool", "value"], "left_anti")
    free = _pool_ranks(cut_lineage(free, "surrogates-free"), order).withColumnRenamed("value", "free")
    dealt = mine.join(free, ["pool", "rank"], "left")
    return dealt.select("part", "value", "style", F.coalesce("free", "next").alias("surrogate")), [c["pool"] for c in crowded]


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(part, value, style, surrogate): distinct surrogates for distinct (part, value, style).

    `entities` is distinct and stored. Names of both kinds are checked together, as any
    other part by itself.
    """
    space = F.when(F.col("part").isin("given", "family"), "name").otherwise(F.col("part"))
    taken = entities.select(space.alias("space"), F.col("value").alias("surrogate")).distinct()
    settled, crowded = _dealt(entities, key)
    waiting = entities.withColumn("space", space)
    if crowded:
        settled = cut_lineage(settled, "surrogates-dealt")
        waiting = waiting.filter(~F.coalesce(_pool()[0].isin(crowded), F.lit(False)))
    for attempt in count():
        drawn = waiting.withColumn("surrogate", _drawn(key, F.col("part"), F.col("value"), F.col("style"), attempt))
        drawn = cut_lineage(drawn, "surrogates-drawn")
        fresh = drawn.join(taken, ["space", "surrogate"], "left_anti")
        heads = fresh.groupBy("space", "surrogate").agg(F.min(F.struct("part", "value", "style")).alias("head"))
        heads = cut_lineage(heads, "surrogates-settled")
        rows = heads.select("head.*", "surrogate")
        settled = rows if settled is None else settled.unionByName(rows)
        if heads.count() == drawn.count():
            return settled
        taken = taken.unionByName(heads.select("space", "surrogate"))
        waiting = drawn.join(rows, ["part", "value", "style"], "left_anti").drop("surrogate")
        if attempt % STORED_EACH == STORED_EACH - 1:
            settled, taken = cut_lineage(settled, "surrogates-settled"), cut_lineage(taken, "surrogates-taken")


def _cased(fresh: Column, word: Column) -> Column:
    """The surrogate in capitals where the word is."""
    return F.when(word == F.upper(word), F.upper(fresh)).otherwise(fresh)


def _dressed(kind: Column, mention: Column, surrogates: Column) -> Column:
    """The surrogates in the format of the mention."""
    first, last = F.element_at(surrogates, 1), F.element_at(surrogates, -1)
    title = F.regexp_extract(mention, rf"^{_TITLES} ", 0)
    pairs = F.arrays_zip(_words(mention).alias("word"), surrogates.alias("fresh"))
    lead = lambda word: F.regexp_extract(word, f"^{_PARTICLES}", 0)
    fresh = F.transform(pairs, lambda p: F.concat(lead(p["word"]), _cased(p["fresh"], F.substr(p["word"], F.length(lead(p["word"])) + 1, F.length(p["word"])))))
    name = F.concat(title, F.array_join(fresh, " "))
    spots = F.transform(
        _characters(mention),
        lambda c, i: F.when(c.rlike(r"[\p{L}\d]"), F.substr(first, F.length(_bare(F.substr(mention, F.lit(1), i + 1))), F.lit(1))).otherwise(c),
    )
    return (
        F.when(kind == "email", F.concat(first, F.lit("@"), last))
        .when(kind == "name", name)
        .when(kind == "ip", first)
        .otherwise(F.array_join(spots, ""))
    )


def _bare_named(gap: Column, families: Column) -> Column:
    """struct<text, n>: text between mentions with the family names of the document (a map to
    surrogates) replaced where they stand alone or within a hyphenated word, and how many they are."""
    known = lambda word: _cased(F.element_at(families, F.lower(word)), word)
    found = F.regexp_extract_all(gap, F.lit(_BARE_PART), 0)
    fresh = F.transform(
        found, lambda word: F.coalesce(known(word), F.array_join(F.transform(F.split(word, "-"), lambda w: F.coalesce(known(w), w)), "-"))
    )
    zipped = F.arrays_zip(F.split(gap, _BARE_PART, -1).alias("gap"), found.alias("found"), fresh.alias("fresh"))
    text = F.array_join(F.transform(zipped, lambda p: F.concat(p["gap"], F.coalesce(p["fresh"], F.lit("")))), "")
    return F.struct(text.alias("text"), F.size(F.filter(zipped, lambda p: p["found"] != p["fresh"])).alias("n"))


def mentions(docs: DataFrame) -> DataFrame:
    """(_id, _text, _at, kind, mention, parts): the mentions of the different (id, text), in order; stored."""
    ident, text = _keyed(docs)
    # A text without these has no mention and is not searched for all of them.
    quick = F.contains(docs["text"], F.lit("@")) | F.rlike(docs["text"], F.lit("[0-9][0-9.]")) | F.rlike(docs["text"], F.lit(_GUARDED["name"]))
    found = docs.filter(quick).filter(F.rlike(docs["text"], F.lit(MENTION))).select(
        ident.alias("_id"), text.alias("_text"), F.regexp_extract_all(docs["text"], F.lit(MENTION), 0).alias("_found")
    )
    found = found.dropDuplicates(["_id", "_text"])
    rows = found.select("_id", "_text", F.posexplode("_found").alias("_at", "mention"))
    # Stored, since the parts use words and gender once a word.
    rows = rows.withColumns({"kind": kind_of(F.col("mention")), "_words": _words(F.col("mention")), "_gender": _gender(F.col("mention"))})
    rows = cut_lineage(rows, "surrogates-mentions")
    parts = _parts(F.col("kind"), F.col("mention"), F.col("_words"), F.col("_gender"))
    return rows.withColumn("parts", parts).drop("_words", "_gender")


def pseudonymized(docs: DataFrame, key: str, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """`docs` with replaced text, and `_n_entities`, the mentions replaced."""
    found = mentions(docs)
    # A mention may have very many parts, so it does not go along with them.
    place = ["_id", "_text", "_at"]
    parts = found.select(*place, F.posexplode("parts").alias("_no", "p")).select(*place, "_no", "p.*")
    parts = cut_lineage(parts, "surrogates-parts")
    entities = cut_lineage(parts.select("part", "value", "style").distinct(), "surrogates-entities")
    table = cut_lineage(surrogate_table(entities, key), "surrogates-table")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_no", "surrogate"))), lambda p: p["surrogate"])
    known = parts.join(table, ["part", "value", "style"])
    family = F.collect_set(F.when(F.col("part") == "family", F.struct("value", "surrogate")))
    known = known.groupBy(*place).agg(ordered.alias("_surrogates"), family.alias("_families"))
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"k.{c}")) for c in place]
    whole = found.select(*place, "kind", "mention").alias("m").join(known.alias("k"), same)
    whole = whole.select(*[F.col(f"m.{c}").alias(c) for c in place], "kind", "mention", "_surrogates", "_families")
    dressed = whole.select("_id", "_text", "_at", _dressed(F.col("kind"), F.col("mention"), F.col("_surrogates")).alias("_fresh"), "_families")
    per_text = dressed.groupBy("_id", "_text").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_fresh"))).alias("_fresh"),
        F.map_from_entries(F.array_distinct(F.flatten(F.collect_list("_families")))).alias("_families"),
    )
    per_text = cut_lineage(per_text, "surrogates-texts")
    small = measure(per_text)[1] <= limit_bytes
    per_text = F.broadcast(per_text) if small else per_text.hint("shuffle_hash")
    ident, key_of_text = _keyed(docs)
    joined = docs.join(per_text, ident.eqNullSafe(per_text["_id"]) & (key_of_text == per_text["_text"]), "left")
    fresh = F.transform(per_text["_fresh"], lambda f: f["_fresh"])
    families = per_text["_families"]
    plain = lambda gap: F.struct(gap.alias("text"), F.lit(0).alias("n"))
    gaps = F.split(docs["text"], MENTION, -1)
    gaps = F.when(F.size(families) > 0, F.transform(gaps, lambda gap: _bare_named(gap, families))).otherwise(F.transform(gaps, plain))
    pieces = F.transform(
        F.arrays_zip(gaps.alias("gap"), fresh.alias("fresh")),
        lambda p: F.struct(F.concat(p["gap"]["text"], F.coalesce(p["fresh"], F.lit(""))).alias("text"), p["gap"]["n"].alias("n")),
    )
    pieces = F.when(per_text["_fresh"].isNotNull(), pieces)
    renewed = F.struct(
        F.array_join(F.transform(pieces, lambda p: p["text"]), "").alias("text"),
        (F.size(per_text["_fresh"]) + F.aggregate(pieces, F.lit(0), lambda n, p: n + p["n"])).cast("long").alias("n"),
    )
    original = [docs[name].alias(f"_c{i}") for i, name in enumerate(docs.columns)]
    done = joined.select(*original, F.when(per_text["_fresh"].isNotNull(), renewed).alias("_renewed"))
    columns = [
        (F.when(F.col("_renewed").isNull(), F.col(f"_c{i}")).otherwise(F.col("_renewed.text")) if name == "text" else F.col(f"_c{i}")).alias(name)
        for i, name in enumerate(docs.columns)
    ]
    return done.select(*columns, F.coalesce("_renewed.n", F.lit(0).cast("long")).alias("_n_entities"))
