"""Secrets in texts: fixed patterns, and a battery of randomness tests.

Base spans come from three patterns. The battery looks at every maximal run of at
least `MIN_CHARS` characters of the base64 alphabets (padding aside) that holds a letter. A run
that mixes the signs of both alphabets is split at those that are foreign to each, and every part that is
long enough is tested in its place; of found parts that overlap, the one that is least like words stays.

* The encoding is inferred from the characters: hex, base32, base62, base64 or
  base64url, each with its alphabet.
* Randomness: a chi-squared test of uniform use of the alphabet, a runs test above and below its
  middle, and a serial-correlation test of neighbours, each as a p-value under the
  hypothesis of a uniformly random string, joined by Fisher's method. A string that they
  refute at `RANDOM_LEVEL` is not a secret.
* Discovery: the p-value under the opposite hypothesis, that the characters are
  drawn like those of long ordinary words. Its statistic is the log-likelihood ratio
  of uniform against ordinary use, whose mean and spread follow the length. Benjamini-Hochberg
  holds the share of false discoveries at `FALSE_DISCOVERIES` in each stratum of
  encoding, length and whether there is a digit, since short strings and letters alone carry less
  evidence.

How ordinary words use each character is counted over the letter-only runs of the whole
corpus. P-values are counted in steps of a tenth of a power of ten, rounded against
discovery, so a stratum is a small histogram.

Built-in expressions only. Defined results: null text is empty; documents without a
span have zero counts and empty lists; rows are treated one by one, repeated or not; an
empty table gives an empty result; other columns are ignored. Positions are code points, the
end exclusive.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import cut_lineage, ids_and_texts

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
MIN_ASSIGNED = 8
MIN_CHARS = 20
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+={0,2}"
# In the order of the result; the last is what the battery adds.
KINDS = ("assign", "access", "hex", "random")

_UPPER, _LOWER, _DIGITS = string.ascii_uppercase, string.ascii_lowercase, string.digits
ENCODINGS = {
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base62": _UPPER + _LOWER + _DIGITS,
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
RANDOM_LEVEL = 1e-4
FALSE_DISCOVERIES = 0.01
# Share of uniform use mixed into ordinary use, which bounds what one character can say.
UNIFORM_SHARE = 0.1
_STEP = 10.0  # steps of a p-value per power of ten
_MOST = 3000


def _matches(text: Column, kind: int, pattern: str, value: int, least: int) -> Column:
    """array<struct<kind, gap, size, ok, run>>: matches with the characters before each, plus a last gap."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    values = F.regexp_extract_all(text, F.lit(pattern), value) if value else found
    zipped = F.arrays_zip(found.alias("found"), values.alias("value"), F.split(text, pattern, -1).alias("gap"))
    rows = F.transform(
        zipped,
        lambda x: F.struct(
            F.lit(kind).alias("kind"),
            F.length(x["gap"]).alias("gap"),
            F.length(x["found"]).alias("size"),
            (F.length(x["value"]) >= least).alias("ok"),
            (x["found"] if kind == 3 else F.lit(None).cast("string")).alias("run"),
        ),
    )
    return F.when(F.rlike(text, F.lit(pattern)), rows).otherwise(F.array().cast(_MATCHES))


_MATCHES = "array<struct<kind:int,gap:int,size:int,ok:boolean,run:string>>"


def _located(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, _found): the matches of every document row, without its text; stored."""
    text = F.col("text")
    found = F.concat(
        _matches(text, 0, ASSIGN, 2, MIN_ASSIGNED),
        _matches(text, 1, ACCESS, 0, 0),
        _matches(text, 2, HEX, 0, 0),
        _matches(text, 3, RUN % MIN_CHARS, 0, 0),
    )
    rows = ids_and_texts(docs).select(F.monotonically_increasing_id().alias("_row"), "doc_id", found.alias("_found"))
    return cut_lineage(rows, "secrets-located")


def _spans(located: DataFrame) -> DataFrame:
    """(_row, kind, start, end, run): the matches at their places."""
    rows = located.select("_row", F.posexplode("_found").alias("_at", "m")).select("_row", "_at", "m.*").filter("size IS NOT NULL")
    so_far = Window.partitionBy("_row", "kind").orderBy("_at")
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    return rows.withColumn("end", end).filter("ok").select("_row", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "run")


def _tested(runs: DataFrame) -> DataFrame:
    """(_row, start, end, run, origin): the runs, those that mix both alphabets as their parts; `origin` is the start of such a run, else null."""

    mixed = F.col("run").rlike("[+/]") & F.col("run").rlike("[-_]")

    def parts(foreign: str) -> DataFrame:
        """The pieces between foreign characters, at their places: each ends where the lengths so far do."""
        pieces = runs.filter(mixed).select("_row", F.col("start").alias("origin"), F.posexplode(F.split("run", foreign, -1)).alias("_nth", "run"))
        so_far = Window.partitionBy("_row", "origin").orderBy("_nth")
        placed = pieces.withColumn("end", F.col("origin") + F.sum(F.length("run") + 1).over(so_far) - 1)
        long_enough = placed.filter(F.length(F.rtrim("run", F.lit("="))) >= MIN_CHARS)
        return long_enough.select("_row", (F.col("end") - F.length("run")).alias("start"), "end", "run", "origin")

    split = parts("[-_]").unionByName(parts("[+/]"))
    return runs.filter(~mixed).select("_row", "start", "end", "run", F.lit(None).cast("bigint").alias("origin")).unionByName(split)


def _apart(found: DataFrame) -> DataFrame:
    """(_row, start, end) of the found runs; of overlapping parts of one run the one with the larger score."""
    span = F.struct((-F.col("score")).alias("cost"), "start", "end")
    listed = found.filter("origin IS NOT NULL").groupBy("_row", "origin").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<cost:double,start:bigint,end:bigint>>")
    kept = F.aggregate(
        "spans",
        none,
        lambda kept, x: F.when(F.exists(kept, lambda k: (k["start"] < x["end"]) & (x["start"] < k["end"])), kept).otherwise(F.concat(kept, F.array(x))),
    )
    parts = listed.select("_row", F.explode(kept).alias("s")).select("_row", "s.start", "s.end")
    return found.filter("origin IS NULL").select("_row", "start", "end").unionByName(parts)


def _inferred(run: Column) -> Column:
    """Name of the encoding, null for runs without a letter."""
    bare = F.rtrim(run, F.lit("="))
    return (
        F.when(~bare.rlike("[A-Za-z]"), None)
        .when(bare.rlike("^[0-9a-f]+$"), "hex")
        .when(bare.rlike("^[0-9A-F]+$"), "HEX")
        .when(bare.rlike("^[A-Z2-7]+$"), "base32")
        .when(bare.rlike("^[A-Za-z0-9]+$"), "base62")
        .when(bare.rlike("^[A-Za-z0-9+/]+$"), "base64")
        .when(bare.rlike("^[A-Za-z0-9_-]+$"), "base64url")
    )


def normal_tail(z: Column) -> Column:
    """P(Z > z), by a rational approximation to five digits of the tail."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(candidates: DataFrame) -> DataFrame:
    """Adds p_random, the joined p-value of the three tests, to rows with `codes`
    (positions in the alphabet, 20 of them or more), `letters` (alphabet size)."""
    n, k = F.size("codes").cast("double"), F.col("letters").cast("double")
    total = lambda column: F.aggregate(column, F.lit(0.0), lambda s, x: s + x)
    squares = F.aggregate(
        F.transform(F.array_distinct("codes"), lambda c: F.size(F.filter("codes", lambda x: x == c)).cast("double")),
        F.lit(0.0),
        lambda s, x: s + x * x,
    )
    ahead, behind = F.slice("codes", 2, F.size("codes")), F.slice("codes", 1, F.size("codes") - 1)
    high = lambda x: (2 * x >= F.col("letters")).cast("int")
    rows = candidates.select(
        "*",
        n.alias("_n"),
        k.alias("_k"),
        squares.alias("_squares"),
        total(F.transform("codes", lambda x: x.cast("double"))).alias("_s1"),
        total(F.transform("codes", lambda x: (x * x).cast("double"))).alias("_s2"),
        total(F.zip_with(behind, ahead, lambda a, b: (a * b).cast("double"))).alias("_s11"),
        (F.element_at("codes", 1) + F.element_at("codes", -1)).cast("double").alias("_ends"),
        total(F.transform("codes", lambda x: high(x).cast("double"))).alias("_high"),
        (1 + total(F.zip_with(behind, ahead, lambda a, b: (high(a) != high(b)).cast("double")))).alias("_runs"),
    )
    # Every step is a projection of its own: the formulas use their parts many times.
    up, down = F.col("_high"), F.col("_n") - F.col("_high")
    mean = F.col("_s1") / F.col("_n")
    rows = rows.withColumns(
        {
            "_chi": F.col("_squares") * F.col("_k") / F.col("_n") - F.col("_n"),
            "_mixed": 2 * up * down,
            "_variance": F.col("_s2") - F.col("_n") * mean * mean,
            "_lagged": F.col("_s11") - mean * (2 * F.col("_s1") - F.col("_ends")) + (F.col("_n") - 1) * mean * mean,
        }
    )
    # Mean and variance of the statistic itself, which hold where cells are sparse; and as its upper
    # tail is skewed, the cube root of its ratio to the mean, which is nearly normal.
    spread = 2 / (9 * F.col("_k"))
    ratio = F.greatest("_chi", F.lit(0.0)) / (F.col("_k") - 1)
    runs_variance = F.col("_mixed") * (F.col("_mixed") - F.col("_n")) / (F.col("_n") * F.col("_n") * (F.col("_n") - 1))
    rows = rows.withColumns(
        {
            "_z_chi": F.least(
                (F.col("_chi") - (F.col("_k") - 1)) / F.sqrt(2 * (F.col("_k") - 1) * (F.col("_n") - 1) / F.col("_n")),
                (F.pow(ratio, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread),
            ),
            "_z_runs": F.when(
                runs_variance > 0, F.abs(F.col("_runs") - F.col("_mixed") / F.col("_n") - 1) / F.sqrt(runs_variance)
            ).otherwise(F.lit(8.0)),
            "_z_serial": F.when(
                F.col("_variance") > 0, F.abs(F.col("_lagged") / F.col("_variance") + 1 / (F.col("_n") - 1)) * F.sqrt("_n")
            ).otherwise(F.lit(8.0)),
        }
    )
    least = F.lit(1e-300)
    logs = {
        "_log_chi": F.log(F.greatest(normal_tail(F.col("_z_chi")), least)),
        "_log_runs": F.log(F.greatest(2 * normal_tail(F.col("_z_runs")), least)),
        "_log_serial": F.log(F.greatest(2 * normal_tail(F.col("_z_serial")), least)),
    }
    rows = rows.withColumns(logs).withColumn("_half", -F.least(F.lit(0.0), F.col("_log_chi") + F.col("_log_runs") + F.col("_log_serial")))
    half = F.col("_half")
    joined = F.exp(-half) * (1 + half + half * half / 2)  # upper tail of chi-squared with 6 degrees
    return rows.select(*candidates.columns, joined.alias("p_random"))


def ordinary_use(runs: DataFrame) -> dict[str, float]:
    """How often ordinary words use each character: counts over all letter-only runs (at most 52 rows)."""
    words = runs.filter(~F.col("run").rlike("[^A-Za-z]"))
    counted = words.select(F.explode(F.split("run", "")).alias("c")).filter("c != ''").groupBy("c").count().collect()
    return {row["c"]: float(row["count"]) for row in counted}


def _ratios(counts: dict[str, float]) -> dict[str, tuple[str, list[float], float, float]]:
    """By encoding: alphabet, log ratio of uniform to ordinary use per character, mean and variance under ordinary use."""
    found = {}
    for name, alphabet in ENCODINGS.items():
        seen = {c: counts.get(c, 0.0) for c in alphabet}
        if not sum(seen.values()):
            seen = {c: float(c.isalpha()) for c in alphabet}
        whole, uniform = sum(seen.values()), 1 / len(alphabet)
        use = [(1 - UNIFORM_SHARE) * seen[c] / whole + UNIFORM_SHARE * uniform for c in alphabet]
        ratio = [math.log(uniform / u) for u in use]
        mean = sum(u * r for u, r in zip(use, ratio, strict=True))
        found[name] = (alphabet, ratio, mean, sum(u * (r - mean) ** 2 for u, r in zip(use, ratio, strict=True)))
    return found


def _candidates(runs: DataFrame, counts: dict[str, float]) -> DataFrame:
    """Runs with an encoding, as codes, with both p-values."""
    table = _ratios(counts)
    spark = runs.sparkSession
    rows = [(name, alphabet, len(alphabet), ratio, mean, variance) for name, (alphabet, ratio, mean, variance) in table.items()]
    known = spark.createDataFrame(rows, "encoding string, alphabet string, letters int, ratio array<double>, mean double, variance double")
    named = runs.withColumn("encoding", _inferred(F.col("run"))).filter("encoding IS NOT NULL")
    coded = named.join(F.broadcast(known), "encoding").withColumn("_bare", F.rtrim("run", F.lit("=")))
    code = F.transform(F.filter(F.split("_bare", ""), lambda c: c != ""), lambda c: F.position(c, F.col("alphabet")) - 1)
    coded = cut_lineage(coded.withColumn("codes", code).drop("alphabet", "_bare"), "secrets-candidates")
    n = F.size("codes").cast("double")
    score = F.aggregate("codes", F.lit(0.0), lambda s, c: s + F.get("ratio", c))
    tested = battery(coded).withColumn("score", score).withColumn("_z", (F.col("score") - n * F.col("mean")) / F.sqrt(n * F.col("variance")))
    tested = tested.withColumn("with_digit", F.col("run").rlike("[0-9]"))
    tested = tested.withColumn("p_ordinary", F.when(F.col("variance") > 0, normal_tail(F.col("_z"))).otherwise(F.lit(1.0)))
    return tested.withColumn("length_class", F.least(F.floor(F.log2(n) + 1e-9), F.lit(7)).cast("int"))


def discovered(tested: DataFrame, share: float = FALSE_DISCOVERIES) -> DataFrame:
    """The rows that Benjamini-Hochberg finds at `share`, in each stratum of encoding, length class and digits."""
    stratum = ["encoding", "length_class", "with_digit"]
    step = F.least(F.floor(-_STEP * F.log10(F.greatest("p_ordinary", F.lit(1e-300)))), F.lit(_MOST)).cast("int")
    stepped = tested.withColumn("_step", F.greatest(step, F.lit(0)))
    counts = stepped.groupBy(*stratum, "_step").agg(F.count(F.lit(1)).alias("_n"))
    more = Window.partitionBy(*stratum).orderBy(F.desc("_step"))
    whole = Window.partitionBy(*stratum)
    passed = counts.withColumns({"_found": F.sum("_n").over(more), "_all": F.sum("_n").over(whole)})
    passed = passed.filter(F.pow(F.lit(10.0), -F.col("_step") / _STEP) <= share * F.col("_found") / F.col("_all"))
    limits = passed.groupBy(*stratum).agg(F.min("_step").alias("_limit"))
    return stepped.join(F.broadcast(limits), stratum).filter(F.col("_step") >= F.col("_limit")).drop("_step", "_limit")


def random_spans(spans: DataFrame) -> DataFrame:
    """(_row, kind, start, end): runs that look random and not like words."""
    runs = spans.filter("kind = 3")
    found = discovered(_candidates(_tested(runs), ordinary_use(runs))).filter(F.col("p_random") >= RANDOM_LEVEL)
    return _apart(cut_lineage(found.select("_row", "start", "end", "origin", "score"), "secrets-random")).select("_row", F.lit(3).alias("kind"), "start", "end")


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): all spans of every document row, as an array of (start, kind, end) by start and kind."""
    located = _located(docs)
    spans = cut_lineage(_spans(located), "secrets-spans")
    kept = spans.filter("kind < 3").select("_row", "kind", "start", "end").unionByName(random_spans(spans))
    listed = kept.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    rows = located.select("_row", "doc_id").join(listed, "_row", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.select("doc_id", F.coalesce("spans", none).alias("spans"))


def shown(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < 3)


def counted(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
