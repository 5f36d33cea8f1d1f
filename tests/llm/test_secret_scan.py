import collections
import hashlib
import itertools
import math
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from feedlake.llm import secret_scan
from tests.llm.fixtures import documents, odd_rows, plain, words

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    """(start, kind, end) of the base spans, by the words of the contract."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


def found(spark, docs):
    return [(r["doc_id"], [tuple(s) for s in r["spans"]]) for r in secret_scan.scanned(docs).collect()]


def random_string(rng, alphabet, n):
    return "".join(rng.choice(alphabet) for _ in range(n))


def corpus(seed=1, n=250):
    rng = random.Random(seed)
    rows, planted = [], {}
    for i in range(n):
        text = " ".join(random_string(rng, string.ascii_lowercase[:14], rng.randrange(2, 30)) for _ in range(60))
        if i % 4 == 0:
            alphabet, size = rng.choice([(string.ascii_letters + string.digits, 40), (string.hexdigits[:16], 28), (string.ascii_letters + string.digits + "+/", 44), (string.ascii_uppercase + "234567", 32)])
            secret = random_string(rng, alphabet, size)
            planted[i] = (len(text) + 1, len(text) + 1 + size)
            text += " " + secret + " end"
        if i % 9 == 0:
            text += rng.choice([" token = 'abc.def.ghi'", " API_KEY:x1", " é password==secret=12345678", " AKIA" + "Z9" * 8, " " + "0f" * 16 + "é"])
        rows.append((i, text))
    return rows, planted


def test_base_spans(spark):
    rows = [*corpus()[0], *[(1000 + i, t) for i, t in enumerate([
        "token=secret: abcdefgh12", "TOKEN='aaaaaaaa' Secret = bbbbbbbb", "apikey: \"k.k.k.k.k\"", "\u017fecret=abcdefgh1", "AKIAAKIAAKIAAKIA1 AKIA1",
        "😀 token=abcdefgh 😀 " + "ab" * 20, "f" * 31 + " " + "f" * 32, "passwordpassword=xxxxxxxxx", "api_key==" + "a" * 9, "token\n=abcdefgh",
    ])]]
    got = dict(found(spark, plain(spark, *rows)))
    for doc, text in rows:
        assert [s for s in got[doc] if s[1] < 3] == base(text), text


def test_random_strings_are_found_and_words_are_not(spark):
    rows, planted = corpus(7, 400)
    got = dict(found(spark, plain(spark, *rows)))
    added = {(doc, s[0], s[2]) for doc, spans in got.items() for s in spans if s[1] == 3}
    hidden = {(doc, *span) for doc, span in planted.items()}
    usable = {(d, a, z) for d, a, z in hidden if re.search("[0-9]", rows[d][1][a:z]) and re.search("[A-Za-z]", rows[d][1][a:z])}
    assert len(added & usable) >= 0.95 * len(usable)
    assert all(rows[d][1][a:z] != "" and not rows[d][1][a:z].isalpha() for d, a, z in added)
    extra = {(d, a, z) for d, a, z in added - hidden if not any(a < s[2] and s[0] < z for s in base(rows[d][1]))}
    assert len(extra) <= 0.02 * len(added) + 1


def added_spans(spark, rows):
    return {(doc, s[0], s[2]) for doc, spans in found(spark, plain(spark, *rows)) for s in spans if s[1] == 3}


def test_tokens_in_paths_with_hyphens(spark):
    rng = random.Random(5)
    rows, hidden = corpus(9)[0], set()
    for k in range(40):
        token = random_string(rng, string.ascii_letters + string.digits, 32)
        before = rng.choice(["https://api.example.com/v1/reset-password/", "see path/of_the/file-", "x_y+"])
        rows.append((1000 + k, f"\U0001f600 {before}{token}/end of it"))
        hidden.add((1000 + k, len(before) + 2, len(before) + 34))
    got = {s for s in added_spans(spark, rows) if s[0] >= 1000}
    covered = {h for h in hidden if any(d == h[0] and a < h[2] and h[1] < z for d, a, z in got)}
    assert len(covered) >= 0.95 * len(hidden)
    assert all(z1 <= a2 or z2 <= a1 for d1, a1, z1 in got for d2, a2, z2 in got if d1 == d2 and (a1, z1) != (a2, z2))


def test_tokens_without_a_digit(spark):
    rng = random.Random(6)
    rows = corpus(9)[0]
    hidden = set()
    for k in range(40):
        rows.append((1000 + k, "key " + random_string(rng, string.ascii_letters, 32)))
        hidden.add((1000 + k, 4, 36))
    assert len(hidden & added_spans(spark, rows)) >= 0.9 * len(hidden)


@pytest.mark.parametrize("text", ["a1" * 12, "aaaaaaaaaaaaaaaaaaaa1", "abcdefghijklmnopqrstuvwxyz0123456789", "covid-19-and-the-long-way-home-in-2021"])
def test_patterned_strings_are_not_random(spark, text):
    rows = corpus(3)[0] + [(9999, f"see {text} here")]
    assert dict(found(spark, plain(spark, *rows)))[9999] == []


def test_p_values(spark):
    rng = random.Random(2)
    rows = [([rng.randrange(16) for _ in range(40)], 16) for _ in range(800)] + [([rng.randrange(62) for _ in range(30)], 62) for _ in range(800)]
    p = [r["p_random"] for r in secret_scan.battery(spark.createDataFrame(rows, "codes array<int>, letters int")).collect()]
    assert sum(x < 0.01 for x in p) < 0.05 * len(p) and sum(x < secret_scan.RANDOM_LEVEL for x in p) <= 4
    tails = spark.createDataFrame([(z / 4,) for z in range(-16, 17)], "z double").select("z", secret_scan.normal_tail(F.col("z")).alias("p"))
    import math

    assert all(abs(r["p"] - 0.5 * math.erfc(r["z"] / math.sqrt(2))) < 1e-6 for r in tails.collect())


def test_odd_rows(spark):
    long_text = ("x " * 200 + "token=abcdefgh1 ") * 400
    rows = [*odd_rows(), (20, long_text), (21, "token=abcdefgh"), (21, "token=abcdefgh")]
    got = found(spark, documents(spark, *rows))
    assert len(got) == len(rows)
    assert sorted((d or -1, [s for s in spans if s[1] < 3]) for d, spans in got) == sorted((d or -1, base(t or "")) for d, t in rows)
    assert secret_scan.scanned(plain(spark, (1, "a")).filter("doc_id > 1")).count() == 0


def test_shown(spark):
    row = secret_scan.scanned(plain(spark, (1, "token=abcdefgh " + "0a" * 16))).select(secret_scan.shown(F.col("spans")).alias("s")).first()
    assert row["s"].startswith("assign:0:14,hex:15:47")
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(F.lit(""), 256)).first()[0]


def test_native_plan(spark):
    rows = secret_scan.scanned(plain(spark, (1, words(random.Random(1), 5))))
    assert not re.search("Python|Pandas|Arrow", rows._jdf.queryExecution().executedPlan().toString())


class Twin:
    """The discovery stage in plain Python: (row, start, end) of the runs that look random."""

    run = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")

    def tested(self, row, start, run):
        if not (re.search("[+/]", run) and re.search("[-_]", run)):
            return [(row, start, start + len(run), run, None)]
        out = []
        for foreign in ("[-_]", "[+/]"):
            at = start
            for piece in re.split(foreign, run):
                if len(piece.rstrip("=")) >= 20:
                    out.append((row, at, at + len(piece), piece, start))
                at += len(piece) + 1
        return out

    def encoding(self, run):
        bare = run.rstrip("=")
        kinds = [("hex", "[0-9a-f]+"), ("HEX", "[0-9A-F]+"), ("base32", "[A-Z2-7]+"), ("base62", "[A-Za-z0-9]+"), ("base64", "[A-Za-z0-9+/]+"), ("base64url", "[A-Za-z0-9_-]+")]
        return next((name for name, p in kinds if re.fullmatch(p, bare)), None) if re.search("[A-Za-z]", bare) else None

    def tail(self, z):
        t = 1 / (1 + 0.2316419 * abs(z))
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        upper = math.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
        return upper if z >= 0 else 1 - upper

    def p_random(self, codes, k):
        n = len(codes)
        chi = sum(c * c for c in collections.Counter(codes).values()) * k / n - n
        z_chi = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
        spread = 2 / (9 * k)
        z_chi = min(z_chi, ((max(chi, 0) / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
        high = [2 * c >= k for c in codes]
        mixed = 2 * sum(high) * (n - sum(high))
        runs = 1 + sum(a != b for a, b in itertools.pairwise(high))
        spread = mixed * (mixed - n) / (n * n * (n - 1))
        z_runs = abs(runs - mixed / n - 1) / math.sqrt(spread) if spread > 0 else 8.0
        mean = sum(codes) / n
        variance = sum((c - mean) ** 2 for c in codes)
        lagged = sum((a - mean) * (b - mean) for a, b in itertools.pairwise(codes))
        z_serial = abs(lagged / variance + 1 / (n - 1)) * math.sqrt(n) if variance > 1e-9 else 8.0
        logs = [math.log(max(p, 1e-300)) for p in (self.tail(z_chi), 2 * self.tail(z_runs), 2 * self.tail(z_serial))]
        half = -min(0.0, sum(logs))
        return math.exp(-half) * (1 + half + half * half / 2)

    def found(self, texts):
        runs = [(n, m.start(), m.group()) for n, text in enumerate(texts) for m in self.run.finditer(text)]
        use = collections.Counter("".join(r for *_, r in runs if r.isascii() and r.isalpha()))
        tables = {}
        for name, alphabet in secret_scan.ENCODINGS.items():
            seen = [use[c] for c in alphabet] if sum(use[c] for c in alphabet) else [float(c.isalpha()) for c in alphabet]
            share = [(1 - secret_scan.UNIFORM_SHARE) * s / sum(seen) + secret_scan.UNIFORM_SHARE / len(alphabet) for s in seen]
            ratio = [math.log(1 / len(alphabet) / u) for u in share]
            mean = sum(u * r for u, r in zip(share, ratio, strict=True))
            tables[name] = ratio, mean, sum(u * (r - mean) ** 2 for u, r in zip(share, ratio, strict=True))
        strata = collections.defaultdict(list)
        for row, start, end, run, origin in (part for r in runs for part in self.tested(*r)):
            if not (name := self.encoding(run)):
                continue
            ratio, mean, variance = tables[name]
            codes = [secret_scan.ENCODINGS[name].index(c) for c in run.rstrip("=")]
            score = sum(ratio[c] for c in codes)
            n = len(codes)
            p = self.tail((score - n * mean) / math.sqrt(n * variance)) if variance > 0 else 1.0
            step = max(0, min(math.floor(-10 * math.log10(max(p, 1e-300))), 3000))
            stratum = name, min(math.floor(math.log2(n) + 1e-9), 7), bool(re.search("[0-9]", run))
            strata[stratum].append((step, row, start, end, origin, score, self.p_random(codes, len(ratio))))
        kept = []
        for rows in strata.values():
            fine = [s for s in {r[0] for r in rows} if 10 ** (-s / 10) <= 0.01 * sum(r[0] >= s for r in rows) / len(rows)]
            kept += [r for r in rows if fine and r[0] >= min(fine) and r[-1] >= secret_scan.RANDOM_LEVEL]
        out, parts = [], collections.defaultdict(list)
        for _, row, start, end, origin, score, _ in kept:
            if origin is None:
                out.append((row, start, end))
            else:
                parts[row, origin].append((-score, start, end))
        for (row, _), spans in parts.items():
            taken = []
            for _, start, end in sorted(spans):
                if all(end <= a or b <= start for a, b in taken):
                    taken.append((start, end))
            out += [(row, *span) for span in taken]
        return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_discovery_against_the_twin(spark, seed):
    rng = random.Random(seed)
    alphabets = [*secret_scan.ENCODINGS.values(), string.ascii_lowercase[:9], "abcABC012", string.ascii_letters + string.digits + "+/-_"]
    texts = []
    for _ in range(250):
        pieces = [words(rng, 4)]
        for _ in range(rng.randrange(5)):
            part = random_string(rng, rng.choice(alphabets), rng.randrange(10, 90))
            pieces.append(rng.choice(["", "https://x.org/v1/", "a-b_c/", "key="]) + part + rng.choice(["", "=", "==", "-tail_of/it"]))
        texts.append(rng.choice([" ", "\n", ", "]).join(pieces))
    got = sorted((doc, a, b) for doc, spans in found(spark, plain(spark, *enumerate(texts))) for a, kind, b in spans if kind == 3)
    assert got == Twin().found(texts) and len(got) > 100
