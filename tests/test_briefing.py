import glob
import json

import pytest
from pyspark.sql import functions as F

from feedlake.plans import briefing as br
from feedlake.plans.daily import run_daily
from feedlake.schema import NO_HITS
from feedlake.streaming.streams import write_silver
from tests.helpers import event, events, values

HIT = "qid long, rank int, source string, title string, body string, link string"


def column(spark, expression, **fields):
    rows = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in fields.items()])
    return rows.select(expression.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "answer, want",
    [
        ("x VERDICT: approve", "APPROVE"),
        ("VERDICT: REVISE then not approved", "APPROVE"),
        ("APPROVE but VERDICT: REVISE", "REVISE"),
        ("verdict: approve\nVerdict: revise", "REVISE"),
        ("no marker", "REVISE"),
        ("no marker, disapproved", "APPROVE"),
        ("", "REVISE"),
    ],
)
def test_verdict(spark, answer, want):
    assert column(spark, br.verdict(F.col("a")), a=answer) == want


def test_search_text(spark):
    text = br.search_text(F.col("q"), F.col("c"))
    assert column(spark, text, q="q", c="") == "q"
    assert column(spark, text, q="q", c=None) == "q"
    assert column(spark, text, q="q", c="c" * 300) == f"q (보강 포인트: {'c' * 200})"


def test_contexts(spark):
    asked = spark.createDataFrame([(1,), (2,)], "qid long")
    hits = spark.createDataFrame(
        [(1, 2, "s2", "t2", None, "l2"), (1, 1, "s1", "t1", "b" * 300, "l1")] + [(1, n, "s", "t", "b", "l") for n in range(3, 12)], HIT
    )
    got = dict(values(br.contexts(asked, hits), "qid", "contexts"))
    lines = got[1].split("\n")
    assert lines[:6] == ["[1] (s1) t1", "    " + "b" * 200, "    링크: l1", "[2] (s2) t2", "    ", "    링크: l2"]
    assert lines[-3].startswith("[11]")
    assert got[2] == NO_HITS


def test_offline_answer(spark):
    rows = spark.createDataFrame([(1, "　 a\nb" + "x" * 500 + "\n")], "qid long, p string")
    got = br.answered(rows, "S" * 40, F.col("p"), "out").first()["out"]
    assert got == "[MOCK-LLM] (" + "S" * 24 + "...) 응답:\n" + ("a b" + "x" * 500)[:400]


def hits_for(asked, source="s"):
    return asked.select(
        "qid", F.lit(1).alias("rank"), F.lit(source).alias("source"), F.lit("t").alias("title"), F.col("text").alias("body"), F.lit("l").alias("link")
    )


def test_offline_loop_ends_by_the_cap(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "please approve")], "qid long, query string")
    out = {r["qid"]: r for r in br.run_briefings(asked, hits_for).collect()}
    assert (out[1]["loops"], out[1]["verdict"]) == (2, "APPROVE")
    assert (out[2]["loops"], out[2]["verdict"]) == (1, "APPROVE")
    assert "보강 포인트" in out[1]["contexts"] and "보강 포인트" not in out[2]["contexts"]
    assert out[1]["briefing"].startswith("[MOCK-LLM] (")


@pytest.mark.parametrize("cap", [1, 3, 4])
def test_cap_is_respected(spark, cap):
    asked = spark.createDataFrame([(1, "a")], "qid long, query string")
    assert values(br.run_briefings(asked, hits_for, max_loops=cap), "loops", "verdict") == [(cap, "APPROVE")]


def test_no_queries_give_no_briefings(spark):
    asked = spark.createDataFrame([], "qid long, query string")
    assert br.run_briefings(asked, hits_for).count() == 0


def test_given_model_decides(spark):
    roles = br.Roles()

    def model(system, texts, temperature):
        if system == roles.critic:
            return ["VERDICT: " + ("APPROVE" if "round two" in t or "easy" in t else "REVISE, round two") for t in texts]
        return [f"{temperature}|{t}" for t in texts]

    asked = spark.createDataFrame([(1, "hard"), (2, "easy")], "qid long, query string")
    out = {r["qid"]: r for r in br.run_briefings(asked, hits_for, model, max_loops=5).collect()}
    assert out[1]["loops"] == 2 and out[2]["loops"] == 1
    assert out[1]["briefing"].startswith("0.5|") and out[1]["analysis"].startswith("0.3|")


def test_role_prompts_cannot_decide_by_themselves():
    roles = br.Roles()
    heads = [p[:24].upper() for p in (roles.researcher, roles.analyst, roles.critic, roles.reporter)]
    assert not any("APPROVE" in h or "VERDICT" in h for h in heads)


def test_daily_run(spark, root):
    rows = [event(f"{n:016x}", title=f"Growth report {n}", published=f"2025-11-0{1 + n % 3} 08:00:00") for n in range(9)]
    write_silver(events(spark, *rows), 0, f"{root}/silver")
    for _ in range(2):
        out = run_daily(spark, root, "2025-11-03")
    assert out.count() == 1 and out.first()["loops"] == 2
    assert "링크: https://n/" in out.first()["contexts"]
    files = glob.glob(f"{root}/briefings/dt=2025-11-03/qid=1/*.txt")
    assert "".join(open(f, encoding="utf-8").read() for f in files).startswith("[MOCK-LLM]")
    assert [tuple(r) for r in br.read_briefings(spark, f"{root}/briefings").collect()] == [("2025-11-03", 1, out.first()["briefing"])]
    words = spark.read.schema("token string, freq long, dt date").parquet(f"{root}/gold/gold_daily_keyword")
    assert values(words.withColumn("dt", F.col("dt").cast("string")), "dt", "token", "freq") == [
        ("2025-11-03", "Growth", 3), ("2025-11-03", "report", 3),
    ]
    assert json.dumps([r["loops"] for r in out.collect()]) == "[2]"


def test_briefings_of_several_queries_keep_apart(spark, root):
    rows = [(1, "# One\n\nline\n"), (2, "# Two"), (30, "")]
    br.write_briefings(spark.createDataFrame(rows, "qid long, briefing string"), root, "2025-11-03")
    br.write_briefings(spark.createDataFrame(rows[:1], "qid long, briefing string"), root, "2025-11-04")
    assert values(br.read_briefings(spark, root), "dt", "qid", "briefing") == [
        ("2025-11-03", 1, rows[0][1]), ("2025-11-03", 2, "# Two"), ("2025-11-03", 30, ""), ("2025-11-04", 1, rows[0][1]),
    ]
