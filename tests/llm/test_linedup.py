import collections
import random
import re

import pytest

from feedlake.llm import linedup
from tests.llm.fixtures import documents, odd_rows, plain

WORD = "[^\x20\x09-\x0d]+"


def brute(rows, least):
    """Deleted lines by (id, text): in a run of `least` words that begins earlier too, or blank between such lines."""
    places = sorted({(d is not None, d or 0, t) for d, t in rows if t is not None})
    runs, gone = collections.defaultdict(list), collections.defaultdict(set)
    order = {}
    for place, (_, _, text) in enumerate(places):
        lines = [(p, line, len(re.findall(WORD, line))) for p, line in enumerate(text.split("\n"))]
        lines = [x for x in lines if x[2]]
        order[place] = places[place]
        for a in range(len(lines)):
            total = 0
            for z in range(a, len(lines)):
                total += lines[z][2]
                if total >= least:
                    runs[tuple(x[1] for x in lines[a : z + 1])].append((place, lines[a][0], lines[z][0]))
    for where in runs.values():
        first = min(where)[:2]
        for place, a, z in where:
            if (place, a) > first:
                gone[order[place]].update(range(a, z + 1))
    for (_, _, text), cut in gone.items():
        full = [p for p, line in enumerate(text.split("\n")) if re.search(WORD, line)]
        for a, z in zip(full, full[1:]):
            if a in cut and z in cut:
                cut.update(range(a, z))
    return gone


def remaining(rows, least):
    gone = brute(rows, least)
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None))
            continue
        cut = gone.get((d is not None, d or 0, t), set())
        out.append((d, "\n".join(x for p, x in enumerate(t.split("\n")) if p not in cut)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("least", [1, 5, 12])
def test_against_all_runs(spark, seed, least):
    rng = random.Random(seed)
    kinds = ["a b c", "d", "e f", "g h i j", "", " ", "k l"]
    passages = [[rng.choice(kinds) for _ in range(rng.randrange(2, 9))] for _ in range(4)]
    rows = []
    for d in range(14):
        lines = []
        for _ in range(rng.randrange(5)):
            lines += rng.choice(passages) if rng.random() < 0.7 else [f"own {d} {rng.random()}"]
        rows.append((d, "\n".join(lines)))
    # Equal ids with other texts are ordered by hash, which brute() cannot know; ids are unique here.
    found = linedup.without_copies(plain(spark, *rows), least).select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in found), key=repr) == remaining(rows, least)


def test_a_passage_goes_where_it_comes_again(spark):
    passage = "\n".join(f"line {k} of the passage has these nine words" for k in range(7))
    rows = [(1, f"own first\n{passage}\nown last"), (2, f"{passage}"), (3, f"x\n\n{passage}\ny"), (4, "short line\nnew"), (5, "short line\nother")]
    found = {r["doc_id"]: r["text"] for r in linedup.without_copies(plain(spark, *rows)).collect()}
    assert found == {1: rows[0][1], 2: "", 3: "x\n\ny", 4: rows[3][1], 5: rows[4][1]}
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in linedup.deduplicated(plain(spark, *rows)).collect()}
    assert sorted(kept) == [1, 3, 4, 5] and kept[3] == ("x\n\ny", 4)


def test_a_line_that_a_third_of_all_rows_hold(spark):
    hot = " ".join(f"hot{k}" for k in range(60))
    rows = [(i, f"{hot}\nown {i}" if i % 3 else f"own {i}") for i in range(300)]
    found = {r["doc_id"]: r["text"] for r in linedup.without_copies(plain(spark, *rows)).collect()}
    assert all(text == (rows[i][1] if i == 1 else f"own {i}") for i, text in found.items())


def test_odd_rows(spark):
    rows = odd_rows()
    found = linedup.without_copies(plain(spark, *rows)).select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in found), key=repr) == remaining(rows, 50)
    clash = documents(spark, *rows)
    kept = linedup.deduplicated(clash.drop("_id", "_text", "_cuts"))
    assert kept.columns == clash.drop("_id", "_text", "_cuts").columns
    assert kept.filter("doc_id = 5").count() == 0 and kept.filter("doc_id IN (2, 3)").count() == 2


def test_both_ways_to_the_texts(spark):
    """The cuts are broadcast up to a limit; beyond it both sides are shuffled."""
    passage = "\n".join(f"line {n} of a passage" for n in range(20))
    docs = plain(spark, *[(n, f"own {n}\n{passage}\nend {n}") for n in range(30)], (None, passage), (99, "none"))
    ways = [linedup.without_copies(docs, limit_bytes=limit) for limit in (0, 1 << 30)]
    assert [sorted(map(repr, way.collect())) for way in ways][0] == sorted(map(repr, ways[1].collect()))
    shown = [way._jdf.queryExecution().executedPlan().toString() for way in ways]
    assert "ShuffledHashJoin" in shown[0] and "BroadcastHashJoin" in shown[1] and "Exchange hashpartitioning" not in shown[1]


def test_empty_table(spark):
    assert linedup.deduplicated(plain(spark, (1, "a")).filter("doc_id > 1")).count() == 0


def test_native_plan(spark):
    plan = linedup.without_copies(plain(spark, (1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
