"""Line dedup: repeated ids and rows, odd and long lines, and the plans of its steps."""

import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from placewise.llm import line_dedup
from tests.llm.test_operators import edit_distance


def deduped(df, **options):
    return Counter(map(tuple, line_dedup.dedupe_lines(df, **options).select("row.doc_id", "n_lines", "n_equal", "n_near", "n_kept", "n_links", "kept_text").collect()))


def brute(ordered, edits=1, least=16):
    """Rows (doc_id, text) in the order of documents."""
    first = {}
    for at, (_, text) in enumerate(ordered):
        for no, line in enumerate(text.split("\n") if text is not None else []):
            first.setdefault(line, (at, no))
    links = {a: [b for b in first if a != b and min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits]
             for a in first}
    out = Counter()
    for at, (doc_id, text) in enumerate(ordered):
        own = sorted((x for x in first if first[x][0] == at), key=first.get)
        near = {x for x in own if any(first[y] < first[x] for y in links[x])}
        n = len(text.split("\n")) if text is not None else 0
        out[doc_id, n, n - len(own), len(near), len(own) - len(near), sum(len(links[x]) for x in own), "\n".join(x for x in own if x not in near)] += 1
    return out


def test_repeated_ids_are_documents_of_their_own(spark):
    df = spark.createDataFrame([(13, "x line\ny line"), (13, "p line\nq line"), (2, "y line\nz line")], "doc_id bigint, text string")
    got = deduped(df)
    assert sum(got.values()) == 3 and got[(2, 2, 0, 0, 2, 0, "y line\nz line")] == 1
    assert got[(13, 2, 0, 0, 2, 0, "p line\nq line")] == 1 and got[(13, 2, 1, 0, 1, 0, "x line")] == 1


def test_equal_rows_and_null_ids(spark):
    rows = [(1, "one line\ntwo line")] * 3 + [(None, "two line\nthree line"), (None, "four line"), (None, None), (5, "")]
    got = deduped(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert got == Counter({(1, 2, 0, 0, 2, 0, "one line\ntwo line"): 1, (1, 2, 2, 0, 0, 0, ""): 2, (None, 2, 1, 0, 1, 0, "three line"): 1,
                           (None, 1, 0, 0, 1, 0, "four line"): 1, (None, 0, 0, 0, 0, 0, ""): 1, (5, 1, 0, 0, 1, 0, ""): 1})


def test_rows_of_one_id_are_ordered_by_their_text_wherever_they_are(spark):
    rows = [(7, f"shared line of all\nown line number {k}") for k in range(20)]
    a = deduped(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    b = deduped(spark.createDataFrame(rows[::-1], "doc_id bigint, text string").coalesce(1))
    assert a == b and sum(n for k, n in a.items() if "shared" in k[-1]) == 1


def test_clashing_columns_and_large_or_negative_ids(spark):
    rows = [(-(1 << 62), "a first line that is here"), (1 << 62, "a first line that is hera\nanother"), (3, "another")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("row", "place", "line", "id", "o_id", "position", "no", "key", "near", "doc", "lines", "a", "b", "_at"):
        df = df.withColumn(name, F.lit(77))
    out = line_dedup.dedupe_lines(df)
    assert deduped(df) == brute(sorted(rows))
    assert out.where("row.place = 77 and row._at = 77 and row.lines = 77").count() == 3


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_edits_of_random_strings(spark, edits):
    rng = np.random.default_rng(edits)
    pairs = []
    for _ in range(600):
        a = "".join(rng.choice(list("abé😀"), rng.integers(0, 14)))
        b = list(a)
        for _ in range(rng.integers(0, edits + 3)):
            k = int(rng.integers(len(b) + 1))
            b[k:k + int(rng.integers(2))] = [str(rng.choice(list("abé😀")))] * int(rng.integers(3))
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame([(a, b, a, b) for a, b in pairs], "p string, q string, a string, b string")
    whole = line_dedup.within_edits(F.col("p"), F.col("q"), edits)
    cut = line_dedup.without_common_ends(df, "a", "b").select("p", "q", whole, line_dedup.within_edits(F.col("a"), F.col("b"), edits))
    for p, q, x, y in cut.collect():
        assert x == y == (edit_distance(p, q) <= edits)


def test_a_pair_costs_time_in_proportion_to_its_lines(spark):
    """The automaton itself, over whole lines that differ at both ends: ten times the length, not a hundred times the time."""
    def seconds(n):
        df = spark.createDataFrame([("a" + "xy" * n + "b", "c" + "xy" * n + "d")] * 6, "a string, b string").coalesce(1)
        df = df.select(line_dedup.within_edits(F.col("a"), F.col("b"), 2).alias("ok"))
        start = time.time()
        assert df.where("ok").count() == 6
        return time.time() - start

    seconds(500)
    short = seconds(500)
    assert seconds(5000) < 10 * short + 2


def test_very_long_lines(spark):
    line = "".join(np.random.default_rng(0).choice(list("abcdefgh "), 30_000))
    rows = [(1, line), (2, line[:15_000] + "Z" + line[15_001:]), (3, "Q" + line[1:-1] + "Q"), (4, line)]
    got = {r[0]: (r[1], r[2]) for r in line_dedup.dedupe_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
           .select("row.doc_id", "n_near", "n_equal").collect()}
    assert got == {1: (0, 0), 2: (1, 0), 3: (0, 0), 4: (0, 1)}


def plan(df, part="toString"):
    return getattr(df._jdf.queryExecution(), part)()


def test_plans_are_native_and_verify_outside_of_joins(odd):
    documents = line_dedup.placed_documents(odd)
    lines = line_dedup.lines_of(documents)
    known = line_dedup.distinct_lines(lines)
    pairs = line_dedup.candidate_pairs(lines)
    judged = line_dedup.judged_pairs(lines, pairs)
    plans = [plan(df) for df in (documents, known, pairs, judged, line_dedup.dedupe_lines(odd))]
    assert not any(re.search("Python|Arrow|Pandas", p) for p in plans)
    tree = judged._jdf.queryExecution().optimizedPlan().toString()
    above = tree[:tree.index("Repartition")]
    assert "aggregate(" in above and "aggregate(" not in tree[tree.index("Repartition"):]
    assert not re.search("Cartesian|NestedLoop", " ".join(plans))


def test_crowded_keys_make_no_pairs_and_lose_no_link(spark, monkeypatch):
    """Lines that share a half with many others are grouped and not paired; counts are those of all pairs."""
    rng = np.random.default_rng(3)
    rows, head = [], "the same first half of "
    for k in range(40):
        tail = list("aabbccddeeffgghhiijjkkl")
        tail[int(rng.integers(23))] = str(rng.choice(list("abxyé😀")))
        rows += [head + "".join(tail), head[:-2] + "".join(tail), "".join(tail) + head, head + "".join(tail[:11] + tail[12:]), head + "x" + "".join(tail)]
        at = int(rng.integers(15, 30))
        rows += [rows[-1][:at] + rows[-1][at + 1:], rows[-2][:at] + rows[-2][at] + rows[-2][at:]]
    docs = [(k, "\n".join(rows[k::20])) for k in range(20)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute(docs)
    for hot in (0, 3):
        monkeypatch.setattr(line_dedup, "HOT", hot)
        assert deduped(df) == want, hot


def test_rows_follow_the_lines_of_a_crowded_key(spark):
    """Many lines that share their first half and differ in more than one edit: no pairs of them."""
    rows = [(k, f"one and the same beginning of a line {k * 7919 % 100003:06d} {k * 104729 % 1000003:07d} end of it") for k in range(400)]
    lines = line_dedup.lines_of(line_dedup.placed_documents(spark.createDataFrame(rows, "doc_id bigint, text string")))
    keys = line_dedup.stored_keys(lines)
    crowded = line_dedup.crowded_keys(keys)
    assert crowded.count() == 1
    sparse = keys.join(crowded, F.col("o_key") == F.col("key"), "left_anti")
    assert line_dedup.candidate_pairs(lines).count() > 50_000 and line_dedup.candidate_pairs(lines, keys=sparse).count() < 2 * len(rows)


def generated(df):
    """Rows out of each Generate of a plan that has run."""
    out = []

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "GenerateExec":
            out.append(node.metrics().apply("numOutputRows").value())
        inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else []
        children = node.children()
        for child in inner + [children.apply(k) for k in range(children.size())]:
            visit(child)

    df.collect()
    visit(df._jdf.queryExecution().executedPlan())
    return out


def test_lines_of_a_crowded_key_are_written_where_another_one_may_differ(spark):
    """Near copies of a long line: rows follow the lines and the few places of the edit, not the length of the line."""
    rng = np.random.default_rng(9)
    base = "".join(rng.choice(list("abcdefgh "), 400))
    inner = [f"{k:04d}" for k in range(300)] + [f"{k:03d}" for k in range(20)]
    rows = [(k, base[:250] + x + base[250:]) for k, x in enumerate(inner)]
    lines = line_dedup.lines_of(line_dedup.placed_documents(spark.createDataFrame(rows, "doc_id bigint, text string")))
    known, keys = line_dedup.distinct_lines(lines), line_dedup.stored_keys(lines)
    links = line_dedup.crowded_links(lines, known, keys, line_dedup.crowded_keys(keys))
    made = generated(links)
    assert made and max(made) <= 20 * len(rows), made
    got = links.join(known, "id").select(F.shiftright("position", line_dedup.LINES_BITS).alias("k"), "n_links", F.shiftright("o_position", line_dedup.LINES_BITS).alias("o")).collect()
    near = {k: [o for o, y in enumerate(inner) if o != k and edit_distance(x, y) <= 1] for k, x in enumerate(inner)}
    assert {r.k: (r.n_links, min(r.k, r.o)) for r in got} == {k: (len(o), min(k, *o)) for k, o in near.items() if o}
