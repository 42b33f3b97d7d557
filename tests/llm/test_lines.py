import random

import pytest

from devtrail.llm.lines import SHORT_CHARS, boilerplate_lines, dedup_lines, site_thresholds
from pyspark.sql import functions as F


def brute(rows, sites=None, short=None):
    """rows: (id, text, site). Texts without lines on ``sites`` or more sites
    (``short`` for short lines; by default shares of all sites), but for a
    line's first place."""
    if sites is None:
        n = len({s for _, _, s in rows})
        sites, short = max(2, -(-n // 10)), max(2, -(-3 * n // 10))
    needed = lambda line: (short or sites) if len(line) < SHORT_CHARS else sites
    spread, first = {}, {}
    for i, t, s in rows:
        for p, line in enumerate((t or "").split("\n")):
            line = line.strip(" \t\r")
            if line:
                spread.setdefault(line, set()).add(s)
                first[line] = min(first.get(line, (i, p)), (i, p))
    out = {}
    for i, t, _ in rows:
        keep = [x for p, x in enumerate(t.split("\n")) if len(spread.get(x.strip(" \t\r"), ())) < needed(x.strip(" \t\r")) or first[x.strip(" \t\r")] == (i, p)]
        out[i] = "\n".join(keep)
    return out


def test_random_documents(spark):
    rnd = random.Random(6)
    common = [f"this boilerplate line has the number {k}" for k in range(12)] + ["short", "", "   spaces around this one line  "]
    rows = []
    for i in range(300):
        lines = [f"line {j} of document {i} is its own" for j in range(rnd.randint(0, 4))]
        lines += [f"{x}\r" if rnd.random() < 0.2 else x for x in rnd.choices(common[:1 + i % len(common)], k=rnd.randint(0, 5))]
        rnd.shuffle(lines)
        rows.append((i, "\n".join(lines), f"site{rnd.randint(0, 14)}" if rnd.random() < 0.9 else None))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for sites, short in ((2, None), (6, 9), (13, 3), (None, None)):
        got = {r.doc_id: r.text for r in dedup_lines(df, min_sites=sites, short_sites=short).collect()}
        assert got == brute(rows, sites, short)


@pytest.mark.parametrize("n", [1, 3, 20, 200])
def test_passages_of_few_sites(spark, n):
    """Passages of over 50 words on 2 to 9 sites, and short lines, by the number of sites."""
    rnd = random.Random(n)
    word = lambda: "".join(rnd.choices("abcdefghij", k=6))
    passages = {k: " ".join(word() for _ in range(55)) for k in range(2, 10)}
    rows = [[i, f"own text {word()} of {i} {word()}", f"s{i % n}"] for i in range(max(60, n))]
    for k, text in passages.items():
        for j in range(k):
            rows[j][1] += f"\n{text}"
    for i in range(len(rows)):
        rows[i][1] += "\nshort one" if i % n < 2 else ""
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, source string")).collect()}
    assert got == brute([tuple(r) for r in rows])
    long, short = site_thresholds(n)
    assert (long, short) == {1: (2, 2), 3: (2, 2), 20: (2, 6), 200: (20, 60)}[n]
    for k, text in passages.items():
        places = sum(text in t for t in got.values())
        assert places == (1 if min(k, n) >= long else k)
    shorts = sum("short one" in t for t in got.values())
    assert shorts == 1 if n == 3 else shorts > 1


def test_near_threshold_lines_are_counted_exactly(spark):
    """Estimates over many sites are not exact; the verdict is."""
    n = [4800, 4990, 4999, 5000, 5001, 5010, 5200, 9000, 100]
    lines = spark.range(max(n)).select(F.explode(F.array(*[F.lit(x) for x in n])).alias("line"), "id").where("id < line")
    lines = lines.select(F.col("line").cast("long"), F.lit(0).alias("line2"), F.lit(False).alias("short"), F.xxhash64("id").alias("site"), F.struct("id").alias("at"))
    got = {r.line: r["first"].id for r in boilerplate_lines(lines, 5000).collect()}
    assert got == {x: 0 for x in n if x >= 5000}


def test_odd_rows(spark, odd_docs):
    line = "a line that stands on every one of the sites"
    more = spark.createDataFrame([(100 + k, f"{line}\nown {k}", "en", f"s{k}", 0, k) for k in range(12)] + [(100, f"{line}\nown 0", "en", "s0", 0, 0)], odd_docs.schema)
    out = dedup_lines(odd_docs.union(more).withColumn("gone", F.lit(1)).withColumn("n_lines", F.lit("clash")))
    rows = out.collect()
    assert out.columns == [*odd_docs.columns, "gone", "n_lines", "removed_lines"] and len(rows) == 23
    assert [r.text for r in rows if r.doc_id == 100] == [f"{line}\nown 0"] * 2  # the first place, in both equal rows
    assert all(r.text == f"own {r.doc_id - 100}" and r.removed_lines == 1 for r in rows if (r.doc_id or 0) > 100)
    assert all(r.n_lines == 0 for r in rows if r.text is None) and [(r.doc_id, r.n_lines, r.removed_lines) for r in rows if r.text == ""] == [
        (3, 1, 0), (5, 1, 1)]  # 5 has the one line of 4, on another site
    assert dedup_lines(odd_docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, docs):
    plan = dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
